"""Classifiers and scores: held-out accuracy, brute force, and awkward rows."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fareweather.llm import language, maxent, passages, rules, toxicity
from fareweather.llm.text import text_chunks
from tests.llm.fixtures import documents, lower, no_documents, odd_documents, texts, words

DATA = "/root/testdata/sf0.1"


def fold(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 5


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


def right_share(scored, labels, label, held_out=True):
    joined = scored.filter(F.col("held_out") == held_out).join(labels.select("doc_id", label), "doc_id")
    return joined.agg(F.avg((F.col("predicted") == F.col(label)).cast("int"))).first()[0]


# --- rules ------------------------------------------------------------------------------------


def test_base_counts(spark):
    rows = texts()
    for row in rules.quality(documents(spark)).collect():
        text = rows[row["doc_id"]] or ""
        own = words(text)
        windows = Counter(tuple(own[i : i + 3]) for i in range(len(own) - 2))
        covered = {i + k for i in range(len(own) - 2) if windows[tuple(own[i : i + 3])] > 1 for k in range(3)}
        lines = [line for line in text.split("\n") if words(line)]
        expected = (len(own), sum(map(len, own)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))
        assert tuple(row[name] for name in rules.COUNTS) == expected
        failed = len(own) < 50 or 100 * len(covered) > 50 * len(own)
        assert row["base_failed"] == failed and not (failed and row["kept"])


def test_votes_decide_by_accuracy():
    random = np.random.default_rng(2)
    good = random.random(5000) < 0.85
    votes = np.ones((5000, 6), int)
    junk = random.integers(0, 4, 5000)
    for second in (0, 1):  # each kind of junk is seen by two rules and passes all others
        votes[~good, junk[~good] + second] = -1
    votes[random.random((5000, 6)) < 0.05] = 0
    patterns, weights = np.unique(votes, axis=0, return_counts=True)
    prior, table = rules.fit_votes(patterns, weights.astype(float))
    kept = rules.posterior_odds(votes, prior, table) >= 0
    assert (kept == good).mean() > 0.97


def test_fit_is_the_same_at_every_size():
    patterns = np.array([[1, 1], [-1, 1], [0, 1]])
    small = rules.fit_votes(patterns, np.array([80.0, 15.0, 5.0]))
    large = rules.fit_votes(patterns, np.array([80.0, 15.0, 5.0]) * 1e9)
    assert small[0] == pytest.approx(large[0]) and np.allclose(small[1], large[1])


def test_rules_tell_junk_from_text(corpus, labels):
    judged = rules.quality(corpus).join(labels, "doc_id").filter("n_words >= 50")
    assert judged.filter("quality = 1 AND NOT kept").count() <= 0.005 * judged.filter("quality = 1").count()
    assert judged.filter("quality = 0 AND kept").count() <= 0.05 * judged.filter("quality = 0").count()


def test_rules_edge_rows(spark):
    assert rules.quality(no_documents(spark)).count() == 0
    odd = odd_documents(spark)
    kept = rules.keep_good(odd)
    assert kept.columns == odd.columns
    assert kept.count() == rules.quality(odd).filter("kept").count() > 0
    assert rules.keep_good(no_documents(spark)).count() == 0


# --- language ---------------------------------------------------------------------------------


def test_language_on_held_out_rows(corpus):
    found = language.predict(corpus, language.train(corpus))
    rows = found.join(corpus.select("doc_id", "lang"), "doc_id").filter("held_out")
    assert rows.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.99
    assert all(r["held_out"] == (fold(r["doc_id"]) == 0) for r in found.limit(200).collect())


def test_folded_weights_equal_the_kernel_with_landmarks():
    random = np.random.default_rng(1)
    seen = random.random((30, 1 << language.BITS)) < 0.02
    shared = language.kernel(seen, seen[:7])
    assert shared[3, 3] == pytest.approx(1) and (shared <= 1.0001).all()
    scaled = random.normal(size=(7, 2)).astype(np.float32)
    folded = seen[:7].T.astype(np.float32) @ (scaled / np.sqrt(seen[:7].sum(axis=1))[:, None])
    model = language.Model(["a", "b"], folded.astype(np.float32))
    best, _ = model.decide(seen)
    margins = shared @ scaled
    clear = np.abs(margins[:, 0] - margins[:, 1]) > 1e-3
    clear &= (np.abs(margins) < 0.99).all(axis=1)
    assert (best == margins.argmax(axis=1))[clear].all()


@pytest.mark.parametrize("text", ["a", "ab", "é", "abc", "abcd"])
def test_language_of_one_tiny_text(spark, text):
    rows = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    found = language.predict(rows, language.train(rows)).collect()
    assert [(r["doc_id"], r["lang_pred"]) for r in found] == [(1, "en")]
    chunk = next(text_chunks(pa.array([text])))
    grams = sum(len(text.encode()) - size + 1 for size in range(1, min(4, len(text.encode())) + 1))
    assert language.presence(chunk).sum() == grams


def test_language_edge_rows(spark):
    odd = odd_documents(spark)
    found = language.predict(odd, language.train(odd))
    assert found.count() == odd.count()
    rows = {r["doc_id"]: r for r in found.collect() if r["doc_id"] is not None}
    for i, text in enumerate(texts()):
        assert (rows[i]["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", text or "")), i
        assert 0 <= rows[i]["score"] <= 1
    nothing = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert language.predict(nothing, language.train(nothing)).filter("lang_pred != 'und'").count() == 0
    assert language.predict(no_documents(spark), language.train(odd)).count() == 0
    kept = language.keep_identified(odd)
    assert kept.columns == odd.columns and kept.count() == found.filter("lang_pred != 'und'").count()


def test_stage_rejects_what_was_never_learned(spark, corpus):
    dice = random.Random(3)
    gibberish = [" ".join("".join(dice.choices("abcdefghijklmnopqrstuvwxyz", k=dice.randint(2, 9))) for _ in range(80)) for _ in range(40)]
    greek = [" ".join("".join(dice.choices("αειουντσρκλμπ", k=dice.randint(2, 9))) for _ in range(80)) for _ in range(40)]
    planted = spark.createDataFrame([(10**9 + i, t, None) for i, t in enumerate(gibberish + greek)], "doc_id long, text string, lang string")
    clean = corpus.filter("size(split(text, ' ')) >= 50").select("doc_id", "text", "lang")
    unlearned = clean.withColumn("lang", F.when(F.col("lang") != "de", F.col("lang")))
    kept = {r["doc_id"] for r in language.keep_identified(unlearned.unionByName(planted)).select("doc_id").collect()}
    assert not any(i >= 10**9 for i in kept)
    rows = [(r["doc_id"] in kept, r["lang"]) for r in clean.select("doc_id", "lang").collect()]
    assert sum(k for k, lang in rows if lang == "de") < 0.1 * sum(lang == "de" for _, lang in rows)
    assert sum(k for k, lang in rows if lang != "de") > 0.995 * sum(lang != "de" for _, lang in rows)
    alone = clean.filter("lang = 'en'").unionByName(planted)
    kept = {r["doc_id"] for r in language.keep_identified(alone).select("doc_id").collect()}
    assert not any(i >= 10**9 for i in kept) and len(kept) > 0.995 * sum(lang == "en" for _, lang in rows)


def test_stage_keeps_texts_where_no_language_could_be_learned(spark):
    nothing = documents(spark).withColumn("lang", F.lit(None).cast("string"))
    held = documents(spark).withColumn("doc_id", F.lit(next(i for i in range(99) if fold(i) == 0)).cast("long"))
    lettered = sum(any(c.isalpha() for c in t or "") for t in texts())
    for df in (nothing, held):
        kept = language.keep_identified(df)
        assert kept.columns == df.columns and kept.count() == lettered


# --- quality and toxicity ---------------------------------------------------------------------


def test_quality_on_held_out_rows(spark, corpus, labels):
    scored = passages.op1_quality_mil(spark, DATA)
    assert scored.count() == corpus.count()
    assert right_share(scored, labels, "quality") > 0.98


def test_attention_slopes():
    random = np.random.default_rng(4)
    model = {k: v.astype(float) + random.normal(scale=0.1, size=v.shape) for k, v in passages.start_weights().items()}
    x, first = random.normal(size=(9, passages.INPUTS)), np.array([0, 2, 3, 9])
    label, weight = np.array([1, 0, 1]), np.array([1.0, 2.0, 0.5])

    def loss():
        p = passages.forward(model, x, first)["score"]
        return -(weight * (label * np.log(p) + (1 - label) * np.log(1 - p))).sum() / weight.sum()

    slopes = passages.slopes(model, x, first, label, weight)
    for name in model:
        at = tuple(random.integers(0, n) for n in model[name].shape)
        model[name][at] += 1e-5
        up = loss()
        model[name][at] -= 2e-5
        down = loss()
        model[name][at] += 1e-5
        assert slopes[name][at] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_toxicity_on_held_out_rows(spark, corpus, labels):
    scored = toxicity.op9_toxicity(spark, DATA)
    assert scored.count() == corpus.count()
    assert right_share(scored, labels, "toxic") > 0.92
    clean = scored.filter("held_out").join(labels, "doc_id").filter("toxic = 0")
    assert clean.filter("predicted = 1").count() <= 0.02 * clean.count()


def test_ftrl_is_sparse_and_finds_the_signal():
    random = np.random.default_rng(0)
    learner = toxicity.Ftrl(1000, toxicity.Rates())
    for i in range(2000):
        row = np.unique(np.append(random.integers(10, 1000, 30), 3 if i % 5 == 0 else 4)).astype(np.int32)
        learner.learn(row, int(i % 5 == 0), 1.0)
    w = learner.weights(np.arange(1001))
    assert w[3] > 1 and w[3] == w.max() and (w[10:1000] == 0).mean() > 0.3


def test_toxicity_depends_on_the_ratio_of_weights_alone(spark, corpus, labels):
    some = toxicity.labelled_sample(corpus, labels, "toxic", 300)
    sample = some.withColumn("weight", F.when(F.col("label") == 0, 7.0).otherwise(1.0)).cache()
    models = [toxicity.train(sample.withColumn("weight", F.col("weight") * times)) for times in (1, 10, 100)]
    for model in models[1:]:
        assert model.keys() == models[0].keys()
        assert all(w == pytest.approx(models[0][k], abs=1e-9) for k, w in model.items())


@pytest.mark.parametrize("operator", ["quality", "toxicity"])
def test_classifier_edge_rows(spark, operator):
    odd = odd_documents(spark)
    n = len(texts())
    labels = spark.createDataFrame([(i, i % 2, (i // 2) % 2) for i in range(n)] + [(1, 0, 1), (None, 1, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    module, label = (passages, "quality") if operator == "quality" else (toxicity, "toxic")
    for given in (labels, labels.limit(0), labels.filter(F.col(label) == 1)):
        sample = module.labelled_sample(odd, given, label, 20)
        assert all(fold(r["doc_id"]) != 0 for r in sample.collect())
        model = module.train(sample)
        scored = module.score(odd, model)
        assert scored.count() == odd.count()
        assert scored.filter("score < 0 OR score > 1 OR score IS NULL OR held_out IS NULL").count() == 0
        assert module.score(no_documents(spark), model).count() == 0


# --- language model ---------------------------------------------------------------------------


def base_scores(rows: list[tuple[int | None, str | None]]):
    counts, n = Counter(), 0
    for doc_id, text in rows:
        if doc_id is not None and fold(doc_id) != 1:
            counts.update(words(lower(text or "")))
            n += 1
    if n:
        counts["\n"] = n
    total, types = sum(counts.values()), len(counts)
    for doc_id, text in rows:
        own = words(lower(text or "")) + ["\n"]
        score = sum(math.log10((counts[w] + 0.5) / (total + 0.5 * (types + 1))) for w in own)
        yield doc_id, len(own), sum(counts[w] > 0 for w in own), total, score


@pytest.mark.parametrize("frequent", [1 << 18, 40, 0])
def test_base_scores(spark, monkeypatch, frequent):
    monkeypatch.setattr(maxent, "FREQUENT", frequent)
    odd = odd_documents(spark)
    rows = [(r["doc_id"], r["text"]) for r in odd.select("doc_id", "text").collect()]
    found = maxent.lm_scores(odd).collect()
    key = lambda r: (r[0] is None, r[0], r[1], r[4])
    got = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"]) for r in found), key=key)
    for a, b in zip(got, sorted(base_scores(rows), key=key), strict=True):
        assert a[:4] == b[:4] and a[4] == pytest.approx(b[4], rel=1e-9)
    assert all(r["score"] < 0 and r["held_out"] == (r["doc_id"] is None or fold(r["doc_id"]) == 1) for r in found)


def test_model_beats_the_base_on_held_out_rows(spark, corpus):
    scores = maxent.lm_scores(corpus).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert scores[0] > 0.95 * scores[1]  # both are negative


def test_units_have_a_distribution():
    random = np.random.default_rng(3)
    w = random.normal(size=(maxent.ROWS, maxent.WIDTH)).astype(np.float32)
    n = maxent.UNITS
    context = tuple(np.full(n, c, np.int32) for c in (5, 900))
    tokens = maxent.Tokens(np.arange(n, dtype=np.int32), np.zeros(n, int), context)
    assert (10 ** maxent.unit_log_probs(w, tokens)).sum() == pytest.approx(1, rel=1e-4)


def test_the_third_unit_before_tells():
    dice = np.random.default_rng(6)
    text = next(text_chunks(pa.array([" ".join("w" for _ in range(30_000))])))
    kinds = dice.integers(1, 9, 30_000)
    kinds[3:] = np.where(np.arange(3, 30_000) % 4 == 3, kinds[:-3], kinds[3:])  # a copy of the third before
    tokens = maxent.tokens_of(text, (kinds * maxent.WIDTH).astype(np.int32))
    learner = maxent.Learner(np.zeros((maxent.ROWS, maxent.WIDTH), np.float32))
    learner.learn(tokens)
    plain = maxent.Tokens(tokens.unit, tokens.doc, tokens.context[:2])
    other = maxent.Learner(np.zeros((maxent.ROWS, maxent.WIDTH), np.float32))
    other.learn(plain)
    assert maxent.unit_log_probs(learner.w, tokens).sum() > 0.97 * maxent.unit_log_probs(other.w, plain).sum()


def test_language_model_without_training_rows(spark):
    assert maxent.lm_scores(no_documents(spark)).count() == 0
    found = maxent.lm_scores(documents(spark).withColumn("doc_id", F.lit(None).cast("long"))).collect()
    assert len(found) == len(texts()) and all(r["n_known"] == 0 and r["train_tokens"] == 0 for r in found)
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in found)
