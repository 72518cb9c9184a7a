"""Operators on pairs and passages against brute force."""

from __future__ import annotations

import hashlib
import math
import random as dice_of
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fareweather.llm import forest, ngram_join, signature_tree, substrings
from fareweather.llm.components import components
from fareweather.llm.signature_tree import linked
from fareweather.llm.tasks import stored
from fareweather.llm.text import distinct_shingles, mix, text_chunks
from tests.llm.fixtures import documents, lower, no_documents, odd_documents, roots, texts, words


def shingle_set(text: str | None, size: int) -> set[tuple[str, ...]]:
    own = words(lower(text or ""))
    return {tuple(own[i : i + size]) for i in range(max(1, len(own) - size + 1))} - {()}


def similar(a: set, b: set, percent: int) -> bool:
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80), (1, 60)])
def test_jaccard_groups(spark, size, percent):
    rows = texts()
    sets = [shingle_set(t, size) for t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if similar(sets[i], sets[j], percent)]
    assert pairs
    found = ngram_join.groups(documents(spark), size, percent).collect()
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"]) for r in found) == [
        (i, len(sets[i]), root) for i, root in enumerate(roots(len(rows), pairs))
    ]


def test_jaccard_groups_over_many_blocks(spark, monkeypatch):
    rows = texts()
    sets = [shingle_set(t, 3) for t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if similar(sets[i], sets[j], 40)]
    monkeypatch.setattr(ngram_join, "BLOCK_BYTES", 3000)
    found = ngram_join.groups(documents(spark), 3, 40).collect()
    assert dict((r["doc_id"], r["component_id"]) for r in found) == dict(enumerate(roots(len(rows), pairs)))


def test_jaccard_edge_rows(spark):
    assert ngram_join.groups(no_documents(spark), 3, 90).count() == 0
    found = ngram_join.groups(odd_documents(spark), 3, 90)
    assert found.count() == odd_documents(spark).count()
    assert found.filter("doc_id IS NULL AND n_shingles > 5").first()["component_id"] == 0
    assert found.filter("doc_id IS NULL AND n_shingles = 0").first()["component_id"] is None
    nameless = documents(spark).withColumn("doc_id", F.when(F.col("doc_id") < 30, F.col("doc_id")))
    sets = [shingle_set(t, 3) for t in texts()]
    linked_ids = {i for i in range(30) for j in range(30, len(sets)) if similar(sets[i], sets[j], 90)}
    groups = ngram_join.groups(nameless, 3, 90).filter("doc_id IS NULL AND component_id IS NOT NULL")
    assert {r["component_id"] for r in groups.collect()} == linked_ids


def test_parts_never_lose_a_link():
    random = np.random.default_rng(3)
    for percent in (90, 80, 60):
        sets = []
        for _ in range(800):
            n = int(random.integers(1, random.choice([4, 20, 60, 600])))
            one = random.integers(0, 2**63, n, dtype=np.uint64)
            change = int(random.integers(0, max(1, n * (100 - percent) // 100) + 1))
            two = np.concatenate([one[change // 2 :], random.integers(0, 2**63, change // 2, dtype=np.uint64)])
            sets += [np.unique(one), np.unique(two)]
        keys, owners, along = ngram_join.part_keys(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]), percent)
        own: list[dict[int, set[int]]] = [{} for _ in sets]
        for key, owner, value in zip(keys.tolist(), owners.tolist(), along.tolist()):
            own[owner].setdefault(value, set()).add(key)
        for i in range(0, len(sets), 2):
            if similar(set(sets[i].tolist()), set(sets[i + 1].tolist()), percent):
                for one, two in ((own[i], own[i + 1]), (own[i + 1], own[i])):
                    others = set().union(*two.values())
                    assert any(len(part & others) >= value & 0xFFFF for value, part in one.items())


def test_signature_trees_connect_what_links(monkeypatch):
    random = np.random.default_rng(0)
    for trial in range(60):
        monkeypatch.setattr(signature_tree, "FAN", int(random.choice([2, 3, 8])))
        monkeypatch.setattr(signature_tree, "BLOCK", int(random.choice([256, 1 << 16])))
        percent, n = int(random.choice([50, 80, 90])), int(random.integers(2, 60))
        bases = [random.integers(0, 2000, random.integers(1, 60)) for _ in range(5)]
        sets = [np.unique(mix(np.append(bases[random.integers(5)], random.integers(0, 2000, random.integers(0, 4))).astype(np.uint64))) for _ in range(n)]
        side = random.integers(0, 2, n) if trial % 3 == 0 else None
        if side is not None and len(set(side.tolist())) < 2:
            side = None
        known = random.integers(0, n, n) if trial % 2 else np.arange(n)
        found = linked(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]), percent, known, side)
        before = [(i, j) for i in range(n) for j in range(i) if known[i] == known[j]]
        true = [
            (i, j)
            for i in range(n)
            for j in range(i)
            if similar(set(sets[i].tolist()), set(sets[j].tolist()), percent) and (side is None or side[i] != side[j])
        ]
        assert {tuple(sorted(p)) for p in found.tolist()} <= {tuple(sorted(p)) for p in true}
        assert roots(n, true + before) == roots(n, [tuple(p) for p in found.tolist()] + before)


def test_keep_one_of_each_group(spark):
    kept = ngram_join.keep_one(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns
    ids = sorted(r["doc_id"] for r in kept.select("doc_id").collect() if r["doc_id"] is not None)
    groups = ngram_join.groups(documents(spark), 5, 80)
    assert ids == sorted(r["doc_id"] for r in groups.filter("doc_id = component_id").collect())


def test_rows_are_judged_by_their_own_text(spark):
    """Other texts of an id stay; of copies the one of least id does, whatever its other rows."""
    dice = dice_of.Random(2)
    a, b, c = (" ".join(f"w{dice.randrange(10**6)}" for _ in range(40)) for _ in range(3))
    rows = [(0, a), (1, a), (1, b), (2, c), (2, c), (None, b), (None, c + " more"), (None, "own words of no one else at all"), (3, ""), (3, ""), (None, None)]
    for order in (rows, rows[::-1]):
        kept = ngram_join.keep_one(spark.createDataFrame(order, "doc_id long, text string").repartition(3))
        found = sorted((tuple(r) for r in kept.collect()), key=repr)
        assert found == sorted([(0, a), (1, b), (2, c), (None, "own words of no one else at all"), (3, ""), (3, ""), (None, None)], key=repr)


def test_the_traversal_decides(spark):
    """On the given table links are found by the trees, which drop pairs of nodes without looking at their sets."""
    texts_of = [r["text"] for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    batch = pa.array(texts_of, pa.string())
    chunks = list(text_chunks(batch))
    values, offsets = zip(*(distinct_shingles(chunk, 3, True) for chunk in chunks))
    sets = [v[a:b] for v, o in zip(values, offsets) for a, b in zip(o[:-1], o[1:]) if b > a]
    join = signature_tree.Join(np.concatenate(sets), np.concatenate([[0], np.cumsum([len(s) for s in sets])]), 90, None, None)
    links = join.run()
    assert len(links) >= 20 and join.dropped > 10 * len(sets) and join.compared < len(sets)


def test_components_of_long_paths_and_stars(spark):
    pairs = [(i, i + 1) for i in range(200)] + [(1000, i) for i in range(1001, 1100)] + [(5000, 5000), (None, 3)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert found == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1100), 1000), 5000: 5000}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- repeated passages ------------------------------------------------------------------------


def kept_words(rows: list[str | None], window: int) -> list[list[str]]:
    seen, covered = set(), [set() for _ in rows]
    for i, text in enumerate(rows):
        own = words(text)
        for s in range(len(own) - window + 1):
            key = tuple(own[s : s + window])
            if key in seen:
                covered[i].update(range(s, s + window))
            seen.add(key)
    return [[w for k, w in enumerate(words(t)) if k not in covered[i]] for i, t in enumerate(rows)]


@pytest.mark.parametrize("window", [4, 8, 20, 64])
def test_passages_are_removed(spark, window):
    rows = texts()
    expected = kept_words(rows, window)
    assert sum(map(len, expected)) < sum(len(words(t)) for t in rows)
    found = {r["doc_id"]: r for r in substrings.dedup(documents(spark).select("doc_id", "text"), window).collect()}
    for i, own in enumerate(expected):
        assert found[i]["kept_text"] == " ".join(own), i
        assert (found[i]["n_words"], found[i]["n_removed"]) == (len(words(rows[i])), len(words(rows[i])) - len(own))


def test_passages_in_many_small_batches(spark, monkeypatch):
    monkeypatch.setattr(substrings, "ROWS_PER_RUN", 50)
    rows = texts()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        found = {r["doc_id"]: r["kept_text"] for r in substrings.dedup(documents(spark).select("doc_id", "text")).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert found == {i: " ".join(own) for i, own in enumerate(kept_words(rows, 20))}


def test_passages_edge_rows(spark):
    odd = odd_documents(spark)
    out = substrings.drop_repeats(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    twice = out.filter("doc_id = 0").select("text").collect()
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0]["text"] == texts()[0]
    assert out.filter("doc_id IS NULL AND text = ''").count() == 1  # its words stand in document 0
    assert substrings.drop_repeats(no_documents(spark)).count() == 0
    nameless = documents(spark).withColumn("doc_id", F.lit(None).cast("long"))
    left = substrings.dedup(nameless).agg(F.sum("n_words") - F.sum("n_removed")).first()[0]
    kept = substrings.dedup(nameless).collect()
    assert len(kept) == len(texts()) and sum(len(words(r[-1])) for r in kept) == left  # the last column of that name
    assert left < sum(len(words(t)) for t in texts()) - 400  # of equal texts one stays


def test_digest_query_is_derived_from_the_operator(spark, folder):
    documents(spark).write.parquet(f"{folder}/documents.parquet")
    expected = kept_words(texts(), 20)
    for row in substrings.op8_substring_dedup(spark, folder).collect():
        assert row["kept_sha256"] == hashlib.sha256(" ".join(expected[row["doc_id"]]).encode()).hexdigest()


# --- embeddings -------------------------------------------------------------------------------


def vectors(n: int = 400, dim: int = 16) -> list[tuple]:
    random = np.random.default_rng(5)
    rows = []
    for i in range(n):
        if i % 4 or i < 8:
            v = random.normal(size=dim)
        else:
            v = np.array(rows[i // 8 * 2][1]) + random.normal(scale=0.02, size=dim)
        rows.append((i, [float(x) for x in v], int(i % 3) if i % 4 else int(i // 8 * 2 % 3)))
    rows += [(n, rows[0][1], rows[0][2]), (n + 1, rows[0][1], rows[0][2]), (n + 2, [2 * x for x in rows[0][1]], rows[0][2])]
    rows += [(n + 3, None, 1), (n + 4, [], 1), (n + 5, [0.0] * dim, 1), (n + 6, [0.0] * dim, 1), (n + 7, [math.nan] * dim, 1)]
    rows += [(n + 8, [None] * dim, 1), (n + 9, rows[0][1], None), (n + 10, rows[0][1], None), (n + 11, rows[0][1][:8], rows[0][2])]
    return rows


def expected_links(rows: list[tuple], cosine: float) -> list[tuple[int, int]]:
    usable = [
        r[1] is not None and len(r[1]) > 0 and None not in r[1] and bool(np.isfinite(r[1]).all()) and any(r[1]) and r[2] is not None
        for r in rows
    ]
    return [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if usable[i] and usable[j] and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1])
        and np.dot(rows[i][1], rows[j][1]) / (np.linalg.norm(rows[i][1]) * np.linalg.norm(rows[j][1])) >= cosine
    ]


@pytest.mark.parametrize(("leaf", "block"), [(512, 4096), (40, 4096), (16, 60), (16, 9)])
def test_vector_groups(spark, monkeypatch, leaf, block):
    monkeypatch.setattr(forest, "LEAF", leaf)
    monkeypatch.setattr(forest, "BLOCK_BYTES", block * 16 * 8)
    rows = vectors()
    pairs = expected_links(rows, 0.9)
    degree = Counter(x for pair in pairs for x in pair)
    found = forest.groups(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), 0.9).collect()
    by_id = {r["vec_id"]: r for r in found}
    assert len(found) == len(rows)
    got = sum(r["n_links"] for r in found)
    assert all(by_id[i]["n_links"] <= degree[i] for i in by_id) and got >= 0.95 * sum(degree.values())
    if leaf == 512:
        assert all(by_id[i]["n_links"] == degree[i] for i in by_id)
        assert [by_id[i]["component_id"] for i in range(len(rows))] == roots(len(rows), pairs)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def planted(random: np.random.Generator, n: int, dim: int, common: float) -> tuple[np.ndarray, list[tuple[int, int]]]:
    """Vectors with cosine ``common`` to each other, and pairs of them at 0.931 to 0.94."""
    centre = unit(random.normal(size=(1, dim)))
    x = unit(np.sqrt(common) * centre + np.sqrt(1 - common) * unit(random.normal(size=(n, dim))))
    pairs = [(2 * i, 2 * i + 1) for i in range(n // 20)]
    for a, b in pairs:
        aside = random.normal(size=dim)
        aside -= aside @ x[a] * x[a]
        c = random.uniform(0.931, 0.94)
        x[b] = c * x[a] + np.sqrt(1 - c * c) * aside / np.linalg.norm(aside)
    return x, pairs


@pytest.mark.parametrize("common", [0.0, 0.5, 0.7])
def test_recall_near_the_threshold_at_shipped_constants(common):
    """One label of 24,000 vectors; the given tables hold no link."""
    x, pairs = planted(np.random.default_rng(11), 24_000, 64, common)
    found, rows = set(), 0
    for leaf in forest.leaves(x, 77, forest.TREES, 0.93):
        rows += len(leaf)
        for p, q in forest.close(x[leaf], 0.93):
            found.update(zip(leaf[p].tolist(), leaf[q].tolist()))
    met = sum((a, b) in found or (b, a) in found for a, b in pairs)
    assert met >= 0.95 * len(pairs)
    assert len(x) < rows <= 20 * forest.TREES * len(x)


@pytest.mark.parametrize("n", [5_000, 20_000, 80_000])
@pytest.mark.parametrize("common", [0.8, 0.9])
def test_dense_labels_are_not_cut_for_ever(n, common):
    """A cut that most points would cross on both sides is given up: a dense label is one part, once."""
    random = np.random.default_rng(n)
    centre = unit(random.normal(size=(1, 64)))
    x = unit(np.sqrt(common) * centre + np.sqrt(1 - common) * unit(random.normal(size=(n, 64))))
    assert sum(len(leaf) for leaf in forest.leaves(x, n, forest.TREES, 0.93)) <= 2 * n


@pytest.mark.parametrize("block", [1 << 20, 1 << 17])
def test_recall_where_labels_are_cut_by_spark(spark, monkeypatch, block):
    """One label that is too large for a task, cut in rounds and compared in parts."""
    monkeypatch.setattr(forest, "BLOCK_BYTES", block)
    x, pairs = planted(np.random.default_rng(12), 6_000, 64, 0.2)
    table = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)], "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: r["component_id"] for r in forest.groups(table, 0.93).collect()}
    assert sum(found[a] == found[b] for a, b in pairs) >= 0.95 * len(pairs)
    linked = sum(vec_id != component for vec_id, component in found.items())
    assert linked <= len(pairs)


def test_dense_label_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(forest, "BLOCK_BYTES", 64 * 8 * 150)
    random = np.random.default_rng(13)
    x = unit(np.sqrt(0.92) * unit(random.normal(size=(1, 64))) + np.sqrt(0.08) * unit(random.normal(size=(700, 64))))
    table = spark.createDataFrame([(i, v.tolist(), "x") for i, v in enumerate(x)], "vec_id long, embedding array<double>, label string")
    near = np.triu(x @ x.T >= 0.93, 1)
    degree = (near | near.T).sum(axis=1)
    for row in forest.groups(table, 0.93).collect():
        assert row["n_links"] == degree[row["vec_id"]]


def test_vector_edge_rows(spark):
    schema = "vec_id long, embedding array<float>, label int, rid long, v binary"
    assert forest.groups(spark.createDataFrame([], schema), 0.93).count() == 0
    rows = [(1, [1.0, 0.0], 1, None, None), (1, [1.0, 0.0], 1, None, None), (None, [2.0, 0.0], 1, None, None), (None, None, None, None, None)]
    found = forest.groups(spark.createDataFrame(rows, schema), 0.93).orderBy(F.col("vec_id").desc()).collect()
    assert [tuple(r) for r in found[:2]] == [(1, 2, 1, True)] * 2
    assert sorted((r["n_links"], r["component_id"], r["kept"]) for r in found[2:] if r["component_id"]) == [(2, 1, False)]
    assert [r for r in found if r["component_id"] is None and r["n_links"] == 0 and not r["kept"]]


def test_many_rows_of_one_id_cost_no_more_than_own_ids(spark):
    """What was found of a row goes back to rows of its id and text alone, not to all rows of the id."""
    dice = dice_of.Random(9)
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [f"{passage} " + " ".join(f"w{dice.randrange(10**6)}" for _ in range(30)) for _ in range(200)]
    out = []
    for ids in ([5] * 200, list(range(200))):
        table = spark.createDataFrame(list(zip(ids, rows)), "doc_id long, text string").repartition(4)
        found = stored(substrings.anchored(table, 20))
        hits = substrings.repeated_anchors(found.select("key", "f1", "anchors"))
        assert hits.count() == 200 and hits.agg(F.max(F.size("hits"))).first()[0] <= 2 * 15
        out.append(substrings.dedup(table).agg(F.sum("n_removed"), F.count("*")).first())
    assert out[0] == out[1] == (199 * 30, 200)
