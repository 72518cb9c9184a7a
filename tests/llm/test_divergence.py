"""The divergence audit against whole-number arithmetic term by term."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fareweather.llm import divergence
from fareweather.llm.divergence import audit
from tests.llm.fixtures import documents, lower, no_documents, odd_documents

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def distance(p: int, q: int) -> int:
    return (p - q) * (p - q) // q


def expected(rows, least: int = 3, top: int = 200) -> list[tuple]:
    by_lang: dict = {}
    for row in rows:
        terms = TERM.findall(lower(row["text"] or ""))
        by_lang.setdefault(row["lang"] or "", []).append((row["source"] or "", terms))
    out = []
    for lang, docs in by_lang.items():
        df = Counter(term for _, terms in docs for term in set(terms))
        kept = sorted(term for term, n in df.items() if n >= least)
        counts: dict = {source: Counter() for source, _ in docs}
        for source, terms in docs:
            counts[source].update(term for term in terms if df[term] >= least)

        def shares(count) -> dict:
            return {term: 1 + 10**9 * (count[term] + 1) // (sum(count.values()) + len(kept)) for term in kept}

        own = {source: shares(count) for source, count in counts.items()}
        whole = shares(sum(counts.values(), Counter()))
        for source in counts:
            pairs = [(sum(distance(own[source][t], own[other][t]) for t in kept), other) for other in counts if other != source]
            terms = [(distance(own[source][t], whole[t]), t) for t in kept if counts[source][t] and own[source][t] > whole[t]]
            for part, found in (("pair", pairs), ("term", terms)):
                found.sort(key=lambda f: (-f[0], f[1].encode()))
                out += [(lang, source, part, item, value, rank) for rank, (value, item) in enumerate(found, 1) if part == "pair" or rank <= top]
    return sorted(out)


def result(df) -> list[tuple]:
    assert df.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(tuple(row) for row in df.collect())


def test_odd_documents(spark):
    table = odd_documents(spark)
    assert result(audit(table)) == expected(table.collect())


@pytest.mark.parametrize("least, top, fit_terms", [(1, 3, 500), (2, 7, 30), (5, 200, 12)])
def test_several_fits_and_small_blocks(spark, monkeypatch, least, top, fit_terms):
    monkeypatch.setattr(divergence, "BLOCK_CELLS", 40)
    monkeypatch.setattr(divergence, "BLOCK_SOURCES", 2)
    monkeypatch.setattr(divergence, "BROADCAST_GROUPS", 0)
    monkeypatch.setattr(divergence, "CHUNK_BYTES", 2000)
    monkeypatch.setattr(divergence, "SKETCH", 1)
    dice = random.Random(least)
    words = [f"{a}{b}é" for a in ("Un", "de", "tra", "x") for b in ("ta", "LE", "mo", "s")]
    rows = [
        (i, None if i % 17 == 0 else " ".join(dice.choices(words, range(1, 17), k=dice.randrange(60))), dice.choice(["en", "de", None, "\0"]), dice.choice(["a", "b", "c", "é", None]), "x")
        for i in range(300)
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, TEXT string").repartition(5)
    assert result(audit(table, least, top, fit_terms)) == expected([dict(zip(("i", "text", "lang", "source"), r)) for r in rows], least, top)


def test_language_without_kept_terms(spark):
    table = spark.createDataFrame([(1, "one", "en", "a"), (2, "two", "en", "b"), (3, None, "fr", "c")], "doc_id long, text string, lang string, source string")
    assert result(audit(table)) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_no_rows(spark):
    assert result(audit(no_documents(spark))) == []


def test_documents_of_terms_seen_often_enough_make_the_same_vocabulary(spark):
    """What a fit learns from has a term at or above the minimum exactly if the documents do."""
    table = documents(spark)
    rows = divergence.term_rows(divergence._source(table), 1, 3).filter("weight = 0").collect()
    seen = Counter(name for row in rows for name in row["terms"])
    df = Counter(f"{r['lang'] or ''}\0{term}" for r in table.collect() for term in set(TERM.findall(lower(r["text"] or ""))))
    assert {t for t, n in seen.items() if n >= 3} == {t for t, n in df.items() if n >= 3}


def test_vectors_of_single_documents_add_up_to_what_the_audit_counts(spark):
    table = documents(spark)
    model, vectors = divergence.document_vectors(table, "de")
    sums: Counter = Counter()
    for row in vectors.collect():
        for index, n in zip(row["counts"].indices.tolist(), row["counts"].values.tolist()):
            sums[(row["source"] or "", model.vocabulary[index])] += int(n)
    rows = divergence._source(table)
    made = divergence.term_rows(rows, 1, 3).withColumn("learn", divergence.F.col("weight") == 0)
    entries, names = divergence.group_counts(spark, made, 1, 3)
    found = entries.join(names, "tid").join(rows.select("gid", "source").distinct(), "gid").filter("lang = 'de'")
    assert sums == {(row["source"], row["term"]): row["n"] for row in found.collect()}


@pytest.mark.parametrize("held, once", [(1 << 20, True), (1, False)])
def test_a_task_adds_up_what_its_chunks_count(spark, monkeypatch, held, once):
    monkeypatch.setattr(divergence, "CHUNK_BYTES", 1)
    monkeypatch.setattr(divergence, "HELD_BYTES", held)
    rows = [(f"Ab b{i % 2} c{i} é " * (i % 4), "en" if i % 3 else None, "xy"[i % 2]) for i in range(24)]
    table = divergence._source(spark.createDataFrame(rows, "text string, lang string, source string").coalesce(1))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)
    try:
        made = divergence.term_rows(table, 2, 3).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    gids = {(r["lang"], r["source"]): r["gid"] for r in table.collect()}
    written = Counter((r["gid"], r["weight"], name) for r in made if r["weight"] for name in r["terms"])
    learned = Counter(name for r in made if not r["weight"] for name in r["terms"])
    assert (max(written.values()) == 1 and max(learned.values()) <= 3) == once

    counts, df = Counter(), Counter()
    for text, lang, source in rows:
        terms = [f"{lang or ''}\0{term}" for term in TERM.findall(lower(text))]
        counts.update((gids[lang or "", source], name) for name in terms)
        df.update(set(terms))
    sums: Counter = Counter()
    for (gid, weight, name), n in written.items():
        sums[gid, name] += n * weight
    assert sums == counts
    assert {name: min(n, 3) for name, n in learned.items()} == {name: min(n, 3) for name, n in df.items()}


def test_long_rows_are_cut(monkeypatch):
    monkeypatch.setattr(divergence, "ROW_TERMS", 3)
    names = pa.array([f"en\0t{i}" for i in range(10)])
    term, gid = np.array([*range(10), 0, 1]), np.array([5] * 10 + [9] * 2)
    counts = divergence._Counts(np.arange(10, dtype=np.uint64), names, np.arange(10) % 4, term, gid, np.array([1] * 9 + [3, 1, 2]))
    rows = [row for batch in divergence._rows_of(counts, 1, 3) for row in batch.to_pylist()]
    assert [len(row["terms"]) for row in rows if row["weight"] == 1] == [3, 3, 3, 1, 1]
    assert [(row["gid"], row["terms"]) for row in rows if row["weight"] == 2] == [(5, ["en\0t9"]), (9, ["en\0t1"])]
    assert [len(row["terms"]) for row in rows if not row["weight"]] == [3, 3, 1, 3, 1, 2]


def test_hashes_with_the_same_leading_bits_are_told_apart():
    hashes = np.array([7 << 40, 5, 4, 5, 7 << 40, 4, 1 << 63], np.uint64)
    assert divergence._ascending(hashes).tolist() == np.argsort(hashes, kind="stable").tolist()
    assert divergence._ascending(hashes[:0]).tolist() == []
