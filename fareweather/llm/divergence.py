"""Source divergence audit: how far the words of each source are from those of the others.

Every language has one vocabulary, the terms in at least ``MIN_DOCUMENTS`` of its documents.
``CountVectorizer`` with a minimum document frequency and the largest integer as vocabulary size
finds the vocabulary and makes sparse vectors of the documents; these are summed by (language,
source), and the sparse sums are evaluated pair by pair. All arithmetic is in whole numbers.

How it is laid out: a term counts as ``language, NUL, term``, so that one fit holds the
vocabularies of all languages, however many there are. A fit keeps its vocabulary on the driver
and broadcasts it, so terms are dealt by hash to as many fits as needed for each to see about
``FIT_TERMS`` different terms at most; how many there can be is measured first, on one document in
``SKETCH``. The term table is stored by fit, so that each reads its own terms only.

Two things save work and change no count. A fit need not know all documents of a frequent term: of
the documents that a task holds the counts of, it gets, for i up to the minimum frequency, one
document of the terms that at least i of them have, which has the same terms at or above the
minimum. And the documents of a group that meet there are added up before they become vectors:
their terms are written once for each binary digit of their counts, as documents with weights 1, 2,
4, ..., whose vectors times their weights add up to the sum of the documents' own vectors.
``document_vectors`` makes these. A task counts a few megabytes of text at once and adds such counts
up to a number of bytes, which is some fifty megabytes of text.

Sums are added up within tasks before they are shuffled, so a source with a third of all documents
is no group of its own. Pairs are evaluated in blocks of terms of one language with a bounded
number of cells (terms times sources). A pair of sources is evaluated from the terms that the first
one has: for them, and for no others, its share differs from that of a term it lacks. What a block
adds to the pair (g, h) is

    sum over the terms of g of  f(p_g, p_h) - f(p_g of a missing term, p_h)
    + sum over h's distinct counts of  (terms with that count) * f(p_g of a missing term, p_h)

Defined cases: null text, language or source reads as empty; a document without terms still makes
its group known; a language without kept terms has all pairs with value 0 and no ``term`` rows; a
source alone in its language has no pairs; repeated rows and ids count as rows each; texts count
whole, however long; other columns are not read, whatever their names; ties rank by the item's
UTF-8; a table without rows gives no rows. Terms and groups are told apart by 64-bit hashes while
they are dealt. A language's list of sources has to fit into a task; the answer itself holds the
square of that list.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareweather.llm.tasks import batch_of, by_place, small_batches, stored
from fareweather.llm.text import Texts, hash_spans, text_chunks
from fareweather.session import scratch_folder

MIN_DOCUMENTS = 3
TOP_TERMS = 200
SHARE_UNITS = 1_000_000_000

#: Different terms, kept or not, that one fit may see; bounds its vocabulary on the driver.
FIT_TERMS = 1 << 22
#: Different terms are counted in one document of so many.
SKETCH = 16
#: Cells (terms times sources) of a block in which pairs are evaluated.
BLOCK_CELLS = 1 << 18
#: Sources that a task evaluates against all others of their language.
BLOCK_SOURCES = 256
#: Groups up to this number are broadcast, three numbers each; beyond it they are joined by a shuffle.
BROADCAST_GROUPS = 100_000

LARGEST_INTEGER = 2**31 - 1

# Fixed value: what a term is.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"

_TOKENS = pa.schema([("gid", pa.int64()), ("weight", pa.int64()), ("fit", pa.int32()), ("terms", pa.list_(pa.string()))])

_TERM_BYTES = np.zeros(256, bool)
_TERM_BYTES[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


#: Bytes of text that are counted at once, bytes of such counts that are added up, and sums that a task holds back.
CHUNK_BYTES = 8 << 20
HELD_BYTES = 96 << 20
#: Terms of a row: ``CountVectorizer`` sorts and hashes the terms of a row, which is faster in the processor's cache.
ROW_TERMS = 512
HELD_SUMS = 1 << 21


def _source(documents: DataFrame) -> DataFrame:
    lang, source, text = (F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("lang", "source", "text"))
    named = by_place(documents, "lang", "source", "text").select(lang, source, text)
    return named.withColumns({"gid": F.xxhash64("lang", "source"), "lid": F.xxhash64("lang")})


def _terms(texts: Texts, at: np.ndarray) -> pa.Array:
    """The terms with these different numbers among those of some documents, A to Z lower-cased."""
    ascending = np.argsort(at)
    start, end = (bound[at[ascending]] for bound in texts.bounds)
    edges = np.zeros(len(texts.data) + 1, np.int8)
    edges[start] += 1
    edges[end] -= 1
    inside = np.cumsum(edges[:-1], dtype=np.int8).view(bool)
    offsets = np.append(0, np.cumsum(end - start)).astype(np.int32)
    written = pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(_LOWER[texts.data[inside]]))
    return written.take(pa.array(np.argsort(ascending)))


def _term_hashes(texts: Texts, lid: pa.Array) -> np.ndarray:
    """A hash of (language, term) for each term."""
    return hash_spans(texts.data, *texts.bounds, lower=True) ^ lid.to_numpy().view(np.uint64)[texts.word_doc]


def different_terms(rows: DataFrame) -> int:
    """A number that the different (language, term) hardly exceed; nothing but hashes is shuffled.

    Documents are dealt into ``SKETCH`` parts by their text. All parts together have no more
    different terms than the sum of each one's, so those of one part are counted.
    """
    small_batches(rows.sparkSession)
    part = rows.filter(F.pmod(F.xxhash64("text"), F.lit(SKETCH)) == 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch["text"], word_bytes=_TERM_BYTES):
                hashes = _term_hashes(texts, batch["lid"].slice(texts.row, len(texts)))
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(hashes).view(np.int64))], ["h"])

    return part.select("text", "lid").mapInArrow(run, "h long").distinct().count() * SKETCH


def term_rows(rows: DataFrame, fits: int, least: int) -> DataFrame:
    """``gid``, ``weight``, ``fit`` and ``terms`` as ``language, NUL, term``.

    A row of weight w has the terms that occur w times more in the held documents of a group than
    its other rows say; rows of weight 0 are the documents that the fits learn from.
    """
    small_batches(rows.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[_Counts]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.nbytes
            if size >= CHUNK_BYTES:
                yield from _chunk_counts(pa.Table.from_batches(held), least)
                held, size = [], 0
        if held:
            yield from _chunk_counts(pa.Table.from_batches(held), least)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for counts in counted(batches):
            held.append(counts)
            size += counts.nbytes
            if size >= HELD_BYTES:
                yield from _rows_of(_added(held, least), fits, least)
                held, size = [], 0
        if held:
            yield from _rows_of(_added(held, least), fits, least)

    return rows.select("text", "lang", "gid", "lid").mapInArrow(run, "gid long, weight long, fit int, terms array<string>")


class _Counts(NamedTuple):
    """Terms by ascending hash, in how many documents each is (``least`` stands for more), and its times in each group."""

    hashes: np.ndarray
    names: pa.Array
    docs: np.ndarray
    term: np.ndarray
    gid: np.ndarray
    times: np.ndarray

    @property
    def nbytes(self) -> int:
        return sum(part.nbytes for part in self)


def _chunk_counts(chunk: pa.Table, least: int) -> Iterator[_Counts]:
    whole = chunk.set_column(0, "text", chunk["text"].cast(pa.large_string())).sort_by("gid").combine_chunks()
    for texts in text_chunks(whole["text"], 2 * CHUNK_BYTES, _TERM_BYTES):
        own = whole.slice(texts.row, len(texts))
        gids, lang = own["gid"].to_numpy(), own["lang"].combine_chunks()
        hashes = _term_hashes(texts, own["lid"])
        order = _ascending(hashes)  # by term, then by document, and so by group
        hashes, docs = hashes[order], texts.word_doc[order]
        new_term, groups = _changes(hashes), gids[docs]
        by_term, by_group = np.flatnonzero(new_term), np.flatnonzero(new_term | _changes(groups))
        names = pc.binary_join_element_wise(lang.take(pa.array(docs[by_term])), _terms(texts, order[by_term]), "\0")
        docs_before = np.append(0, np.cumsum(new_term | _changes(docs)))
        yield _Counts(
            hashes[by_term],
            names,
            np.minimum(np.diff(docs_before[np.append(by_term, len(order))]), least),
            np.searchsorted(by_term, by_group, "right") - 1,
            groups[by_group],
            np.diff(np.append(by_group, len(order))),
        )


def _added(held: list[_Counts], least: int) -> _Counts:
    """The counts of different documents in one; those of a group come one after the other."""
    hashes, first, code = np.unique(np.concatenate([part.hashes for part in held]), return_index=True, return_inverse=True)
    begin = np.cumsum([0, *(len(part.hashes) for part in held)])
    term = np.concatenate([code[i + part.term] for i, part in zip(begin, held)])
    gids, group = np.unique(np.concatenate([part.gid for part in held]), return_inverse=True)
    keys = group * max(len(hashes), 1) + term
    order = np.argsort(keys)
    new = np.flatnonzero(_changes(keys[order]))
    before = np.append(0, np.cumsum(np.concatenate([part.times for part in held])[order]))
    docs = np.bincount(code, np.concatenate([part.docs for part in held]), len(hashes)).astype(np.int64)
    return _Counts(
        hashes,
        pa.concat_arrays([part.names for part in held]).take(pa.array(first)),
        np.minimum(docs, least),
        term[order[new]],
        gids[group[order[new]]],
        np.diff(before[np.append(new, len(order))]),
    )


def _rows_of(counts: _Counts, fits: int, least: int) -> Iterator[pa.RecordBatch]:
    def listed(of: np.ndarray, learn: bool, weight: int, fit: int, at: np.ndarray) -> pa.RecordBatch:
        """The terms ``at``, each ``of`` a group or a document to learn from, in rows of ``ROW_TERMS`` at most."""
        new = _changes(of)
        place = np.arange(len(of)) - np.flatnonzero(new)[np.cumsum(new) - 1]
        begin = np.flatnonzero(place % ROW_TERMS == 0)
        lists = pa.ListArray.from_arrays(pa.array(np.append(begin, len(of)), pa.int32()), counts.names.take(pa.array(at)))
        gid = pa.nulls(len(begin), pa.int64()) if learn else of[begin]
        return batch_of(_TOKENS, gid=gid, weight=np.full(len(begin), weight), fit=np.full(len(begin), fit), terms=lists)

    fit_of = _dealt(counts.hashes, fits)
    for fit in range(fits):
        mine = np.flatnonzero(fit_of[counts.term] == fit)
        for k in range(int(counts.times[mine].max(initial=0)).bit_length()):
            chosen = mine[counts.times[mine] >> k & 1 == 1]
            yield listed(counts.gid[chosen], False, 1 << k, fit, counts.term[chosen])
        nth, seen = np.nonzero((fit_of == fit) & (counts.docs > np.arange(least)[:, None]))
        yield listed(nth, True, 0, fit, seen)


def _ascending(hashes: np.ndarray) -> np.ndarray:
    """A stable argsort: numpy sorts numbers faster than places, so leading bits are sorted with the place behind them."""
    places = np.uint64((1 << len(hashes).bit_length()) - 1)
    order = (np.sort(hashes & ~places | np.arange(len(hashes), dtype=np.uint64)) & places).astype(np.int64)
    ordered = hashes[order]
    if (ordered[1:] < ordered[:-1]).any():  # different hashes with the same leading bits
        return np.argsort(hashes, kind="stable")
    return order


def _changes(values: np.ndarray) -> np.ndarray:
    """Where a value differs from the one before; the first one does."""
    out = np.ones(len(values), bool)
    out[1:] = values[1:] != values[:-1]
    return out


def _dealt(hashes: np.ndarray, fits: int) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.int64) % fits


def summed_vectors(vectors: DataFrame, first_id: int) -> DataFrame:
    """``gid``, ``tid``, ``n`` and ``of_lang``, the term's whole count.

    Sparse vectors times their weights are added up by group within tasks, then shuffled by term.
    """
    schema = pa.schema([("gid", pa.int64()), ("tid", pa.int64()), ("n", pa.int64())])

    def totals(held: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        gid, term, n = (np.concatenate(parts) for parts in zip(*held))
        groups, code = np.unique(gid, return_inverse=True)
        keys = code.astype(np.int64) << 32 | term
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
        first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])[: len(keys)])
        sums = np.add.reduceat(n, first) if len(first) else n
        return batch_of(schema, gid=groups[keys[first] >> 32], tid=(keys[first] & 0xFFFFFFFF) + first_id, n=sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            indices = batch["counts"].field("indices")
            times = np.diff(indices.offsets.to_numpy(zero_copy_only=False))
            n = batch["counts"].field("values").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            held.append(
                (
                    np.repeat(batch["gid"].to_numpy(), times),
                    indices.flatten().to_numpy(zero_copy_only=False).astype(np.int64),
                    n * np.repeat(batch["weight"].to_numpy(), times),
                )
            )
            size += len(n)
            if size >= HELD_SUMS:
                yield totals(held)
                held, size = [], 0
        if held:
            yield totals(held)

    sums = vectors.select("gid", "weight", "counts").mapInArrow(run, "gid long, tid long, n long").repartition("tid")
    whole = F.sum("n").over(Window.partitionBy("tid"))
    return sums.groupBy("tid", "gid").agg(F.sum("n").alias("n")).withColumn("of_lang", whole)


def group_counts(spark: SparkSession, tokens: DataFrame, fits: int, least: int) -> tuple[DataFrame, DataFrame]:
    """``gid, tid, n, of_lang`` of all kept terms, and ``tid, lang, term``; one fit after the other."""
    folder = scratch_folder(spark, "divergence")
    # Documents of one empty term, which no text has, so that no vocabulary is empty.
    seed = spark.range(max(least, 1)).select(F.array(F.lit("\0")).alias("terms"))
    term = F.substring_index("name", "\0", -1)
    lang = F.left("name", F.length("name") - F.length(term) - 1)
    for i in range(fits):
        rows = tokens.filter(F.col("fit") == i)
        vectorizer = CountVectorizer(inputCol="terms", outputCol="counts", minDF=float(least), vocabSize=LARGEST_INTEGER)
        model = vectorizer.fit(rows.filter("learn").select("terms").unionByName(seed))
        model.write().save(f"{folder}/model{i}")
        vocabulary = spark.read.parquet(f"{folder}/model{i}/data").select(F.posexplode("vocabulary").alias("at", "name"))
        first_id = i * LARGEST_INTEGER
        names = vocabulary.select((F.col("at").cast("long") + first_id).alias("tid"), lang.alias("lang"), term.alias("term"))
        names.filter("term != ''").write.mode("append").parquet(f"{folder}/names")
        vectors = model.transform(rows.filter("NOT learn"))
        summed_vectors(vectors, first_id).write.mode("append").parquet(f"{folder}/sums")
    return (
        spark.read.schema("tid long, gid long, n long, of_lang long").parquet(f"{folder}/sums"),
        spark.read.schema("tid long, lang string, term string").parquet(f"{folder}/names"),
    )


def quotient(a: Column, b: Column) -> Column:
    """``floor(a / b)`` of whole numbers from 0 on."""
    return F.call_function("div", a, b)


def share(n: str, total: str, terms: str) -> Column:
    return 1 + quotient(SHARE_UNITS * (F.col(n) + 1), F.col(total) + F.col(terms))


def distance(p: str, q: str) -> Column:
    return quotient((F.col(p) - F.col(q)) * (F.col(p) - F.col(q)), F.col(q))


def pair_values(entries: DataFrame, groups: DataFrame, blocks: int, parts: int = 1) -> DataFrame:
    """``gid, other, value`` of all ordered pairs of groups of a language.

    ``entries`` has ``of, gid, tid, n``, ``of`` being the language's ``lid`` in ``groups``, which has
    ``lid, gid, total, kept``. A task of the
    evaluation holds one of ``blocks`` blocks of a language's terms and evaluates one of ``parts``
    parts of its sources against all of them.
    """
    each_part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part")
    each_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    left = entries.select("*", F.pmod(F.xxhash64("tid"), F.lit(blocks)).cast("int").alias("block"), each_part)
    right = groups.select("*", F.pmod("gid", F.lit(parts)).alias("own"), each_block).select("*", each_part)
    schema = pa.schema([("gid", pa.int64()), ("other", pa.int64()), ("value", pa.int64())])
    keys = ["block", "part"]

    def run(counts: pa.Table, sources: pa.Table) -> pa.Table:
        if not sources.num_rows:
            return schema.empty_table()
        sources = sources.sort_by("gid")
        gid = sources["gid"].to_numpy()
        weight = sources["total"].to_numpy() + sources["kept"].to_numpy()
        mine = np.flatnonzero(sources["own"].to_numpy() == sources["part"][0].as_py())
        values = block_values(counts, gid, weight, mine)
        shown = (values != 0) | (sources["block"][0].as_py() == 0)
        shown[np.arange(len(mine)), mine] = False
        g, h = np.nonzero(shown)
        return pa.table([gid[mine[g]], gid[h], values[g, h]], schema=schema)

    evaluated = left.groupBy("of", *keys).cogroup(right.groupBy("lid", *keys)).applyInArrow(run, "gid long, other long, value long")
    return evaluated.groupBy("gid", "other").agg(F.sum("value").alias("value"))


def block_values(counts: pa.Table, gid: np.ndarray, weight: np.ndarray, mine: np.ndarray) -> np.ndarray:
    """What the terms of a block add to the value of each group of ``mine`` against each of ``gid``."""
    out = np.zeros((len(mine), len(gid)), np.int64)
    if not counts.num_rows:
        return out
    row = np.searchsorted(gid, counts["gid"].to_numpy())
    terms, column = np.unique(counts["tid"].to_numpy(), return_inverse=True)
    n = np.zeros((len(gid), len(terms)), np.int64)
    n[row, column] = counts["n"].to_numpy()
    missing = 1 + SHARE_UNITS // weight
    shares = 1 + SHARE_UNITS * (n + 1) // weight[:, None]
    for h in range(len(gid)):
        seen, times = np.unique(shares[h], return_counts=True)
        out[:, h] = distances(missing[mine][:, None], seen[None]) @ times
    for i, g in enumerate(mine):
        own = np.flatnonzero(n[g])
        others = shares[:, own]
        out[i] += (distances(shares[g, own][None], others) - distances(missing[g], others)).sum(axis=1)
    return out


def distances(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def document_vectors(documents: DataFrame, lang: str, least: int = MIN_DOCUMENTS) -> tuple[CountVectorizerModel, DataFrame]:
    """The vectorizer of one language's documents, and these with their ``terms`` and exact sparse ``counts``.

    For vocabularies that fit on the driver; ``audit`` has no such limit.
    """
    lowered = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    terms = F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))
    named = by_place(documents, "doc_id", "lang", "source", "text")
    rows = named.filter(F.coalesce("lang", F.lit("")) == lang).withColumn("terms", terms)
    vectorizer = CountVectorizer(inputCol="terms", outputCol="counts", minDF=float(least), vocabSize=LARGEST_INTEGER)
    model = vectorizer.fit(rows)
    return model, model.transform(rows)


def audit(documents: DataFrame, least: int = MIN_DOCUMENTS, top: int = TOP_TERMS, fit_terms: int = FIT_TERMS) -> DataFrame:
    """``lang, source, part, item, value, rank``: every pair of sources, and each source's most typical terms."""
    spark = documents.sparkSession
    rows = _source(documents)
    fits = max(1, -(-different_terms(rows) // fit_terms))
    folder = scratch_folder(spark, "terms")
    made = term_rows(rows, fits, least).withColumn("learn", F.col("weight") == 0)
    # Terms hardly repeat within a row, so a dictionary of them would only cost time.
    made.write.partitionBy("fit", "learn").option("parquet.enable.dictionary", "false").parquet(folder)
    tokens = spark.read.schema("gid long, weight long, terms array<string>, fit int, learn boolean").parquet(folder)

    entries, names = group_counts(spark, tokens, fits, least)
    by_lang = names.groupBy("lang").agg(F.count("*").alias("kept"))
    by_group = entries.groupBy("gid").agg(F.sum("n").alias("total"))
    known = rows.select("lang", "source", "gid", "lid").distinct()
    sized = known.join(by_group, "gid", "left").join(by_lang, "lang", "left").fillna(0)
    groups = stored(sized.withColumn("lang_total", F.sum("total").over(Window.partitionBy("lid"))))
    per_lang = groups.groupBy("lid").agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
    n_groups, most, kept = per_lang.agg(F.sum("n"), F.max("n"), F.sum("kept")).first()
    if not n_groups:
        return spark.createDataFrame([], "lang string, source string, part string, item string, value long, rank int")
    groups = F.broadcast(groups) if n_groups <= BROADCAST_GROUPS else groups

    pairs = (
        pair_values(
            entries.drop("of_lang").join(groups.select("gid", F.col("lid").alias("of")), "gid"),
            groups.select("lid", "gid", "total", "kept"),
            -(-kept * most // BLOCK_CELLS) or 1,
            -(-most // BLOCK_SOURCES),
        )
        .join(groups.select(F.col("gid").alias("other"), F.col("source").alias("item")), "other")
        .join(groups.select("gid", "lang", "source"), "gid")
    )
    by_value = F.rank().over(Window.partitionBy("gid").orderBy(F.col("value").desc()))
    typical = (
        entries.join(groups.select("gid", "total", "lang_total", "kept"), "gid")
        .withColumns({"p": share("n", "total", "kept"), "q": share("of_lang", "lang_total", "kept")})
        .filter("p > q")
        .select("gid", "tid", distance("p", "q").alias("value"))
        .withColumn("by_value", by_value)
        .filter(F.col("by_value") <= top)  # with all ties of the last value; only these get their names
        .join(names.select("tid", F.col("term").alias("item")), "tid")
        .join(groups.select("gid", "lang", "source"), "gid")
    )
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    ranked = {"pair": pairs.withColumn("rank", place), "term": typical.withColumn("rank", place).filter(F.col("rank") <= top)}
    columns = ["lang", "source", "part", "item", "value", "rank"]
    both = [found.withColumn("part", F.lit(part)).select(*columns) for part, found in ranked.items()]
    return both[0].unionByName(both[1])


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP11_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents
), t AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), kept AS (
  SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT rid) >= 3
), langs AS (
  SELECT lang, sum(n)::BIGINT AS total, count(*) AS v FROM kept GROUP BY lang
), found AS (
  SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL
), sizes AS (
  SELECT lang, source, sum(n)::BIGINT AS total FROM found GROUP BY ALL
), g AS (
  SELECT DISTINCT d.lang, d.source, coalesce(sizes.total, 0) AS total, coalesce(langs.v, 0) AS v
  FROM d LEFT JOIN sizes USING (lang, source) LEFT JOIN langs ON langs.lang = d.lang
), p AS (
  SELECT g.lang, g.source, kept.term, coalesce(found.n, 0) AS n,
         1 + 1000000000 * (coalesce(found.n, 0) + 1) // (g.total + g.v) AS p
  FROM g JOIN kept USING (lang) LEFT JOIN found USING (lang, source, term)
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sums.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
), q AS (
  SELECT kept.lang, kept.term, 1 + 1000000000 * (kept.n + 1) // (langs.total + langs.v) AS q
  FROM kept JOIN langs USING (lang)
), terms AS (
  SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p.p - q.q) * (p.p - q.q) // q.q AS value
  FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p.p > q.q
)
SELECT lang, source, part, item, value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS "rank"
FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) <= 200
"""
