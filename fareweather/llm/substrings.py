"""Removal of repeated passages by level-wise doubling.

A window is ``window`` consecutive words of one document. Every word that lies in a window whose
word sequence also starts earlier (in a document of smaller id, or earlier in the same one) is
removed; windows are judged on the input, so the order of work doesn't matter.

Documents with equal word sequences are settled first: all but the one of least id lose all their
words. Of the rest, windows of a quarter of the length are looked at first, then twice as long
ones around those that repeat, then twice as long again; what is unique at one length is not
followed further.

1. Of the short windows in each full window only the least hash is an anchor. Equal full windows
   have equal anchors, so a full window can only repeat if its anchor does. Anchors that occur
   once are dropped by one shuffle of hashes.
2. The texts with anchors left give the longer windows around them, eight or so to a row, keyed by
   the anchor. Windows that repeat among some hundred thousand of a task are settled there, so
   that however often a passage occurs, these send it once. In each anchor's group the windows of half the length
   are compared first, full windows only where those repeat.
3. Places found to repeat go back to their documents, and the words left are put together.

Defined cases: null, empty and blank texts have no words; a text shorter than a window loses
nothing; rows with the same id and the same words count as one document and get the same result;
of rows with the same id and other words a fixed one counts as earlier; rows without an id come
after all others; very long texts count whole; an empty table gives an empty result. Other columns are carried along as they
are, whatever their names. Exact up to collisions of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fareweather.llm.tasks import batch_of, by_place, grouped_stream, small_batches, stored
from fareweather.llm.text import Texts, join_hashes, mix, signed, text_chunks, window_hashes

LAST = 2**63 - 1
ROWS_PER_RUN = 50_000

#: Windows of one task that are compared with each other before they are sent.
WINDOWS_AT_ONCE = 600_000


def sequence_fingerprints(texts: Texts, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits for the word sequence of each document."""
    place = (np.arange(len(hashes)) - texts.first_word[texts.word_doc]).astype(np.uint64)
    both = []
    for seed in (21, 22):
        sums = np.zeros(len(hashes) + 1, np.uint64)
        np.cumsum(mix(hashes + mix(place, seed), seed), out=sums[1:])
        both.append(signed(mix(sums[texts.first_word[1:]] - sums[texts.first_word[:-1]], seed)))
    return both[0], both[1]


class Windows:
    """Windows of some documents at three lengths, each twice the one before.

    Arrays are indexed by word; ``valid`` marks the words where a full window starts.
    """

    def __init__(self, texts: Texts, hashes: np.ndarray, window: int):
        self.window, self.short = window, window // 4
        self.span = window - self.short + 1  # short windows in a full one
        n = len(hashes)
        self.first, self.n = texts.first_word, n
        left = texts.first_word[1:][texts.word_doc] - np.arange(n)
        self.valid = left >= window
        self.low = self._padded(window_hashes(hashes, self.short))
        self.half = self._padded(join_hashes(self.low[: n - self.short], self.low[self.short :]) if n > self.short else [])
        two = 2 * self.short
        self.full = self._padded(join_hashes(self.half[: n - two], self.half[two:]) if n > two else [])
        self.least = np.zeros(n, np.uint64)
        starts = np.flatnonzero(self.valid)
        if len(starts):
            self.least[starts] = self._sliding(self.low, np.minimum, self.span)[starts]

    def _padded(self, values) -> np.ndarray:
        out = np.zeros(self.n, np.uint64)
        out[: len(values)] = values
        return out

    def _sliding(self, values: np.ndarray, best, size: int) -> np.ndarray:
        """``best`` of ``size`` neighbours from each place on; the places near the end are unused."""
        out, done = values.copy(), 1
        while done < size:
            step = min(done, size - done)
            out[: self.n - step] = best(out[: self.n - step], out[step:])
            done += step
        return out

    def anchors(self) -> np.ndarray:
        """The words where a short window starts that is the least of some full window."""
        if not self.valid.any():
            return np.zeros(0, np.int64)
        over = np.concatenate([np.zeros(self.span - 1, np.uint64), np.where(self.valid, self.least, np.uint64(0))])
        out, done = over.copy(), 1
        while done < self.span:
            step = min(done, self.span - done)
            out[: len(out) - step] = np.maximum(out[: len(out) - step], out[step:])
            done += step
        covered = np.concatenate([np.zeros(self.span - 1, bool), self.valid]).cumsum()
        seen = covered[self.span - 1 :] - np.concatenate([[0], covered[: self.n - 1]])
        return np.flatnonzero((out[: self.n] == self.low) & (seen > 0))

    def anchor_of(self, starts: np.ndarray) -> np.ndarray:
        """The first place of the least short window of each full window."""
        out = np.full(len(starts), -1)
        for step in range(self.span):
            at = starts + step
            out = np.where((out < 0) & (self.low[at] == self.least[starts]), at, out)
        return out


def identity(documents: DataFrame) -> list[Column]:
    """``key``, by which rows meet what was found of them, and ``ord``, which tells which is earlier.

    Rows meet by id and text, so that many rows of one id, or without one, are not one group. What
    another row of the same key finds is told apart by its word sequence. Rows without an id come
    last.
    """
    doc_id = documents["doc_id"].cast("long")
    return [F.xxhash64(doc_id, documents["text"]).alias("key"), F.coalesce(doc_id, F.lit(LAST)).alias("ord")]


def anchored(documents: DataFrame, window: int) -> DataFrame:
    """Identity, size, fingerprint and ``anchors`` of every document; an anchor that recurs there is listed twice."""
    names = ["key", "ord", "n", "f1", "f2"]
    schema = pa.schema([(name, pa.int64()) for name in names] + [("anchors", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch["text"]):
                hashes = texts.word_hashes()
                f1, f2 = sequence_fingerprints(texts, hashes)
                windows = Windows(texts, hashes, window)
                values, ends = at_most_twice(texts, windows)
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(signed(values)))
                own = batch.slice(texts.row, len(texts))
                yield batch_of(schema, key=own["key"], ord=own["ord"], n=texts.n_words, f1=f1, f2=f2, anchors=lists)

    source = documents.select(*identity(documents), "text")
    return source.mapInArrow(run, ", ".join(f"{name} long" for name in names) + ", anchors array<long>")


def at_most_twice(texts: Texts, windows: Windows) -> tuple[np.ndarray, np.ndarray]:
    """Anchors of each document in order of value, none more than twice, and their offsets."""
    at = windows.anchors()
    doc, value = texts.word_doc[at], windows.low[at]
    order = np.lexsort((value, doc))
    doc, value = doc[order], value[order]
    third = np.zeros(len(doc), bool)
    third[2:] = (value[2:] == value[:-2]) & (doc[2:] == doc[:-2])
    return value[~third], np.searchsorted(doc[~third], np.arange(len(texts) + 1))


def repeated_anchors(firsts: DataFrame) -> DataFrame:
    """``key`` and the list ``hits`` of (``f1``, ``anchor``) for anchors that occur twice or more.

    Counts are partial aggregates and stored before the join, which can then split the documents
    of an anchor that very many have.
    """
    rows = firsts.select("key", "f1", F.explode("anchors").alias("anchor"))
    repeated = stored(rows.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor"))
    found = rows.join(repeated, "anchor", "left_semi")
    return found.groupBy("key").agg(F.collect_list(F.struct("f1", "anchor")).alias("hits"))


def hits_of(batch: pa.RecordBatch, name: str, rows: slice) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row number of each entry of a list of structs, and the entries' fields."""
    lists = batch[name].slice(rows.start, rows.stop - rows.start).fill_null([])
    counts = np.diff(lists.offsets.to_numpy())
    entries = lists.flatten()
    fields = {f.name: entries.field(i).to_numpy(zero_copy_only=False) for i, f in enumerate(entries.type)}
    return np.repeat(np.arange(len(lists)), counts), fields


RUN_FIELDS = ["anchor", "key", "ord", "f1", "start", "before", "after", "done"]


def window_runs(documents: DataFrame, hits: DataFrame, window: int) -> DataFrame:
    """Runs of neighbouring full windows with the same repeated anchor.

    ``start`` is the first window's first word, ``windows`` their hashes, ``before`` and ``after``
    the hashes of half the length on either side of the anchor, ``offset`` the anchor's place
    from the start. Bits of ``done`` mark windows that occur earlier among those of the task compared so far.
    """
    schema = pa.schema([(name, pa.int64()) for name in [*RUN_FIELDS, "offset"]] + [("windows", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[dict[str, np.ndarray]] = []
        for batch in batches:
            for texts in text_chunks(batch["text"]):
                part = runs_of(batch, texts, window)
                parts += [] if part is None else [part]
                if sum(len(part["full"]) for part in parts) >= WINDOWS_AT_ONCE:
                    yield from settled(schema, parts)
                    parts = []
        if parts:
            yield from settled(schema, parts)

    source = documents.select(*identity(documents), "text").join(hits, "key")
    kinds = ", ".join(f"{name} long" for name in [*RUN_FIELDS, "offset"])
    return source.select("key", "ord", "text", "hits").mapInArrow(run, f"{kinds}, windows binary")


def runs_of(batch: pa.RecordBatch, texts: Texts, window: int) -> dict[str, np.ndarray] | None:
    """All full windows of some documents whose anchor is a hit, with what their runs need."""
    rows = slice(texts.row, texts.row + len(texts))
    hashes = texts.word_hashes()
    f1, _ = sequence_fingerprints(texts, hashes)
    windows = Windows(texts, hashes, window)
    starts = np.flatnonzero(windows.valid)
    if not len(starts):
        return None
    at = windows.anchor_of(starts)
    row, entry = hits_of(batch, "hits", rows)
    mine = entry["f1"] == f1[row]
    wanted = np.unique(mix(entry["anchor"][mine].view(np.uint64) + mix(row[mine].astype(np.uint64), 31)))
    doc = texts.word_doc[starts]
    keep = np.isin(mix(windows.low[at] + mix(doc.astype(np.uint64), 31)), wanted)
    starts, at, doc = starts[keep], at[keep], doc[keep]
    if not len(starts):
        return None
    short = windows.short
    from_doc = at - windows.first[doc]
    return {
        "anchor": windows.low[at],
        "key": batch["key"].to_numpy()[rows][doc],
        "ord": batch["ord"].to_numpy()[rows][doc],
        "f1": f1[doc],
        "start": starts - windows.first[doc],
        "before": np.where(from_doc >= short, windows.half[np.maximum(at - short, 0)], np.uint64(0)),
        "after": windows.half[at],  # only read where the window holds all of it
        "at": from_doc,
        "full": windows.full[starts],
    }


def settled(schema: pa.Schema, parts: list[dict[str, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Rows for the runs of a batch; a run whose windows are all done travels without them."""
    w = {name: np.concatenate([part[name] for part in parts]) for name in parts[0]}
    done = later_ones(w["full"], w["ord"], w["f1"], w["start"])
    new = np.ones(len(done), bool)
    new[1:] = w["start"][1:] != w["start"][:-1] + 1
    for name in ("key", "f1", "at"):
        new[1:] |= w[name][1:] != w[name][:-1]
    first = np.flatnonzero(new)
    place = np.arange(len(done)) - first[np.cumsum(new) - 1]
    bits = np.bitwise_or.reduceat(done.astype(np.int64) << place, first)
    size = np.diff(np.append(first, len(done)))
    finished = bits == (np.int64(1) << size) - 1
    anchor = signed(np.where(finished, mix(w["f1"][first].view(np.uint64)), w["anchor"][first]))
    ends = np.append(first, len(done))
    full = [b"" if over else w["full"][a:b].tobytes() for a, b, over in zip(ends[:-1], ends[1:], finished)]
    yield batch_of(
        schema,
        anchor=anchor,
        key=w["key"][first],
        ord=w["ord"][first],
        f1=w["f1"][first],
        start=w["start"][first],
        before=signed(w["before"][first]),
        after=signed(w["after"][first]),
        done=bits,
        offset=w["at"][first] - w["start"][first],
        windows=full,
    )


def later_ones(key: np.ndarray, *place: np.ndarray) -> np.ndarray:
    """Whether the same key also stands at an earlier place; equal places are one."""
    order = np.lexsort((*place[::-1], key))
    new = np.ones(len(order), bool)
    new[1:] = key[order][1:] != key[order][:-1]
    first = np.flatnonzero(new)[np.cumsum(new) - 1] if len(order) else order
    later = np.zeros(len(order), bool)
    for p in place:
        later |= p[order] != p[order][first]
    out = np.zeros(len(order), bool)
    out[order] = later
    return out


def repeats_of(key: np.ndarray) -> np.ndarray:
    """Whether a key occurs more than once."""
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    out = np.zeros(len(key), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def places(runs: DataFrame, window: int) -> DataFrame:
    """``key``, ``f1``, ``start`` and ``mask``: bit i tells that the window at ``start + i`` is a repeat."""
    short = window // 4
    schema = pa.schema([("key", pa.int64()), ("f1", pa.int64()), ("start", pa.int64()), ("mask", pa.int64())])

    def compare(table: pa.Table) -> Iterator[pa.RecordBatch]:
        r = {name: table[name].to_numpy() for name in [*RUN_FIELDS, "offset"]}
        blobs = table["windows"].to_pylist()
        full = np.frombuffer(b"".join(blobs), np.uint64)
        size = np.array([len(blob) // 8 for blob in blobs])
        run = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(run)) - np.repeat(np.cumsum(size) - size, size)
        mask = r["done"].copy()
        open_windows = (r["done"][run] >> place) & 1 == 0
        run, place, full = run[open_windows], place[open_windows], full[open_windows]
        if len(run):
            # Half the length first: a window holds the half before its anchor or the one after it.
            after = (r["offset"][run] - place) <= window - 2 * short
            before = (r["offset"][run] - place) >= short
            ok_after = np.zeros(len(size), bool)
            ok_before = np.zeros(len(size), bool)
            rows_after, rows_before = np.unique(run[after]), np.unique(run[before])
            ok_after[rows_after] = repeats_of(r["after"][rows_after])
            ok_before[rows_before] = repeats_of(r["before"][rows_before])
            keep = (after & ok_after[run]) | (~after & ok_before[run])
            run, place, full = run[keep], place[keep], full[keep]
            later = later_ones(full, r["ord"][run], r["f1"][run], r["start"][run] + place)
            np.bitwise_or.at(mask, run[later], np.int64(1) << place[later])
        some = np.flatnonzero(mask)
        yield batch_of(schema, key=r["key"][some], f1=r["f1"][some], start=r["start"][some], mask=mask[some])

    return (
        runs.repartition("anchor")
        .sortWithinPartitions("anchor")
        .mapInArrow(
            lambda batches: grouped_stream(batches, ["anchor"], ROWS_PER_RUN, compare), "key long, f1 long, start long, mask long"
        )
    )


def dedup(documents: DataFrame, window: int = 20, as_is: bool = False) -> DataFrame:
    """All columns of ``documents`` but ``text``, then ``n_words``, ``n_removed`` and ``kept_text``.

    ``kept_text`` has the words kept, joined by one space; with ``as_is`` a text that loses nothing
    stays as it was. ``window`` is a multiple of four.
    """
    if window % 4 or window > 64:
        raise ValueError("window has to be a multiple of four, 64 at most")
    small_batches(documents.sparkSession)
    named = by_place(documents, "doc_id", "text")
    rows = stored(anchored(named, window))
    firsts = stored(
        rows.groupBy("f1", "f2")
        .agg(F.min(F.struct("ord", "key", "anchors")).alias("s"), F.max(F.struct("ord", "key")).alias("last"))
        .select("f1", "f2", "s.ord", "s.key", "s.anchors", "last")
    )
    hits = repeated_anchors(firsts.select("key", "f1", "anchors"))
    found = stored(places(window_runs(named, hits, window), window))
    first = F.struct("ord", "key")
    copied = firsts.filter(F.col("last") > first).select("f1", "f2", first.alias("first"))
    copies = (
        rows.filter(F.col("n") >= window)
        .select("key", "ord", "f1", "f2")
        .join(copied, ["f1", "f2"])
        .filter(first > F.col("first"))
        .select("key", "f1", F.lit(-1).cast("long").alias("start"), F.lit(0).cast("long").alias("mask"))
    )
    marks = found.unionByName(copies).groupBy("key").agg(F.collect_set(F.struct("f1", "start", "mask")).alias("marks"))
    marks = stored(marks)
    return without(documents, marks, window, as_is)


def without(documents: DataFrame, marks: DataFrame, window: int, as_is: bool) -> DataFrame:
    at = {name: documents.columns.index(name) for name in ("doc_id", "text")}
    others = [i for i in range(len(documents.columns)) if i != at["text"]]
    placed = documents.toDF(*[f"p{i}" for i in range(len(documents.columns))])
    named = placed.select(F.col(f"p{at['doc_id']}").alias("doc_id"), F.col(f"p{at['text']}").alias("text"), *[F.col(f"p{i}").alias(f"c{n}") for n, i in enumerate(others)])
    key, _ = identity(named)
    source = named.select(key, "*").drop("doc_id").join(marks, "key", "left").drop("key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch["text"]):
                rows = slice(texts.row, texts.row + len(texts))
                own = batch.slice(texts.row, len(texts))
                removed = removed_words(batch, texts, rows, window)
                sums = np.concatenate([[0], np.cumsum(removed)])
                lost = sums[texts.first_word[1:]] - sums[texts.first_word[:-1]]
                kept = kept_texts(texts, ~removed)
                if as_is:
                    kept = [old if n == 0 else new for old, new, n in zip(own["text"].to_pylist(), kept, lost)]
                columns = [own[f"c{i}"] for i in range(len(others))]
                columns += [pa.array(texts.n_words, pa.int64()), pa.array(lost, pa.int64()), pa.array(kept, pa.string())]
                names = [f"c{i}" for i in range(len(others))] + ["n_words", "n_removed", "kept_text"]
                yield pa.RecordBatch.from_arrays(columns, names)

    made = [StructField("n_words", LongType()), StructField("n_removed", LongType()), StructField("kept_text", StringType())]
    schema = StructType([StructField(f"c{n}", documents.schema.fields[i].dataType) for n, i in enumerate(others)] + made)
    return source.mapInArrow(run, schema).toDF(*[documents.columns[i] for i in others], "n_words", "n_removed", "kept_text")


def removed_words(batch: pa.RecordBatch, texts: Texts, rows: slice, window: int) -> np.ndarray:
    """The words of some documents that lie in a marked window."""
    hashes = texts.word_hashes()
    f1, _ = sequence_fingerprints(texts, hashes)
    row, mark = hits_of(batch, "marks", rows)
    mine = mark["f1"] == f1[row]
    row, start, mask = row[mine], mark["start"][mine], mark["mask"][mine]
    change = np.zeros(len(hashes) + window + 1, np.int64)
    for bit in range(window - window // 4 + 1):
        on = (mask >> bit) & 1 == 1
        at = texts.first_word[row[on]] + start[on] + bit
        np.add.at(change, at, 1)
        np.add.at(change, at + window, -1)
    removed = np.cumsum(change)[: len(hashes)] > 0
    whole = np.zeros(len(texts), bool)
    whole[row[start < 0]] = True
    return removed | whole[texts.word_doc]


def kept_texts(texts: Texts, kept: np.ndarray) -> list[str]:
    """The kept words of each document, joined by one space."""
    start, end = (bound[kept] for bound in texts.bounds)
    length = end - start + 1
    ends = np.cumsum(length)
    data = np.append(texts.data, np.uint8(32))
    at = np.repeat(start - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
    out = data[np.minimum(at, len(data) - 1)]
    out[ends - 1] = 32
    body = out.tobytes()
    sums = np.concatenate([[0], ends])
    words = np.concatenate([[0], np.cumsum(kept)])[texts.first_word]
    return [body[a : max(a, b - 1)].decode() for a, b in zip(sums[words[:-1]].tolist(), sums[words[1:]].tolist())]


def drop_repeats(documents: DataFrame, window: int = 20) -> DataFrame:
    """``documents`` with the words left as ``text`` and their length as ``n_chars`` (if there is such a column)."""
    text = documents.columns.index("text")
    others = [i for i in range(len(documents.columns)) if i != text]
    out = dedup(documents, window, as_is=True).toDF(*[f"c{i}" for i in others], "words", "removed", "kept")
    columns = [F.col("kept") if i == text else F.col(f"c{i}") for i in range(len(documents.columns))]
    if "n_chars" in documents.columns:
        at = documents.columns.index("n_chars")
        length = F.length("kept").cast(documents.schema.fields[at].dataType)
        columns[at] = F.when(F.col("removed") > 0, length).otherwise(columns[at])
    return out.select(*[column.alias(f"k{i}") for i, column in enumerate(columns)]).toDF(*documents.columns)


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = by_place(spark.read.parquet(f"{sf_dir}/documents.parquet"), "doc_id", "text")
    kept = dedup(documents, window=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


OP8_SQL = """
WITH words AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) AS w FROM documents),
windows AS (
    SELECT doc_id, s, array_to_string(w[s:s + 19], ' ') AS sequence
    FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS s FROM words WHERE len(w) >= 20)),
ranked AS (
    SELECT doc_id, s, row_number() OVER (PARTITION BY sequence ORDER BY doc_id, s) AS place FROM windows),
covered AS (
    SELECT DISTINCT doc_id, s + k AS i FROM (SELECT doc_id, s FROM ranked WHERE place > 1), range(20) AS r(k)),
places AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS i, unnest(w) AS word FROM words),
kept AS (
    SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS text, count(*) AS n
    FROM places AS p LEFT JOIN covered AS c ON p.doc_id = c.doc_id AND p.i = c.i
    WHERE c.i IS NULL GROUP BY p.doc_id)
SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(kept.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM words LEFT JOIN kept ON words.doc_id = kept.doc_id
"""
