"""N-gram Jaccard join by signature trees: groups of documents that resemble each other.

A document's set holds its distinct shingles. Two documents link when ``100 * overlap >= percent
* union``; the join returns the groups that links connect, one row a document.

1. Equal sets become one: Spark groups by a 128-bit fingerprint, partial minima first.
2. Sets meet where they could overlap enough. Linked sets differ by few tokens, so if a hash deals
   the tokens into some parts more than that, so many parts of both are equal: the parts are the
   keys. A set that shares fewer keys, with whichever sets, links with none. Within a key's sets,
   ordered by size, a run without a gap wider than the threshold allows becomes a star, so no
   pairs are listed.
3. Each connected candidate group is joined by signature trees (``signature_tree``): one tree for
   up to ``BLOCK_BYTES`` of sets, several for larger groups. Trees of one group are first joined
   with themselves and the group's first set; only trees not yet wholly connected then meet pair
   by pair.
4. Groups are the connected components of the links found.

Defined cases: null, empty and blank texts have no shingle and stay alone; a text of fewer words
than a shingle has one shingle, its whole sequence; equal texts always link; repeated ids count
as one document each row, rows without an id can link but don't name a group; very long texts count
whole; of equal ids and sizes the set of least fingerprint comes first; an empty table gives an empty
result; other columns are never read, whatever their names. Exact up to collisions of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareweather.llm.components import components, merged
from fareweather.llm.signature_tree import linked
from fareweather.llm.tasks import appended, batch_of, by_place, grouped_stream, small_batches, stored
from fareweather.llm.text import Texts, distinct_shingles, mix, set_fingerprints, signed, text_chunks

BAND_RATIO = 1.6
SEEDS = 4
MORE_PARTS = 8
BLOCK_BYTES = 8 << 20
ROWS_PER_RUN = 500


def _texts(documents: DataFrame) -> DataFrame:
    """``doc_id``, ``text``, and ``row``, by which a row is found again; many rows without an id are not one group."""
    doc_id = F.col("doc_id").cast("long")
    return documents.select(doc_id.alias("doc_id"), "text", F.coalesce(doc_id, F.xxhash64("text")).alias("row"))


def bands(percent: int, largest: int) -> list[int]:
    """Least sizes of the size bands; sets that link lie in the same band or in neighbouring ones."""
    ratio = max(BAND_RATIO, 100 / percent)
    out = [1]
    while out[-1] <= largest:
        out.append(int(np.ceil(out[-1] * ratio)))
    return out


def parts_of_band(low: np.ndarray, high: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """How many parts the sets of a band are dealt into, and how many more that is than needed.

    Two linked sets of at most ``high`` tokens differ by ``differ`` tokens at most, so that of
    ``differ + 1 + spare`` parts more than ``spare`` are equal. Some parts are spared because they
    stay empty, some more so that linked sets have several parts in common.
    """
    differ = 2 * high * (100 - percent) // (100 + percent)
    empty = (differ + 1) * np.exp(-low * percent / 100 / (differ + 1))
    spare = np.where(empty < 0.05, 0, np.ceil(empty + 2 * np.sqrt(empty))).astype(np.int64) + differ // MORE_PARTS
    return differ + 1 + spare, spare


def part_keys(values: np.ndarray, offsets: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, the place of the set that each belongs to, and what goes along with it.

    A set takes part in its own size band and, if larger sets of the next band can link with it,
    in that one too. In a band its tokens are dealt into parts; each part that has tokens is a
    key. Were all equal parts of two linked sets empty, both would have more empty parts than the
    band spares: such sets are dealt once more by another hash, and the last time their empty
    parts are keys as well.

    What goes along is the size, the band, and how many keys at least a set has in common with
    any one that links with it there: the equal parts, less the empty ones.
    """
    sizes = np.diff(offsets)
    starts = np.array(bands(percent, int(sizes.max(initial=0)) * 100 // percent + 1))
    own = np.searchsorted(starts, sizes, "right") - 1
    guest = (sizes > 0) & (sizes * 100 // percent >= starts[np.minimum(own + 1, len(starts) - 1)])
    keys, owners, along = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for band, docs in ((own, np.flatnonzero(sizes > 0)), (own + 1, np.flatnonzero(guest))):
        for seed in range(SEEDS):
            if not len(docs):
                break
            here, n = band[docs], sizes[docs]
            parts, spare = parts_of_band(starts[here], starts[here + 1] - 1, percent)
            first = np.concatenate([[0], np.cumsum(parts)])
            token = values[np.repeat(offsets[docs] - np.cumsum(n) + n, n) + np.arange(n.sum())]
            doc = np.repeat(np.arange(len(docs)), n)
            place = (mix(token, 41 + seed) >> np.uint64(32)) * parts[doc].astype(np.uint64) >> np.uint64(32)
            at = first[doc] + place.astype(np.int64)
            sums = np.zeros(first[-1], np.uint64)
            np.add.at(sums, at, mix(token, 51 + seed))
            full = np.bincount(at, minlength=first[-1]) > 0
            holder = np.repeat(np.arange(len(docs)), parts)
            empty = parts - np.bincount(holder[full], minlength=len(docs))
            poor = empty > spare
            shown = full | poor[holder] if seed == SEEDS - 1 else full
            code = (here[holder] << 40) | (seed << 34) | (np.arange(first[-1]) - first[holder])
            shared = np.where(poor | (seed > 0), 1, np.minimum(1 + spare - empty, 0xFFFF))
            keys.append(mix(sums[shown] + mix(code[shown].astype(np.uint64), 61)))
            owners.append(docs[holder[shown]])
            along.append(((n << 32) | (here << 16) | shared)[holder[shown]])
            docs = docs[poor]
    return np.concatenate(keys), np.concatenate(owners), np.concatenate(along)


def described(documents: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``row``, set size and fingerprint (``f1``, ``f2``) of every document."""
    names = ["doc_id", "row", "n", "f1", "f2"]
    schema = pa.schema([(name, pa.int64()) for name in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch["text"]):
                values, offsets = distinct_shingles(texts, words, lower=True)
                f1, f2 = set_fingerprints(values, offsets)
                own = batch.slice(texts.row, len(texts))
                yield batch_of(
                    schema, doc_id=own["doc_id"], row=own["row"], n=np.diff(offsets), f1=signed(f1), f2=signed(f2)
                )

    return _texts(documents).mapInArrow(run, ", ".join(f"{name} long" for name in names))


def set_keys(documents: DataFrame, words: int, percent: int) -> DataFrame:
    """``key``, ``set`` and ``along`` for every key of every set; of equal sets in a chunk one is taken."""
    schema = pa.schema([("key", pa.int64()), ("set", pa.int64()), ("along", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch["text"]):
                values, offsets = distinct_shingles(texts, words, lower=True)
                f1, _ = set_fingerprints(values, offsets)
                once = np.zeros(len(texts), bool)
                once[np.unique(f1, return_index=True)[1]] = True
                keys, owners, along = part_keys(values, offsets, percent)
                some = once[owners]
                yield batch_of(schema, key=signed(keys[some]), set=signed(f1[owners[some]]), along=along[some])

    return documents.select("text").mapInArrow(run, "key long, set long, along long")


def distinct_sets(rows: DataFrame) -> DataFrame:
    """``set`` (its fingerprint), its size, the least document that has it, and a row to read it from."""
    least = [F.min(name).alias(name) for name in ("n", "doc_id", "row")]
    return rows.filter("n > 0").groupBy("f1", "f2").agg(*least).select(F.col("f1").alias("set"), "doc_id", "row", "n")


def candidates(keys: DataFrame, percent: int) -> DataFrame:
    """Stars that connect all sets which have enough keys in common with others and differ little in size.

    A set stays if in some band as many of its keys are shared, by whichever sets, as a set that
    links with it would share. So most sets that only have a line or a passage in common go.
    """
    by_key = Window.partitionBy("key").orderBy("along", "set")
    lonely = F.lag("set").over(by_key).eqNullSafe(F.col("set")) & F.lead("set").over(by_key).isNull()
    alone = F.lag("set").over(by_key).isNull() & F.lead("set").over(by_key).eqNullSafe(F.col("set"))
    single = F.lag("set").over(by_key).isNull() & F.lead("set").over(by_key).isNull()
    shared = stored(keys.withColumn("alone", single | lonely | alone).filter("NOT alone").select("key", "set", "along").distinct())
    counted = shared.groupBy("set", "along").agg(F.count("*").alias("keys"))
    enough = counted.filter(F.col("keys") >= F.col("along").bitwiseAND(0xFFFF)).select("set").distinct()
    size = F.shiftright("along", 32)
    before = F.lag(size).over(by_key)
    head = F.when(before.isNull() | (100 * before < percent * size), F.col("set"))
    return (
        shared.join(enough, "set")
        .withColumn("head", head)
        .withColumn("hub", F.last("head", ignorenulls=True).over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
        .filter("hub != set")
        .select(F.col("set").alias("a"), F.col("hub").alias("b"))
        .distinct()
    )


def blocked(sets: DataFrame, groups: DataFrame) -> DataFrame:
    """Members of candidate groups, each group cut by size into blocks of about ``BLOCK_BYTES``.

    Tokens are added up by group and size, so that no window holds a group's members; sets of one
    size are dealt by their hash to the blocks that their tokens fill.
    """
    members = sets.select("set", "n", "row").join(groups.select(F.col("node").alias("set"), F.col("component").alias("grp")), "set")
    tokens = members.groupBy("grp", "n").agg((F.count("*") * F.col("n")).alias("own"))
    upto = Window.partitionBy("grp").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    begun = tokens.withColumn("before", F.coalesce(F.sum("own").over(upto), F.lit(0)))
    share = F.pmod(F.xxhash64("set"), F.lit(1 << 20)) / float(1 << 20)
    block = F.floor((F.col("before") + share * F.col("own")) * 8 / BLOCK_BYTES).cast("int")
    return members.join(begun, ["grp", "n"]).select("set", "n", "row", "grp", block.alias("block"))


def tree_links(documents: DataFrame, dealt: DataFrame, words: int, percent: int) -> DataFrame:
    """Stars that connect what links within each deal of ``dealt`` (``set``, ``row``, ``grp``, ``i``, ``j``, ``side``, ``label``).

    Texts come from ``documents``; a set is built again from its text where its deal is joined.
    With ``i < j`` only sets of different sides are compared.
    """
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    fields = ["grp", "i", "j", "set", "side", "label"]
    rows_schema = pa.schema([(name, pa.int64()) for name in fields] + [("tokens", pa.binary())])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch["text"]):
                values, offsets = distinct_shingles(texts, words, lower=True)
                own = batch.slice(texts.row, len(texts))
                f1 = signed(set_fingerprints(values, offsets)[0])
                right = pa.array(f1 == own["set"].to_numpy())  # another row may have the same id
                tokens = pa.array([values[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])], pa.binary())
                out = batch_of(rows_schema, **{name: own[name] for name in fields}, tokens=tokens)
                yield out.filter(right)

    def join(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = np.stack([table[name].to_numpy() for name in ("grp", "i", "j", "set")])
        group = np.ones(table.num_rows, bool)
        group[1:] = (keys[:3, 1:] != keys[:3, :-1]).any(axis=0)
        fresh = group.copy()
        fresh[1:] |= keys[3, 1:] != keys[3, :-1]
        rows = np.flatnonzero(fresh)
        firsts = np.append(np.flatnonzero(group[rows]), len(rows))
        side, label, tokens = table["side"].to_numpy(), table["label"].to_numpy(), table["tokens"]
        found = []
        for a, b in zip(firsts[:-1], firsts[1:]):
            own = rows[a:b]
            if len(own) < 2:
                continue
            sets = [np.frombuffer(tokens[int(r)].as_py(), np.uint64) for r in own]
            offsets = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
            across = keys[1, own[0]] != keys[2, own[0]]
            pairs = linked(np.concatenate(sets), offsets, percent, label[own], side[own] if across else None)
            hub = merged(np.arange(len(own)), pairs[:, 0], pairs[:, 1])  # stars, so that components settle soon
            joined = np.flatnonzero(hub != np.arange(len(own)))
            found.append(keys[3][own][np.stack([joined, hub[joined]], axis=1)])
        pairs = np.concatenate(found) if found else np.zeros((0, 2), np.int64)
        yield batch_of(schema, a=pairs[:, 0], b=pairs[:, 1])

    order = ["grp", "i", "j", "set"]
    return (
        dealt.join(_texts(documents).select("row", "text"), "row")
        .select(*[F.col(name).cast("long").alias(name) for name in fields], "text")
        .mapInArrow(build, ", ".join(f"{name} long" for name in fields) + ", tokens binary")
        .repartition("grp", "i", "j")
        .sortWithinPartitions(*order)
        .mapInArrow(lambda batches: grouped_stream(batches, order[:3], ROWS_PER_RUN, join), "a long, b long")
    )


def links(documents: DataFrame, sets: DataFrame, words: int, percent: int) -> DataFrame:
    """Links (``a``, ``b``) between sets that connect all sets which are similar enough."""
    members = stored(blocked(sets, components(candidates(set_keys(documents, words, percent), percent))))
    wide = members.groupBy("grp").agg(F.max("block").alias("last"))
    first = members.groupBy("grp").agg(F.min(F.struct("n", "set", "row")).alias("s"))
    own = members.withColumns({"i": F.col("block"), "j": F.col("block"), "side": F.lit(0), "label": F.col("set")})
    guests = (
        wide.filter("last > 0")
        .select("grp", F.explode(F.sequence(F.lit(1), "last")).alias("i"))
        .join(first, "grp")
        .select("s.set", "s.row", "grp", "i", F.col("i").alias("j"), F.lit(0).alias("side"), F.col("s.set").alias("label"))
    )
    columns = ["set", "row", "grp", "i", "j", "side", "label"]
    found = stored(tree_links(documents, own.select(*columns).unionByName(guests.select(*columns)), words, percent))
    if wide.filter("last > 0").isEmpty():
        return found
    return found.unionByName(_between_blocks(documents, members, found, words, percent))


def _between_blocks(documents: DataFrame, members: DataFrame, found: DataFrame, words: int, percent: int) -> DataFrame:
    """Links between the blocks of large groups that are not one component yet."""
    labels = components(found).select(F.col("node").alias("set"), F.col("component").alias("label"))
    known = stored(
        members.join(members.filter("block > 0").select("grp").distinct(), "grp")
        .join(labels, "set", "left")
        .withColumn("label", F.coalesce("label", "set"))
    )
    blocks = known.groupBy("grp", "block").agg(
        F.min("n").alias("low"), F.max("n").alias("high"), F.min("label").alias("least"), F.max("label").alias("most")
    )
    i, j = blocks.alias("i"), blocks.alias("j")
    near = (
        (F.col("i.grp") == F.col("j.grp"))
        & (F.col("i.block") < F.col("j.block"))
        & (100 * F.col("i.high") >= percent * F.col("j.low"))
        & ~((F.col("i.least") == F.col("i.most")) & (F.col("j.least") == F.col("j.most")) & (F.col("i.least") == F.col("j.least")))
    )
    pairs = i.join(j, near).select(F.col("i.grp").alias("grp"), F.col("i.block").alias("i"), F.col("j.block").alias("j"))
    deals = pairs.select(
        "grp", "i", "j", F.explode(F.array(F.struct(F.col("i").alias("block"), F.lit(0).alias("side")), F.struct(F.col("j").alias("block"), F.lit(1).alias("side")))).alias("d")
    ).select("grp", "i", "j", "d.block", "d.side")
    return stored(tree_links(documents, known.join(deals, ["grp", "block"]), words, percent))


def placed_sets(documents: DataFrame, words: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The rows as ``described``, and every distinct ``set`` with its least ``doc_id`` and its ``component``."""
    small_batches(documents.sparkSession)
    documents = by_place(documents, "doc_id", "text")
    rows = stored(described(documents, words))
    sets = stored(distinct_sets(rows))
    found = components(links(documents, sets, words, percent))
    placed = (
        sets.select("set", "doc_id")
        .join(found.select(F.col("node").alias("set"), "component"), "set", "left")
        .withColumn("component", F.coalesce("component", "set"))
    )
    return rows, placed


def groups(documents: DataFrame, words: int, percent: int) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` (least id that links reach) of every row."""
    rows, placed = placed_sets(documents, words, percent)
    least = placed.groupBy("component").agg(F.min("doc_id").alias("least"))
    named = placed.join(least, "component").select(F.col("set").alias("f1"), "least")
    return (
        rows.select("doc_id", "n", F.when(F.col("n") > 0, F.col("f1")).alias("f1"))
        .join(named, "f1", "left")
        .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("least", "doc_id").alias("component_id"))
    )


def keep_one(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of ``documents`` for each group of similar texts, columns as they are.

    Rows are judged by their own text: the row of least id stays (rows without an id come last),
    of several texts of that id in the group a fixed one, of equal ones one. Rows without a
    shingle are no duplicates of anything and all stay.
    """
    _, placed = placed_sets(documents, words, percent)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "set")).alias("first")
    firsts = placed.groupBy("component").agg(first).select(F.col("first.set").alias("winner"), F.col("first.doc_id").alias("first"))

    def fingerprints(texts: Texts) -> dict[str, object]:
        values, offsets = distinct_shingles(texts, words, lower=True)
        sizes = np.diff(offsets)
        f1 = signed(set_fingerprints(values, offsets)[0])
        return {"set": pa.array(f1, mask=sizes == 0), "n": sizes}

    places = [f"c{i}" for i in range(len(documents.columns))]
    doc_id = F.col(f"c{documents.columns.index('doc_id')}").cast("long")
    own = appended(documents, pa.schema([("set", pa.int64()), ("n", pa.int64())]), fingerprints).toDF(*places, "set", "n")
    named = own.withColumn("id", doc_id).withColumn("set", F.coalesce("set", F.xxhash64("id")))
    is_first = (F.col("set") == F.col("winner")) & F.col("id").eqNullSafe(F.col("first"))
    kept = named.join(firsts, is_first, "left").filter("n = 0 OR winner IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("set", "id").orderBy("n"))
    return kept.withColumn("place", place).filter("n = 0 OR place = 1").select(*places).toDF(*documents.columns)


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(spark.read.parquet(f"{sf_dir}/documents.parquet"), words=3, percent=90)


OP2_SQL = """
WITH words AS (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
sets AS (
    SELECT doc_id, list_distinct(CASE
        WHEN w IS NULL OR len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN generate_series(1, len(w) - 2)] END) AS s
    FROM words),
tokens AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
pairs AS (
    SELECT a.doc_id AS a, b.doc_id AS b
    FROM tokens AS a JOIN tokens AS b ON a.t = b.t AND a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n
    HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
edges AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (
    WITH RECURSIVE r(doc_id, other) AS (
        SELECT doc_id, doc_id FROM sets UNION SELECT r.doc_id, e.b FROM r JOIN edges AS e ON r.other = e.a)
    SELECT doc_id, min(other) AS component_id FROM r GROUP BY doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, reach.component_id
FROM sets AS s JOIN reach ON s.doc_id = reach.doc_id
"""
