"""Near-duplicate embeddings by a forest of random-projection trees.

Vectors are compared within equal labels only. Every tree cuts a label's vectors in two along a
random direction at the median, and the parts likewise, until a part holds ``LEAF`` vectors or so.
Vectors close to a cut go to both sides, so that neighbours are seldom parted. Pairs are compared
within the leaves of all ``TREES`` trees, in double precision; pairs found are joined into groups.

Equal vectors become one point first, which stands for all of them. A label, or part of one, that
fits into ``BLOCK_BYTES`` goes to one task, which grows the rest of its trees in memory; a label
that does so as a whole gets all its trees there, so its points are shuffled once. Larger labels
are first cut by Spark, in rounds of up to ``DEPTH`` cuts: thresholds are fitted to about
``SAMPLE`` points of each part that is still too large, and every point is sent down.

A cut is worth its overlap only if few points lie in it. One that sends more than ``TIGHT`` of a
part to both sides is given up: such a part is dense, most of its points are close to each other,
and comparing it as a whole takes less work than cutting it again and again. So a point has at most
``(1 + TIGHT) ** cuts`` rows in a tree. A label that can't be cut at all is compared once, not once
for each tree. Parts over ``BLOCK_BYTES`` that stay whole are compared block by block, so nothing
is left out and no task holds more than two blocks.

Pairs are never listed. A part passes on, for each point that links with another, the least
point it is joined to there. How many vectors a point links with is then counted within the
groups so found, block by block, where every pair of points meets exactly once.

Defined cases: a vector that is null, empty, zero or holds null or non-finite components, and a
vector without a label, links with nothing; vectors of different length don't link; rows with the
same id are vectors of their own but share the id; rows without an id can link but don't name a
group; vectors count with all their components, however many; an empty table gives an empty
result; other columns are never read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareweather.llm.components import components, merged
from fareweather.llm.tasks import batch_of, by_place, grouped_stream, small_batches, stored

TREES = 8
LEAF = 128
DEPTH = 5
SAMPLE = 1024
ROUNDS = 12

#: Components of the points that a task holds at once, twice where blocks meet.
BLOCK_BYTES = 16 << 20

#: Half the width of the overlap at a cut, in standard deviations of what a cut's direction shows
#: of the distance of two vectors that just link.
SPILL = 0.4

#: A cut is given up if more of its points than this lie in the overlap.
TIGHT = 0.25

#: Pairs that a task holds before it joins their points.
PAIRS_AT_ONCE = 1 << 20

ROWS_PER_RUN = 4096


def block_points(dim: Column) -> Column:
    """How many points of so many components a block has."""
    return F.greatest(F.lit(2), F.floor(F.lit(BLOCK_BYTES) / (8 * dim))).cast("int")


def points_of(embeddings: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All vectors with their point (``rid``, null for those that link with nothing), and the points."""
    schema = pa.schema([("vec_id", pa.int64()), ("label", pa.string()), ("dim", pa.int32()), ("v", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [unit_bytes(row) for row in batch["v"].to_pylist()]
            usable = [None if v is None or label is None else v for v, label in zip(out, batch["label"].to_pylist())]
            dims = [None if v is None else len(v) // 8 for v in usable]
            yield batch_of(schema, vec_id=batch["vec_id"], label=batch["label"], dim=dims, v=usable)

    source = by_place(embeddings, "vec_id", "label", "embedding").select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("string").alias("label"),
        F.col("embedding").cast("array<double>").alias("v"),
    )
    rows = stored(
        source.mapInArrow(run, "vec_id long, label string, dim int, v binary").withColumn(
            "rid", F.when(F.col("v").isNotNull(), F.xxhash64("label", "v"))
        )
    )
    points = (
        rows.filter("rid IS NOT NULL")
        .groupBy("rid", "label", "dim", "v")
        .agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
    )
    return rows.select("vec_id", "rid"), stored(points)


def unit_bytes(row: list | None) -> bytes | None:
    """A vector of length 1 as bytes; None if it has no direction."""
    if not row or None in row:
        return None
    v = np.array(row, float)
    if not np.isfinite(v).all():
        return None
    largest = np.abs(v).max()
    if largest == 0:
        return None
    v = v / largest
    return (v / np.sqrt(v @ v) + 0.0).tobytes()


def directions(node: int, dim: int) -> np.ndarray:
    """The random directions of a part's cuts, always the same ones for the same part."""
    d = np.random.default_rng(node & (2**63 - 1)).normal(size=((1 << DEPTH) - 1, dim))
    return d / np.linalg.norm(d, axis=1, keepdims=True)


def margin(cosine: float, dim: int) -> float:
    return SPILL * np.sqrt(2 * (1 - cosine) / dim)


def fit_cuts(x: np.ndarray, node: int, levels: int, cosine: float) -> np.ndarray:
    """Thresholds of the cuts of a part, fitted to some of its points; NaN for no cut."""
    cuts = np.full((1 << DEPTH) - 1, np.nan)
    across = directions(node, x.shape[1])
    inside = {0: np.arange(len(x))}
    for i in range((1 << levels) - 1):
        rows = inside.get(i)
        if rows is None or len(rows) < 16:
            continue
        cut = halves(x[rows] @ across[i], margin(cosine, x.shape[1]))
        if cut is not None:
            cuts[i], left, right = cut
            inside[2 * i + 1], inside[2 * i + 2] = rows[left], rows[right]
    return cuts


def halves(along: np.ndarray, width: float) -> tuple[float, np.ndarray, np.ndarray] | None:
    """The median and the points on either side of it, those close to it on both; None if these are too many."""
    middle = float(np.median(along))
    if np.mean(np.abs(along - middle) <= width) > TIGHT:
        return None
    return middle, np.flatnonzero(along <= middle + width), np.flatnonzero(along >= middle - width)


def sent_down(x: np.ndarray, node: int, cuts: np.ndarray, cosine: float) -> Iterator[tuple[int, np.ndarray]]:
    """The leaves that the points reach below a part, and which points reach them."""
    across, width = directions(node, x.shape[1]), margin(cosine, x.shape[1])
    reached = [(0, np.arange(len(x)))]
    while reached:
        i, rows = reached.pop()
        if not len(rows):
            continue
        if i >= len(cuts) or np.isnan(cuts[i]):
            yield i, rows
            continue
        along = x[rows] @ across[i]
        reached.append((2 * i + 1, rows[along <= cuts[i] + width]))
        reached.append((2 * i + 2, rows[along >= cuts[i] - width]))


def child(node: int, i: int) -> int:
    """The number of a part below another."""
    value = (node * 0x9E3779B97F4A7C15 + (i + 1) * 0xD6E8FEB86659FD93) & (2**64 - 1)
    value = ((value ^ (value >> 29)) * 0xBF58476D1CE4E5B9) & (2**64 - 1)
    value ^= value >> 32
    return value - (1 << 64) if value >= 1 << 63 else value


def matrix(blobs: list[bytes], dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), float).reshape(-1, dim)


def parts(points: DataFrame, cosine: float) -> DataFrame:
    """``rid``, ``node`` and ``trees``: the parts that each point is compared in.

    ``trees`` is how many trees are to be grown in a part; 0 for one that is compared as a whole.
    """
    sizes = points.groupBy("label", "dim").agg(F.count("*").alias("held"))
    sizes = stored(sizes.withColumn("fits", F.col("held") <= block_points(F.col("dim"))))
    labelled = points.select("rid", "label", "dim").join(sizes, ["label", "dim"])
    whole = F.xxhash64("label", "dim")
    done = labelled.filter("fits").select("rid", whole.alias("node"), F.lit(TREES).alias("trees"))
    if sizes.filter("NOT fits").isEmpty():
        return done
    trees = labelled.filter("NOT fits").withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))))
    open_rows = trees.select("rid", F.xxhash64("tree", "label", "dim").alias("node"), whole.alias("root"), "dim")
    for level in range(ROUNDS):
        counts = open_rows.groupBy("node").agg(F.count("*").alias("size"))
        sized = stored(open_rows.join(counts, "node").withColumn("fits", F.col("size") <= block_points(F.col("dim"))))
        done = done.unionByName(sized.filter("fits").select("rid", "node", F.lit(1).alias("trees")))
        large = sized.filter("NOT fits")
        if large.isEmpty():
            return done
        wide = large.join(points.select("rid", "v"), "rid")
        cuts = stored(fitted(wide, cosine))
        # A label that no cut thins out is one part, whichever trees find so.
        uncut = large.join(cuts.filter("whole").select("node"), "node")
        done = done.unionByName(
            uncut.select("rid", F.col("root" if level == 0 else "node").alias("node"), F.lit(0).alias("trees")).distinct()
        )
        open_rows = routed(wide.join(cuts.filter("NOT whole").select("node", "cuts"), "node"), cosine).withColumn("root", F.col("node"))
    return done.unionByName(open_rows.select("rid", "node", F.lit(0).alias("trees")))  # parts this deep are compared as they are


def fitted(wide: DataFrame, cosine: float) -> DataFrame:
    """``node``, ``cuts`` and whether the part stays ``whole``, from about ``SAMPLE`` points of each part."""
    draw = F.pmod(F.xxhash64("rid", "node"), F.lit(1 << 30))
    levels = F.least(F.lit(DEPTH), F.ceil(F.log2(F.col("size") / block_points(F.col("dim"))))).cast("int").alias("levels")
    sample = wide.filter(draw < F.lit(float(SAMPLE << 30)) / F.col("size")).select("node", levels, "dim", "v")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        node, dim = int(pdf["node"].iloc[0]), int(pdf["dim"].iloc[0])
        x = matrix(sorted(pdf["v"]), dim)  # in order, so that a repeated task fits the same cuts
        cuts = fit_cuts(x, node, int(pdf["levels"].iloc[0]), cosine)
        return pd.DataFrame({"node": [node], "cuts": [cuts.tobytes()], "whole": [bool(np.isnan(cuts).all())]})

    return sample.groupBy("node").applyInPandas(fit, "node long, cuts binary, whole boolean")


def routed(rows: DataFrame, cosine: float) -> DataFrame:
    schema = pa.schema([("rid", pa.int64()), ("node", pa.int64()), ("dim", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, rid = batch["node"].to_numpy(), batch["rid"].to_numpy()
            order = np.argsort(node, kind="stable")
            ends = np.append(np.flatnonzero(np.diff(node[order], prepend=node[order][:1] - 1)), len(order)) if len(order) else []
            for a, b in zip(ends[:-1], ends[1:]):
                own = order[a:b]
                here, dim = int(node[own[0]]), batch["dim"][int(own[0])].as_py()
                x = matrix([batch["v"][int(i)].as_py() for i in own], dim)
                for i, at in sent_down(x, here, np.frombuffer(batch["cuts"][int(own[0])].as_py(), float), cosine):
                    yield batch_of(schema, rid=rid[own[at]], node=np.full(len(at), child(here, i)), dim=np.full(len(at), dim))

    return rows.select("rid", "node", "dim", "v", "cuts").mapInArrow(run, "rid long, node long, dim int")


def leaves(x: np.ndarray, node: int, trees: int, cosine: float) -> Iterator[np.ndarray]:
    """The points of each leaf of the trees of a part; all points, once, if no tree can cut them."""
    uncut = False
    for tree in range(trees):
        random = np.random.default_rng([node & (2**63 - 1), tree])
        open_parts = [np.arange(len(x))]
        while open_parts:
            rows = open_parts.pop()
            if len(rows) > LEAF:
                direction = random.normal(size=x.shape[1])
                cut = halves(x[rows] @ (direction / np.linalg.norm(direction)), margin(cosine, x.shape[1]))
                if cut is not None:
                    open_parts += [rows[cut[1]], rows[cut[2]]]
                    continue
            if len(rows) < len(x) or not uncut:
                yield rows
            uncut |= len(rows) == len(x)
        if len(x) <= LEAF:
            return


PAIR_COLUMNS = ["grp", "i", "j", "block", "rid", "dim", "copies", "trees", "v"]


def in_blocks(rows: DataFrame) -> DataFrame:
    """The members of each ``grp``, cut into blocks, once for each pair of blocks they are in."""
    sizes = rows.groupBy("grp").agg(F.ceil(F.count("*") / F.max(block_points(F.col("dim")))).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j")),
    )
    dealt = rows.join(sizes, "grp").withColumn("block", block).withColumn("deal", F.explode(others))
    return dealt.withColumns({"i": F.col("deal.i"), "j": F.col("deal.j")})


def by_pair_of_blocks(points: DataFrame, members: DataFrame, work, kind: str) -> DataFrame:
    """Call ``work`` on the points of every pair of blocks of ``members`` (``grp``, ``rid``, ``trees``)."""

    def run(table: pa.Table) -> Iterator[pa.RecordBatch]:
        keys = np.stack([table[name].to_numpy() for name in ("grp", "i", "j")])
        new = np.ones(table.num_rows, bool)
        new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        ends = np.append(np.flatnonzero(new), table.num_rows)
        found = [work(table.slice(a, b - a)) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist()) if b - a > 1]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*found)], kind.replace(" long", "").split(", "))

    rows = in_blocks(members.join(points.select("rid", "dim", "copies", "v"), "rid"))
    return (
        rows.select(*PAIR_COLUMNS)
        .repartition("grp", "i", "j")
        .sortWithinPartitions("grp", "i", "j", "rid")
        .mapInArrow(lambda batches: grouped_stream(batches, ["grp", "i", "j"], ROWS_PER_RUN, run), kind)
    )


def near_pairs(table: pa.Table, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of points that link, each pair once; of two blocks, pairs across them."""
    i, j, dim = (table[name][0].as_py() for name in ("i", "j", "dim"))
    block = table["block"].to_numpy()
    for p, q in close(matrix(table["v"].to_pylist(), dim), cosine):
        across = (block[p] != block[q]) | (i == j)
        if across.any():
            yield p[across], q[across]


def close(x: np.ndarray, cosine: float, rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of vectors whose cosine is enough, each pair once."""
    for first in range(0, len(x), rows):
        p, q = np.nonzero(x[first : first + rows] @ x[first:].T >= cosine)
        real = p < q
        if real.any():
            yield p[real] + first, q[real] + first


def hubs(points: DataFrame, placed: DataFrame, cosine: float) -> DataFrame:
    """``rid``, ``hub``: for each point that links with another in a part, the least it is joined to there."""

    def join(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        rid = table["rid"].to_numpy()
        hub, linked = np.arange(len(rid)), np.zeros(len(rid), bool)
        held, size = [], 0
        for p, q in _part_pairs(table, cosine):
            linked[p] = linked[q] = True
            held.append((p, q))
            size += len(p)
            if size >= PAIRS_AT_ONCE:
                hub, held, size = _joined(hub, held), [], 0
        hub = _joined(hub, held)
        some = np.flatnonzero(linked)
        return rid[some], rid[hub[some]]

    members = placed.withColumnRenamed("node", "grp")
    return by_pair_of_blocks(points, members, join, "rid long, hub long").distinct()


def _part_pairs(table: pa.Table, cosine: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of points that link within a leaf of the part; a pair comes once for each of these."""
    trees, i, j = (table[name][0].as_py() for name in ("trees", "i", "j"))
    if not trees or i != j:
        yield from near_pairs(table, cosine)
        return
    x = matrix(table["v"].to_pylist(), table["dim"][0].as_py())
    for rows in leaves(x, table["grp"][0].as_py(), trees, cosine):
        for p, q in close(x[rows], cosine):
            yield rows[p], rows[q]


def _joined(hub: np.ndarray, held: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    if not held:
        return hub
    p, q = (hub[np.concatenate(side)] for side in zip(*held))
    return merged(hub, p[p != q], q[p != q])


def counted(points: DataFrame, joined: DataFrame, cosine: float) -> DataFrame:
    """``rid``, ``links``: how many vectors of other points each point of a group links with."""

    def count(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        rid, copies = table["rid"].to_numpy(), table["copies"].to_numpy()
        links = np.zeros(len(rid))
        for p, q in near_pairs(table, cosine):
            links += np.bincount(p, copies[q], len(rid)) + np.bincount(q, copies[p], len(rid))
        return rid, links.astype(np.int64)

    members = joined.select(F.col("component").alias("grp"), F.col("node").alias("rid"), F.lit(0).alias("trees"))
    found = by_pair_of_blocks(points, members, count, "rid long, links long")
    return found.groupBy("rid").agg(F.sum("links").alias("links"))


def groups(embeddings: DataFrame, cosine: float) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every vector."""
    small_batches(embeddings.sparkSession)
    vectors, points = points_of(embeddings)
    placed = stored(parts(points, cosine))
    joined = components(hubs(points, placed, cosine), "rid", "hub")
    links = counted(points, joined, cosine)
    placed_points = (
        points.select("rid", "vec_id", "copies")
        .join(joined.select(F.col("node").alias("rid"), "component"), "rid", "left")
        .withColumn("component", F.coalesce("component", "rid"))
    )
    least = placed_points.groupBy("component").agg(F.min("vec_id").alias("least"))
    named = placed_points.join(least, "component").join(links, "rid", "left").select(
        "rid", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
    return vectors.join(named, "rid", "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("least", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("least", "vec_id"), F.lit(False)).alias("kept"),
    )


def op4_embedding_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), cosine=0.93)
