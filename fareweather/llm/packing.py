"""Best-fit packing of documents into sequences of several permitted lengths.

A document is its words and one end; one longer than the largest capacity is cut into pieces of
that capacity and a rest. Pieces go, longest first, into the open bin with the least room that
still holds them. If none does, a bin is opened: of the capacities that hold the piece the one
whose cost per token is least, counting what the pieces still to come can put into the rest of
it. At the end every bin shrinks to the smallest capacity that holds its contents.

Pieces of one length are alike, so the plan is made from how many there are of each length: at
most as many numbers as the largest capacity, however many documents. The plan says for ranges of
pieces of a length which range of bins they go to, and where in them. Spark numbers the pieces of
each length, dealt over ``PIECES_PER_DEAL`` sized deals, so that a length that very many have is
not one task's; every piece then looks its place up in the plan.

Defined cases: a null, empty or blank text is one token, its end; repeated rows are packed each;
rows without an id are packed like all others; a text longer than the
largest bin is cut into pieces; pieces of one length are dealt in a fixed order, and of bins that
cost the same the smallest is opened; an empty table gives an empty result; other columns are never
read, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareweather.llm.tasks import batch_of, by_place, small_batches, stored
from fareweather.llm.text import text_chunks

CAPACITIES = (1024, 2048, 4096, 8192)
PIECES_PER_DEAL = 5_000


def sequence_cost(capacity: int) -> float:
    """What a sequence costs to train on: a part in proportion to its length and one to its square."""
    return capacity + capacity * capacity / 65536


@dataclass
class Plan:
    """Where pieces go. A segment holds the pieces ``rank`` to the next segment's of one ``length``."""

    segments: list[tuple[int, int, int, int, int]] = field(default_factory=list)  # length, rank, bin, per bin, offset
    bins: list[tuple[int, int]] = field(default_factory=list)  # first bin of a range, tokens in each

    def arrays(self, capacities: tuple[int, ...]) -> dict[str, np.ndarray]:
        segments = np.array(sorted(self.segments), np.int64).reshape(-1, 5)
        bins = np.array(sorted(self.bins), np.int64).reshape(-1, 2)
        sizes = np.array(sorted(capacities), np.int64)
        fitting = sizes[np.searchsorted(sizes, bins[:, 1])] if len(bins) else bins[:, 1]
        return {"segments": segments, "first": bins[:, 0], "capacity": fitting}


def plan_bins(
    counts: Mapping[int, int], capacities: tuple[int, ...] = CAPACITIES, costs: Mapping[int, float] | None = None
) -> Plan:
    """Best fit by falling length over ``counts`` (pieces of each length)."""
    sizes = sorted(capacities)
    price = dict(costs or {size: sequence_cost(size) for size in sizes})
    lengths = sorted(length for length, n in counts.items() if n > 0)
    plan, next_bin = Plan(), 0
    rooms: list[int] = []
    open_bins: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # room: first bin, bins, tokens in each

    def put(room: int, first: int, n: int, used: int) -> None:
        if room == 0 or room < lengths[0]:
            plan.bins.append((first, used))
            return
        if not open_bins[room]:
            insort(rooms, room)
        open_bins[room].append((first, n, used))

    for place in range(len(lengths) - 1, -1, -1):
        length, left, rank = lengths[place], counts[lengths[place]], 0
        while left:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                room = rooms[at]
                first, n, used = open_bins[room].pop()
                if not open_bins[room]:
                    rooms.pop(at)
                each = min(room // length, left)  # a bin with this piece is the next one's best fit
                taken = min(n, left // each)
                if taken < n:
                    put(room, first + taken, n - taken, used)
                plan.segments.append((length, rank, first, each, used))
                put(room - each * length, first, taken, used + each * length)
                rank, left = rank + taken * each, left - taken * each
                continue
            size = cheapest(length, left, lengths[: place + 1], counts, sizes, price)
            each = min(size // length, left)
            n = left // each
            plan.segments.append((length, rank, next_bin, each, 0))
            put(size - each * length, next_bin, n, each * length)
            rank, left, next_bin = rank + n * each, left - n * each, next_bin + n
    for groups in open_bins.values():
        plan.bins += [(first, used) for first, _, used in groups]
    return plan


def cheapest(
    length: int, left: int, shorter: list[int], counts: Mapping[int, int], sizes: list[int], price: Mapping[int, float]
) -> int:
    """The capacity with the least cost per token, filled up with what is still to come."""
    best, least = 0, float("inf")
    for size in sizes:
        if size < length:
            continue
        room = size - length * min(size // length, left)
        at = bisect_left(shorter, min(room, length - 1) + 1) - 1
        while at >= 0 and room >= shorter[0]:
            room -= shorter[at] * min(counts[shorter[at]], room // shorter[at])
            at = min(at, bisect_left(shorter, room + 1)) - 1
        cost = price[size] / (size - room)
        if cost < least:
            best, least = size, cost
    return best


def pieces(documents: DataFrame, largest: int) -> DataFrame:
    """``doc_id``, ``piece`` and ``n_tokens`` of the pieces of every document."""
    schema = pa.schema([("doc_id", pa.int64()), ("tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch["text"]):
                yield batch_of(schema, doc_id=batch["doc_id"].slice(texts.row, len(texts)), tokens=texts.n_words + 1)

    source = by_place(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    piece = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("tokens") - 1) / largest)))
    return (
        source.mapInArrow(run, "doc_id long, tokens long")
        .select("doc_id", "tokens", piece.alias("piece"))
        .select("doc_id", "piece", F.least(F.lit(largest), F.col("tokens") - F.col("piece") * largest).cast("int").alias("n_tokens"))
    )


def numbered(items: DataFrame, total: int) -> DataFrame:
    """``rank`` of each piece among those of its length."""
    deals = max(1, -(-total // PIECES_PER_DEAL))
    who = F.coalesce("doc_id", F.monotonically_increasing_id())  # stored rows, so the numbers don't change
    dealt = items.withColumn("deal", F.pmod(F.xxhash64(who, "piece"), F.lit(deals)).cast("int"))
    before = Window.partitionBy("n_tokens").orderBy("deal").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy("n_tokens", "deal")
        .agg(F.count("*").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    )
    within = Window.partitionBy("n_tokens", "deal").orderBy("doc_id", "piece")
    return (
        dealt.withColumn("place", F.row_number().over(within))
        .join(offsets.select("n_tokens", "deal", "before"), ["n_tokens", "deal"])
        .select("doc_id", "piece", "n_tokens", (F.col("before") + F.col("place") - 1).alias("rank"))
    )


def pack(documents: DataFrame, capacities: tuple[int, ...] = CAPACITIES, costs: Mapping[int, float] | None = None) -> DataFrame:
    """``doc_id``, ``piece``, ``n_tokens``, ``bin_id``, ``bin_offset`` and ``bin_capacity`` of every piece."""
    small_batches(documents.sparkSession)
    items = stored(pieces(documents, max(capacities)))
    counts = {row["n_tokens"]: row["n"] for row in items.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}
    plan = documents.sparkSession.sparkContext.broadcast(plan_bins(counts, capacities, costs).arrays(capacities))
    names = ["doc_id", "piece", "n_tokens", "bin_id", "bin_offset", "bin_capacity"]
    schema = pa.schema([(name, pa.int64()) for name in names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        segments, first, capacity = (plan.value[name] for name in ("segments", "first", "capacity"))
        codes = segments[:, 0] << 40 | segments[:, 1]
        for batch in batches:
            length, rank = batch["n_tokens"].to_numpy().astype(np.int64), batch["rank"].to_numpy()
            own = segments[np.searchsorted(codes, length << 40 | rank, "right") - 1]
            within = rank - own[:, 1]
            bins = own[:, 2] + within // own[:, 3]
            yield batch_of(
                schema,
                doc_id=batch["doc_id"],
                piece=batch["piece"],
                n_tokens=length,
                bin_id=bins,
                bin_offset=own[:, 4] + within % own[:, 3] * length,
                bin_capacity=capacity[np.searchsorted(first, bins, "right") - 1],
            )

    return numbered(items, sum(counts.values())).mapInArrow(run, ", ".join(f"{name} long" for name in names))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
