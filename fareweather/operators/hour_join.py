"""Trips LEFT JOIN weather on the full hour, one output row per matching observation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareweather.functions.clock import hour_key, instant_hour_key
from fareweather.session import shared_folder

WEATHER_COLUMNS = ("temperature", "humidity", "wind_speed", "weather_category")

# Weather is broadcast only up to this measured size. One observation per hour
# makes 8,760 rows a year, so the limit holds about a century of hourly feeds.
BROADCAST_LIMIT_BYTES = 128 * 1024 * 1024
# Hash relation cost of one observation besides its text: key, pointers, row header, 3 doubles.
OBSERVATION_BYTES = 128

# Nor is it broadcast if some hour has more observations: one task would write out all pairs of
# its trips of that hour.
BUSY_HOUR = 1_000

# Beyond that an hour is cut into cells of about this many rows, and of so many pairs at most.
CELL_ROWS = 1_000_000
CELL_PAIRS = 20_000_000
# The list of cut hours is broadcast; cells grow with the data so that it stays this short.
MAX_CELLS = 200_000
# The shuffle gets at least one partition for so many rows, whatever the session's setting.
PARTITION_ROWS = 5_000_000


def enrich_trips(
    trips: DataFrame,
    weather: DataFrame,
    broadcast_limit: int = BROADCAST_LIMIT_BYTES,
    cell_rows: int = CELL_ROWS,
    cell_pairs: int = CELL_PAIRS,
) -> DataFrame:
    """All trip columns plus the weather of the pickup hour.

    Unmatched trips stay with NULL weather, several observations in an hour repeat the
    trip, and a NULL pickup matches nothing.
    """
    observations = weather.select(instant_hour_key(F.col("timestamp")).alias("_hour"), *WEATHER_COLUMNS).where(
        F.col("_hour").isNotNull()
    )
    keyed = trips.withColumn("_hour", hour_key(F.col("tpep_pickup_datetime")))
    size, busiest = measured(observations)
    if size <= broadcast_limit and busiest <= BUSY_HOUR:
        joined = keyed.join(F.broadcast(observations), "_hour", "left")
    else:
        joined = _join_in_cells(keyed, observations, cell_rows, cell_pairs)
    return joined.select(*trips.columns, *WEATHER_COLUMNS)


def measured(observations: DataFrame) -> tuple[int, int]:
    """An upper estimate of the broadcast size, and the observations of the busiest hour.

    Both come from the data itself, not from plan statistics.
    """
    text = F.coalesce(F.sum(F.octet_length("weather_category")), F.lit(0))
    per_hour = observations.groupBy("_hour").agg(F.count(F.lit(1)).alias("n"), text.alias("text"))
    rows, text, busiest = per_hour.agg(F.sum("n"), F.sum("text"), F.max("n")).first()
    return (rows or 0) * OBSERVATION_BYTES + (text or 0), busiest or 0


def _join_in_cells(keyed: DataFrame, observations: DataFrame, cell_rows: int, cell_pairs: int) -> DataFrame:
    """Shuffled join in which a busy hour is spread over a grid of cells.

    Trips of an hour are dealt to `_trip_cell`, observations to `_weather_cell`; each side is
    repeated along the other's axis, so every pair meets in exactly one cell. A trip visits
    only weather cells that hold a row, so no cell can add a false unmatched row. NULL pickups
    form a busy "hour" of their own and are dealt out the same way.
    """
    shared_folder(keyed.sparkSession)  # checkpoint() below needs the folder
    per_hour = (
        keyed.groupBy("_hour")
        .agg(F.count(F.lit(1)).alias("trips"))
        .join(observations.groupBy("_hour").agg(F.count(F.lit(1)).alias("observations")), "_hour", "full")
        .fillna(0, ["trips", "observations"])
        .checkpoint()
    )
    total, pairs = per_hour.agg(
        F.sum(F.col("trips") + F.col("observations")), F.sum(F.col("trips").cast("double") * F.col("observations"))
    ).first()
    total, pairs = total or 0, pairs or 0.0
    cell_rows = max(cell_rows, -(-2 * total // MAX_CELLS))
    cell_pairs = max(cell_pairs, 2 * pairs / MAX_CELLS)
    sized = per_hour.withColumns(_grid(cell_rows, cell_pairs)).checkpoint()
    cut_hours = sized.drop("trips", "observations").where((F.col("trip_cells") > 1) | (F.col("weather_cells") > 1))
    copied = sized.agg(
        F.sum(F.col("trips") * (F.col("weather_cells") - 1) + F.col("observations") * (F.col("trip_cells") - 1))
    ).first()[0] or 0

    # Dealt by position, which evens out identical observations too; checkpointed because
    # the positions are used twice and must not change when a task is run again.
    dealt = (
        observations.join(F.broadcast(cut_hours), "_hour", "left")
        .where(F.coalesce("trip_cells", F.lit(1)) > 0)  # a busy hour nobody travelled in
        .withColumn(
            "_weather_cell",
            F.pmod(F.monotonically_increasing_id(), F.coalesce("weather_cells", F.lit(1))),
        )
        .checkpoint()
    )
    held_cells = (
        dealt.where(F.col("weather_cells") > 1)
        .groupBy("_hour")
        .agg(F.collect_set("_weather_cell").alias("held_cells"))
    )
    cut_list = cut_hours.select(F.col("_hour").alias("_cut_hour"), "trip_cells")
    trip_side = (
        _deal_trips(keyed, cut_list)
        .join(F.broadcast(held_cells), "_hour", "left")  # after the deal, whose shuffle the lists would swell
        .withColumn("_weather_cell", F.explode(F.coalesce("held_cells", F.array(F.lit(0).cast("bigint")))))
        .select(*keyed.columns, "_trip_cell", "_weather_cell")
    )
    weather_side = dealt.withColumn(
        "_trip_cell", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("trip_cells", F.lit(1)) - 1))
    ).select(*observations.columns, "_trip_cell", "_weather_cell")
    keys = ["_hour", "_trip_cell", "_weather_cell"]
    # A number given keeps AQE from merging cells whose inputs are small but whose pairs are many.
    usual = int(keyed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    partitions = max(-(-total // PARTITION_ROWS), copied // PARTITION_ROWS, int(min(4 * pairs // cell_pairs, 4 * usual)))
    if partitions > 1:
        partitions = max(partitions, usual)
        trip_side = trip_side.repartition(partitions, *keys)
        weather_side = weather_side.repartition(partitions, *keys)
    return trip_side.join(weather_side, keys, "left")


def _grid(cell_rows: float, cell_pairs: float) -> dict[str, Column]:
    """Into how many cells an hour's trips and its observations are cut.

    Each side is copied as often as the other is cut. For a number of cells, fewest rows are
    copied when both sides come to as many copies in all; an hour cut along one side alone would
    copy the other once for every cell.
    """
    trips, observations = F.col("trips").cast("double"), F.col("observations").cast("double")
    cells = F.ceil(trips * observations / F.lit(cell_pairs))
    even = F.round(F.sqrt(cells * observations / F.greatest(trips, F.lit(1.0)))).cast("bigint")
    weather_cells = F.greatest(F.ceil(observations / cell_rows), F.least(even, cells), F.lit(1))
    paired = F.ceil(trips * observations / weather_cells / F.lit(cell_pairs))
    return {
        "weather_cells": weather_cells,
        "trip_cells": F.greatest(F.ceil(trips / cell_rows), F.least(paired, F.col("trips"))),
    }


def _deal_trips(keyed: DataFrame, cut_list: DataFrame) -> DataFrame:
    """`keyed` with the cells of its hour and its own `_trip_cell`, which is 0 in hours that aren't cut.

    Trips of a cut hour are dealt by content and input split, and copies of one trip in one split
    are numbered and go round the cells. As copies are alike, a task that runs again deals the
    same rows to the same cells in whatever order they arrive. Only trips of cut hours are
    shuffled for it.
    """
    cells = F.coalesce("trip_cells", F.lit(1)).cast("bigint")
    placed = (
        keyed.withColumn("_split", F.spark_partition_id())
        .join(F.broadcast(cut_list), F.col("_hour").eqNullSafe(F.col("_cut_hour")), "left")
    )
    content = F.xxhash64(*keyed.columns, "_split")
    copy = F.row_number().over(Window.partitionBy("_split", "_content").orderBy("_content"))
    dealt = placed.where(cells > 1).withColumn("_content", content).withColumn("_trip_cell", F.pmod(F.pmod("_content", cells) + copy, cells))
    return placed.where(cells == 1).withColumn("_trip_cell", F.lit(0).cast("bigint")).unionByName(dealt.drop("_content"))
