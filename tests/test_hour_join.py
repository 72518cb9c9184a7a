from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fareweather.functions.clock import hour_key
from fareweather.operators import hour_join
from fareweather.operators.hour_join import WEATHER_COLUMNS, enrich_trips, measured
from tests.plans import final_plan_text, plan_text, rows
from tests.trips import edge_facts, simple_facts, weather

TWO_AT_TEN = [("2024-01-07 10:05:00", 1.0, "Rain"), ("2024-01-07 10:40:00", 2.0, "Clear")]


def in_cells(trips, observations, cell_rows=2):
    return enrich_trips(trips, observations, broadcast_limit=0, cell_rows=cell_rows)


@pytest.mark.parametrize("join", [enrich_trips, in_cells])
def test_observations_of_the_hour_repeat_the_trip(spark, join):
    joined = join(edge_facts(spark), weather(spark, TWO_AT_TEN))
    found = sorted(
        ((row["PULocationID"], row["temperature"], row["weather_category"]) for row in joined.collect()), key=repr
    )
    assert found == [
        (1, 1.0, "Rainy"),
        (1, 2.0, "Clear"),
        (2, None, None),
        (3, None, None),
        (4, None, None),
        (5, 1.0, "Rainy"),
        (5, 2.0, "Clear"),
        (6, None, None),
    ]


def brute_force(trips, observations):
    def hour(moment):
        return moment and moment.replace(minute=0, second=0, microsecond=0)

    observed = {}
    for row in observations.collect():
        if row["timestamp"] is not None:
            values = tuple(row[name] for name in WEATHER_COLUMNS)
            observed.setdefault(hour(row["timestamp"].replace(tzinfo=None)), []).append(values)
    nothing = [(None,) * len(WEATHER_COLUMNS)]
    return sorted(
        (
            tuple(trip) + values
            for trip in trips.collect()
            for values in observed.get(hour(trip["tpep_pickup_datetime"]), nothing)
        ),
        key=repr,
    )


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_busy_hours_and_copies(spark, seed):
    """A third of the trips in one hour, a third without pickup, copies on both sides."""
    dice = random.Random(seed)
    start = datetime(2024, 3, 1)

    def moment(busy):
        pick = dice.random()
        if pick < 0.33:
            return str(start + timedelta(minutes=busy))
        return str(start + timedelta(minutes=dice.randrange(60 * 12)))

    trips = simple_facts(
        spark,
        [(None if dice.random() < 0.3 else moment(5), float(dice.randrange(4)), 10.0, 1.0) for _ in range(120)]
        + [(str(start), 1.0, 5.0, 0.0)] * 40,
    )
    trips = trips.withColumn("PULocationID", trips["PULocationID"] % 3)
    observations = weather(
        spark,
        [(moment(7), float(dice.randrange(3)), dice.choice(["Rain", "Clear", None])) for _ in range(30)]
        + [(str(start), 1.0, "Rain")] * 12
        + [("2024-04-01 00:00:00", 9.0, "Snow")] * 9  # busy, but nobody travels
        + [(None, 5.0, "Rain")],
    )
    expected = brute_force(trips, observations)
    assert rows(enrich_trips(trips, observations)) == expected
    for cell_rows in (1, 3, 1000):
        assert rows(in_cells(trips, observations, cell_rows)) == expected


def test_no_weather_keeps_every_trip(spark):
    trips, nothing = edge_facts(spark), weather(spark, [])
    assert enrich_trips(trips, nothing).count() == 6
    assert in_cells(trips, nothing).count() == 6


def test_broadcast_depends_on_the_measured_size(spark):
    trips, observations = edge_facts(spark), weather(spark, TWO_AT_TEN)
    size, busiest = measured(observations.withColumn("_hour", F.hour("timestamp")))
    assert busiest == 2 and size > measured(observations.limit(1).withColumn("_hour", F.lit(1)))[0] > 0
    within = plan_text(enrich_trips(trips, observations, broadcast_limit=size))
    assert "BroadcastHashJoin LeftOuter" in within and "SortMergeJoin" not in within
    assert "Exchange hashpartitioning" not in within
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        beyond = plan_text(enrich_trips(trips, observations, broadcast_limit=size - 1))
        assert "SortMergeJoin LeftOuter" in beyond and "_trip_cell" in beyond
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_an_hour_busy_on_both_sides_is_dealt_out(spark):
    """With AQE on, no task gets much more than its share of the pairs."""
    trips = simple_facts(spark, [("2024-01-07 10:00:00", float(n), 10.0, 1.0) for n in range(1500)])
    observations = weather(spark, [("2024-01-07 10:30:00", float(n), "Rain") for n in range(800)])
    joined = enrich_trips(trips, observations, cell_pairs=3000, broadcast_limit=0)
    per_task = [row["count"] for row in joined.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(per_task) == 1500 * 800
    assert len(per_task) >= 8 and max(per_task) <= 2 * sum(per_task) / len(per_task)


def test_a_busy_hour_is_cut_along_both_sides(spark, monkeypatch):
    """600 cells of 400 pairs: 20 times 30 of them copy 24,000 rows, 600 in a line would copy 240,000."""
    trips = simple_facts(spark, [("2024-01-07 10:00:00", float(n), 10.0, 1.0) for n in range(600)])
    observations = weather(spark, [("2024-01-07 10:30:00", float(n), "Rain") for n in range(400)])
    shuffled, repartition = [], type(trips).repartition

    def counted(frame, *args):
        shuffled.append(frame.count())
        return repartition(frame, *args)

    monkeypatch.setattr(type(trips), "repartition", counted)
    joined = enrich_trips(trips, observations, cell_pairs=400, broadcast_limit=0)
    assert len(shuffled) == 2 and max(shuffled) <= 12_600
    pairs = joined.agg(F.count(F.lit(1)), F.count_distinct("PULocationID", "temperature")).first()
    assert tuple(pairs) == (600 * 400, 600 * 400)


def test_a_busy_hour_is_not_broadcast(spark, monkeypatch):
    trips, observations = edge_facts(spark), weather(spark, TWO_AT_TEN)
    expected = rows(enrich_trips(trips, observations))
    monkeypatch.setattr(hour_join, "BUSY_HOUR", 1)
    joined = enrich_trips(trips, observations)
    assert "_trip_cell" in plan_text(joined) and rows(joined) == expected


def test_many_rows_get_many_shuffle_partitions(spark, monkeypatch):
    trips = simple_facts(spark, [(f"2024-01-07 {n % 24:02d}:00:00", 1.0, 10.0, 1.0) for n in range(200)])
    observations = weather(spark, TWO_AT_TEN)
    expected = brute_force(trips, observations)
    monkeypatch.setattr(hour_join, "PARTITION_ROWS", 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = in_cells(trips, observations)
        plan = plan_text(joined)
        assert rows(joined) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges = [line for line in plan.splitlines() if "_trip_cell" in line and "hashpartitioning" in line]
    assert len(exchanges) == 2 and all(", 41)" in line and "REPARTITION_BY_NUM" in line for line in exchanges)


def test_filter_and_columns_reach_the_scan(spark, folder):
    edge_facts(spark).write.parquet(f"{folder}/fact")
    enriched = enrich_trips(spark.read.parquet(f"{folder}/fact"), weather(spark, TWO_AT_TEN))
    plan = final_plan_text(enriched.where("passenger_count > 0").groupBy("weather_category").count())
    assert "GreaterThan(passenger_count,0.0)" in plan
    assert "ReadSchema: struct<tpep_pickup_datetime:timestamp_ntz,passenger_count:double>" in plan


def test_copies_of_one_trip_fill_all_cells_evenly(spark):
    busy, calm = (simple_facts(spark, [(f"2024-01-07 {hour}:15:00", 1.0, 40.0, 10.0)]) for hour in (10, 11))
    copies = [trip.withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(n)))).drop("n") for trip, n in ((busy, 1000), (calm, 3))]
    keyed = copies[0].union(copies[1]).coalesce(1).withColumn("_hour", hour_key(F.col("tpep_pickup_datetime")))
    hour = keyed.agg(F.min("_hour")).first()[0]
    cells = spark.createDataFrame([(hour, 7, [0, 1])], "_cut_hour BIGINT, trip_cells BIGINT, held_cells ARRAY<BIGINT>")
    dealt = hour_join._deal_trips(keyed, cells)
    sizes = {(row["_hour"] == hour, row["_trip_cell"]): row["count"] for row in dealt.groupBy("_hour", "_trip_cell").count().collect()}
    assert sizes.pop((False, 0)) == 3
    assert sorted(sizes.values()) == [142] * 1 + [143] * 6 and len(sizes) == 7
