from __future__ import annotations

import math
import random
from datetime import datetime, timedelta

import pytest

from fareweather.operators.hour_join import enrich_trips
from fareweather.operators.summaries import (
    high_value,
    hourly_totals,
    passenger_stats,
    passenger_stats_from_enriched,
    trip_summary,
    trip_summary_from_enriched,
)
from tests.trips import at, edge_facts, simple_facts, weather

HOUR = "2024-01-07 10:00:00"


def both_summaries(trips, observations):
    return (
        trip_summary(hourly_totals(trips), observations),
        trip_summary_from_enriched(enrich_trips(trips, observations)),
    )


def both_stats(trips, observations):
    return (
        passenger_stats(hourly_totals(trips), observations),
        passenger_stats_from_enriched(enrich_trips(trips, observations)),
    )


def test_summary_of_edge_rows_is_sorted_nulls_last(spark):
    observations = weather(
        spark, [("2024-01-07 10:05:00", 1.0, "Rain"), ("2024-01-07 10:40:00", 2.0, "Clear"), (None, 3.0, "Rain")]
    )
    for summary in both_summaries(edge_facts(spark), observations):
        assert [tuple(row) for row in summary.collect()] == [
            (at("2024-01-06 23:00:00"), None, 1, 1.0, 0.0),
            (at(HOUR), "Clear", 2, 1830.0, 20.0),
            (at(HOUR), "Rainy", 2, 1830.0, 20.0),
            (at("2024-01-07 11:00:00"), None, 1, 0.0, 25.0),
            (at("2024-01-08 11:00:00"), None, 1, -3600.0, 0.0),
            (None, None, 1, None, 0.0),
        ]


def test_stats_drop_zero_negative_and_missing_passengers(spark):
    trips = simple_facts(spark, [(HOUR, p, 8.0, 1.0) for p in (0.0, -1.0, None, 2.0)])
    for stats in both_stats(trips, weather(spark, [(HOUR, 1.0, "Rain")] * 3)):
        assert [tuple(row) for row in stats.collect()] == [(2.0, 3, 27.0, 12.5)]


@pytest.mark.parametrize("seed", [4, 5])
def test_both_forms_agree(spark, seed):
    dice = random.Random(seed)
    start = datetime(2024, 5, 1)

    def moment():
        return None if dice.random() < 0.1 else str(start + timedelta(minutes=dice.randrange(600)))

    trips = simple_facts(
        spark,
        [
            (
                moment(),
                dice.choice([None, 0.0, 1.0, 2.0, 3.0]),
                dice.choice([-4.0, 0.0, 16.0, 32.0]),
                dice.choice([1.0, 4.0]),
            )
            for _ in range(200)
        ],
    )
    observations = weather(spark, [(moment(), 1.0, dice.choice(["Rain", "Clouds", "Snow"])) for _ in range(25)])

    def same(left, right):
        assert len(left) == len(right)
        for a, b in zip(left, right):
            for x, y in zip(a, b):
                assert x == y or (isinstance(x, float) and math.isclose(x, y, rel_tol=1e-12)), (a, b)

    fast, joined = both_summaries(trips, observations)
    same(fast.collect(), joined.collect())
    fast, joined = both_stats(trips, observations)
    same(sorted(fast.collect()), sorted(joined.collect()))


@pytest.mark.parametrize(
    ("count", "spent", "tip", "kept"),
    [
        (11, 300.01, 15.01, True),
        (10, 300.01, 15.01, False),
        (11, 300.0, 15.01, False),
        (11, 300.01, 15.0, False),
        (11, 300.01, None, False),
    ],
)
def test_high_value_limits_are_strict(spark, count, spent, tip, kept):
    schema = "passenger_count DOUBLE, trip_count BIGINT, total_spent DOUBLE, avg_tip_percentage DOUBLE"
    assert high_value(spark.createDataFrame([(1.0, count, spent, tip)], schema)).count() == int(kept)
