"""Every registered query against its SQL on the smallest tables."""

from __future__ import annotations

import shutil
from datetime import datetime, timedelta
from pathlib import Path

import pytest

import __spark_entry__ as registry
from fareweather.operators.hour_join import enrich_trips
from tests.conftest import SMALL
from tests.oracle import assert_same, connect

ENGINE = registry.QUERIES  # the training-data operators have their own tests
ORACLES = registry.oracle_sql()


@pytest.fixture(scope="module")
def connection():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(ENGINE) <= set(ORACLES) and set(ORACLES) <= set(registry.queries())


@pytest.mark.parametrize("name", list(ENGINE))
def test_query(spark, connection, name):
    assert_same(registry.queries()[name](spark, SMALL), connection, ORACLES[name])


def test_entry(spark):
    assert registry.entry(spark).columns == [
        "hour",
        "weather_category",
        "trip_count",
        "avg_trip_duration",
        "avg_tip_percentage",
    ]


EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


@pytest.mark.parametrize("observed", [True, False])
def test_pairs_of_busy_hours_carry_their_category_as_a_number(spark, folder, monkeypatch, observed):
    """Hours with and without observations; nulls in every column, copies, or no observation at all."""
    start = datetime(2024, 1, 1)
    events = [
        (
            None if n % 17 == 0 else n,
            None if n % 13 == 0 else start + timedelta(minutes=n),
            None if n % 11 == 0 else n % 12,
            (None, "view", "error", "buy")[n % 4] if observed else "error",
            None if n % 9 == 0 else float(n % 23),
            None if n % 10 == 0 else '{"k": %d}' % (n % 8),
        )
        for n in range(240)
    ]
    spark.createDataFrame(events + events[:40], EVENTS).coalesce(1).write.parquet(f"{folder}/out")
    (part,) = Path(folder, "out").glob("part-*.parquet")
    shutil.copy(part, Path(folder, "events.parquet"))
    kinds = []

    def seen(*args, **options):
        joined = enrich_trips(*args, **options)
        kinds.append(dict(joined.dtypes)["weather_category"])
        return joined

    monkeypatch.setattr(registry, "enrich_trips", seen)
    summed = registry.queries()["trip_enriched_busy_hours"](spark, folder)
    assert assert_same(summed, connect(folder), ORACLES["trip_enriched_busy_hours"]) == 13
    assert kinds == ["bigint"]
