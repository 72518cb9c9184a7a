"""Tasks that fail after handing out their rows, as on a lost executor, and run again."""

from __future__ import annotations

import uuid

import pytest

from fareweather.operators.hour_join import enrich_trips
from fareweather.operators.summaries import hourly_totals, trip_summary
from fareweather.sources.warehouse import JdbcWarehouse, LakeWarehouse
from tests.plans import rows
from tests.trips import simple_facts, weather


def fail_first_attempts(batches):
    from pyspark import TaskContext

    yield from batches
    task = TaskContext.get()
    if task.attemptNumber() == 0 and task.partitionId() % 2 == 0:
        raise RuntimeError("lost")


@pytest.fixture()
def steady(spark):
    moments = [f"2024-01-07 {n % 3:02d}:{n % 60:02d}:00" for n in range(120)]
    return simple_facts(spark, [(m, float(n % 4), 10.0, n / 8) for n, m in enumerate(moments)])


@pytest.fixture()
def failing(steady):
    return steady.repartition(4).mapInPandas(fail_first_attempts, steady.schema)


@pytest.fixture()
def observations(spark):
    return weather(spark, [(f"2024-01-07 00:{n:02d}:00", float(n), "Rain") for n in range(8)])


@pytest.mark.parametrize("broadcast_limit", [10**9, 0])
def test_join(steady, failing, observations, broadcast_limit):
    joined = enrich_trips(failing, observations, broadcast_limit, cell_rows=3)
    assert rows(joined) == rows(enrich_trips(steady, observations))


def test_report(steady, failing, observations):
    summary = trip_summary(hourly_totals(failing), observations)
    assert summary.collect() == trip_summary(hourly_totals(steady), observations).collect()


def test_stored_table(spark, folder, steady, failing):
    warehouse = LakeWarehouse(spark, f"{folder}/warehouse", f"w{uuid.uuid4().hex}")
    warehouse.replace("fact_taxi_trips", failing)
    assert rows(warehouse.table("fact_taxi_trips")) == rows(steady)


def test_database_table(spark, steady, failing):
    url = f"jdbc:derby:memory:w{uuid.uuid4().hex};create=true"
    warehouse = JdbcWarehouse(spark, url, {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    warehouse.replace("fact_taxi_trips", failing)
    assert rows(warehouse.table("fact_taxi_trips")) == rows(steady)
