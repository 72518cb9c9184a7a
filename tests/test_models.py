from __future__ import annotations

import uuid
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from fareweather.plans.flows import FlowConfig, run_trip_batch, run_weather_batch
from fareweather.operators.hour_join import enrich_trips
from fareweather.operators.summaries import hourly_totals, trip_summary, trip_summary_from_enriched
from fareweather.plans.models import (
    MODELS,
    TRIP_MODELS,
    WEATHER_MODELS,
    build_models,
    months_of_hours,
    read_model,
)
from fareweather.schemas import TABLES
from fareweather.sources.trip_lake import month_path
from fareweather.sources.warehouse import JdbcWarehouse, LakeWarehouse
from tests.plans import plan_text, rows
from tests.trips import edge_facts, raw_trips, simple_facts, weather

HOUR = "2024-01-07 10:00:00"


@pytest.fixture(params=["lake", "jdbc"])
def warehouse(request, spark, folder):
    name = f"w{uuid.uuid4().hex}"
    if request.param == "lake":
        return LakeWarehouse(spark, f"{folder}/warehouse", name)
    return JdbcWarehouse(
        spark, f"jdbc:derby:memory:{name};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    )


def load(spark, warehouse, passengers=2.0, observations=1):
    warehouse.replace("fact_taxi_trips", simple_facts(spark, [(HOUR, passengers, 40.0, 10.0)] * 11))
    warehouse.replace("dim_weather", weather(spark, [(HOUR, 1.0, "Rain")] * observations))


def test_all_models_in_order_with_declared_columns(spark, warehouse):
    load(spark, warehouse)
    assert build_models(warehouse) == list(MODELS)
    for name in ("trip_enriched", "trip_summary_per_hour", "high_value_customers"):
        table = warehouse.table(name)
        assert [(f.name, f.dataType) for f in table.schema] == [(f.name, f.dataType) for f in TABLES[name]]
    assert warehouse.view("source_fact_taxi_trips").count() == 11
    assert warehouse.view("source_dim_weather").columns == TABLES["dim_weather"].fieldNames()
    assert [tuple(row) for row in warehouse.table("high_value_customers").collect()] == [(2.0, 11, 550.0, 25.0)]


def test_models_left_out_go_stale(spark, warehouse):
    load(spark, warehouse)
    build_models(warehouse)
    load(spark, warehouse, passengers=3.0, observations=2)
    assert build_models(warehouse, only=WEATHER_MODELS) == list(WEATHER_MODELS)
    assert warehouse.table("trip_enriched").count() == 22
    assert read_model(warehouse, "trip_summary_per_hour").first()["trip_count"] == 22
    assert warehouse.table("high_value_customers").first()["passenger_count"] == 2.0
    build_models(warehouse, only=TRIP_MODELS)
    assert warehouse.table("high_value_customers").first()["passenger_count"] == 3.0


def test_a_report_alone_reads_the_stored_join(spark, warehouse):
    load(spark, warehouse)
    build_models(warehouse)
    load(spark, warehouse, observations=5)
    build_models(warehouse, only=["trip_summary_per_hour", "high_value_customers"])
    assert read_model(warehouse, "trip_summary_per_hour").first()["trip_count"] == 11
    assert warehouse.table("high_value_customers").first()["trip_count"] == 11


def test_unknown_model(spark, warehouse):
    with pytest.raises(ValueError, match="nonsense"):
        build_models(warehouse, only=["nonsense"])


def test_tables_survive_a_round_trip(spark, warehouse):
    facts = edge_facts(spark).where("trip_duration IS NULL OR trip_duration <> 0")
    for _ in range(2):
        warehouse.replace("fact_taxi_trips", facts)
    assert rows(warehouse.table("fact_taxi_trips")) == rows(facts)


def test_a_new_session_finds_the_tables(spark, folder):
    def session():
        return LakeWarehouse(spark, f"{folder}/warehouse", f"w{uuid.uuid4().hex}")

    written = session()
    written.replace("fact_taxi_trips", edge_facts(spark))
    written.append_batch("dim_weather", weather(spark, [(HOUR, 1.0, "Rain")]), 0)
    written.create_empty("weather_quarantine")
    found = session()
    assert found.table("fact_taxi_trips").count() == 6
    assert found.table("weather_quarantine").count() == 0
    assert found.table("dim_weather").count() == 1
    found.append_batch("dim_weather", weather(spark, [(HOUR, 2.0, "Rain")] * 2), 1)
    assert found.table("dim_weather").count() == 3
    later = session()
    later.append_batch("dim_weather", weather(spark, [(HOUR, 2.0, "Rain")]), 1)
    assert later.table("dim_weather").count() == 2
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        later.table("trip_enriched")


def test_both_flows(spark, folder, warehouse):
    config = FlowConfig(
        warehouse=warehouse,
        raw_trips=f"{folder}/raw",
        trip_lake=f"{folder}/lake",
        weather_landing=f"{folder}/landing",
        weather_checkpoint=f"{folder}/checkpoint",
    )
    for month, count in ((1, 12), (2, 3)):
        moment = f"2022-{month:02d}-03 09:30:00"
        trips = raw_trips(spark, [(moment, moment, 1.0, 40.0, 10.0, 50.0, 2.0)] * count)
        trips.write.parquet(month_path(config.raw_trips, (2022, month)))
    payload = '{"dt":1641201000,"main":{"temp":1.5},"weather":[{"main":"Clouds"}]}'  # 2022-01-03 09:10
    run_weather_batch(spark, config, spark.createDataFrame([(payload,)], "value STRING"), models=())
    status = run_trip_batch(spark, config, [(2022, 1), (2022, 2), (2022, 3)])
    assert [row["ok"] for row in status.orderBy("month").collect()] == [True, True, False]
    summary = read_model(warehouse, "trip_summary_per_hour").collect()
    assert [(row["weather_category"], row["trip_count"]) for row in summary] == [("Cloudy", 12), (None, 3)]
    assert warehouse.table("high_value_customers").first()["trip_count"] == 15

    more = raw_trips(spark, [("2022-02-03 09:30:00", "2022-02-03 09:30:00", 1.0, 40.0, 10.0, 50.0, 2.0)] * 5)
    more.write.mode("overwrite").parquet(month_path(config.raw_trips, (2022, 2)))
    run_trip_batch(spark, config, [(2022, 2)], transform_periods=[(2022, 2)], models=TRIP_MODELS)
    assert warehouse.table("fact_taxi_trips").count() == 17  # one month replaced, the other kept
    assert warehouse.table("trip_enriched").count() == 17
    assert warehouse.table("high_value_customers").first()["trip_count"] == 17

    run_weather_batch(spark, config, spark.createDataFrame([(payload,)], "value STRING"), only_new_months=True)
    assert warehouse.table("dim_weather").count() == 2
    assert warehouse.table("trip_enriched").count() == 12 * 2 + 5
    full = rows(warehouse.table("trip_enriched"))
    build_models(warehouse)
    assert rows(warehouse.table("trip_enriched")) == full


def test_new_weather_reads_and_writes_its_months_only(spark, folder):
    warehouse = LakeWarehouse(spark, f"{folder}/warehouse", f"w{uuid.uuid4().hex}")
    months = [(2022, m) for m in range(1, 5)]
    trips = simple_facts(spark, [(f"2022-{m:02d}-03 09:30:00", 1.0, 40.0, 10.0) for _, m in months for _ in range(3)])
    keyed = trips.withColumns({"year": F.year("tpep_pickup_datetime"), "month": F.month("tpep_pickup_datetime")})
    warehouse.replace("fact_taxi_trips", keyed)
    warehouse.create_empty("dim_weather")
    build_models(warehouse)
    before = set(warehouse.snapshot("trip_enriched").parts)
    warehouse.append_batch("dim_weather", weather(spark, [("2022-03-03 09:10:00", 1.0, "Rain")]), 0)
    chosen = months_of_hours(warehouse, [(2022, 3)])
    assert chosen == [(2022, 3)]
    build_models(warehouse, months=chosen)
    changed = before ^ set(warehouse.snapshot("trip_enriched").parts)
    assert len(changed) == 2 and all(part.endswith("/year=2022/month=3") for part in changed)
    assert warehouse.table("trip_enriched").where("weather_category = 'Rainy'").count() == 3


def test_a_month_without_rows_is_emptied(spark, folder):
    warehouse = LakeWarehouse(spark, f"{folder}/warehouse", f"w{uuid.uuid4().hex}")
    keyed = simple_facts(spark, [(HOUR, 1.0, 40.0, 10.0)] * 2).withColumn("year", F.lit(2024))
    both = keyed.withColumn("month", F.lit(1)).union(keyed.withColumn("month", F.lit(2)))
    warehouse.replace("fact_taxi_trips", both)
    warehouse.replace_months("fact_taxi_trips", both.where("false"), [(2024, 1)])
    assert [tuple(r) for r in warehouse.all_months("fact_taxi_trips").groupBy("month").count().collect()] == [(2, 2)]


def test_a_failed_rebuild_leaves_the_old_table(spark, folder):
    def session():
        return LakeWarehouse(spark, f"{folder}/warehouse", f"w{uuid.uuid4().hex}")

    def fail(batches):
        yield from batches
        raise RuntimeError("lost for good")

    warehouse = session()
    for name in ("fact_taxi_trips", "high_value_customers"):
        good = simple_facts(spark, [(HOUR, 1.0, 40.0, 10.0)] * 10)
        if name == "high_value_customers":
            good = spark.createDataFrame([(1.0, 2, 3.0, 4.0)] * 10, TABLES[name])
        warehouse.replace(name, good)
        with pytest.raises(Exception, match="lost for good"):
            warehouse.replace(name, good.mapInPandas(fail, good.schema))
        assert warehouse.table(name).count() == 10
        assert session().table(name).count() == 10
        warehouse.replace(name, good.limit(3))
        assert warehouse.table(name).count() == 3 and session().table(name).count() == 3


def test_old_versions_go(spark, folder):
    warehouse = LakeWarehouse(spark, f"{folder}/warehouse", f"w{uuid.uuid4().hex}", keep_seconds=0)
    for n in range(1, 5):
        warehouse.replace("high_value_customers", spark.createDataFrame([(1.0, 2, 3.0, 4.0)] * n, TABLES["high_value_customers"]))
    assert len(list(Path(warehouse.path("high_value_customers")).glob("written=*"))) == 2
    assert warehouse.table("high_value_customers").count() == 4


def test_both_report_forms_agree_in_any_zone(spark):
    trips = simple_facts(spark, [("2024-03-10 02:30:00", 1.0, 40.0, 10.0), ("2024-11-03 01:30:00", 1.0, 4.0, 1.0), (HOUR, 1.0, 4.0, 1.0)])
    observations = weather(spark, [("2024-03-10 02:10:00", 1.0, "Rain"), (HOUR, 2.0, "Clear")])
    expected = trip_summary(hourly_totals(trips), observations).collect()
    assert [str(row["hour"]) for row in expected] == [HOUR, "2024-03-10 02:00:00", "2024-11-03 01:00:00"]
    observations = spark.createDataFrame(observations.collect(), observations.schema)
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert trip_summary(hourly_totals(trips), observations).collect() == expected
        assert trip_summary_from_enriched(enrich_trips(trips, observations)).collect() == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_a_database_table_is_computed_once(spark):
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        calls.add(1)
        yield from batches

    facts = simple_facts(spark, [(HOUR, 1.0, 40.0, 10.0)] * 4).coalesce(1)
    url = f"jdbc:derby:memory:w{uuid.uuid4().hex};create=true"
    warehouse = JdbcWarehouse(spark, url, {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    warehouse.replace("fact_taxi_trips", facts.mapInPandas(count, facts.schema))
    assert calls.value == 1
