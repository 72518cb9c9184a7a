from __future__ import annotations

import uuid
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fareweather.functions.weather import dim_weather
from fareweather.schemas import RAW_WEATHER
from fareweather.sources.warehouse import JdbcWarehouse, LakeWarehouse
from fareweather.sources.weather_landing import land_observations, land_payloads
from fareweather.streaming.weather_stream import run_weather_stream, start_weather_stream
from tests.plans import rows
from tests.test_functions import DOCUMENTS

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


@pytest.fixture(params=["lake", "jdbc"])
def warehouse(request, spark, folder):
    name = f"w{uuid.uuid4().hex}"
    if request.param == "lake":
        return LakeWarehouse(spark, f"{folder}/warehouse", name)
    return JdbcWarehouse(spark, f"jdbc:derby:memory:{name};create=true", DERBY)


def texts(spark, documents):
    return spark.createDataFrame([(text,) for text in documents], "value STRING")


def dated(spark, count, start=0):
    return texts(
        spark,
        [
            f'{{"dt":{1704067200 + n * 60},"main":{{"temp":{n}}},"weather":[{{"main":"Rain"}}]}}'
            for n in range(start, start + count)
        ],
    )


def test_waves_add_up_to_the_batch_result(spark, folder, warehouse):
    landing, checkpoint = f"{folder}/landing", f"{folder}/checkpoint"
    for start, count in ((0, 5), (5, 7)):
        land_payloads(dated(spark, count, start), landing)
        run_weather_stream(spark, landing, warehouse, checkpoint)
    run_weather_stream(spark, landing, warehouse, checkpoint)
    batch = dim_weather(spark.read.schema(RAW_WEATHER).json(landing))
    assert rows(warehouse.table("dim_weather")) == rows(batch)
    assert warehouse.table("dim_weather").count() == 12


def test_several_micro_batches_in_one_run(spark, folder, warehouse):
    landing = f"{folder}/landing"
    for start in range(3):
        land_payloads(dated(spark, 2, start * 2).coalesce(1), landing)
    run_weather_stream(spark, landing, warehouse, f"{folder}/checkpoint", files_per_batch=1)
    assert warehouse.table("dim_weather").count() == 6


def test_a_running_stream_picks_up_new_files(spark, folder, warehouse):
    landing = _landed(spark, folder, dated(spark, 2))
    query = start_weather_stream(spark, landing, warehouse, f"{folder}/checkpoint", keep_running=True)
    try:
        query.processAllAvailable()
        assert warehouse.table("dim_weather").count() == 2
        land_payloads(dated(spark, 3, 2), landing)
        query.processAllAvailable()
        assert warehouse.table("dim_weather").count() == 5
        assert query.isActive
    finally:
        query.stop()


def test_a_repeated_batch_adds_nothing(spark, folder, warehouse):
    batch = dim_weather(spark.read.schema(RAW_WEATHER).json(_landed(spark, folder, dated(spark, 6))))
    copies = batch.union(batch)  # equal observations are kept
    warehouse.append_batch("dim_weather", copies, 0)
    warehouse.append_batch("dim_weather", batch, 1)
    warehouse.append_batch("dim_weather", copies, 0)
    assert warehouse.table("dim_weather").count() == 18


def test_streams_and_backfills_add_up(spark, folder, warehouse):
    """Two checkpoints count their batches from 0 each; rows written without a stream stay, too."""
    batch = dim_weather(spark.read.schema(RAW_WEATHER).json(_landed(spark, folder, dated(spark, 6))))
    warehouse.replace("dim_weather", batch)
    for start in (10, 20):
        land_payloads(dated(spark, 2, start), f"{folder}/landing{start}")
        for _ in range(2):
            run_weather_stream(spark, f"{folder}/landing{start}", warehouse, f"{folder}/checkpoint{start}")
    assert warehouse.table("dim_weather").count() == 10
    warehouse.append_batch("dim_weather", batch, 0, "other")
    warehouse.append_batch("dim_weather", batch, 0, "other")
    assert warehouse.table("dim_weather").count() == 16


def test_compaction_keeps_rows_and_the_last_batch(spark, folder):
    warehouse = LakeWarehouse(spark, f"{folder}/warehouse", f"w{uuid.uuid4().hex}")
    batch = dim_weather(spark.read.schema(RAW_WEATHER).json(_landed(spark, folder, dated(spark, 6))))
    for stream in ("one", "two"):
        for number in range(4):
            warehouse.append_batch("dim_weather", batch, number, stream)
    before = rows(warehouse.table("dim_weather"))
    warehouse.compact("dim_weather")
    assert rows(warehouse.table("dim_weather")) == before
    batches = warehouse.with_batches("dim_weather").select("stream_id", "batch_id").distinct()
    assert rows(batches) == [("none", -1), ("one", 3), ("two", 3)]
    warehouse.append_batch("dim_weather", batch, 3, "one")  # a repeat
    warehouse.append_batch("dim_weather", batch, 4, "one")
    assert warehouse.table("dim_weather").count() == len(before) + 6


def test_read_files_leave_the_landing_folder(spark, folder, warehouse):
    landing, archive = f"{folder}/landing", f"{folder}/archive"
    for start in range(4):
        land_payloads(dated(spark, 2, start * 2).coalesce(1), landing)
        run_weather_stream(spark, landing, warehouse, f"{folder}/checkpoint", archive=archive)
    assert warehouse.table("dim_weather").count() == 8
    assert len(list(Path(landing).glob("part-*"))) < 4 and list(Path(archive).rglob("part-*"))


def test_every_payload_lands_in_one_table(spark, folder, warehouse):
    good = '{"dt":1704067200,\r\n"main":{"temp":1.5},\n\n"weather":[]}'
    payloads = texts(spark, [good, None, "", " \t\n ", "broken\n{"])
    land_payloads(payloads, f"{folder}/landing")
    run_weather_stream(spark, f"{folder}/landing", warehouse, f"{folder}/checkpoint")
    assert warehouse.table("dim_weather").count() == 1
    records = sorted(row["record"] for row in warehouse.table("weather_quarantine").collect())
    assert records == ["broken {"] + ['{"message":"empty payload"}'] * 3


def test_months_of_new_weather_are_returned(spark, folder, warehouse):
    land_payloads(dated(spark, 3), f"{folder}/landing")
    assert run_weather_stream(spark, f"{folder}/landing", warehouse, f"{folder}/checkpoint") == [(2024, 1)]
    assert run_weather_stream(spark, f"{folder}/landing", warehouse, f"{folder}/checkpoint") == []


def test_a_half_written_batch_is_completed(spark, folder):
    """What a crash between two committed tasks leaves behind in a database."""
    warehouse = JdbcWarehouse(spark, f"jdbc:derby:memory:w{uuid.uuid4().hex};create=true", DERBY)
    batch = dim_weather(spark.read.schema(RAW_WEATHER).json(_landed(spark, folder, dated(spark, 6))))
    copies = batch.union(batch)
    warehouse.append_batch("dim_weather", batch.where("temperature < 4"), 3)
    warehouse.append_batch("dim_weather", copies, 3)
    assert rows(warehouse.table("dim_weather")) == rows(copies)


def _landed(spark, folder, payloads):
    land_payloads(payloads, f"{folder}/documents")
    return f"{folder}/documents"


def test_undated_documents_are_set_aside(spark, folder, warehouse):
    landing = _landed(spark, folder, texts(spark, [text for text, _ in DOCUMENTS]))
    run_weather_stream(spark, landing, warehouse, f"{folder}/checkpoint")
    assert warehouse.table("dim_weather").count() == 3
    records = warehouse.table("weather_quarantine").collect()
    assert sorted(row["record"] for row in records) == [
        '{"cod":"401","message":"Invalid API key"}',
        '{"dt":17040',
    ]
    assert all("/documents/" in row["source_file"] for row in records)


def test_undated_documents_can_be_passed_through(spark, folder, warehouse):
    landing = _landed(spark, folder, texts(spark, [text for text, _ in DOCUMENTS]))
    run_weather_stream(spark, landing, warehouse, f"{folder}/checkpoint", keep_undated=True)
    table = warehouse.table("dim_weather")
    assert table.count() == 5
    assert [row["weather_category"] for row in table.where(F.col("timestamp").isNull()).collect()] == ["Other"] * 2


def test_structured_observations_land_as_documents(spark, folder):
    observations = spark.createDataFrame(
        [(1704067200, (3.5, 80.0), (4.1,), [("Rain", "light rain")])],
        "dt BIGINT, main STRUCT<temp: DOUBLE, humidity: DOUBLE>, wind STRUCT<speed: DOUBLE>, "
        "weather ARRAY<STRUCT<main: STRING, description: STRING>>",
    )
    land_observations(observations, f"{folder}/landing")
    land_observations(observations, f"{folder}/landing")
    flat = dim_weather(spark.read.schema(RAW_WEATHER).json(f"{folder}/landing"))
    assert [row["weather_category"] for row in flat.collect()] == ["Rainy", "Rainy"]


def test_a_failing_sink_fails_the_run(spark, folder):
    class Broken:
        def create_empty(self, name):
            pass

        def append_batch(self, name, df, batch_id, stream_id):
            raise RuntimeError("no space")

    landing = _landed(spark, folder, dated(spark, 1))
    with pytest.raises(Exception, match="no space"):
        run_weather_stream(spark, landing, Broken(), f"{folder}/checkpoint")
