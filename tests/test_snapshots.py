"""Tables change in one step; frames opened before and other months stay as they are."""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fareweather.operators.summaries import hourly_totals, trip_summary
from fareweather.plans.flows import FlowConfig, run_trip_batch, run_weather_batch
from fareweather.plans.models import build_models, read_model, stored_totals
from fareweather.sources import snapshots
from fareweather.sources.snapshots import SNAPSHOTS, Snapshots
from fareweather.sources.trip_lake import month_path
from fareweather.sources.warehouse import JdbcWarehouse, LakeWarehouse
from fareweather.sources.weather_landing import land_payloads
from fareweather.streaming.weather_stream import run_weather_stream
from tests.plans import plan_text, rows
from tests.trips import raw_trips, simple_facts, weather

DERBY = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}


def lake(spark, folder, **settings):
    return LakeWarehouse(spark, f"{folder}/warehouse", f"w{uuid.uuid4().hex}", **settings)


def database(spark):
    return JdbcWarehouse(spark, f"jdbc:derby:memory:w{uuid.uuid4().hex};create=true", DERBY)


@pytest.fixture(params=["lake", "jdbc"])
def warehouse(request, spark, folder):
    return lake(spark, folder) if request.param == "lake" else database(spark)


def monthly(spark, counts: dict[int, int], fare: float = 40.0):
    """Trips of months of 2022."""
    trips = simple_facts(spark, [(f"2022-{m:02d}-03 09:30:00", 1.0, fare, 10.0) for m, n in counts.items() for _ in range(n)])
    return trips.withColumns({"year": F.year("tpep_pickup_datetime"), "month": F.month("tpep_pickup_datetime")})


def by_month(warehouse) -> dict[int, int]:
    return dict(warehouse.all_months("fact_taxi_trips").groupBy("month").count().collect())


def fail(batches):
    yield from batches
    raise RuntimeError("lost for good")


def test_a_frame_opened_before_a_month_is_replaced_reads_its_old_rows(spark, folder):
    warehouse = lake(spark, folder)
    warehouse.replace("fact_taxi_trips", monthly(spark, {1: 2, 2: 3}))
    opened, view = warehouse.table("fact_taxi_trips"), warehouse.database
    by_view = spark.table(f"{view}.fact_taxi_trips")
    warehouse.replace_months("fact_taxi_trips", monthly(spark, {2: 7}), [(2022, 2)])
    warehouse.replace_months("fact_taxi_trips", monthly(spark, {}), [(2022, 1)])
    assert opened.count() == 5 and by_view.count() == 5
    assert warehouse.table("fact_taxi_trips").count() == 7 and spark.table(f"{view}.fact_taxi_trips").count() == 7


def test_months_are_replaced_alone(spark, warehouse):
    warehouse.replace("fact_taxi_trips", monthly(spark, {1: 2, 2: 3, 3: 4}))
    warehouse.replace_months("fact_taxi_trips", monthly(spark, {2: 5, 3: 9}), [(2022, 2)])  # the rows of March are not asked for
    assert by_month(warehouse) == {1: 2, 2: 5, 3: 4}
    warehouse.replace_months("fact_taxi_trips", monthly(spark, {}), [(2022, 3), (2022, 7)])
    assert by_month(warehouse) == {1: 2, 2: 5}
    assert warehouse.table("fact_taxi_trips", [(2022, 2)]).count() == 5


def test_a_failed_change_leaves_the_old_rows(spark, warehouse):
    good = monthly(spark, {1: 2, 2: 3})
    warehouse.replace("fact_taxi_trips", good)
    content = warehouse.content("fact_taxi_trips")
    broken = good.mapInPandas(fail, good.schema)
    with pytest.raises(Exception, match="lost for good"):
        warehouse.replace("fact_taxi_trips", broken)
    with pytest.raises(Exception, match="lost for good"):
        warehouse.replace_months("fact_taxi_trips", broken, [(2022, 2)])
    assert by_month(warehouse) == {1: 2, 2: 3} and warehouse.content("fact_taxi_trips") == content


def test_a_database_changes_over_in_one_transaction(spark):
    """The statement after the deletion fails; the old rows are still there."""
    warehouse = database(spark)
    warehouse.replace("fact_taxi_trips", monthly(spark, {1: 2}))
    with pytest.raises(Exception, match="NOWHERE"):
        warehouse._transaction("DELETE FROM fact_taxi_trips", "INSERT INTO nowhere SELECT * FROM fact_taxi_trips")
    assert warehouse.table("fact_taxi_trips").count() == 2


def test_a_table_of_copies_is_read_in_even_ranges(spark):
    warehouse = database(spark)
    warehouse.replace("fact_taxi_trips", monthly(spark, {1: 4000, 2: 2000}))
    for batch in range(5):
        warehouse.append_batch("dim_weather", weather(spark, [("2022-01-03 09:10:00", 1.0, "Rain")] * 400), batch)
    for name, n in (("fact_taxi_trips", 6000), ("dim_weather", 2000)):
        split = warehouse._loaded(name)
        sizes = [len(part) for part in split.rdd.glom().collect()]
        assert len(sizes) == warehouse.read_connections and sum(sizes) == n
        assert max(sizes) <= 2 * n / len(sizes)


def test_writers_at_once_both_come_through(spark, folder):
    first, second = lake(spark, folder), lake(spark, folder)
    first.replace("fact_taxi_trips", monthly(spark, {1: 1}))
    frames = [monthly(spark, {month: month}) for month in range(2, 8)]
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda pair: (first, second)[pair[0] % 2].replace_months("fact_taxi_trips", pair[1], [(2022, pair[0])]), zip(range(2, 8), frames)))
    assert by_month(first) == {month: month for month in range(1, 8)}
    assert first.snapshot("fact_taxi_trips").number == 7


def test_an_unfinished_snapshot_is_not_read_and_then_given_up(spark, folder, monkeypatch):
    warehouse = lake(spark, folder)
    warehouse.replace("fact_taxi_trips", monthly(spark, {1: 2}))
    left = Path(warehouse.path("fact_taxi_trips")) / SNAPSHOTS / "s000000000002.json"
    left.write_text('{"number": 2, "parts": [')
    assert by_month(warehouse) == {1: 2}
    monkeypatch.setattr(snapshots, "WAIT_SECONDS", 0.2)
    warehouse.replace_months("fact_taxi_trips", monthly(spark, {2: 3}), [(2022, 2)])
    assert by_month(warehouse) == {1: 2, 2: 3}


def test_only_listed_folders_are_ever_deleted(spark, folder):
    warehouse = lake(spark, folder, keep_seconds=0)
    foreign = Path(warehouse.path("fact_taxi_trips")) / "written=0-slow" / "year=2022"
    foreign.mkdir(parents=True)
    for n in range(1, 5):
        warehouse.replace("fact_taxi_trips", monthly(spark, {1: n}))
    assert foreign.exists() and by_month(warehouse) == {1: 4}
    assert len(Snapshots(spark, warehouse.path("fact_taxi_trips"), 0)._names()) == 1


def parquet_bytes(warehouse, name) -> dict[Path, int]:
    return {path: path.stat().st_size for path in Path(warehouse.path(name)).rglob("*.parquet")}


def test_compaction_writes_no_more_than_the_new_batches(spark, folder):
    warehouse = lake(spark, folder)
    big = weather(spark, [(f"2022-01-03 {n % 24:02d}:{n % 60:02d}:00", float(n), "Rain") for n in range(5000)])
    warehouse.append_batch("dim_weather", big, 0, "one")
    warehouse.append_batch("dim_weather", big.limit(3), 1, "one")
    warehouse.compact("dim_weather")
    content = warehouse.content("dim_weather")
    for batch in range(2, 6):
        warehouse.append_batch("dim_weather", big.limit(3), batch, "one")
        assert warehouse.content("dim_weather") != content
        content, before = warehouse.content("dim_weather"), parquet_bytes(warehouse, "dim_weather")
        warehouse.compact("dim_weather")
        after = parquet_bytes(warehouse, "dim_weather")
        assert sum(size for path, size in after.items() if path not in before) < 10_000 < max(before.values())
        assert warehouse.content("dim_weather") == content  # the same rows
    assert warehouse.table("dim_weather").count() == 5000 + 5 * 3


def test_compaction_merges_its_own_parts_by_levels(spark, folder):
    warehouse, one = lake(spark, folder), weather(spark, [("2022-01-03 09:10:00", 1.0, "Rain")])
    for batch in range(12):
        warehouse.append_batch("dim_weather", one, batch, "one")
        warehouse.compact("dim_weather", fan=3)
    assert warehouse.table("dim_weather").count() == 12
    levels = [part.rpartition("=")[2] for part in warehouse.snapshot("dim_weather").parts]
    assert sorted(levels) == ["-1", "-1", "-3", "11"]  # 9 rows, 1 and 1, and the last batch


def test_compaction_beside_a_stream_loses_nothing(spark, folder):
    warehouse, other = lake(spark, folder), lake(spark, folder)
    one = weather(spark, [("2022-01-03 09:10:00", 1.0, "Rain")])
    warehouse.append_batch("dim_weather", one, 0, "one")

    def stream():
        for batch in range(1, 25):
            warehouse.append_batch("dim_weather", one, batch, "one")

    with ThreadPoolExecutor(2) as pool:
        running = pool.submit(stream)
        while not running.done():
            other.compact("dim_weather", fan=2)
        running.result()
    assert warehouse.table("dim_weather").count() == 25
    repeats = warehouse.with_batches("dim_weather").where("batch_id = 24").count()
    assert repeats == 1


def flow(spark, folder, warehouse):
    config = FlowConfig(
        warehouse=warehouse,
        raw_trips=f"{folder}/raw",
        trip_lake=f"{folder}/lake",
        weather_landing=f"{folder}/landing",
        weather_checkpoint=f"{folder}/checkpoint",
    )
    for month in range(1, 5):
        moment = f"2022-{month:02d}-03 09:30:00"
        trips = raw_trips(spark, [(moment, moment, 1.0, 40.0, 10.0, 50.0, 2.0)] * (10 + month))
        trips.write.parquet(month_path(config.raw_trips, (2022, month)))
    return config


def observed(spark, month):
    text = f'{{"dt":{1641201000 + (month - 1) * 31 * 86400},"main":{{"temp":1.5}},"weather":[{{"main":"Clouds"}}]}}'
    return spark.createDataFrame([(text,)], "value STRING")


def test_new_weather_reads_no_trips_of_other_months(spark, folder):
    """The rows of the other months are taken away after the first run; the second doesn't miss them."""
    warehouse = lake(spark, folder)
    config = flow(spark, folder, warehouse)
    run_weather_batch(spark, config, observed(spark, 1), models=())
    run_trip_batch(spark, config, [(2022, m) for m in range(1, 5)])
    expected = rows(read_model(warehouse, "trip_summary_per_hour"))
    for part in warehouse.snapshot("fact_taxi_trips").parts:
        if not part.endswith("/month=1"):
            for file in Path(f"{warehouse.path('fact_taxi_trips')}/{part}").glob("*.parquet"):
                file.unlink()
    run_weather_batch(spark, config, observed(spark, 1))
    twice = [(*row[:2], row[2] * 2 if row[1] else row[2], *row[3:]) for row in expected]
    assert rows(read_model(warehouse, "trip_summary_per_hour")) == sorted(twice, key=repr)
    assert warehouse.table("trip_enriched").count() == 11 * 2 + 12 + 13 + 14


@pytest.mark.parametrize("kind", ["lake", "jdbc"])
def test_month_by_month_equals_a_full_rebuild(spark, folder, kind):
    warehouse = lake(spark, folder) if kind == "lake" else database(spark)
    config = flow(spark, folder, warehouse)
    run_weather_batch(spark, config, observed(spark, 1), models=())
    run_trip_batch(spark, config, [(2022, 1), (2022, 2)])
    run_trip_batch(spark, config, [(2022, 3)], transform_periods=[(2022, 3)])
    run_weather_batch(spark, config, observed(spark, 3))
    names = ["trip_enriched", "trip_summary_per_hour", "high_value_customers"]
    stepwise = {name: rows(warehouse.table(name)) for name in names}
    build_models(warehouse)
    warehouse.replace("fact_taxi_trips", warehouse.all_months("fact_taxi_trips").checkpoint())
    full = trip_summary(hourly_totals(warehouse.table("fact_taxi_trips")), warehouse.table("dim_weather"))
    assert stepwise == {name: rows(warehouse.table(name)) for name in names}
    assert stepwise["trip_summary_per_hour"] == rows(full)
    assert len(stepwise["trip_enriched"]) == 11 + 12 + 13


def test_totals_follow_changes_from_elsewhere(spark, warehouse):
    warehouse.replace("fact_taxi_trips", monthly(spark, {1: 2, 2: 3}))
    assert stored_totals(warehouse).agg(F.sum("trips")).first()[0] == 5
    warehouse.replace_months("fact_taxi_trips", monthly(spark, {2: 7}), [(2022, 2)])
    assert stored_totals(warehouse).agg(F.sum("trips")).first()[0] == 9


def test_joined_table_is_rebuilt_whole_if_weather_came_from_elsewhere(spark, folder):
    warehouse = lake(spark, folder)
    config = flow(spark, folder, warehouse)
    run_weather_batch(spark, config, observed(spark, 1), models=())
    run_trip_batch(spark, config, [(2022, 1), (2022, 2)])
    warehouse.append_batch("dim_weather", weather(spark, [("2022-02-03 09:10:00", 1.0, "Rain")] * 2), 0, "elsewhere")
    run_weather_batch(spark, config, observed(spark, 1))
    assert warehouse.table("trip_enriched").count() == 11 * 2 + 12 * 2


def test_reports_plan_reads_totals_only(spark, folder):
    warehouse = lake(spark, folder)
    warehouse.replace("fact_taxi_trips", monthly(spark, {1: 2}))
    warehouse.create_empty("dim_weather")
    plan = plan_text(trip_summary(stored_totals(warehouse), warehouse.table("dim_weather")))
    assert "/trip_totals/" in plan and "fact_taxi_trips" not in plan
    months = plan_text(warehouse.table("fact_taxi_trips", [(2022, 5)]))
    assert "month=1" not in months


@pytest.mark.parametrize("files, jobs", [(2, 1), (1000, 2)])
def test_a_micro_batch_takes_two_jobs_at_most(spark, folder, files, jobs):
    """The write itself, and for large batches an exchange before it; nothing is counted apart."""
    warehouse, landing = lake(spark, folder), f"{folder}/landing"
    payloads = [(f'{{"dt":{1704067200 + n * 60},"main":{{"temp":{n}}},"weather":[]}}',) for n in range(12)]
    land_payloads(spark.createDataFrame(payloads, "value STRING").repartition(4), landing)
    numbers = []
    append = warehouse.append_batch

    def counted(name, df, batch_id, stream_id):
        before = spark.sparkContext._jsc.sc().dagScheduler().nextJobId()
        append(name, df, batch_id, stream_id)
        numbers.append(spark.sparkContext._jsc.sc().dagScheduler().nextJobId() - before)

    warehouse.append_batch = counted
    assert run_weather_stream(spark, landing, warehouse, f"{folder}/checkpoint", files_per_batch=files) == [(2024, 1)]
    assert len(numbers) == -(-4 // files) and max(numbers) <= jobs
    assert warehouse.table("dim_weather").count() == 12
