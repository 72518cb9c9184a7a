from __future__ import annotations

from pathlib import Path

import pyarrow.parquet
from pyspark.sql import functions as F

from fareweather.functions.trips import fact_trips
from fareweather.schemas import RAW_TRIP
from fareweather.sources import sample_feeds
from fareweather.sources.trip_lake import ingest_periods, month_path, read_lake
from fareweather.sources.warehouse import LakeWarehouse
from tests.plans import plan_text, rows
from tests.trips import at, raw_trips

MONTHS = [(2023, 1), (2023, 2), (2023, 3)]


def write_month(spark, root, period, count, change=lambda df: df):
    year, month = period
    moment = f"{year}-{month:02d}-05 08:00:00"
    trips = raw_trips(spark, [(moment, moment, 1.0, 10.0, 1.0, 11.0, 2.0)] * count)
    change(trips).coalesce(1).write.mode("overwrite").parquet(month_path(root, period))


def status_of(status):
    return [(row["year"], row["month"], row["ok"], row["rows"]) for row in status.orderBy("year", "month").collect()]


def test_drifting_types_absent_and_extra_columns(spark, folder):
    root, lake = f"{folder}/raw", f"{folder}/lake"
    write_month(spark, root, MONTHS[0], 2)
    write_month(
        spark,
        root,
        MONTHS[1],
        3,
        lambda df: df.withColumns(
            {
                "passenger_count": F.col("passenger_count").cast("bigint"),
                "tpep_pickup_datetime": F.col("tpep_pickup_datetime").cast("timestamp"),
                "congestion_surcharge": F.lit(2.5),
            }
        ),
    )
    write_month(spark, root, MONTHS[2], 1, lambda df: df.drop("tip_amount"))
    assert status_of(ingest_periods(spark, root, lake, MONTHS)) == [
        (2023, 1, True, 2),
        (2023, 2, True, 3),
        (2023, 3, True, 1),
    ]
    landed = read_lake(spark, lake)
    assert landed.columns == RAW_TRIP.fieldNames() + ["year", "month"]
    found = landed.groupBy("month", F.month("tpep_pickup_datetime"), "passenger_count").agg(
        F.count("*"), F.sum("tip_amount")
    )
    assert sorted(map(tuple, found.collect())) == [(1, 1, 2.0, 2, 2.0), (2, 2, 2.0, 3, 3.0), (3, 3, 2.0, 1, None)]


def test_bad_months_do_not_stop_the_others(spark, folder):
    root, lake = f"{folder}/raw", f"{folder}/lake"
    write_month(spark, root, MONTHS[0], 2)
    Path(month_path(root, MONTHS[1])).write_text("<Error>AccessDenied</Error>")
    write_month(spark, root, MONTHS[2], 4)
    status = ingest_periods(spark, root, lake, [*MONTHS, (2023, 4)])
    assert status_of(status) == [
        (2023, 1, True, 2),
        (2023, 2, False, None),
        (2023, 3, True, 4),
        (2023, 4, False, None),
    ]
    assert all(bool(row["error"]) != row["ok"] for row in status.collect())
    assert read_lake(spark, lake).count() == 6


def test_damage_behind_a_good_footer_is_found_and_keeps_the_old_month(spark, folder):
    root, lake = f"{folder}/raw", f"{folder}/lake"
    for period in MONTHS:
        write_month(spark, root, period, 50)
    ingest_periods(spark, root, lake, MONTHS)
    write_month(spark, root, MONTHS[0], 60)
    write_month(spark, root, MONTHS[1], 60)
    (part,) = Path(month_path(root, MONTHS[1])).glob("part-*.parquet")
    footer = pyarrow.parquet.read_metadata(part).serialized_size + 8
    damaged = bytearray(part.read_bytes())
    damaged[4 : len(damaged) - footer] = b"\xff" * (len(damaged) - footer - 4)
    part.write_bytes(bytes(damaged))
    for checksum in part.parent.glob(".*.crc"):
        checksum.unlink()
    assert status_of(ingest_periods(spark, root, lake, MONTHS)) == [
        (2023, 1, True, 60),
        (2023, 2, False, None),
        (2023, 3, True, 50),
    ]
    counts = read_lake(spark, lake).groupBy("month").count().collect()
    assert sorted(map(tuple, counts)) == [(1, 60), (2, 50), (3, 50)]


def test_a_second_run_replaces_its_months_only(spark, folder):
    root, lake = f"{folder}/raw", f"{folder}/lake"
    for period in MONTHS:
        write_month(spark, root, period, 2)
    ingest_periods(spark, root, lake, MONTHS)
    write_month(spark, root, MONTHS[1], 5)
    ingest_periods(spark, root, lake, [MONTHS[1], MONTHS[1]])
    assert sorted(map(tuple, read_lake(spark, lake).groupBy("month").count().collect())) == [(1, 2), (2, 5), (3, 2)]


def test_an_empty_month_empties_its_partition(spark, folder):
    root, lake = f"{folder}/raw", f"{folder}/lake"
    for period in MONTHS:
        write_month(spark, root, period, 2)
    ingest_periods(spark, root, lake, MONTHS)
    write_month(spark, root, MONTHS[2], 2, lambda df: df.where("false"))
    assert status_of(ingest_periods(spark, root, lake, [MONTHS[2]])) == [(2023, 3, True, 0)]
    assert sorted(map(tuple, read_lake(spark, lake).groupBy("month").count().collect())) == [(1, 2), (2, 2)]


def test_chosen_months_prune_partitions(spark, folder):
    root, lake = f"{folder}/raw", f"{folder}/lake"
    for period in MONTHS:
        write_month(spark, root, period, 2)
    ingest_periods(spark, root, lake, MONTHS)
    chosen = read_lake(spark, lake, [(2023, 1), (2023, 3), (2022, 2)])
    assert chosen.count() == 4
    plan = plan_text(chosen)
    (filters,) = [line for line in plan.splitlines() if line.startswith("PartitionFilters")]
    assert "year" in filters and "month" in filters
    assert "PushedFilters" not in plan and "Filter " not in plan  # nothing left to test per row
    assert read_lake(spark, lake, []).count() == 0


def test_lake_and_tables_are_packed_without_dictionaries(spark, folder):
    """As much of the data hardly repeats, dictionaries cost more time than they save room."""
    root, lake = f"{folder}/raw", f"{folder}/lake"
    write_month(spark, root, MONTHS[0], 500)
    ingest_periods(spark, root, lake, MONTHS[:1])
    warehouse = LakeWarehouse(spark, f"{folder}/warehouse", f"packed_{Path(folder).name.replace('-', '_')}")
    warehouse.replace("fact_taxi_trips", fact_trips(read_lake(spark, lake), "year", "month"))
    warehouse.append_batch("weather_quarantine", spark.createDataFrame([("a", "b")], "source_file STRING, record STRING"), 0)
    files = [path for top in (lake, warehouse.root) for path in Path(top).rglob("*.parquet") if path.is_file()]
    found = [pyarrow.parquet.ParquetFile(path).metadata for path in files]
    groups = [file.row_group(0) for file in found if file.num_row_groups]  # tasks without rows leave empty files
    assert len(groups) >= 3
    for group in groups:
        for column in map(group.column, range(group.num_columns)):
            assert column.compression == "ZSTD" and not any("DICTIONARY" in kind for kind in column.encodings)


def test_raw_lines_are_the_monthly_trips(spark, folder):
    """Nothing that a trip is made of changes in the exchange, which line items pass before they are trips."""
    lines = [
        (n, n * 7 % 50, n % 4, n % 7 + 1, float(n % 50), 100.0 + n, n % 10 / 100, "RAN"[n % 3], at(f"1996-{n % 3 + 1:02d}-{n % 28 + 1:02d} 00:00:00") if n % 11 else None)
        for n in range(300)
    ]
    names = "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE"
    data = spark.createDataFrame(lines, f"{names}, l_discount DOUBLE, l_returnflag STRING, l_shipdate TIMESTAMP_NTZ")
    data.union(data.limit(20)).write.parquet(f"{folder}/lineitem.parquet")
    sample_feeds.write_raw_lines(spark, folder, f"{folder}/raw")
    trips = sample_feeds.monthly_trips(spark, folder)
    raw = spark.read.parquet(f"{folder}/raw")
    assert rows(raw.select(trips.columns)) == rows(trips) and raw.count() == 320
    month = F.date_format("tpep_pickup_datetime", "yyyy-MM")
    assert raw.where(F.col("file") != F.concat(F.lit("yellow_tripdata_"), month, F.lit(".parquet"))).count() == 0
