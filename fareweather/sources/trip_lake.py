"""Monthly raw trip files, conformed into one Parquet lake partitioned by (year, month)."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareweather.schemas import INT, RAW_TRIP, conform, struct
from fareweather.session import PARQUET_OPTIONS, object_store_path
from fareweather.sources.folders import Folder

Period = tuple[int, int]

# Fixed value: the published file name is this stem and the month, as in ..._2022-01.parquet.
FILE_STEM = "yellow_tripdata"

LAKE_SCHEMA = StructType(RAW_TRIP.fields + struct(year=INT, month=INT).fields)
STATUS_SCHEMA = "year INT, month INT, ok BOOLEAN, rows BIGINT, error STRING"

# Months landed side by side, so that the tail of one does not leave the cluster idle. A month of
# one file is one task, so a larger cluster gets as many as it has cores, up to a bound for the driver.
PARALLEL_MONTHS, MOST_PARALLEL_MONTHS = 8, 16


def month_path(raw_root: str, period: Period, stem: str = FILE_STEM) -> str:
    year, month = period
    return f"{object_store_path(raw_root).rstrip('/')}/{stem}_{year}-{month:02d}.parquet"


def ingest_periods(
    spark: SparkSession,
    raw_root: str,
    lake_root: str,
    periods: Iterable[Period],
    stem: str = FILE_STEM,
) -> DataFrame:
    """Land the given months in the lake and report each one; a bad month does not stop the rest.

    Column types differ between months, so a plain read of the whole folder fails. Each month is
    read with its own footer, cast to the declared schema, and replaces its own partition.
    """

    @inheritable_thread_target(spark)  # the caller's job group and pool hold for the months, too
    def land(period: Period) -> tuple:
        try:
            return *period, True, land_month(spark, raw_root, lake_root, period, stem), None
        except Exception as error:  # a missing, foreign or damaged file is this month's problem only
            return *period, False, None, _first_line(error)

    cores = spark.sparkContext.defaultParallelism
    with ThreadPoolExecutor(max(PARALLEL_MONTHS, min(cores, MOST_PARALLEL_MONTHS))) as pool:
        status = list(pool.map(land, dict.fromkeys(periods)))
    return spark.createDataFrame(status, STATUS_SCHEMA)


def land_month(
    spark: SparkSession, raw_root: str, lake_root: str, period: Period, stem: str = FILE_STEM
) -> int:
    """Replace one month of the lake and return its rows; on failure the old month stays."""
    year, month = period
    counted = Observation()
    raw = spark.read.parquet(month_path(raw_root, period, stem))
    trips = conform(raw, RAW_TRIP).observe(counted, F.count(F.lit(1)).alias("rows"))
    lake_root = object_store_path(lake_root).rstrip("/")
    # As text: whole numbers would be compiled into the code, anew for every month.
    keys = {"year": F.lit(str(year)), "month": F.lit(str(month))}
    (
        trips.withColumns(keys)
        .write.options(**PARQUET_OPTIONS)
        .partitionBy("year", "month")
        .mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .parquet(lake_root)
    )
    rows = counted.get["rows"]
    if not rows:  # a dynamic overwrite without rows keeps what an earlier run left
        Folder(spark, lake_root).delete(f"year={year}/month={month}")
    return rows


def read_lake(spark: SparkSession, lake_root: str, periods: Iterable[Period] | None = None) -> DataFrame:
    """Raw trips of the chosen months, or of all; the choice prunes partitions before the scan."""
    lake = spark.read.schema(LAKE_SCHEMA).parquet(object_store_path(lake_root))
    if periods is not None:
        by_year: dict[int, list[int]] = {}
        for year, month in periods:
            by_year.setdefault(year, []).append(month)
        chosen = [
            (F.col("year") == year) & F.col("month").isin(months) for year, months in by_year.items()
        ]
        lake = lake.where(reduce(Column.__or__, chosen, F.lit(False)))
    return lake


def _first_line(error: Exception) -> str:
    text = str(error).strip()
    return text.splitlines()[0] if text else type(error).__name__
