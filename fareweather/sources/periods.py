"""The months a trip feed is read for."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The years read by default, and the last month read of a year.
DEFAULT_YEARS = (2022, 2023, 2024)
DEFAULT_LAST_MONTHS = {2024: 4}


def as_list(value: int | Iterable[int]) -> list[int]:
    """A single number stands for a list of one."""
    return [value] if isinstance(value, int) else list(value)


def year_frame(spark: SparkSession, years: int | Iterable[int] = DEFAULT_YEARS) -> DataFrame:
    return spark.createDataFrame([(year,) for year in as_list(years)], "year INT")


def enumerate_periods(
    years: DataFrame, months: int | Iterable[int] | None = None, last_months: Mapping[int, int] | None = None
) -> DataFrame:
    """One (year, month) row per month of each row of `years`; given months apply to every year.

    `last_months` ends a year early where no months are given.
    """
    if months is None:
        last = F.lit(12)
        for year, month in (last_months or {}).items():
            last = F.when(F.col("year") == year, month).otherwise(last)
        wanted = F.sequence(F.lit(1), last)
    else:
        wanted = F.array(*[F.lit(month) for month in as_list(months)]).cast("array<int>")
    return years.select(F.col("year").cast("int").alias("year"), F.explode(wanted).alias("month"))


def period_list(periods: DataFrame) -> list[tuple[int, int]]:
    """The periods as (year, month) pairs for the driver: at most a few hundred calendar months."""
    return [(row["year"], row["month"]) for row in periods.orderBy("year", "month").collect()]


def default_periods(
    spark: SparkSession,
    years: int | Iterable[int] = DEFAULT_YEARS,
    months: int | Iterable[int] | None = None,
) -> list[tuple[int, int]]:
    return period_list(enumerate_periods(year_frame(spark, years), months, DEFAULT_LAST_MONTHS))
