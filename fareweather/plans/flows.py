"""The two recurring jobs as plain functions for a scheduler to call."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from fareweather.functions.trips import fact_trips
from fareweather.plans.models import build_models, contents, months_of_hours, refresh_totals
from fareweather.sources.periods import default_periods
from fareweather.sources.trip_lake import FILE_STEM, Period, ingest_periods, read_lake
from fareweather.sources.weather_landing import land_payloads
from fareweather.sources.warehouse import JdbcWarehouse, LakeWarehouse
from fareweather.streaming.weather_stream import run_weather_stream


@dataclass(frozen=True)
class FlowConfig:
    """Folders and the warehouse; every path must be reachable by all executors."""

    warehouse: LakeWarehouse | JdbcWarehouse
    raw_trips: str | None = None
    trip_lake: str | None = None
    weather_landing: str | None = None
    weather_checkpoint: str | None = None
    weather_archive: str | None = None
    file_stem: str = FILE_STEM


def build_fact_trips(spark: SparkSession, config: FlowConfig, periods: Iterable[Period] | None = None) -> None:
    """Replace the fact table from all landed months, or only the given months of it and of the stored totals."""
    warehouse = config.warehouse
    if periods is None:
        warehouse.replace("fact_taxi_trips", fact_trips(read_lake(spark, config.trip_lake), "year", "month"))
    else:
        periods, before = list(periods), warehouse.content("fact_taxi_trips")
        trips = fact_trips(read_lake(spark, config.trip_lake, periods), "year", "month")
        warehouse.replace_months("fact_taxi_trips", trips, periods)
        refresh_totals(warehouse, periods, before)


def run_trip_batch(
    spark: SparkSession,
    config: FlowConfig,
    periods: Iterable[Period] | None = None,
    transform_periods: Iterable[Period] | None = None,
    models: Iterable[str] | None = None,
) -> DataFrame:
    """Ingest the periods, rebuild the fact table and the models; return the ingest status.

    With `transform_periods` only these months of the fact table and of the stored totals are
    replaced, and only they are read for it. The same holds for the joined table if it covers
    everything that was there before; otherwise it is rebuilt whole.
    """
    warehouse = config.warehouse
    periods = default_periods(spark) if periods is None else list(periods)
    status = ingest_periods(spark, config.raw_trips, config.trip_lake, periods, config.file_stem)
    transform_periods = None if transform_periods is None else list(transform_periods)
    whole = joined_is_whole(warehouse)
    build_fact_trips(spark, config, transform_periods)
    build_models(warehouse, models, transform_periods if whole else None)
    return status


def joined_is_whole(warehouse) -> bool:
    """Whether the joined table was built from all trips and all weather that are stored."""
    built_from = warehouse.sources("trip_enriched")
    return bool(built_from) and built_from == contents(warehouse)


def run_weather_batch(
    spark: SparkSession,
    config: FlowConfig,
    payloads: DataFrame | None = None,
    models: Iterable[str] | None = None,
    only_new_months: bool = True,
) -> None:
    """Land new payload texts, stream everything not yet read into the warehouse, rebuild the models.

    If the joined table covered everything before, it is rebuilt for those months alone that the
    new weather falls in, and no other months of the fact table are read; the result is the same.
    """
    warehouse = config.warehouse
    if payloads is not None:
        land_payloads(payloads, config.weather_landing)
    whole = only_new_months and joined_is_whole(warehouse)
    seen = run_weather_stream(
        spark, config.weather_landing, warehouse, config.weather_checkpoint, archive=config.weather_archive
    )
    build_models(warehouse, models, months_of_hours(warehouse, seen) if whole else None)
