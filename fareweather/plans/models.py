"""The models over the warehouse: staging views, the joined table, the two reports."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareweather.functions.clock import hour_key
from fareweather.operators.hour_join import enrich_trips
from fareweather.operators.summaries import (
    high_value,
    hourly_totals,
    passenger_stats,
    passenger_stats_from_enriched,
    sort_summary,
    trip_summary,
    trip_summary_from_enriched,
)

# Staging view -> source table it passes through.
STAGING = {"source_fact_taxi_trips": "fact_taxi_trips", "source_dim_weather": "dim_weather"}


class Report(NamedTuple):
    from_totals: Callable[[DataFrame, DataFrame], DataFrame]
    from_enriched: Callable[[DataFrame], DataFrame]


REPORTS = {
    "trip_summary_per_hour": Report(trip_summary, trip_summary_from_enriched),
    "high_value_customers": Report(
        lambda totals, weather: high_value(passenger_stats(totals, weather)),
        lambda enriched: high_value(passenger_stats_from_enriched(enriched)),
    ),
}

# Dependency order: staging, then the join, then the reports.
MODELS = (*STAGING, "trip_enriched", *REPORTS)

# The selections of the two recurring flows. Neither covers every model.
TRIP_MODELS = ("source_fact_taxi_trips", "trip_enriched", "trip_summary_per_hour", "high_value_customers")
WEATHER_MODELS = ("source_dim_weather", "trip_enriched", "trip_summary_per_hour")


def build_models(
    warehouse, only: Iterable[str] | None = None, months: Iterable[tuple[int, int]] | None = None
) -> list[str]:
    """Rebuild the chosen models, or all, in dependency order; return the names built.

    Models left out keep their earlier content. A report chosen without `trip_enriched` is
    grouped from that table as it stands. Chosen together with it, both reports come from the
    stored totals of the trips, which gives the same rows without reading the joined table back.

    With `months`, `trip_enriched` is rebuilt for these months of the fact table only, from these
    only, and keeps all others; the reports cover all months as ever, but no trips are read for them.
    """
    chosen = set(MODELS if only is None else only)
    unknown = chosen - set(MODELS)
    if unknown:
        raise ValueError(f"unknown models: {sorted(unknown)}")
    for view in STAGING:
        if view in chosen:
            warehouse.create_view(view, STAGING[view])
    reports = [name for name in REPORTS if name in chosen]
    if "trip_enriched" in chosen:
        weather = staged(warehouse, "source_dim_weather")
        built_from = contents(warehouse)
        if months is None or not warehouse.sources("trip_enriched"):
            trips = warehouse.all_months("fact_taxi_trips")
            warehouse.replace("trip_enriched", enrich_trips(trips, weather), built_from)
        else:
            trips = warehouse.table("fact_taxi_trips", months)
            warehouse.replace_months("trip_enriched", enrich_trips(trips, weather), months, built_from)
        totals = stored_totals(warehouse) if reports else None
        for name in reports:
            warehouse.replace(name, REPORTS[name].from_totals(totals, weather))
    elif reports:
        enriched = warehouse.table("trip_enriched")
        for name in reports:
            warehouse.replace(name, REPORTS[name].from_enriched(enriched))
    return [name for name in MODELS if name in chosen]


def staged(warehouse, view: str) -> DataFrame:
    """Pass-through of a source table."""
    return warehouse.table(STAGING[view]).select("*")


def contents(warehouse) -> dict[str, str]:
    """What the joined table and the totals are built from, as it stands."""
    return {name: warehouse.content(name) for name in STAGING.values()}


def stored_totals(warehouse) -> DataFrame:
    """The totals of the fact table by landed month; built again if it changed by other ways than `refresh_totals`."""
    content = warehouse.content("fact_taxi_trips")
    if not content or warehouse.sources("trip_totals").get("fact_taxi_trips") != content:
        totals = hourly_totals(warehouse.all_months("fact_taxi_trips"), "year", "month")
        warehouse.replace("trip_totals", totals, {"fact_taxi_trips": content})
    return warehouse.table("trip_totals")


def refresh_totals(warehouse, months: Iterable[tuple[int, int]], before: str) -> None:
    """Follow a change of these months of the fact table, whose content was `before`; reads these months only."""
    if before and warehouse.sources("trip_totals").get("fact_taxi_trips") == before:
        content = warehouse.content("fact_taxi_trips")
        totals = hourly_totals(warehouse.table("fact_taxi_trips", months), "year", "month")
        warehouse.replace_months("trip_totals", totals, months, {"fact_taxi_trips": content})


def months_of_hours(warehouse, months: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """The months of the fact table that have trips picked up in the given calendar months.

    Pickups lie in the month they were landed for, but for a few. The stored totals tell; no trips
    are read.
    """

    def first_hour(year: int, month: int) -> Column:
        return hour_key(F.make_timestamp_ntz(F.lit(year), F.lit(month), F.lit(1), F.lit(0), F.lit(0), F.lit(0)))

    spans = [
        (F.col("hour_key") >= first_hour(y, m)) & (F.col("hour_key") < first_hour(y + m // 12, m % 12 + 1)) for y, m in months
    ]
    if not spans:
        return []
    stored_totals(warehouse)
    found = warehouse.all_months("trip_totals").where(reduce(Column.__or__, spans)).select("year", "month").distinct()
    return sorted((row["year"], row["month"]) for row in found.collect())


def read_model(warehouse, name: str) -> DataFrame:
    """A built table model; the hourly report comes sorted, as a stored table has no order."""
    table = warehouse.table(name)
    return sort_summary(table) if name == "trip_summary_per_hour" else table
