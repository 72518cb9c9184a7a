"""The two summary reports.

Each report comes in two forms with equal results. ``*_from_enriched`` groups the joined table.
The plain form never joins trips to observations: every trip of an hour meets the same
observations, so it takes the trips summed per hour (``hourly_totals``: map-side combined, a few
rows per hour however busy the hour is, one scan for both reports), counts observations per hour,
and joins the two short lists. Trip counts and sums are then multiplied by the number of
observations the join would have paired them with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareweather.functions.clock import hour_from_key, hour_key, hour_start, instant_hour_key

# All three limits are strict.
MIN_TRIPS = 10
MIN_SPENT = 300
MIN_TIP_PERCENTAGE = 15


def trip_summary_from_enriched(enriched: DataFrame) -> DataFrame:
    summary = (
        enriched.select(
            hour_start(F.col("tpep_pickup_datetime")).alias("hour"),
            "weather_category",
            "trip_duration",
            "tip_percentage",
        )
        .groupBy(1, 2)
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.avg("trip_duration").alias("avg_trip_duration"),
            F.avg("tip_percentage").alias("avg_tip_percentage"),
        )
    )
    return sort_summary(summary)


def hourly_totals(trips: DataFrame, *keys: str) -> DataFrame:
    """Per pickup hour and passenger count, all that either report needs of the trips.

    With `keys`, per these, too; the reports add such totals up.
    """
    return trips.groupBy(
        hour_key(F.col("tpep_pickup_datetime")).alias("hour_key"), "passenger_count", *keys
    ).agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum("trip_duration").alias("seconds"),
        F.count("trip_duration").alias("timed_trips"),
        F.sum("tip_percentage").alias("tips"),
        F.count("tip_percentage").alias("tipped_trips"),
        F.sum("total_amount").alias("spent"),
    )


def trip_summary(totals: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips, mean duration and mean tip per pickup hour and weather category."""
    per_hour = totals.groupBy("hour_key").agg(
        F.sum("trips").alias("trips"),
        F.try_divide(F.sum("seconds"), F.sum("timed_trips")).alias("avg_trip_duration"),
        F.try_divide(F.sum("tips"), F.sum("tipped_trips")).alias("avg_tip_percentage"),
    )
    categories = observation_counts(weather, F.col("weather_category"))
    summary = per_hour.join(categories, "hour_key", "left").select(
        hour_from_key(F.col("hour_key")).alias("hour"),
        "weather_category",
        (F.col("trips") * repeats()).alias("trip_count"),
        "avg_trip_duration",
        "avg_tip_percentage",
    )
    return sort_summary(summary)


def sort_summary(summary: DataFrame) -> DataFrame:
    """By hour, then category, NULLs last."""
    return summary.orderBy(F.col("hour").asc_nulls_last(), F.col("weather_category").asc_nulls_last())


def positive_passenger_trips(trips: DataFrame) -> DataFrame:
    return trips.where(F.col("passenger_count") > 0)


def passenger_stats_from_enriched(enriched: DataFrame) -> DataFrame:
    return (
        positive_passenger_trips(enriched)
        .groupBy("passenger_count")
        .agg(
            F.count(F.lit(1)).alias("trip_count"),
            F.sum("total_amount").alias("total_spent"),
            F.avg("tip_percentage").alias("avg_tip_percentage"),
        )
    )


def passenger_stats(totals: DataFrame, weather: DataFrame) -> DataFrame:
    """Trips, total spent and mean tip per passenger count, as seen through the hour join."""
    return (
        positive_passenger_trips(totals)
        .join(observation_counts(weather), "hour_key", "left")
        .groupBy("passenger_count")
        .agg(
            F.sum(F.col("trips") * repeats()).alias("trip_count"),
            F.sum(F.col("spent") * repeats()).alias("total_spent"),
            F.try_divide(
                F.sum(F.col("tips") * repeats()), F.sum(F.col("tipped_trips") * repeats())
            ).alias("avg_tip_percentage"),
        )
    )


def high_value(stats: DataFrame) -> DataFrame:
    """Passenger groups above all three limits; a NULL mean never qualifies."""
    return stats.where(
        (F.col("trip_count") > MIN_TRIPS)
        & (F.col("total_spent") > MIN_SPENT)
        & (F.col("avg_tip_percentage") > MIN_TIP_PERCENTAGE)
    )


def observation_counts(weather: DataFrame, *keys: Column) -> DataFrame:
    return (
        weather.where(F.col("timestamp").isNotNull())
        .groupBy(instant_hour_key(F.col("timestamp")).alias("hour_key"), *keys)
        .agg(F.count(F.lit(1)).alias("observations"))
    )


def repeats() -> Column:
    """How often the hour join shows a trip: once per observation, or once unmatched."""
    return F.coalesce(F.col("observations"), F.lit(1))
