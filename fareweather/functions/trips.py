"""Features of a single trip."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareweather.functions.clock import hour_of_day, weekday
from fareweather.schemas import FACT_TRIPS

# The distance bands are half-open, the labels carry no unit conversion.
SHORT_BELOW, SHORT_LABEL = 2, "0-2 km"
MEDIUM_BELOW, MEDIUM_LABEL = 5, "2-5 km"
LONG_LABEL = ">5 km"


def trip_duration(pickup: Column, dropoff: Column) -> Column:
    """Whole seconds between the ends, each rounded down first; may be negative."""
    return F.unix_timestamp(dropoff) - F.unix_timestamp(pickup)


def distance_category(distance: Column) -> Column:
    """NULL and NaN count as long trips, negative distances as short ones."""
    return (
        F.when(distance < SHORT_BELOW, SHORT_LABEL)
        .when(distance < MEDIUM_BELOW, MEDIUM_LABEL)
        .otherwise(LONG_LABEL)
    )


def tip_percentage(tip: Column, fare: Column) -> Column:
    """Tip as a share of a positive fare; any other fare, NULL included, gives 0."""
    return F.when(fare > 0, tip / fare * 100).otherwise(F.lit(0.0))


def with_trip_features(trips: DataFrame) -> DataFrame:
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return trips.withColumns(
        {
            "trip_duration": trip_duration(pickup, dropoff),
            "distance_category": distance_category(F.col("trip_distance")),
            "tip_percentage": tip_percentage(F.col("tip_amount"), F.col("fare_amount")),
            "pickup_hour": hour_of_day(pickup),
            "pickup_day": weekday(pickup),
        }
    )


def fact_trips(trips: DataFrame, *keep: str) -> DataFrame:
    """Raw trips to the fact table's columns and those to keep; one narrow projection over the scan."""
    return with_trip_features(trips).select(*FACT_TRIPS.fieldNames(), *keep)
