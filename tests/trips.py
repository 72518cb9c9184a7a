"""Literal trips and observations."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareweather.functions.trips import fact_trips
from fareweather.functions.weather import with_weather_features
from fareweather.schemas import DIM_WEATHER, RAW_TRIP, conform


def at(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


# pickup, dropoff, distance, fare, tip, total, passengers -> duration, category, tip %, hour, day
EDGE_TRIPS = [
    ("2024-01-07 10:15:00", "2024-01-07 10:45:30", 1.99, 10.0, 2.0, 12.0, 1.0, (1830, "0-2 km", 20.0, 10, 1)),
    ("2024-01-06 23:59:59.900", "2024-01-07 00:00:00.100", 2.0, 0.0, 5.0, 5.0, 0.0, (1, "2-5 km", 0.0, 23, 7)),
    ("2024-01-08 11:00:00", "2024-01-08 10:00:00", 5.0, -4.0, 1.0, -3.0, 2.0, (-3600, ">5 km", 0.0, 11, 2)),
    (None, "2024-01-08 10:00:00", None, None, 1.0, None, None, (None, ">5 km", 0.0, None, None)),
    ("2024-01-07 10:59:59", None, -1.0, 20.0, None, 20.0, 1.0, (None, "0-2 km", None, 10, 1)),
    ("2024-01-07 11:00:00", "2024-01-07 11:00:00", float("nan"), 8.0, 2.0, 10.0, 3.0, (0, ">5 km", 25.0, 11, 1)),
]


def raw_trips(spark: SparkSession, trips) -> DataFrame:
    """From (pickup, dropoff, distance, fare, tip, total, passengers); the trip's number is its zone."""
    data = [
        (at(p), at(d), dist, fare, tip, total, passengers, 1, number, number)
        for number, (p, d, dist, fare, tip, total, passengers) in enumerate(trips, 1)
    ]
    return spark.createDataFrame(data, RAW_TRIP)


def edge_facts(spark: SparkSession) -> DataFrame:
    return fact_trips(raw_trips(spark, [trip[:7] for trip in EDGE_TRIPS]))


def simple_facts(spark: SparkSession, trips) -> DataFrame:
    """From (pickup, passengers, fare, tip)."""
    return fact_trips(
        raw_trips(spark, [(p, p, 1.0, fare, tip, fare + tip, passengers) for p, passengers, fare, tip in trips])
    )


def weather(spark: SparkSession, observations) -> DataFrame:
    """From (moment, temperature, condition)."""
    data = [(at(m), t, 50.0, 3.0, c) for m, t, c in observations]
    flat = spark.createDataFrame(
        data, "moment TIMESTAMP_NTZ, temperature DOUBLE, humidity DOUBLE, wind_speed DOUBLE, weather_condition STRING"
    )
    stamped = flat.withColumn("timestamp", F.col("moment").cast("timestamp"))
    return conform(with_weather_features(stamped), DIM_WEATHER)
