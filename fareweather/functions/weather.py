"""Flattening and labelling of weather observations; the same code serves batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareweather.functions.clock import epoch_to_timestamp, hour_of_day, weekday


def condition_text(weather_json: Column) -> Column:
    """`main` of the first condition; a lone object is read as an array of one."""
    conditions = F.from_json(weather_json, "array<struct<main: string, description: string>>")
    return F.get(conditions, F.lit(0))["main"]


def weather_category(condition: Column) -> Column:
    """Looked for in this order, case-sensitive, first match wins."""
    return (
        F.when(condition.like("%Rain%"), "Rainy")
        .when(condition.like("%Cloud%"), "Cloudy")
        .when(condition.like("%Clear%"), "Clear")
        .otherwise("Other")
    )


def flatten_observations(raw: DataFrame) -> DataFrame:
    return raw.select(
        epoch_to_timestamp(F.col("dt")).alias("timestamp"),
        F.col("main.temp").alias("temperature"),
        F.col("main.humidity").alias("humidity"),
        F.col("wind.speed").alias("wind_speed"),
        condition_text(F.col("weather")).alias("weather_condition"),
    )


def with_weather_features(observations: DataFrame) -> DataFrame:
    moment = F.col("timestamp")
    return observations.withColumns(
        {
            "weather_category": weather_category(F.col("weather_condition")),
            "hour": hour_of_day(moment),
            "day_of_week": weekday(moment),
        }
    )


def dim_weather(raw: DataFrame) -> DataFrame:
    """Raw observations to the weather table's columns."""
    return with_weather_features(flatten_observations(raw))
