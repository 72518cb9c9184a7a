"""Trip and weather feeds derived from the given test tables.

`events` becomes one month of trips and weather at the same hours. `lineitem` becomes seven years
of monthly trips and `orders` their weather, for the jobs that work month by month.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareweather.functions.weather import with_weather_features
from fareweather.schemas import DIM_WEATHER, RAW_TRIP, conform
from fareweather.session import PARQUET_OPTIONS
from fareweather.sources.trip_lake import FILE_STEM, Period

# Monthly files written below a partition folder, so that one Spark job writes them all.
SAMPLE_STEM = f"file={FILE_STEM}"
MONTH_NUMBER = "_month"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _k() -> Column:
    """The whole number in `{"k": 42}`, found four times faster than by parsing the JSON."""
    return F.regexp_extract("props", r'"k": *(\d+)', 1).cast("int")


def _after(moment: Column, minutes: Column) -> Column:
    return moment + F.make_dt_interval(mins=minutes.cast("int"))


def event_trips(spark: SparkSession, sf_dir: str, *keep: str) -> DataFrame:
    """Every event as a raw trip; `keep` names event columns to carry along."""
    passengers = F.col("event_id") % 7
    tip = F.col("value") * (passengers * 6) / 100
    trips = {
        "tpep_pickup_datetime": F.col("ts"),
        "tpep_dropoff_datetime": _after(F.col("ts"), _k()),
        "trip_distance": _k().cast("double") / 10,
        "fare_amount": F.col("value"),
        "tip_amount": tip,
        "total_amount": F.col("value") + tip,
        "passenger_count": passengers.cast("double"),
        "payment_type": F.col("user_id") % 6 + 1,
        "PULocationID": F.col("user_id"),
        "DOLocationID": (F.col("user_id") * 7 + F.col("event_id")) % 265,
    }
    return table(spark, sf_dir, "events").select(
        *keep, *[trips[name].alias(name) for name in RAW_TRIP.fieldNames()]
    )


def _condition(number: Column) -> Column:
    kind = number % 5
    return (
        F.when(kind == 0, "Rain").when(kind == 1, "Clouds").when(kind == 2, "Clear").when(kind == 3, "Snow")
    )


def observing_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events but those that stand for failed requests (`undated_documents`)."""
    return table(spark, sf_dir, "events").where(~F.col("event_type").isin("error", "signup"))


def event_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observing event as a flat weather observation."""
    return (
        observing_events(spark, sf_dir)
        .select(
            F.col("ts").cast("timestamp").alias("timestamp"),
            F.col("value").alias("temperature"),
            _k().cast("double").alias("humidity"),
            (_k().cast("double") / 5).alias("wind_speed"),
            _condition(_k()).alias("weather_condition"),
        )
    )


def event_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform(with_weather_features(event_observations(spark, sf_dir)), DIM_WEATHER)


def reported_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reading per 20 minutes, summed up from all observing events in that time.

    A station reports a few times an hour however much traffic there is, so the hour join
    grows with the trips alone.
    """
    slot = F.floor(F.unix_timestamp("ts") / 1200)
    readings = (
        observing_events(spark, sf_dir)
        .groupBy(slot.alias("slot"))
        .agg(
            F.min("ts").cast("timestamp").alias("timestamp"),
            F.max("value").alias("temperature"),
            F.max(_k()).cast("double").alias("humidity"),
            (F.min(_k()).cast("double") / 5).alias("wind_speed"),
            _condition(F.sum(_k())).alias("weather_condition"),
        )
    )
    return conform(with_weather_features(readings), DIM_WEATHER)


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every observing event as a weather document, with `weather` as an array or a lone object."""
    return observing_events(spark, sf_dir).select(
        _document(
            seconds=F.unix_timestamp("ts"),
            temperature=F.col("value"),
            humidity=_k().cast("double"),
            wind_speed=_k().cast("double") / 5,
            condition=_condition(_k()),
            as_array=F.col("event_id") % 2 == 0,
        ).alias("value")
    )


def undated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every `error` event as an error payload, every `signup` event as broken JSON."""
    payload = F.to_json(F.struct(F.lit(401).alias("cod"), F.col("event_id").cast("string").alias("message")))
    broken = F.concat(F.lit('{"dt":'), F.unix_timestamp("ts").cast("string"))
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type").isin("error", "signup"))
        .select(F.when(F.col("event_type") == "error", payload).otherwise(broken).alias("value"))
    )


def _document(
    seconds: Column,
    temperature: Column,
    humidity: Column,
    wind_speed: Column,
    condition: Column,
    as_array: Column,
) -> Column:
    state = F.struct(condition.alias("main"), F.lit("as observed").alias("description"))
    nothing = F.array().cast("array<struct<main: string, description: string>>")
    states = F.when(condition.isNotNull(), F.array(state)).otherwise(nothing)
    measured = (
        seconds.alias("dt"),
        F.struct(temperature.alias("temp"), humidity.alias("humidity")).alias("main"),
        F.struct(wind_speed.alias("speed")).alias("wind"),
    )
    return F.when(as_array, F.to_json(F.struct(*measured, states.alias("weather")))).otherwise(
        F.to_json(F.struct(*measured, state.alias("weather")))
    )


def _line_pickup() -> Column:
    minute = (F.col("l_orderkey") * 37 + F.col("l_partkey") * 11 + F.col("l_linenumber")) % 1440
    return _after(F.col("l_shipdate"), minute)


def line_trips(lines: DataFrame) -> DataFrame:
    """Line items as raw trips; returned goods give negative fares, small ones negative durations."""
    pickup = _line_pickup()
    fare = F.when(F.col("l_returnflag") == "R", -F.col("l_extendedprice")).otherwise(F.col("l_extendedprice"))
    tip = F.col("l_extendedprice") * F.col("l_discount") * F.col("l_linenumber")
    trips = {
        "tpep_pickup_datetime": pickup,
        "tpep_dropoff_datetime": _after(pickup, F.col("l_quantity") * 2 - 10),
        "trip_distance": F.col("l_quantity") / 8,
        "fare_amount": fare,
        "tip_amount": tip,
        "total_amount": fare + tip,
        "passenger_count": (F.col("l_linenumber") - 1).cast("double"),
        "payment_type": F.col("l_suppkey") % 6 + 1,
        "PULocationID": F.col("l_suppkey"),
        "DOLocationID": F.col("l_partkey"),
    }
    return lines.select(*[trips[name].alias(name) for name in RAW_TRIP.fieldNames()])


def monthly_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line item as a raw trip."""
    return line_trips(table(spark, sf_dir, "lineitem"))


def order_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One weather document per hour and order status, summed up from all orders."""
    hour = F.unix_timestamp("o_orderdate") + F.col("o_orderkey") % 24 * 3600
    kind = F.sum("o_custkey") % 5
    return (
        table(spark, sf_dir, "orders")
        .groupBy(hour.alias("hour"), "o_orderstatus")
        .agg(
            _document(
                seconds=F.max(hour) + F.count(F.lit(1)) % 3600,
                temperature=F.max("o_totalprice") / 10000,
                humidity=(F.sum("o_custkey") % 101).cast("double"),
                wind_speed=(F.min("o_orderkey") % 200).cast("double") / 10,
                condition=_condition(F.sum("o_custkey")),
                as_array=kind % 2 == 0,
            ).alias("value")
        )
        .select("value")
    )


def write_raw_months(trips: DataFrame, raw_root: str) -> None:
    """Raw trips as one file folder per pickup month; AQE splits a month too large for one task."""
    _write_months(_by_month(trips, F.col("tpep_pickup_datetime")).drop(MONTH_NUMBER), raw_root)


def write_raw_lines(spark: SparkSession, sf_dir: str, raw_root: str) -> None:
    """The same for all line items, which become trips after the exchange, as their own columns are narrower."""
    _write_months(line_trips(_by_month(table(spark, sf_dir, "lineitem"), _line_pickup())), raw_root)


def _by_month(rows: DataFrame, pickup: Column) -> DataFrame:
    """Rows exchanged by the number of their pickup month; file names would be longer than some rows."""
    return rows.withColumn(MONTH_NUMBER, F.year(pickup) * 12 + F.month(pickup)).hint("rebalance", MONTH_NUMBER)


def _write_months(trips: DataFrame, raw_root: str) -> None:
    pickup = F.col("tpep_pickup_datetime")
    two_digits = F.lpad(F.month(pickup).cast("string"), 2, "0")
    name = F.concat(F.lit(f"{FILE_STEM}_"), F.year(pickup), F.lit("-"), two_digits, F.lit(".parquet"))
    named = trips.withColumn("file", name)
    named.write.options(**PARQUET_OPTIONS).partitionBy("file").mode("append").parquet(raw_root)


def trip_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The years in which either feed has trips."""
    lines = table(spark, sf_dir, "lineitem").select(F.year("l_shipdate").alias("year"))
    events = table(spark, sf_dir, "events").select(F.year("ts").alias("year"))
    return lines.union(events).distinct()


def trip_months(trips: DataFrame) -> list[Period]:
    pickup = F.col("tpep_pickup_datetime")
    months = trips.select(F.year(pickup).alias("year"), F.month(pickup).alias("month")).distinct()
    return sorted((row["year"], row["month"]) for row in months.collect())
