"""Column names and types of every relation. These are fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import (
    DataType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
    TimestampType,
)


def struct(**columns: DataType) -> StructType:
    """All columns are nullable."""
    return StructType([StructField(name, kind) for name, kind in columns.items()])


WALL_CLOCK, INSTANT = TimestampNTZType(), TimestampType()
DOUBLE, LONG, INT, TEXT = DoubleType(), LongType(), IntegerType(), StringType()

RAW_TRIP = struct(
    tpep_pickup_datetime=WALL_CLOCK,
    tpep_dropoff_datetime=WALL_CLOCK,
    trip_distance=DOUBLE,
    fare_amount=DOUBLE,
    tip_amount=DOUBLE,
    total_amount=DOUBLE,
    passenger_count=DOUBLE,
    payment_type=LONG,
    PULocationID=LONG,
    DOLocationID=LONG,
)

# `weather` stays raw JSON text: feeds carry it as an object or as an array of objects.
RAW_WEATHER = struct(
    dt=LONG,
    main=struct(temp=DOUBLE, humidity=DOUBLE),
    wind=struct(speed=DOUBLE),
    weather=TEXT,
)

FACT_TRIPS = struct(
    tpep_pickup_datetime=WALL_CLOCK,
    tpep_dropoff_datetime=WALL_CLOCK,
    trip_duration=LONG,
    distance_category=TEXT,
    payment_type=LONG,
    tip_percentage=DOUBLE,
    pickup_hour=INT,
    pickup_day=INT,
    PULocationID=LONG,
    DOLocationID=LONG,
    fare_amount=DOUBLE,
    tip_amount=DOUBLE,
    total_amount=DOUBLE,
    passenger_count=DOUBLE,
)

DIM_WEATHER = struct(
    timestamp=INSTANT,
    temperature=DOUBLE,
    humidity=DOUBLE,
    wind_speed=DOUBLE,
    weather_condition=TEXT,
    weather_category=TEXT,
    hour=INT,
    day_of_week=INT,
)

WEATHER_QUARANTINE = struct(source_file=TEXT, record=TEXT)

TRIP_ENRICHED = StructType(
    FACT_TRIPS.fields
    + [DIM_WEATHER[name] for name in ("temperature", "humidity", "wind_speed", "weather_category")]
)

TRIP_SUMMARY = struct(
    hour=WALL_CLOCK,
    weather_category=TEXT,
    trip_count=LONG,
    avg_trip_duration=DOUBLE,
    avg_tip_percentage=DOUBLE,
)

HIGH_VALUE = struct(
    passenger_count=DOUBLE,
    trip_count=LONG,
    total_spent=DOUBLE,
    avg_tip_percentage=DOUBLE,
)

# Sums of the trips of a landed month by pickup hour and passenger count; all that the reports need.
TRIP_TOTALS = struct(
    hour_key=LONG,
    passenger_count=DOUBLE,
    trips=LONG,
    seconds=LONG,
    timed_trips=LONG,
    tips=DOUBLE,
    tipped_trips=LONG,
    spent=DOUBLE,
)

TABLES = {
    "fact_taxi_trips": FACT_TRIPS,
    "dim_weather": DIM_WEATHER,
    "weather_quarantine": WEATHER_QUARANTINE,
    "trip_enriched": TRIP_ENRICHED,
    "trip_summary_per_hour": TRIP_SUMMARY,
    "high_value_customers": HIGH_VALUE,
    "trip_totals": TRIP_TOTALS,
}


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Cast to the declared types, fill absent columns with NULL and drop the others."""
    present = {name.lower() for name in df.columns}
    return df.selectExpr(
        *[
            f"CAST({f'`{field.name}`' if field.name.lower() in present else 'NULL'} "
            f"AS {field.dataType.simpleString()}) AS `{field.name}`"
            for field in schema.fields
        ]
    )
