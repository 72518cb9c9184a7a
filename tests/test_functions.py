from __future__ import annotations

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fareweather.functions.clock import hour_from_key, hour_key, hour_start
from fareweather.functions.weather import dim_weather, weather_category
from fareweather.schemas import DIM_WEATHER, FACT_TRIPS, RAW_WEATHER
from tests.trips import EDGE_TRIPS, at, edge_facts


def test_trip_features_of_edge_rows(spark):
    facts = edge_facts(spark)
    assert facts.columns == FACT_TRIPS.fieldNames()
    assert [f.dataType for f in facts.schema] == [f.dataType for f in FACT_TRIPS]
    found = {
        row["PULocationID"]: (
            row["trip_duration"],
            row["distance_category"],
            row["tip_percentage"],
            row["pickup_hour"],
            row["pickup_day"],
        )
        for row in facts.collect()
    }
    assert found == {number: trip[7] for number, trip in enumerate(EDGE_TRIPS, 1)}


DOCUMENTS = [
    (
        '{"dt":1704067200,"main":{"temp":3.5,"humidity":80},"wind":{"speed":4.1},'
        '"weather":[{"id":500,"main":"Rain","description":"light rain"}]}',
        (3.5, "Rain", "Rainy", 0, 2),
    ),
    (
        '{"dt":1704070800,"main":{"temp":4,"humidity":81},"wind":{"speed":4},'
        '"weather":{"main":"Clouds","description":"few"}}',
        (4.0, "Clouds", "Cloudy", 1, 2),
    ),
    ('{"dt":1704074400,"main":{"temp":1},"weather":[]}', (1.0, None, "Other", 2, 2)),
    ('{"cod":401,"message":"Invalid API key"}', (None, None, "Other", None, None)),
    ('{"dt":17040', (None, None, "Other", None, None)),
]


def test_weather_documents(spark, folder):
    for number, (text, _) in enumerate(DOCUMENTS):
        Path(folder, f"weather_{number}.json").write_text(text)
    flat = dim_weather(spark.read.schema(RAW_WEATHER).json(folder))
    assert flat.columns == DIM_WEATHER.fieldNames()
    assert [f.dataType for f in flat.schema] == [f.dataType for f in DIM_WEATHER]
    names = ("temperature", "weather_condition", "weather_category", "hour", "day_of_week")
    found = [tuple(row[name] for name in names) for row in flat.collect()]
    assert sorted(found, key=repr) == sorted((expected for _, expected in DOCUMENTS), key=repr)


def test_first_of_several_conditions_counts(spark, folder):
    document = {"dt": 0, "weather": [{"main": "Clear"}, {"main": "Rain"}]}
    Path(folder, "weather.json").write_text(json.dumps(document))
    row = dim_weather(spark.read.schema(RAW_WEATHER).json(folder)).first()
    assert (row["weather_condition"], row["weather_category"]) == ("Clear", "Clear")


@pytest.mark.parametrize(
    ("condition", "category"),
    [
        ("Rain", "Rainy"),
        ("Clouds", "Cloudy"),
        ("Clear", "Clear"),
        ("Snow", "Other"),
        ("light rain", "Other"),
        ("Rain Clouds", "Rainy"),
        (None, "Other"),
    ],
)
def test_category_text(spark, condition, category):
    frame = spark.createDataFrame([(condition,)], "condition STRING")
    assert frame.select(weather_category(F.col("condition"))).first()[0] == category


def test_hour_key_agrees_with_truncation(spark):
    moments = [(at(m),) for m in ("2024-01-07 10:59:59.999", "1969-12-31 23:30:00", "2024-02-29 00:00:00")]
    frame = spark.createDataFrame(moments + [(None,)], "m TIMESTAMP_NTZ")
    for row in frame.select(hour_from_key(hour_key(F.col("m"))), hour_start(F.col("m"))).collect():
        assert row[0] == row[1]
