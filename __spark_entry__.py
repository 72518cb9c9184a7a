"""The registered queries and the SQL each is checked against."""

from __future__ import annotations

import importlib
import uuid
from collections.abc import Callable
from types import ModuleType

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareweather.functions.clock import hour_from_key, hour_of_day, hour_start, weekday
from fareweather.functions.trips import distance_category, fact_trips, tip_percentage, trip_duration
from fareweather.functions.weather import dim_weather, weather_category
from fareweather.operators.hour_join import enrich_trips
from fareweather.operators.summaries import (
    high_value,
    hourly_totals,
    passenger_stats,
    passenger_stats_from_enriched,
    positive_passenger_trips,
    trip_summary,
    trip_summary_from_enriched,
)
from fareweather.plans.flows import FlowConfig, run_trip_batch, run_weather_batch
from fareweather.plans.models import STAGING, WEATHER_MODELS, build_models, read_model, stored_totals
from fareweather.schemas import RAW_WEATHER
from fareweather.session import scratch_folder, use_session_defaults
from fareweather.sources import sample_feeds as feeds
from fareweather.sources.periods import default_periods, enumerate_periods
from fareweather.sources.trip_lake import ingest_periods, month_path, read_lake
from fareweather.sources.warehouse import JdbcWarehouse, LakeWarehouse
from fareweather.sources.weather_landing import land_payloads
from fareweather.streaming.weather_stream import run_weather_stream

SMOKE_DIR = "/root/testdata/sf0.001"

# Files that a wave of documents lands in.
WAVE_FILES = 8

Query = Callable[[SparkSession, str], DataFrame]


def entry(spark: SparkSession) -> DataFrame:
    """Trips per hour and weather category."""
    return queries()["trip_summary_per_hour"](spark, SMOKE_DIR)


def queries() -> dict[str, Query]:
    return {name: _with_session_defaults(query) for name, query in {**QUERIES, **_llm_queries()}.items()}


def _module(name: str) -> ModuleType | None:
    """A module of the training-data operators; None if they aren't there."""
    try:
        return importlib.import_module(name)
    except ModuleNotFoundError as error:
        if error.name is None or not f"{name}.".startswith(f"{error.name}."):
            raise
        return None


def _llm_modules() -> tuple[ModuleType | None, ModuleType | None]:
    """The operators' queries and the pipeline, which needs the operators."""
    operators = _module("fareweather.llm.queries")
    return operators, _module("corpus_pipeline") if operators else None


def _llm_queries() -> dict[str, Query]:
    operators, pipeline = _llm_modules()
    return {**(operators.QUERIES if operators else {}), **({"pipeline": pipeline.run} if pipeline else {})}


def _llm_oracles() -> dict[str, str]:
    operators, pipeline = _llm_modules()
    found = dict(operators.ORACLE_SQL) if operators else {}
    if pipeline and pipeline.ORACLE_SQL:
        found["pipeline"] = pipeline.ORACLE_SQL
    return found


def _with_session_defaults(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(use_session_defaults(spark), sf_dir)

    return run


# --- shared inputs ---------------------------------------------------------------------------


def _fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_trips(feeds.event_trips(spark, sf_dir))


def _totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_totals(_fact(spark, sf_dir))


def _lake_warehouse(spark: SparkSession) -> LakeWarehouse:
    return LakeWarehouse(spark, scratch_folder(spark, "warehouse"), f"fareweather_{uuid.uuid4().hex}")


def _loaded_warehouse(spark: SparkSession, sf_dir: str) -> LakeWarehouse:
    warehouse = _lake_warehouse(spark)
    warehouse.replace("fact_taxi_trips", _fact(spark, sf_dir))
    warehouse.replace("dim_weather", feeds.reported_weather(spark, sf_dir))
    return warehouse


def _jdbc_warehouse(spark: SparkSession) -> JdbcWarehouse:
    """The database named by `spark.fareweather.jdbc.*`.

    Where none is named, a local session uses Spark's bundled embedded database, which only its
    own process sees; a cluster needs the setting.
    """
    url = spark.conf.get("spark.fareweather.jdbc.url", None)
    if url is not None:
        names = ("driver", "user", "password")
        settings = {name: spark.conf.get(f"spark.fareweather.jdbc.{name}", None) for name in names}
        return JdbcWarehouse(spark, url, {name: value for name, value in settings.items() if value})
    if spark.sparkContext.master.partition("[")[0] != "local":
        raise RuntimeError("set spark.fareweather.jdbc.url to a database that all executors reach")
    return JdbcWarehouse(
        spark,
        f"jdbc:derby:memory:fareweather_{uuid.uuid4().hex};create=true",
        {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"},
    )


def _raw_months(spark: SparkSession, sf_dir: str) -> str:
    raw_root = scratch_folder(spark, "raw")
    feeds.write_raw_lines(spark, sf_dir, raw_root)
    return raw_root


def _monthly_lake(spark: SparkSession, sf_dir: str) -> str:
    lake = scratch_folder(spark, "lake")
    periods = feeds.trip_months(feeds.monthly_trips(spark, sf_dir))
    ingest_periods(spark, _raw_months(spark, sf_dir), lake, periods, feeds.SAMPLE_STEM)
    return lake


def _wall_clock(weather: DataFrame) -> DataFrame:
    return weather.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


def _names(df: DataFrame, column: str) -> Column:
    """The different texts of a column that has few of them, as an array; NULL is not listed."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return F.array(*[F.lit(row[0]) for row in found]).cast("array<string>")


def _rounded(df: DataFrame, spent_places: int = 4) -> DataFrame:
    """Sums of doubles depend on the order of addition; round away the digits it touches."""
    places = {"avg_trip_duration": 6, "avg_tip_percentage": 6, "total_spent": spent_places}
    return df.withColumns({name: F.round(name, n) for name, n in places.items() if name in df.columns})


# --- trips -----------------------------------------------------------------------------------


def trip_fact_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _fact(spark, sf_dir)


def trip_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    pickup, dropoff = F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime")
    return feeds.event_trips(spark, sf_dir, "event_id").select(
        "event_id", trip_duration(pickup, dropoff).alias("trip_duration")
    )


def distance_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.event_trips(spark, sf_dir, "event_id").select(
        "event_id", distance_category(F.col("trip_distance")).alias("distance_category")
    )


def tip_percentages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Over the monthly feed, whose returned goods have fares below zero."""
    percentage = tip_percentage(F.col("tip_amount"), F.col("fare_amount"))
    return feeds.monthly_trips(spark, sf_dir).select(
        "fare_amount", F.round("tip_amount", 4).alias("tip_amount"), F.round(percentage, 6).alias("tip_percentage")
    )


def pickup_hour_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    pickup = F.col("tpep_pickup_datetime")
    return feeds.event_trips(spark, sf_dir, "event_id").select(
        "event_id",
        hour_start(pickup).alias("pickup_hour_start"),
        hour_of_day(pickup).alias("pickup_hour"),
        weekday(pickup).alias("pickup_day"),
    )


# --- weather ---------------------------------------------------------------------------------


def weather_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = F.from_json("value", RAW_WEATHER.simpleString())
    raw = feeds.event_documents(spark, sf_dir).select(parsed.alias("raw")).select("raw.*")
    return _wall_clock(dim_weather(raw))


def weather_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    condition = F.col("weather_condition")
    return (
        feeds.event_observations(spark, sf_dir)
        .groupBy("weather_condition", weather_category(condition).alias("weather_category"))
        .agg(F.count(F.lit(1)).alias("observations"))
    )


def weather_hour_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        feeds.event_weather(spark, sf_dir)
        .groupBy("hour", "day_of_week")
        .agg(F.count(F.lit(1)).alias("observations"))
    )


# --- join and reports --------------------------------------------------------------------------


def trip_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich_trips(_fact(spark, sf_dir), feeds.reported_weather(spark, sf_dir))


def trip_enriched_in_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join as if weather were too large to broadcast and most hours too busy."""
    return enrich_trips(
        _fact(spark, sf_dir), feeds.reported_weather(spark, sf_dir), broadcast_limit=0, cell_rows=2
    )


def trip_enriched_busy_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All trips and all observations piled into the same fifty hours, summed up by hour and category."""
    first = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    zone_hour = F.make_dt_interval(hours=(F.col("PULocationID") % 50).cast("int"))
    humid_hour = F.make_dt_interval(hours=(F.col("humidity") % 50).cast("int"))
    trips = _fact(spark, sf_dir).withColumn("tpep_pickup_datetime", first + zone_hour)
    weather = feeds.event_weather(spark, sf_dir).withColumn("timestamp", (first + humid_hour).cast("timestamp"))
    names = _names(weather, "weather_category")
    # Every pair is looked up by its category, as a number in less than half the time it takes as text.
    weather = weather.withColumn("weather_category", F.array_position(names, F.col("weather_category")))
    joined = enrich_trips(trips, weather, broadcast_limit=0, cell_pairs=20_000)
    summed = joined.groupBy(F.col("tpep_pickup_datetime").alias("hour"), "weather_category").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("PULocationID").alias("zones"), F.max("temperature").alias("warmest")
    )
    return summed.withColumn("weather_category", F.get(names, (F.col("weather_category") - 1).cast("int")))


def trip_enriched_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the trips are copies of one trip; its hour is cut into cells that the copies fill evenly."""
    copied = F.col("PULocationID") % 3 == 0
    moment = F.when(copied, F.lit("2024-01-01 12:30:00").cast("timestamp_ntz")).otherwise(F.col("tpep_pickup_datetime"))
    trips = _fact(spark, sf_dir).select(
        moment.alias("tpep_pickup_datetime"), F.when(copied, F.lit(0)).otherwise(F.col("PULocationID")).alias("PULocationID")
    )
    joined = enrich_trips(trips, feeds.reported_weather(spark, sf_dir), broadcast_limit=0, cell_pairs=1_000)
    return joined.groupBy("weather_category").agg(
        F.count(F.lit(1)).alias("pairs"), F.sum("PULocationID").alias("zones"), F.max("temperature").alias("warmest")
    )


def trip_summary_per_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(trip_summary(_totals(spark, sf_dir), feeds.reported_weather(spark, sf_dir)))


def trip_summary_of_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(trip_summary_from_enriched(trip_enriched(spark, sf_dir)))


def positive_passengers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positive_passenger_trips(_fact(spark, sf_dir))


def passenger_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(passenger_stats(_totals(spark, sf_dir), feeds.reported_weather(spark, sf_dir)))


def passenger_statistics_of_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(passenger_stats_from_enriched(trip_enriched(spark, sf_dir)))


def high_value_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(high_value(passenger_stats(_totals(spark, sf_dir), feeds.reported_weather(spark, sf_dir))))


# --- views and tables --------------------------------------------------------------------------


def staging_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The views as another session of the catalog finds them."""
    warehouse = _loaded_warehouse(spark, sf_dir)
    build_models(warehouse, only=STAGING)
    other = use_session_defaults(spark.newSession())
    trips = other.table(f"{warehouse.database}.source_fact_taxi_trips").groupBy(F.col("pickup_hour").alias("hour"))
    weather = other.table(f"{warehouse.database}.source_dim_weather").groupBy("hour")
    return trips.agg(F.count(F.lit(1)).alias("trips")).join(
        weather.agg(F.count(F.lit(1)).alias("observations")), "hour", "full"
    )


def materialised_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _loaded_warehouse(spark, sf_dir)
    build_models(warehouse)
    return _rounded(read_model(warehouse, "trip_summary_per_hour"))


def selective_rebuild(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All models are built before any weather is known, then some again with weather."""
    warehouse = _lake_warehouse(spark)
    warehouse.replace("fact_taxi_trips", _fact(spark, sf_dir))
    warehouse.create_empty("dim_weather")
    build_models(warehouse)
    warehouse.replace("dim_weather", feeds.reported_weather(spark, sf_dir))
    build_models(warehouse, only=WEATHER_MODELS)

    def size(model: str, trips) -> DataFrame:
        return warehouse.table(model).agg(
            F.lit(model).alias("model"), F.count(F.lit(1)).alias("row_count"), trips.alias("trips")
        )

    return (
        size("trip_enriched", F.count(F.lit(1)))
        .union(size("trip_summary_per_hour", F.sum("trip_count")))
        .union(size("high_value_customers", F.sum("trip_count")))
    )


def sql_on_stored_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Models are catalog tables, so plain SQL reads them too."""
    warehouse = _loaded_warehouse(spark, sf_dir)
    build_models(warehouse, only=["trip_enriched"])
    return spark.sql(f"""
        WITH per_day AS (
            SELECT pickup_day, weather_category, count(*) AS trips, max(temperature) AS warmest
            FROM {warehouse.database}.trip_enriched
            GROUP BY 1, 2)
        SELECT * FROM per_day WHERE trips > 10 ORDER BY 1 NULLS LAST, 2 NULLS LAST""")


# --- monthly ingest ----------------------------------------------------------------------------


def _period_counts(spark: SparkSession, sf_dir: str, periods: DataFrame) -> DataFrame:
    shipped = feeds.table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").alias("day"))
    seen = feeds.table(spark, sf_dir, "events").select(F.col("ts").alias("day"))
    counts = (
        shipped.union(seen)
        .groupBy(F.year("day").alias("year"), F.month("day").alias("month"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return periods.join(counts, ["year", "month"], "left").fillna(0, ["rows"])


def period_enumeration(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every published month of the years seen in the feeds, with the rows it holds."""
    return _period_counts(spark, sf_dir, enumerate_periods(feeds.trip_years(spark, sf_dir)))


def period_cross_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _period_counts(spark, sf_dir, enumerate_periods(feeds.trip_years(spark, sf_dir), months=[1, 6, 12]))


def period_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The months a run takes by default, with the rows the feeds hold for them."""
    return _period_counts(spark, sf_dir, spark.createDataFrame(default_periods(spark), "year INT, month INT"))


def lake_ingest_by_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        read_lake(spark, _monthly_lake(spark, sf_dir))
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("trips"), F.round(F.sum("total_amount"), 4).alias("total_spent"))
    )


def period_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact rows of three chosen months."""
    lake = _monthly_lake(spark, sf_dir)
    chosen = fact_trips(read_lake(spark, lake, [(1996, 3), (1997, 11), (1997, 12)]))
    return chosen.withColumns({name: F.round(name, 4) for name in ("tip_amount", "total_amount")}).withColumn(
        "tip_percentage", F.round("tip_percentage", 6)
    )


def schema_drift_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Even months carry whole-number passengers, fractional payment types and one column more."""
    trips = feeds.monthly_trips(spark, sf_dir)
    is_even = F.month("tpep_pickup_datetime") % 2 == 0
    drifted = trips.withColumns(
        {
            "passenger_count": F.col("passenger_count").cast("bigint"),
            "payment_type": F.col("payment_type").cast("double"),
            "airport_fee": F.lit(1.25),
        }
    )
    raw_root, lake = scratch_folder(spark, "raw"), scratch_folder(spark, "lake")
    feeds.write_raw_months(trips.where(~is_even), raw_root)
    feeds.write_raw_months(drifted.where(is_even), raw_root)
    ingest_periods(spark, raw_root, lake, feeds.trip_months(trips), feeds.SAMPLE_STEM)
    return (
        read_lake(spark, lake)
        .groupBy("passenger_count", "payment_type")
        .agg(F.count(F.lit(1)).alias("trips"), F.countDistinct("year", "month").alias("months"))
    )


def ingest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good months, one file that is not Parquet (2002-01) and one that is missing (2002-02)."""
    raw_root, lake = _raw_months(spark, sf_dir), scratch_folder(spark, "lake")
    page = spark.createDataFrame([("<Error>AccessDenied</Error>",)], "value STRING")
    page.write.text(month_path(raw_root, (2002, 1), feeds.SAMPLE_STEM))
    periods = feeds.trip_months(feeds.monthly_trips(spark, sf_dir)) + [(2002, 1), (2002, 2)]
    status = ingest_periods(spark, raw_root, lake, periods, feeds.SAMPLE_STEM)
    return status.select("year", "month", "ok", "rows", F.col("error").isNotNull().alias("has_error"))


# --- weather landing and stream ----------------------------------------------------------------


def _waves(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The documents in two parts, each in several files."""
    documents = feeds.event_documents(spark, sf_dir).repartition(WAVE_FILES, "value")
    is_array = F.col("value").contains('"weather":[')
    return [documents.where(is_array), documents.where(~is_array)]


def _stream_in_two_waves(spark: SparkSession, sf_dir: str, warehouse, between: Callable[[], None] | None = None) -> None:
    """Several micro-batches a wave; files that have been read move out of the landing folder."""
    landing, checkpoint = scratch_folder(spark, "landing"), scratch_folder(spark, "checkpoint")
    options = {"files_per_batch": WAVE_FILES // 2, "archive": scratch_folder(spark, "archive")}
    for wave in _waves(spark, sf_dir):
        land_payloads(wave, landing)
        run_weather_stream(spark, landing, warehouse, checkpoint, **options)
        if between:
            between()
    run_weather_stream(spark, landing, warehouse, checkpoint, **options)  # nothing new: adds nothing


def weather_json_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with line breaks in them, null payloads and blank ones: each ends up in one table."""
    warehouse, landing = _lake_warehouse(spark), scratch_folder(spark, "landing")
    documents = feeds.event_documents(spark, sf_dir).withColumn("value", F.regexp_replace("value", ",", ",\n"))
    failed = feeds.undated_documents(spark, sf_dir)
    empty = F.when(F.col("value").contains("cod"), F.lit(" \n\t"))
    land_payloads(documents.union(failed.select(empty)), landing)
    run_weather_stream(spark, landing, warehouse, scratch_folder(spark, "checkpoint"))
    observed = _wall_clock(warehouse.table("dim_weather"))
    set_aside = warehouse.table("weather_quarantine").select(F.col("record").alias("weather_category"))
    return observed.unionByName(set_aside, allowMissingColumns=True)


def weather_two_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landing folders, each with its own checkpoint, into one warehouse."""
    warehouse = _lake_warehouse(spark)
    for wave in _waves(spark, sf_dir):
        landing = scratch_folder(spark, "landing")
        land_payloads(wave, landing)
        run_weather_stream(spark, landing, warehouse, scratch_folder(spark, "checkpoint"))
    return _wall_clock(warehouse.table("dim_weather"))


def weather_backfill_then_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One part is written as a whole table, the other is streamed to it."""
    warehouse, landing = _lake_warehouse(spark), scratch_folder(spark, "landing")
    old, new = _waves(spark, sf_dir)
    parsed = old.select(F.from_json("value", RAW_WEATHER.simpleString()).alias("raw")).select("raw.*")
    warehouse.replace("dim_weather", dim_weather(parsed))
    land_payloads(new, landing)
    run_weather_stream(spark, landing, warehouse, scratch_folder(spark, "checkpoint"))
    return _wall_clock(warehouse.table("dim_weather"))


def weather_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Older batches are merged after each wave."""
    warehouse = _lake_warehouse(spark)
    _stream_in_two_waves(spark, sf_dir, warehouse, lambda: warehouse.compact("dim_weather"))
    return _wall_clock(warehouse.table("dim_weather"))


def weather_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse = _lake_warehouse(spark)
    _stream_in_two_waves(spark, sf_dir, warehouse)
    return _wall_clock(warehouse.table("dim_weather"))


def weather_stream_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last batches are handed to the sink once more, as after a crash before the commit."""
    warehouse = _lake_warehouse(spark)
    _stream_in_two_waves(spark, sf_dir, warehouse)
    stored = warehouse.with_batches("dim_weather").checkpoint()
    last = F.max_by(F.struct("stream_id", "batch_id"), "batch_id").alias("last")
    for row in stored.groupBy("stream_id").agg(last).collect():  # one stream
        stream_id, batch_id = row["last"]
        own = stored.where((F.col("stream_id") == stream_id) & (F.col("batch_id") == batch_id))
        warehouse.append_batch("dim_weather", own.drop("stream_id", "batch_id"), batch_id, stream_id)
    return _wall_clock(warehouse.table("dim_weather"))


def weather_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    warehouse, landing = _lake_warehouse(spark), scratch_folder(spark, "landing")
    documents = feeds.event_documents(spark, sf_dir).union(feeds.undated_documents(spark, sf_dir))
    land_payloads(documents, landing)
    run_weather_stream(spark, landing, warehouse, scratch_folder(spark, "checkpoint"))
    dated = warehouse.table("dim_weather").select(F.lit("dim_weather").alias("destination"))
    undated = warehouse.table("weather_quarantine").select(F.lit("weather_quarantine").alias("destination"))
    return dated.union(undated).groupBy("destination").agg(F.count(F.lit(1)).alias("documents"))


# --- JDBC --------------------------------------------------------------------------------------


def jdbc_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice; the second write replaces the first."""
    warehouse = _jdbc_warehouse(spark)
    for _ in range(2):
        warehouse.replace("fact_taxi_trips", _fact(spark, sf_dir))
    return warehouse.table("fact_taxi_trips")


def jdbc_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two micro-batches, of which the first arrives twice."""
    warehouse = _jdbc_warehouse(spark)
    weather = feeds.event_weather(spark, sf_dir)
    rainy = F.col("weather_category") == "Rainy"
    for batch_id, part in ((0, rainy), (1, ~rainy), (0, rainy)):
        warehouse.append_batch("dim_weather", weather.where(part), batch_id)
    return _wall_clock(warehouse.table("dim_weather"))


def jdbc_month_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One month of three is emptied in the database and filled again from the lake; the others stay."""
    warehouse, months = _jdbc_warehouse(spark), [(1996, 3), (1997, 11), (1997, 12)]
    trips = fact_trips(read_lake(spark, _monthly_lake(spark, sf_dir), months), "year", "month")
    warehouse.replace("fact_taxi_trips", trips)
    for part in (trips.where("false"), trips):
        warehouse.replace_months("fact_taxi_trips", part, months[1:2])
    return _by_month(warehouse)


def _by_month(warehouse) -> DataFrame:
    return (
        warehouse.all_months("fact_taxi_trips")
        .groupBy("year", "month")
        .agg(F.count(F.lit(1)).alias("trips"), F.round(F.sum("total_amount"), 2).alias("total_spent"))
    )


# --- end to end --------------------------------------------------------------------------------


def _flow_config(spark: SparkSession, sf_dir: str) -> FlowConfig:
    return FlowConfig(
        warehouse=_lake_warehouse(spark),
        raw_trips=_raw_months(spark, sf_dir),
        trip_lake=scratch_folder(spark, "lake"),
        weather_landing=scratch_folder(spark, "landing"),
        weather_checkpoint=scratch_folder(spark, "checkpoint"),
        file_stem=feeds.SAMPLE_STEM,
    )


def fact_month_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three months are loaded, one of them in part; then that one is replaced and the others stay."""
    config, months = _flow_config(spark, sf_dir), [(1996, 3), (1997, 11), (1997, 12)]
    run_trip_batch(spark, config, months, models=())
    config.warehouse.replace_months(
        "fact_taxi_trips", config.warehouse.table("fact_taxi_trips", months[1:2]).where("fare_amount < 0").checkpoint(), months[1:2]
    )
    run_trip_batch(spark, config, months[1:2], transform_periods=months[1:2], models=())
    return _by_month(config.warehouse)


def months_under_a_reader(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A frame opened before months are replaced, read after it, and the table as it is then."""
    warehouse, months = _lake_warehouse(spark), [(1996, 3), (1997, 11), (1997, 12)]
    trips = fact_trips(read_lake(spark, _monthly_lake(spark, sf_dir), months), "year", "month")
    warehouse.replace("fact_taxi_trips", trips)
    opened = warehouse.all_months("fact_taxi_trips")
    warehouse.replace_months("fact_taxi_trips", trips.where("fare_amount < 0"), months[1:])
    both = [frame.withColumn("opened", F.lit(when)) for frame, when in ((opened, "before"), (warehouse.all_months("fact_taxi_trips"), "after"))]
    return both[0].unionByName(both[1]).groupBy("opened", "year", "month").agg(F.count(F.lit(1)).alias("trips"))


def trip_totals_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by landed month, two months of which were replaced after the others were summed."""
    config, months = _flow_config(spark, sf_dir), feeds.trip_months(feeds.monthly_trips(spark, sf_dir))
    run_trip_batch(spark, config, months[2:], models=())
    stored_totals(config.warehouse)
    run_trip_batch(spark, config, months[:2], transform_periods=months[:2], models=())
    totals = stored_totals(config.warehouse)
    sums = [F.sum(name).alias(name) for name in ("trips", "seconds", "timed_trips", "tipped_trips")]
    return totals.groupBy(hour_from_key(F.col("hour_key")).alias("hour"), "passenger_count").agg(
        *sums, F.round(F.sum("spent"), 4).alias("spent")
    )


def weather_stepwise_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined table after weather came in two parts; the second one rebuilds its months alone."""
    config, documents = _flow_config(spark, sf_dir), feeds.order_documents(spark, sf_dir)
    first = F.pmod(F.xxhash64("value"), F.lit(2)) == 0
    run_weather_batch(spark, config, documents.where(first), models=())
    run_trip_batch(spark, config, feeds.trip_months(feeds.monthly_trips(spark, sf_dir)))
    run_weather_batch(spark, config, documents.where(~first))
    return (
        config.warehouse.table("trip_enriched")
        .groupBy("weather_category", "pickup_hour")
        .agg(F.count(F.lit(1)).alias("trips"), F.round(F.sum("total_amount"), 4).alias("total_spent"))
    )


def trip_batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _flow_config(spark, sf_dir)
    run_weather_batch(spark, config, feeds.order_documents(spark, sf_dir), models=())
    run_trip_batch(spark, config, feeds.trip_months(feeds.monthly_trips(spark, sf_dir)))
    return _rounded(read_model(config.warehouse, "high_value_customers"), spent_places=2)


def weather_batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = _flow_config(spark, sf_dir)
    config.warehouse.create_empty("dim_weather")
    run_trip_batch(spark, config, feeds.trip_months(feeds.monthly_trips(spark, sf_dir)), models=())
    run_weather_batch(spark, config, feeds.order_documents(spark, sf_dir), models=WEATHER_MODELS)
    return _rounded(read_model(config.warehouse, "trip_summary_per_hour"))


QUERIES: dict[str, Query] = {
    "trip_fact_projection": trip_fact_projection,
    "trip_duration": trip_durations,
    "distance_category": distance_categories,
    "tip_percentage": tip_percentages,
    "pickup_hour_day": pickup_hour_day,
    "weather_flatten": weather_flatten,
    "weather_category": weather_categories,
    "weather_hour_day": weather_hour_day,
    "trip_enriched": trip_enriched,
    "trip_enriched_in_cells": trip_enriched_in_cells,
    "trip_enriched_busy_hours": trip_enriched_busy_hours,
    "trip_enriched_copies": trip_enriched_copies,
    "trip_summary_per_hour": trip_summary_per_hour,
    "trip_summary_of_enriched": trip_summary_of_enriched,
    "positive_passenger_trips": positive_passengers,
    "passenger_stats": passenger_statistics,
    "passenger_stats_of_enriched": passenger_statistics_of_enriched,
    "high_value_customers": high_value_customers,
    "staging_views": staging_views,
    "materialised_models": materialised_models,
    "selective_rebuild": selective_rebuild,
    "sql_on_stored_models": sql_on_stored_models,
    "period_enumeration": period_enumeration,
    "period_cross_months": period_cross_months,
    "period_defaults": period_defaults,
    "lake_ingest_by_period": lake_ingest_by_period,
    "period_selection": period_selection,
    "schema_drift_union": schema_drift_union,
    "ingest_status": ingest_status,
    "weather_json_landing": weather_json_landing,
    "weather_stream": weather_stream,
    "weather_stream_idempotent": weather_stream_idempotent,
    "weather_two_streams": weather_two_streams,
    "weather_backfill_then_stream": weather_backfill_then_stream,
    "weather_compacted": weather_compacted,
    "weather_quarantine": weather_quarantine,
    "jdbc_overwrite": jdbc_overwrite,
    "jdbc_append": jdbc_append,
    "jdbc_month_replaced": jdbc_month_replaced,
    "fact_month_replaced": fact_month_replaced,
    "months_under_a_reader": months_under_a_reader,
    "trip_totals_stored": trip_totals_stored,
    "trip_batch_run": trip_batch_run,
    "weather_batch_run": weather_batch_run,
    "weather_stepwise_run": weather_stepwise_run,
}


# --- SQL for the comparison ----------------------------------------------------------------------

K = "CAST(regexp_extract(props, '[0-9]+') AS INTEGER)"

EVENT_TRIPS = f"""
    SELECT event_id,
           ts AS tpep_pickup_datetime,
           ts + {K} * INTERVAL 1 MINUTE AS tpep_dropoff_datetime,
           CAST({K} AS DOUBLE) / 10 AS trip_distance,
           value AS fare_amount,
           value * ((event_id % 7) * 6) / 100 AS tip_amount,
           value + value * ((event_id % 7) * 6) / 100 AS total_amount,
           CAST(event_id % 7 AS DOUBLE) AS passenger_count,
           user_id % 6 + 1 AS payment_type,
           user_id AS "PULocationID",
           (user_id * 7 + event_id) % 265 AS "DOLocationID"
    FROM events"""

MINUTE = "CAST((l_orderkey * 37 + l_partkey * 11 + l_linenumber) % 1440 AS INTEGER)"
FARE = "CASE WHEN l_returnflag = 'R' THEN -l_extendedprice ELSE l_extendedprice END"
TIP = "l_extendedprice * l_discount * l_linenumber"

MONTHLY_TRIPS = f"""
    SELECT l_shipdate + {MINUTE} * INTERVAL 1 MINUTE AS tpep_pickup_datetime,
           l_shipdate + ({MINUTE} + CAST(l_quantity * 2 - 10 AS INTEGER)) * INTERVAL 1 MINUTE
               AS tpep_dropoff_datetime,
           l_quantity / 8 AS trip_distance,
           {FARE} AS fare_amount,
           {TIP} AS tip_amount,
           {FARE} + {TIP} AS total_amount,
           CAST(l_linenumber - 1 AS DOUBLE) AS passenger_count,
           l_suppkey % 6 + 1 AS payment_type,
           l_suppkey AS "PULocationID",
           l_partkey AS "DOLocationID"
    FROM lineitem"""

FACT_COLUMNS = """
           tpep_pickup_datetime,
           tpep_dropoff_datetime,
           CAST(epoch(date_trunc('second', tpep_dropoff_datetime)) AS BIGINT)
               - CAST(epoch(date_trunc('second', tpep_pickup_datetime)) AS BIGINT) AS trip_duration,
           CASE WHEN trip_distance >= 5 THEN '>5 km'
                WHEN trip_distance >= 2 THEN '2-5 km'
                ELSE '0-2 km' END AS distance_category,
           payment_type,
           CASE WHEN fare_amount > 0 THEN tip_amount / fare_amount * 100 ELSE 0.0 END AS tip_percentage,
           CAST(extract(hour FROM tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
           CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_day,
           "PULocationID",
           "DOLocationID",
           fare_amount,
           tip_amount,
           total_amount,
           passenger_count"""

CONDITION = f"""CASE {K} % 5 WHEN 0 THEN 'Rain' WHEN 1 THEN 'Clouds'
                WHEN 2 THEN 'Clear' WHEN 3 THEN 'Snow' END"""
CATEGORY = f"CASE {K} % 5 WHEN 0 THEN 'Rainy' WHEN 1 THEN 'Cloudy' WHEN 2 THEN 'Clear' ELSE 'Other' END"


def _event_weather(moment: str) -> str:
    return f"""
    SELECT {moment} AS "timestamp",
           value AS temperature,
           CAST({K} AS DOUBLE) AS humidity,
           CAST({K} AS DOUBLE) / 5 AS wind_speed,
           {CONDITION} AS weather_condition,
           {CATEGORY} AS weather_category,
           CAST(extract(hour FROM ts) AS INTEGER) AS hour,
           CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week
    FROM events WHERE event_type NOT IN ('error', 'signup')"""


REPORTED_WEATHER = f"""
    SELECT min(ts) AS "timestamp",
           max(value) AS temperature,
           CAST(max({K}) AS DOUBLE) AS humidity,
           CAST(min({K}) AS DOUBLE) / 5 AS wind_speed,
           CASE sum({K}) % 5 WHEN 0 THEN 'Rainy' WHEN 1 THEN 'Cloudy' WHEN 2 THEN 'Clear' ELSE 'Other' END
               AS weather_category
    FROM events WHERE event_type NOT IN ('error', 'signup')
    GROUP BY floor(epoch(ts) / 1200)"""

ORDER_HOUR = "o_orderdate + CAST(o_orderkey % 24 AS INTEGER) * INTERVAL 1 HOUR"

ORDER_WEATHER = f"""
    SELECT {ORDER_HOUR} AS "timestamp",
           CASE sum(o_custkey) % 5 WHEN 0 THEN 'Rainy' WHEN 1 THEN 'Cloudy' WHEN 2 THEN 'Clear' ELSE 'Other' END
               AS weather_category
    FROM orders GROUP BY {ORDER_HOUR}, o_orderstatus"""


def _models(trips: str, weather: str, weather_columns: str) -> str:
    return f"""
WITH fact AS (SELECT {FACT_COLUMNS} FROM ({trips}) AS raw),
     weather AS ({weather}),
     enriched AS (
         SELECT fact.*, {weather_columns}
         FROM fact LEFT JOIN weather AS w
           ON date_trunc('hour', w."timestamp") = date_trunc('hour', fact.tpep_pickup_datetime))"""


SUMMARY_QUERY = """
SELECT date_trunc('hour', tpep_pickup_datetime) AS hour,
       weather_category,
       count(*) AS trip_count,
       round(avg(trip_duration), 6) AS avg_trip_duration,
       round(avg(tip_percentage), 6) AS avg_tip_percentage
FROM enriched
GROUP BY date_trunc('hour', tpep_pickup_datetime), weather_category"""

STATS_QUERY = """
SELECT passenger_count,
       count(*) AS trip_count,
       round(sum(total_amount), {places}) AS total_spent,
       round(avg(tip_percentage), 6) AS avg_tip_percentage
FROM {table}
WHERE passenger_count > 0
GROUP BY passenger_count"""

HIGH_VALUE_LIMITS = """
HAVING count(*) > 10 AND sum(total_amount) > 300 AND avg(tip_percentage) > 15"""


def oracle_sql() -> dict[str, str]:
    return {**_engine_oracles(), **_llm_oracles()}


def _engine_oracles() -> dict[str, str]:
    fact = f"SELECT {FACT_COLUMNS} FROM ({EVENT_TRIPS}) AS raw"
    streamed_weather = _event_weather("date_trunc('second', ts)")
    event_models = _models(
        EVENT_TRIPS, REPORTED_WEATHER, "w.temperature, w.humidity, w.wind_speed, w.weather_category"
    )
    monthly_models = _models(MONTHLY_TRIPS, ORDER_WEATHER, "w.weather_category")
    enriched = event_models + "\nSELECT * FROM enriched"
    summary = event_models + SUMMARY_QUERY
    stats = event_models + STATS_QUERY.format(table="enriched", places=4)
    month = "CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, CAST(month(tpep_pickup_datetime) AS INTEGER) AS month"
    three_months = f"""
SELECT {month}, count(*) AS trips, round(sum(total_amount), 2) AS total_spent
FROM ({MONTHLY_TRIPS}) AS raw
WHERE (year(tpep_pickup_datetime), month(tpep_pickup_datetime)) IN ((1996, 3), (1997, 11), (1997, 12))
GROUP BY 1, 2"""
    period_counts = """
feed AS (SELECT l_shipdate AS day FROM lineitem UNION ALL SELECT ts AS day FROM events),
years AS (SELECT DISTINCT CAST(year(day) AS INTEGER) AS year FROM feed),
counts AS (SELECT CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month, count(*) AS n
           FROM feed GROUP BY 1, 2),
months AS (SELECT CAST(m AS INTEGER) AS month FROM generate_series(1, 12) AS g(m))
SELECT years.year, months.month, coalesce(counts.n, 0) AS rows
FROM years JOIN months ON {condition}
LEFT JOIN counts ON counts.year = years.year AND counts.month = months.month"""
    return {
        "trip_fact_projection": fact,
        "trip_duration": f"SELECT event_id, CAST({K} * 60 AS BIGINT) AS trip_duration FROM events",
        "distance_category": f"""
SELECT event_id, CASE WHEN {K} >= 50 THEN '>5 km' WHEN {K} >= 20 THEN '2-5 km' ELSE '0-2 km' END
       AS distance_category FROM events""",
        "tip_percentage": f"""
SELECT {FARE} AS fare_amount, round({TIP}, 4) AS tip_amount,
       CASE WHEN l_returnflag <> 'R' AND l_extendedprice > 0 THEN round(l_discount * l_linenumber * 100, 6) ELSE 0.0 END
           AS tip_percentage
FROM lineitem""",
        "pickup_hour_day": """
SELECT event_id, date_trunc('hour', ts) AS pickup_hour_start,
       CAST(extract(hour FROM ts) AS INTEGER) AS pickup_hour,
       CAST(dayofweek(ts) + 1 AS INTEGER) AS pickup_day
FROM events""",
        "weather_flatten": streamed_weather,
        "weather_category": f"""
SELECT {CONDITION} AS weather_condition, {CATEGORY} AS weather_category, count(*) AS observations
FROM events WHERE event_type NOT IN ('error', 'signup') GROUP BY 1, 2""",
        "weather_hour_day": """
SELECT CAST(extract(hour FROM ts) AS INTEGER) AS hour, CAST(dayofweek(ts) + 1 AS INTEGER) AS day_of_week,
       count(*) AS observations
FROM events WHERE event_type NOT IN ('error', 'signup') GROUP BY 1, 2""",
        "trip_enriched": enriched,
        "trip_enriched_in_cells": enriched,
        "trip_enriched_busy_hours": f"""
WITH trips AS (SELECT CAST("PULocationID" % 50 AS INTEGER) AS h, "PULocationID" AS zone FROM ({EVENT_TRIPS}) AS t),
     weather AS (SELECT CAST({K} % 50 AS INTEGER) AS h, {CATEGORY} AS weather_category, value AS temperature
                 FROM events WHERE event_type NOT IN ('error', 'signup')),
     zones AS (SELECT h, count(*) AS n, sum(zone) AS zones FROM trips GROUP BY 1),
     readings AS (SELECT h, weather_category, count(*) AS n, max(temperature) AS warmest FROM weather GROUP BY 1, 2)
SELECT TIMESTAMP '2024-01-01 00:00:00' + z.h * INTERVAL 1 HOUR AS hour, weather_category,
       CAST(z.n * coalesce(r.n, 1) AS BIGINT) AS pairs, CAST(zones * coalesce(r.n, 1) AS BIGINT) AS zones, warmest
FROM zones AS z LEFT JOIN readings AS r ON z.h = r.h""",
        "trip_enriched_copies": f"""
WITH trips AS (SELECT CASE WHEN "PULocationID" % 3 = 0 THEN TIMESTAMP '2024-01-01 12:30:00' ELSE tpep_pickup_datetime END AS moment,
                      CASE WHEN "PULocationID" % 3 = 0 THEN 0 ELSE "PULocationID" END AS zone
               FROM ({EVENT_TRIPS}) AS t),
     weather AS ({REPORTED_WEATHER})
SELECT weather_category, count(*) AS pairs, CAST(sum(zone) AS BIGINT) AS zones, max(temperature) AS warmest
FROM trips LEFT JOIN weather AS w ON date_trunc('hour', w."timestamp") = date_trunc('hour', moment)
GROUP BY weather_category""",
        "trip_summary_per_hour": summary,
        "trip_summary_of_enriched": summary,
        "positive_passenger_trips": f"SELECT * FROM ({fact}) AS fact WHERE passenger_count > 0",
        "passenger_stats": stats,
        "passenger_stats_of_enriched": stats,
        "high_value_customers": stats + HIGH_VALUE_LIMITS,
        "staging_views": f"""
SELECT coalesce(t.hour, w.hour) AS hour, trips, observations
FROM (SELECT CAST(extract(hour FROM ts) AS INTEGER) AS hour, count(*) AS trips FROM events GROUP BY 1) AS t
FULL JOIN (SELECT CAST(extract(hour FROM "timestamp") AS INTEGER) AS hour, count(*) AS observations
           FROM ({REPORTED_WEATHER}) AS r GROUP BY 1) AS w ON t.hour = w.hour""",
        "materialised_models": summary,
        "selective_rebuild": event_models
        + f""",
summary AS ({SUMMARY_QUERY}),
stale AS ({STATS_QUERY.format(table="fact", places=4)} {HIGH_VALUE_LIMITS})
SELECT 'trip_enriched' AS model, count(*) AS row_count, count(*) AS trips FROM enriched
UNION ALL SELECT 'trip_summary_per_hour', count(*), CAST(sum(trip_count) AS BIGINT) FROM summary
UNION ALL SELECT 'high_value_customers', count(*), CAST(sum(trip_count) AS BIGINT) FROM stale""",
        "sql_on_stored_models": event_models
        + """
SELECT pickup_day, weather_category, count(*) AS trips, max(temperature) AS warmest
FROM enriched GROUP BY pickup_day, weather_category HAVING count(*) > 10""",
        "period_enumeration": "WITH"
        + period_counts.format(condition="true"),
        "period_cross_months": "WITH" + period_counts.format(condition="months.month IN (1, 6, 12)"),
        "period_defaults": "WITH"
        + period_counts.replace(
            "SELECT DISTINCT CAST(year(day) AS INTEGER) AS year FROM feed",
            "SELECT CAST(y AS INTEGER) AS year FROM generate_series(2022, 2024) AS g(y)",
        ).format(condition="(years.year <> 2024 OR months.month <= 4)"),
        "lake_ingest_by_period": f"""
SELECT {month}, count(*) AS trips, round(sum(total_amount), 4) AS total_spent
FROM ({MONTHLY_TRIPS}) AS raw GROUP BY 1, 2""",
        "period_selection": f"""
SELECT * REPLACE (round(tip_amount, 4) AS tip_amount, round(total_amount, 4) AS total_amount,
                  round(tip_percentage, 6) AS tip_percentage)
FROM (SELECT {FACT_COLUMNS} FROM ({MONTHLY_TRIPS}) AS raw) AS fact
WHERE date_trunc('month', tpep_pickup_datetime) IN
      (TIMESTAMP '1996-03-01', TIMESTAMP '1997-11-01', TIMESTAMP '1997-12-01')""",
        "schema_drift_union": f"""
SELECT passenger_count, payment_type, count(*) AS trips,
       count(DISTINCT date_trunc('month', tpep_pickup_datetime)) AS months
FROM ({MONTHLY_TRIPS}) AS raw GROUP BY 1, 2""",
        "ingest_status": f"""
SELECT {month}, true AS ok, count(*) AS rows, false AS has_error FROM ({MONTHLY_TRIPS}) AS raw GROUP BY 1, 2
UNION ALL SELECT 2002, 1, false, NULL, true
UNION ALL SELECT 2002, 2, false, NULL, true""",
        "weather_json_landing": streamed_weather
        + """
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, '{"message":"empty payload"}', NULL, NULL
FROM events WHERE event_type IN ('error', 'signup')""",
        "weather_two_streams": streamed_weather,
        "weather_backfill_then_stream": streamed_weather,
        "weather_compacted": streamed_weather,
        "weather_stream": streamed_weather,
        "weather_stream_idempotent": streamed_weather,
        "weather_quarantine": """
SELECT CASE WHEN event_type IN ('error', 'signup') THEN 'weather_quarantine' ELSE 'dim_weather' END AS destination,
       count(*) AS documents
FROM events GROUP BY 1""",
        "jdbc_overwrite": fact,
        "jdbc_append": _event_weather("ts"),
        "jdbc_month_replaced": three_months,
        "fact_month_replaced": three_months,
        "months_under_a_reader": f"""
SELECT opened, {month}, count(*) AS trips
FROM ({MONTHLY_TRIPS}) AS raw, (VALUES ('before'), ('after')) AS frames(opened)
WHERE (year(tpep_pickup_datetime), month(tpep_pickup_datetime)) IN ((1996, 3), (1997, 11), (1997, 12))
  AND (opened = 'before' OR month(tpep_pickup_datetime) = 3 OR fare_amount < 0)
GROUP BY ALL""",
        "trip_totals_stored": f"""
SELECT date_trunc('hour', tpep_pickup_datetime) AS hour, passenger_count, count(*) AS trips,
       CAST(sum(trip_duration) AS BIGINT) AS seconds, count(trip_duration) AS timed_trips,
       count(tip_percentage) AS tipped_trips, round(sum(total_amount), 4) AS spent
FROM (SELECT {FACT_COLUMNS} FROM ({MONTHLY_TRIPS}) AS raw) AS fact GROUP BY 1, 2""",
        "weather_stepwise_run": monthly_models
        + """
SELECT weather_category, pickup_hour, count(*) AS trips, round(sum(total_amount), 4) AS total_spent
FROM enriched GROUP BY weather_category, pickup_hour""",
        "trip_batch_run": monthly_models + STATS_QUERY.format(table="enriched", places=2) + HIGH_VALUE_LIMITS,
        "weather_batch_run": monthly_models + SUMMARY_QUERY,
    }
