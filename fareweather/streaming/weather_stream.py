"""Weather documents from the landing folder into the warehouse, one finite run at a time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from fareweather.functions.clock import DAY_SECONDS
from fareweather.functions.weather import dim_weather
from fareweather.schemas import RAW_WEATHER, TEXT, struct
from fareweather.session import object_store_path

CORRUPT_COLUMN = "_corrupt_record"
# Fixed value: where Spark keeps the id of the stream that a job belongs to.
QUERY_ID = "sql.streaming.queryId"
# What the weather service answers instead of an observation.
ERROR_PAYLOAD = struct(cod=TEXT, message=TEXT)
STREAM_SCHEMA = StructType([*RAW_WEATHER.fields, *ERROR_PAYLOAD.fields]).add(CORRUPT_COLUMN, TEXT)

# Bounds one micro-batch, and with it the file list the driver plans, when much has piled up.
FILES_PER_BATCH = 100_000

# So many landed files are read by a few tasks, and so written to a few files, anyway.
FEW_FILES = 64


def weather_source(
    spark: SparkSession, landing: str, files_per_batch: int = FILES_PER_BATCH, archive: str | None = None
) -> DataFrame:
    """Unbounded table of raw observations with the file each came from.

    With `archive` files move there some time after their batch is done, so that the landing
    folder, which is listed for each batch, doesn't grow for ever.
    """
    reader = (
        spark.readStream.schema(STREAM_SCHEMA)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .option("maxFilesPerTrigger", files_per_batch)
    )
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", object_store_path(archive))
    return (
        reader.json(object_store_path(landing))
        .select("*", F.col("_metadata.file_path").alias("source_file"))
    )


def start_weather_stream(
    spark: SparkSession,
    landing: str,
    warehouse,
    checkpoint: str,
    keep_undated: bool = False,
    files_per_batch: int = FILES_PER_BATCH,
    keep_running: bool = False,
    archive: str | None = None,
    seen: set[tuple[int, int]] | None = None,
) -> StreamingQuery:
    """Process everything landed since the last run of the same checkpoint, then stop.

    With `keep_running` the query goes on looking for new files until the caller stops it.
    Documents without an observation time (error payloads, broken JSON) go to
    `weather_quarantine`; `keep_undated` passes them on as rows of NULLs instead. A batch that is
    run again after a failure replaces what it wrote before; it is told from others by its number
    and by the id that Spark keeps in the checkpoint, which a new checkpoint doesn't share. The
    calendar months of the observations are added to `seen`.
    """
    warehouse.create_empty("dim_weather")
    warehouse.create_empty("weather_quarantine")

    def sized(rows: DataFrame) -> DataFrame:
        """Rows exchanged once so that files get a fit size, unless the batch is too small to make many."""
        return rows.hint("rebalance") if files_per_batch > FEW_FILES else rows

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty(QUERY_ID) or "stream"
        dated = F.lit(True) if keep_undated else F.col("dt").isNotNull()
        # One pass: what else there is to know is counted while the rows are written.
        noticed = Observation()
        watched = batch.observe(noticed, F.count_if(~dated).alias("undated"), F.collect_set(_month()).alias("months"))
        warehouse.append_batch("dim_weather", sized(dim_weather(watched.where(dated))), batch_id, stream_id)
        if noticed.get["undated"]:
            warehouse.append_batch("weather_quarantine", sized(quarantine_rows(batch.where(~dated))), batch_id, stream_id)
            warehouse.publish("weather_quarantine")
        if seen is not None:
            seen.update((month // 12, month % 12 + 1) for month in noticed.get["months"])

    writer = (
        weather_source(spark, landing, files_per_batch, archive)
        .writeStream.foreachBatch(write_batch)
        .outputMode("append")
        .option("checkpointLocation", object_store_path(checkpoint))
    )
    return (writer if keep_running else writer.trigger(availableNow=True)).start()


def run_weather_stream(
    spark: SparkSession, landing: str, warehouse, checkpoint: str, **options
) -> list[tuple[int, int]]:
    """Start the stream, wait for its end and return the months seen; a failed batch raises here."""
    seen: set[tuple[int, int]] = set()
    start_weather_stream(spark, landing, warehouse, checkpoint, seen=seen, **options).awaitTermination()
    if seen or options.get("keep_undated"):
        warehouse.publish("dim_weather")
    return sorted(seen)


def _month() -> Column:
    """The calendar month of an observation in UTC, numbered from January of the year 0."""
    day = F.date_from_unix_date(F.floor(F.col("dt") / DAY_SECONDS).cast("int"))
    return F.year(day) * 12 + F.month(day) - 1


def quarantine_rows(undated: DataFrame) -> DataFrame:
    """The source file, and the broken text or the fields that were understood."""
    parsed = F.to_json(F.struct(*RAW_WEATHER.fieldNames(), *ERROR_PAYLOAD.fieldNames()))
    return undated.select("source_file", F.coalesce(CORRUPT_COLUMN, parsed).alias("record"))
