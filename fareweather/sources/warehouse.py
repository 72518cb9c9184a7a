"""Where finished tables live: Parquet tables in the catalog, or a JDBC database.

Both kinds offer the same calls. ``replace`` swaps a whole table, ``replace_months`` some months
of it, ``append_batch`` adds one micro-batch of a stream and may be repeated for the same batch,
``create_empty`` makes a table readable before its first rows, ``create_view`` publishes a
pass-through, ``table`` reads. ``content`` tells whether a table changed, ``sources`` what content
of other tables it was built from.
"""

from __future__ import annotations

import json
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareweather.schemas import INT, LONG, TABLES, TEXT, conform, struct
from fareweather.session import PARQUET_OPTIONS, object_store_path, shared_folder
from fareweather.sources.folders import Folder
from fareweather.sources.snapshots import Snapshot, Snapshots

STREAM_COLUMN, BATCH_COLUMN = "stream_id", "batch_id"
BATCH_KEYS = struct(**{STREAM_COLUMN: TEXT, BATCH_COLUMN: LONG})
MONTH_KEYS = struct(year=INT, month=INT)

# Bookkeeping columns by which a table's folder is partitioned; readers don't see them.
PARTITION_KEYS = {
    "dim_weather": BATCH_KEYS,
    "weather_quarantine": BATCH_KEYS,
    "fact_taxi_trips": MONTH_KEYS,
    "trip_enriched": MONTH_KEYS,
    "trip_totals": MONTH_KEYS,
}

# The catalog replaces a view by dropping it and making it anew, which two threads must not do at once.
PUBLISHING = threading.Lock()

# What the folder of one write is named by.
WRITTEN = "written"

# What follows SELECT 1 in databases that want a table there.
ONE_ROW = {"derby": "FROM SYSIBM.SYSDUMMY1", "oracle": "FROM DUAL", "db2": "FROM SYSIBM.SYSDUMMY1"}

# Rows that no stream brought, and the rows of a stream's older batches after compaction.
NO_STREAM, NO_BATCH = "none", -1


def with_keys(df: DataFrame, keys: StructType) -> DataFrame:
    """`df` and those of the keys it lacks: no stream, no batch, or the month 0 of the year 0."""
    missing = {STREAM_COLUMN: NO_STREAM, BATCH_COLUMN: NO_BATCH, "year": 0, "month": 0}
    return df.withColumns(
        {f.name: F.lit(missing[f.name]).cast(f.dataType) for f in keys if f.name not in df.columns}
    ) if any(f.name not in df.columns for f in keys) else df


def in_months(months: Iterable[tuple[int, int]]) -> Column:
    by_year: dict[int, list[int]] = {}
    for year, month in months:
        by_year.setdefault(year, []).append(month)
    chosen = [(F.col("year") == year) & F.col("month").isin(own) for year, own in by_year.items()]
    return reduce(Column.__or__, chosen, F.lit(False))


class LakeWarehouse:
    """Tables as Parquet folders below one root, published as views in a database of the catalog.

    Every write makes new folders, and a snapshot then names those the table consists of
    (`snapshots.py`). Readers, also in other sessions, have the old rows until the new ones are
    whole, and a frame opened before keeps them; a failed write is never read. Replaced folders
    are kept for `keep_seconds`.
    """

    def __init__(self, spark: SparkSession, root: str, database: str = "fareweather", keep_seconds: float = 86_400):
        self.spark = spark
        self.root = object_store_path(root).rstrip("/")
        self.database = database
        self.keep_seconds = keep_seconds
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{self.root}'")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def replace(self, name: str, df: DataFrame, sources: Mapping[str, str] | None = None) -> Snapshot:
        """Swap the whole table; `sources` notes what content of other tables it was built from."""
        parts = self._write(name, df)
        return self._commit(name, lambda old: old.of(parts, sources or {}))

    def create_empty(self, name: str) -> None:
        if self.snapshot(name) is None:
            if name in PARTITION_KEYS:  # a snapshot of no folders
                self._commit(name, lambda old: old if old.number else old.of([]))
            else:
                self.replace(name, self.spark.createDataFrame([], TABLES[name]))
        elif not self.spark.catalog.tableExists(f"{self.database}.{name}"):
            self.publish(name)

    def append_batch(self, name: str, df: DataFrame, batch_id: int, stream_id: str = "batches") -> None:
        """Write the batch as its own folder; a repeated batch of the same stream replaces itself.

        Other readers of `table` have it at once, SQL on the catalog's view after `publish`.
        """
        own = f"/{STREAM_COLUMN}={self._escaped(stream_id)}/{BATCH_COLUMN}={batch_id}"
        part = _new_folder() + own
        df.write.options(**PARQUET_OPTIONS).parquet(f"{self.path(name)}/{part}")
        self._snapshots(name).commit(lambda old: old.of([p for p in old.parts if not p.endswith(own)] + [part]))

    def replace_months(
        self, name: str, df: DataFrame, months: Iterable[tuple[int, int]], sources: Mapping[str, str] | None = None
    ) -> Snapshot:
        """Replace the given months of a table by the rows of `df` (with `year` and `month`), keep all others."""
        months = set(months)
        parts = self._write(name, with_keys(df, MONTH_KEYS).where(in_months(months)))
        own = tuple(f"/{month_folder(month)}" for month in months)
        return self._commit(name, lambda old: old.of([p for p in old.parts if not p.endswith(own)] + parts, sources))

    def compact(self, name: str, fan: int = 16) -> None:
        """Merge the older batches of each stream; the last one stays, as only it can be repeated.

        May run beside streams that write to the table. Only the batches since the last time are
        read and written; of what was merged before, `fan` merged parts become one of the next
        level (kept as batch -1, -2, ... of no stream), so that a row is written again a few times
        in all.
        """
        found = self.snapshot(name)
        batches = {part: _batch_of(part) for part in (found.parts if found else ())}
        last: dict[str, int] = {}
        for stream, batch in batches.values():
            last[stream] = max(batch, last.get(stream, batch))
        older = [part for part, (stream, batch) in batches.items() if stream != NO_STREAM and batch < last[stream]]
        if older:
            self._merge(name, older, NO_BATCH)
        level = NO_BATCH
        while found and any(batch <= level for stream, batch in map(_batch_of, found.parts) if stream == NO_STREAM):
            found = self.snapshot(name)
            same = [part for part in found.parts if _batch_of(part) == (NO_STREAM, level)]
            if len(same) >= fan:
                self._merge(name, same, level - 1)
            level -= 1
        self.publish(name)

    def _merge(self, name: str, parts: list[str], level: int) -> None:
        merged = f"{_new_folder()}/{STREAM_COLUMN}={NO_STREAM}/{BATCH_COLUMN}={level}"
        rows = self._rows(name, parts).drop(*BATCH_KEYS.fieldNames())
        rows.hint("rebalance").write.options(**PARQUET_OPTIONS).parquet(f"{self.path(name)}/{merged}")

        def swapped(old: Snapshot) -> Snapshot:
            if not set(parts) <= set(old.parts):
                raise RuntimeError(f"{name} was replaced while its batches were merged; nothing was changed")
            return old.of([part for part in old.parts if part not in set(parts)] + [merged], same_rows=True)

        self._snapshots(name).commit(swapped)

    def create_view(self, view: str, name: str) -> None:
        """Publish a pass-through of a table for every session of the catalog."""
        self._found(name)
        names = TABLES[name].fieldNames() if name in TABLES else self.table(name).columns
        columns = ", ".join(f"`{column}`" for column in names)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.database}.{view} AS SELECT {columns} FROM {self.database}.{name}"
        )

    def view(self, view: str) -> DataFrame:
        return self.spark.table(f"{self.database}.{view}")

    def table(self, name: str, months: Iterable[tuple[int, int]] | None = None) -> DataFrame:
        """The table without its bookkeeping; with `months` only their folders, and the months beside the rows."""
        found = self._found(name)
        if months is not None:
            own = tuple(f"/{month_folder(month)}" for month in months)
            return self._rows(name, [part for part in found.parts if part.endswith(own)])
        rows = self._rows(name, found.parts)
        return rows.drop(*PARTITION_KEYS[name].fieldNames()) if name in PARTITION_KEYS else rows

    def with_batches(self, name: str) -> DataFrame:
        """A streamed table with the stream and the batch of each row."""
        return self._rows(name, self._found(name).parts)

    def all_months(self, name: str) -> DataFrame:
        """A monthly table with its `year` and `month`."""
        return self._rows(name, self._found(name).parts)

    def snapshot(self, name: str) -> Snapshot | None:
        """What the table consists of; None if it was never written."""
        return self._snapshots(name).latest()

    def content(self, name: str) -> str | None:
        """Changes whenever the table's rows do."""
        found = self.snapshot(name)
        return found.content if found else None

    def sources(self, name: str) -> dict[str, str]:
        """The content of the tables that this one was built from, as far as it was noted."""
        found = self.snapshot(name)
        return found.sources if found else {}

    def publish(self, name: str) -> None:
        """Point the catalog's view to the table as it stands."""
        self._publish(name, self.snapshot(name))

    def _publish(self, name: str, found: Snapshot) -> None:
        keys = PARTITION_KEYS.get(name)
        if keys is None:
            source = f"SELECT * FROM parquet.`{self.path(name)}/{found.parts[0]}`"
        elif not found.parts:
            columns = [f"CAST(NULL AS {f.dataType.simpleString()}) AS `{f.name}`" for f in TABLES[name]]
            source = f"SELECT {', '.join(columns)} WHERE false"
        else:
            folder = ", '/', ".join(f"'{key}=', `{key}`" for key in (WRITTEN, *keys.fieldNames()))
            listed = ", ".join(f"'{part}'" for part in found.parts)
            shown = ", ".join(f"`{f.name}`" for f in TABLES[name])
            source = f"SELECT {shown} FROM parquet.`{self.path(name)}` WHERE concat({folder}) IN ({listed})"
        with PUBLISHING:
            self.spark.sql(f"CREATE OR REPLACE VIEW {self.database}.{name} AS {source}")

    def _found(self, name: str) -> Snapshot:
        found = self.snapshot(name)
        if found is None:
            raise AnalysisException(f"[PATH_NOT_FOUND] no whole version of the table in {self.path(name)}")
        if not self.spark.catalog.tableExists(f"{self.database}.{name}"):
            self._publish(name, found)
        return found

    def _rows(self, name: str, parts: Iterable[str]) -> DataFrame:
        """The rows of some folders, with the keys they are partitioned by."""
        paths, keys = [f"{self.path(name)}/{part}" for part in parts], PARTITION_KEYS.get(name)
        if keys is None:
            return self.spark.read.parquet(*paths)
        schema = StructType(TABLES[name].fields + keys.fields)
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path(name)).parquet(*paths).drop(WRITTEN)

    def _write(self, name: str, df: DataFrame) -> list[str]:
        """Write the rows to folders of their own and list these."""
        keys, version = PARTITION_KEYS.get(name), _new_folder()
        if keys is None:
            df.write.options(**PARQUET_OPTIONS).parquet(f"{self.path(name)}/{version}")
            return [version]
        writer = with_keys(df, keys).write.options(**PARQUET_OPTIONS).partitionBy(*keys.fieldNames())
        writer.parquet(f"{self.path(name)}/{version}")
        folder, parts = Folder(self.spark, self.path(name)), [version]
        for key in keys.fieldNames():
            parts = [f"{part}/{own}" for part in parts for own in folder.names(part) if own.startswith(f"{key}=")]
        return parts

    def _commit(self, name: str, change: Callable[[Snapshot], Snapshot]) -> Snapshot:
        new = self._snapshots(name).commit(change)
        self.publish(name)
        return new

    def _snapshots(self, name: str) -> Snapshots:
        return Snapshots(self.spark, self.path(name), self.keep_seconds)

    def _escaped(self, value: str) -> str:
        """As Spark writes it into the name of a partition's folder."""
        return self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(value)


def _new_folder() -> str:
    return f"{WRITTEN}={time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def month_folder(month: tuple[int, int]) -> str:
    return f"year={month[0]}/month={month[1]}"


def _batch_of(part: str) -> tuple[str, int]:
    stream, batch = part.split("/")[-2:]
    return stream.partition("=")[2], int(batch.partition("=")[2])


@dataclass
class JdbcWarehouse:
    """Tables in a database; `properties` holds the user, password and driver.

    New rows of a table go to a staging table first, task by task; when all are there, the
    database moves them over in one transaction, so that a failed write leaves the old rows in
    place and readers see all of a change or nothing. What the tables' contents were built from is
    noted in the table `STATE`, in the same transaction.
    """

    spark: SparkSession
    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    write_connections: int = 16
    read_connections: int = 24
    insert_rows: int = 10_000
    fetch_rows: int = 10_000
    # Large tables are read over several connections, by a column that deals rows out evenly.
    SPLIT_TABLES = ("fact_taxi_trips", "trip_enriched", "dim_weather")
    SHARE_COLUMN, SHARES, STEP = "read_share", 960, 593
    STATE = "fareweather_state"

    def replace(self, name: str, df: DataFrame, sources: Mapping[str, str] | None = None) -> None:
        """Swap all rows of the table; the table itself stays, so views on it survive."""
        self._swap(name, with_keys(df, PARTITION_KEYS[name]) if name in PARTITION_KEYS else df, None, sources or {})

    def replace_months(
        self, name: str, df: DataFrame, months: Iterable[tuple[int, int]], sources: Mapping[str, str] | None = None
    ) -> None:
        """Replace the given months of a table by the rows of `df` (with `year` and `month`), keep all others."""
        months = sorted(set(months))
        chosen = [f"({self._quoted('year')} = {year} AND {self._quoted('month')} = {month})" for year, month in months]
        self.create_empty(name)
        self._swap(name, with_keys(df, MONTH_KEYS).where(in_months(months)), " OR ".join(chosen) or "1 = 0", sources)

    def _swap(self, name: str, df: DataFrame, condition: str | None, sources: Mapping[str, str] | None) -> None:
        """Put the rows of `df` in the place of those that fulfil the condition.

        Tasks commit one by one, and one that is lost after its commit runs again; the row count
        tells. The rows are computed once, into the shared folder, then written and counted.
        """
        shared_folder(self.spark)
        computed, staging = self._dealt(name, df, F.lit(0)).checkpoint(), f"{name}_staging"
        self._writer(computed, staging).mode("overwrite").option("truncate", "true").save()
        rows, landed = computed.count(), self._scalar(f"SELECT COUNT(*) AS n FROM {staging}")
        if landed != rows:
            raise RuntimeError(f"{staging}: wrote {rows} rows but the table holds {landed}")
        if not self._exists(name):
            self._writer(self.spark.createDataFrame([], computed.schema), name).mode("append").save()
        columns = ", ".join(self._quoted(column) for column in computed.columns)
        self._transaction(
            f"DELETE FROM {name}" + (f" WHERE {condition}" if condition else ""),
            f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {staging}",
            f"DELETE FROM {staging}",
            *self._noted(name, self.sources(name) if sources is None else sources),
        )

    def create_empty(self, name: str) -> None:
        if not self._exists(name):
            keys = PARTITION_KEYS.get(name, StructType([]))
            empty = with_keys(self.spark.createDataFrame([], TABLES[name]), keys)
            self._writer(self._dealt(name, empty, F.lit(0)), name).mode("append").save()

    def append_batch(self, name: str, df: DataFrame, batch_id: int, stream_id: str = "batches") -> None:
        """Insert the rows of the batch that the table lacks: all of them, the first time."""
        self.create_empty(name)
        batch = df.withColumns({STREAM_COLUMN: F.lit(stream_id), BATCH_COLUMN: F.lit(batch_id).cast("bigint")})
        missing = batch
        if self._batch_rows(name, batch_id, stream_id) > 0:
            mine = (F.col(BATCH_COLUMN) == batch_id) & (F.col(STREAM_COLUMN) == stream_id)
            missing = batch.exceptAll(conform(self._loaded(name).where(mine), batch.schema))
        self._writer(self._dealt(name, missing, F.xxhash64(STREAM_COLUMN, BATCH_COLUMN)), name).mode("append").save()
        rows, landed = batch.count(), self._batch_rows(name, batch_id, stream_id)
        if landed != rows:
            raise RuntimeError(
                f"{name}: batch {batch_id} of stream {stream_id} has {rows} rows but the table holds {landed}; "
                f"delete that batch of that stream from the table and run the stream again"
            )
        self._transaction(*self._noted(name, {}))

    def create_view(self, view: str, name: str) -> None:
        """A view of this session; the database's own views are its administrator's."""
        self.table(name).createOrReplaceTempView(view)

    def view(self, view: str) -> DataFrame:
        return self.spark.table(view)

    def publish(self, name: str) -> None:
        """Nothing to do: the database shows its tables as they stand."""

    def table(self, name: str, months: Iterable[tuple[int, int]] | None = None) -> DataFrame:
        """The table without its bookkeeping; with `months` only those, and the months beside the rows."""
        if months is not None:
            return self.all_months(name).where(in_months(months))
        loaded = self._loaded(name).drop(STREAM_COLUMN, BATCH_COLUMN, self.SHARE_COLUMN)
        return conform(loaded, TABLES[name]) if name in TABLES else loaded

    def all_months(self, name: str) -> DataFrame:
        """A monthly table with its `year` and `month`."""
        return conform(self._loaded(name), StructType(TABLES[name].fields + MONTH_KEYS.fields))

    def content(self, name: str) -> str | None:
        """Changes whenever the table's rows do."""
        return self._state(name)[0]

    def sources(self, name: str) -> dict[str, str]:
        """The content of the tables that this one was built from, as far as it was noted."""
        return self._state(name)[1]

    def _state(self, name: str) -> tuple[str | None, dict[str, str]]:
        if not self._exists(self.STATE):
            return None, {}
        found = self._reader(self.STATE).load().where(F.col("name") == name).first()
        return (found["content"], json.loads(found["sources"])) if found else (None, {})

    def _noted(self, name: str, sources: Mapping[str, str]) -> list[str]:
        """What a transaction that changes a table notes about it."""
        if not self._exists(self.STATE):
            empty = self.spark.createDataFrame([], struct(name=TEXT, content=TEXT, sources=TEXT))
            types = "name VARCHAR(64), content VARCHAR(64), sources VARCHAR(1000)"
            self._writer(empty, self.STATE).option("createTableColumnTypes", types).mode("append").save()
        columns = ", ".join(map(self._quoted, ("name", "content", "sources")))
        return [
            f"DELETE FROM {self.STATE} WHERE {self._quoted('name')} = '{name}'",
            f"INSERT INTO {self.STATE} ({columns}) VALUES ('{name}', '{uuid.uuid4().hex}', '{json.dumps(dict(sources))}')",
        ]

    def _dealt(self, name: str, df: DataFrame, offset: Column) -> DataFrame:
        """Rows dealt into even shares by position, whatever they hold, so that reads split evenly.

        Positions go round in long steps, so that a few rows spread as well as many.
        """
        if name not in self.SPLIT_TABLES:
            return df
        share = F.pmod(F.monotonically_increasing_id() * self.STEP + F.pmod(offset, F.lit(self.SHARES)), F.lit(self.SHARES))
        return df.withColumn(self.SHARE_COLUMN, share.cast("int"))

    def _transaction(self, *statements: str) -> None:
        """Run statements on one connection: all of them or none."""
        connection = self._connection()
        try:
            connection.setAutoCommit(False)
            for statement in statements:
                running = connection.createStatement()
                running.executeUpdate(statement)
                running.close()
            connection.commit()
        except Exception:
            connection.rollback()
            raise
        finally:
            connection.close()

    def _connection(self):
        jvm, given = self.spark._jvm, self.spark._jvm.java.util.Properties()
        for key, value in self.properties.items():
            given.setProperty(key, value)
        if "driver" in self.properties:
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(self.properties["driver"])
        return jvm.java.sql.DriverManager.getConnection(self.url, given)

    def _quoted(self, column: str) -> str:
        return self.spark._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(self.url).quoteIdentifier(column)

    def _writer(self, df: DataFrame, name: str):
        writer = (
            df.write.format("jdbc")
            .options(**self.properties)
            .option("url", self.url)
            .option("dbtable", name)
            .option("numPartitions", self.write_connections)
            .option("batchsize", self.insert_rows)
        )
        if STREAM_COLUMN in df.columns:  # a bounded text, so that every database can compare it
            writer = writer.option("createTableColumnTypes", f"{STREAM_COLUMN} VARCHAR(64)")
        return writer

    def _reader(self, name: str):
        return (
            self.spark.read.format("jdbc")
            .options(**self.properties)
            .option("url", self.url)
            .option("dbtable", name)
            .option("fetchsize", self.fetch_rows)
            .option("preferTimestampNTZ", "true")
        )

    def _loaded(self, name: str) -> DataFrame:
        """The table as the database has it, read in even ranges of shares where it has them."""
        loaded = self._reader(name).load()
        if self.SHARE_COLUMN not in loaded.columns:
            return loaded
        return (
            self._reader(name)
            .option("partitionColumn", self.SHARE_COLUMN)
            .option("lowerBound", 0)
            .option("upperBound", self.SHARES)
            .option("numPartitions", self.read_connections)
            .load()
        )

    def _batch_rows(self, name: str, batch_id: int, stream_id: str) -> int:
        condition = f"{self._quoted(BATCH_COLUMN)} = {batch_id} AND {self._quoted(STREAM_COLUMN)} = '{stream_id}'"
        return self._scalar(f"SELECT COUNT(*) AS n FROM {name} WHERE {condition}")

    def _scalar(self, query: str) -> int:
        reader = self.spark.read.format("jdbc").options(**self.properties).option("url", self.url)
        return int(reader.option("query", query).load().first()[0])

    def _exists(self, name: str) -> bool:
        """Whether the table is there; a lost connection fails instead."""
        kind = self.url.split(":")[1]
        self._scalar(f"SELECT 1 AS n {ONE_ROW.get(kind, '')}")
        try:
            self._reader(name).load()
        except Exception:
            return False
        return True
