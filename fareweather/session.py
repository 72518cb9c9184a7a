"""Session settings and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Mapping

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    # Trip wall-clock times and weather epochs meet in the hour join, so both
    # sides must be read in one fixed zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A task of a partitioned write meets one or two months. With a few writers
    # open at once it streams them out instead of sorting its rows by month.
    "spark.sql.maxConcurrentOutputFileWriters": "8",
}

# How lake and tables are written. Amounts and moments hardly repeat, so dictionaries cost more time
# than they save room; zstd packs what does repeat.
PARQUET_OPTIONS = {"compression": "zstd", "parquet.enable.dictionary": "false"}

# Settings that only take effect before the session starts.
START_DEFAULTS = {
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def s3a_settings(
    endpoint: str | None = None,
    path_style: bool = False,
    access_key: str | None = None,
    secret_key: str | None = None,
) -> dict[str, str]:
    """Object-store settings; leave the keys out to use the cluster's own credentials."""
    settings = {
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
    }
    optional = {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
    }
    settings.update({key: value for key, value in optional.items() if value is not None})
    return settings


def build_session(app_name: str, settings: Mapping[str, str] | None = None) -> SparkSession:
    """One builder for the batch and the streaming jobs; the caller's settings win."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SESSION_DEFAULTS, **START_DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_session_defaults(spark: SparkSession) -> SparkSession:
    """Apply the run-time defaults to a session somebody else created; they stay set."""
    for key, value in SESSION_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def object_store_path(path: str) -> str:
    """``s3://`` paths are read through the ``s3a`` connector."""
    return "s3a://" + path[len("s3://"):] if path.startswith("s3://") else path


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may do without the setting; it gets a temporary folder.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = object_store_path(named) if named else context.getCheckpointDir()
    if folder is None:
        if context.master.partition("[")[0] != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="fareweather-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def scratch_folder(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
