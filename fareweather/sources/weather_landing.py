"""The folder of weather documents, one JSON object per line, that the stream reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareweather.session import object_store_path

# What lands for a payload without content; it has no observation time, so it is set aside.
EMPTY_PAYLOAD = '{"message":"empty payload"}'


def land_payloads(payloads: DataFrame, landing: str) -> None:
    """Add payload texts (one string column) to the landing folder, one line each.

    Line breaks, which JSON allows between its parts but never inside a string, become spaces. A
    null or blank payload lands as a document that says so. A file appears only when the write
    commits, so a running stream never sees half of one.
    """
    text = F.translate(F.col(f"`{payloads.columns[0]}`"), "\r\n", "  ")
    line = F.when(F.length(F.trim(F.translate(text, "\t", " "))) > 0, text).otherwise(EMPTY_PAYLOAD)
    payloads.select(line.alias("value")).write.mode("append").text(object_store_path(landing))


def land_observations(observations: DataFrame, landing: str) -> None:
    """Add structured observations to the landing folder as JSON documents."""
    land_payloads(observations.select(F.to_json(F.struct("*")).alias("value")), landing)
