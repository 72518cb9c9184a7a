"""What the operators share on Spark's side: the split of labelled rows, stored results, grouped streams."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_type
from pyspark.sql.types import StructField, StructType

from fareweather.llm.text import Texts, text_chunks
from fareweather.session import shared_folder


BATCH_BYTES = 4 << 20


def fold(doc_id: Column | str) -> Column:
    """crc32(doc_id as text) mod 5; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 5


def held_out(doc_id: str, remainder: int) -> Column:
    """Whether nothing may be learned from the row; rows without an id are never learned from."""
    return F.coalesce(fold(doc_id) == remainder, F.lit(True))


def by_place(df: DataFrame, *names: str) -> DataFrame:
    """The named columns alone, taken by their place, so that other columns' names don't matter.

    ``TEXT`` or ``Doc_Id`` beside ``text`` and ``doc_id`` make plain selection by name ambiguous.
    Where two columns share a name to the letter, the first counts.
    """
    lowered = [name.lower() for name in df.columns]
    at = {name: df.columns.index(name) if name in df.columns else lowered.index(name.lower()) for name in names}
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]).select(*[F.col(f"c{at[name]}").alias(name) for name in names])


def stored(df: DataFrame) -> DataFrame:
    """``df`` computed once and written to the shared checkpoint folder, its lineage cut.

    Shuffle files of what led to it go as soon as the driver's JVM has collected its garbage, so
    the frame computed is let go of before that is asked for.
    """
    spark = df.sparkSession
    shared_folder(spark)
    out = df.checkpoint(eager=True)
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return out


def small_batches(spark: SparkSession) -> None:
    """Hand texts to Python a few megabytes at a time, however long they are; the setting stays."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def appended(
    df: DataFrame, fields: pa.Schema, compute: Callable[[Texts], dict], text: str = "text", max_rows: int = 1 << 30, **inputs: Column
) -> DataFrame:
    """All columns of ``df`` as they are, then ``fields``, which ``compute`` makes from some texts.

    ``inputs`` are further columns that ``compute`` gets by name. Columns go by place, so names of
    ``df`` may clash with anything, each other included.
    """
    small_batches(df.sparkSession)
    carried, extra = [f"c{i}" for i in range(len(df.columns))], list(inputs)
    at = df.columns.index(text)
    renamed = df.toDF(*carried)
    source = renamed.select(*carried, *[inputs[name].alias(name) for name in extra])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch[f"c{at}"], max_rows=max_rows):
                own = batch.slice(texts.row, len(texts))
                made = compute(texts, **{name: own[name] for name in extra})
                columns = [own[name] for name in carried] + [pa.array(made[f.name], f.type) for f in fields]
                yield pa.RecordBatch.from_arrays(columns, [*carried, *fields.names])

    schema = StructType(
        [*renamed.schema.fields, *[StructField(f.name, from_arrow_type(f.type)) for f in fields]]
    )
    return source.mapInArrow(run, schema).toDF(*df.columns, *fields.names)


def batch_of(schema: pa.Schema, **columns) -> pa.RecordBatch:
    arrays = [
        columns[field.name] if isinstance(columns[field.name], pa.Array) else pa.array(columns[field.name], field.type)
        for field in schema
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def grouped_stream(
    batches: Iterator[pa.RecordBatch], keys: list[str], rows: int, work: Callable[[pa.Table], Iterator[pa.RecordBatch]]
) -> Iterator[pa.RecordBatch]:
    """Call ``work`` on runs of whole groups of about ``rows`` rows; the input is sorted by ``keys``.

    A run ends where the key changes, so a group is never cut, and no more than a run and one
    group are held.
    """
    held: list[pa.RecordBatch] = []
    count = 0
    for batch in batches:
        if batch.num_rows == 0:
            continue
        held.append(batch)
        count += batch.num_rows
        if count < rows:
            continue
        table = pa.Table.from_batches(held)
        cut = last_change(table, keys)
        if cut:
            yield from work(table.slice(0, cut))
            table = table.slice(cut)
        held, count = table.to_batches(), table.num_rows
    if count:
        yield from work(pa.Table.from_batches(held))


def last_change(table: pa.Table, keys: list[str]) -> int:
    """The first row of the last group."""
    cut = 0
    for key in keys:
        values = table[key].to_numpy()
        changes = np.flatnonzero(values[1:] != values[:-1])
        cut = max(cut, int(changes[-1]) + 1 if len(changes) else 0)
    return cut
