"""Byte-level BPE encoding and decoding with a local rank file.

``encode`` and ``decode`` work row by row in Arrow batches; the rank file is read once by the
driver, checked against ``MAX_RANK_BYTES`` and broadcast.

Defined cases: a null or empty text has no ids and decodes to no bytes; nulls in other columns,
repeated rows and further columns of any name don't matter, for only the named ones are read; an
empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareweather.llm.tasks import batch_of, by_place, small_batches

MAX_RANK_BYTES = 64 << 20

#: Characters of text given to the library at once, as far as there is a safe boundary.
PART = 1 << 14

#: Runs of white space from this length on are merged without the library's pattern, whose
#: matcher keeps a state for each character of such a run.
LONG_SPACE = 1 << 12

#: Between these two characters every match ends, whatever stands around them: no branch of the
#: pattern crosses from a letter to something else, from a digit to something else, or from
#: anything but white space into white space.
_SAFE = regex.compile(r"(?<=\p{L})(?!\p{L})|(?<=\p{N})(?!\p{N})|(?<=\P{White_Space})(?=\p{White_Space})")
_SPACE = regex.compile(rf"\p{{White_Space}}{{{LONG_SPACE},}}")

SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


class Codec:
    """One encoding. ``ranks`` is the content of a rank file."""

    def __init__(self, ranks: bytes, pattern: str):
        table = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}
        self.encoding = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for part, whole in parts(text):
            if whole:
                ids += self.encoding._encode_single_piece(part)
            else:
                ids += self.encoding.encode_ordinary(part)
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return self.encoding.decode_bytes(ids)


def parts(text: str) -> Iterator[tuple[str, bool]]:
    """Cut a text where matches of the pattern end anyhow; True marks a part that is one match.

    A run of white space before a word is one match but for its last character; at the end of the
    text it is one match as a whole.
    """
    begin = 0
    if len(text) > LONG_SPACE:
        for run in _SPACE.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            yield from ((part, False) for part in plain_parts(text[begin : run.start()]))
            yield text[run.start() : end], True
            begin = end
    yield from ((part, False) for part in plain_parts(text[begin:]))


def plain_parts(text: str) -> Iterator[str]:
    begin = 0
    while len(text) - begin > PART:
        cut = _SAFE.search(text, begin + PART)
        if cut is None or cut.start() >= len(text):
            break
        yield text[begin : cut.start()]
        begin = cut.start()
    if begin < len(text):
        yield text[begin:]


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as file:
        ranks = file.read(MAX_RANK_BYTES + 1)
    if len(ranks) > MAX_RANK_BYTES:
        raise ValueError(f"{path} is larger than {MAX_RANK_BYTES} bytes")
    return ranks


_codecs: dict[tuple[int, str], Codec] = {}


def codec_of(ranks: bytes, pattern: str) -> Codec:
    """The codec, built once for each Python worker."""
    key = (hash(ranks), pattern)
    if key not in _codecs:
        _codecs[key] = Codec(ranks, pattern)
    return _codecs[key]


def encode(df: DataFrame, rank_path: str, pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``id_column``, ``ids`` (array of int) of every row."""
    small_batches(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    schema = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks.value, pattern)
        for batch in batches:
            for some in slices(batch):
                ids = [codec.encode(text or "") for text in some["text"].to_pylist()]
                yield batch_of(schema, id=some["id"], ids=ids)

    named = by_place(df, id_column, text_column).toDF("id", "text")
    source = named.select(F.col("id").cast("long").alias("id"), "text")
    return source.mapInArrow(run, "id long, ids array<int>").withColumnRenamed("id", id_column)


def decode(df: DataFrame, rank_path: str, pattern: str, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """``id_column``, ``bytes`` of every row; the bytes may be no valid text if the ids were cut."""
    small_batches(df.sparkSession)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    schema = pa.schema([("id", pa.int64()), ("bytes", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks.value, pattern)
        for batch in batches:
            for some in slices(batch):
                yield batch_of(schema, id=some["id"], bytes=[codec.decode(ids or []) for ids in some["ids"].to_pylist()])

    source = by_place(df, id_column, ids_column).toDF("id", "ids").select(F.col("id").cast("long").alias("id"), "ids")
    return source.mapInArrow(run, "id long, bytes binary").withColumnRenamed("id", id_column)


def slices(batch: pa.RecordBatch, rows: int = 256) -> Iterator[pa.RecordBatch]:
    return (batch.slice(i, rows) for i in range(0, batch.num_rows, rows))


def digests(df: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """What ``op10_bpe`` returns: lengths and digests of the ids and of the bytes they decode to.

    The ids go from ``encode`` to ``decode`` within Spark, batch by batch, without a shuffle.
    """
    ids = encode(df, rank_path, pattern)
    ranks = df.sparkSession.sparkContext.broadcast(read_ranks(rank_path))
    schema = pa.schema(
        [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = codec_of(ranks.value, pattern)
        for batch in batches:
            rows = batch["ids"].to_pylist()
            yield batch_of(
                schema,
                doc_id=batch["doc_id"],
                n_tokens=[len(row) for row in rows],
                ids_sha256=[hashlib.sha256(np.array(row, "<u4").tobytes()).hexdigest() for row in rows],
                decoded_sha256=[hashlib.sha256(codec.decode(row)).hexdigest() for row in rows],
            )

    return ids.mapInArrow(run, SCHEMA)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return digests(documents, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
