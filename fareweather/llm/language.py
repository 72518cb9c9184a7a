"""Language identification by string kernels.

The kernel is the blended spectrum of presence: how many distinct byte n-grams of 1 to
``MAX_GRAM`` bytes two texts share, over the root of the product of how many each has. N-grams go
to ``1 << BITS`` buckets, A-Z in lower case. Some labelled texts are Nyström landmarks; kernel
ridge regression on the kernel with these is fitted for each language against the rest. A batch
is scored by one matrix product: the products with the landmarks and with their weights are
associative, so landmarks and weights are multiplied once, on the driver.

Fitting uses at most ``PER_LANGUAGE`` documents of each language, of which ``LANDMARKS`` are
landmarks; they reach the driver as bitmaps of ``2 ** BITS / 8`` bytes, never as text. The
``LANGUAGES`` most frequent values of ``lang`` are learned, so that a column full of stray values
can't outgrow the driver; where there are many, each has fewer rows and landmarks, such that all
together stay below ``ROWS_IN_ALL`` (39 MB) and ``LANDMARKS_IN_ALL``, and the broadcast weights
below 17 MB. Texts in other languages get one of those learned. Scoring covers every whole text
and shuffles nothing.

A filter on the language (``keep_identified``) rejects by the margin of the language found, the
value that kernel ridge regression brings towards 1 for its texts and to -1 for all others; a text that
shares no n-gram with a landmark has 0. The least margin of a language is ``ENOUGH`` of what all but
``STRAYS`` of its labelled sample reach under a model learned from the other half of the sample;
``ENOUGH_ALONE`` of it where only one language is labelled, as nothing brings other texts below 0 then.
A language whose own rows do not get beyond 0 that way rejects nothing, and so does a table without
labelled rows: all its texts with a letter stay.

Defined cases: null texts and texts without a letter are ``und`` with score 0; so is every text
if no labelled row exists; rows without an id are held out, rows with a null language are not
learned from; repeated rows get the same answer; ties go to the first language in order, and of equally
frequent languages at the bound the first in order are learned; very long texts count whole; an
empty table gives an empty result; other columns are never read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fareweather.llm.tasks import appended, batch_of, by_place, held_out, small_batches
from fareweather.llm.text import Texts, text_chunks

BITS = 15
MAX_GRAM = 4
#: Languages learned, the most frequent values of ``lang``: a broadcast of 128 KB of weights each.
LANGUAGES = 128
#: Rows learned from, of each language and in all: bitmaps of 4 KB each on the driver.
PER_LANGUAGE = 300
ROWS_IN_ALL = 9600
LANDMARKS = 60
LANDMARKS_IN_ALL = 2048
RIDGE = 1e-4
ROWS = 256
STRAYS = 0.01
ENOUGH = 0.25
ENOUGH_ALONE = 0.75
UNKNOWN = "und"

_FOLD = np.arange(256, dtype=np.uint32)
_FOLD[65:91] += 32


def presence(texts: Texts) -> np.ndarray:
    """Row i tells which buckets the n-grams of document i fall into."""
    seen = np.zeros((len(texts), 1 << BITS), bool)
    data = _FOLD[texts.data]
    docs = np.repeat(np.arange(len(texts)), np.diff(texts.offsets))
    left = texts.offsets[1:][docs] - np.arange(len(data))  # bytes to the end of the document
    base = docs.astype(np.int64) << BITS
    code = np.zeros(len(data), np.uint32)
    flat = seen.reshape(-1)
    for size in range(1, min(MAX_GRAM, len(data)) + 1):
        code[: len(data) - size + 1] = (code[: len(data) - size + 1] << np.uint32(8)) | data[size - 1 :]
        whole = left >= size
        bucket = (code + np.uint32(size * 0x3C6EF372 & 0xFFFFFFFF)) * np.uint32(2654435769)
        bucket ^= bucket >> np.uint32(15)
        bucket *= np.uint32(0x85EBCA6B)
        flat[(base + (bucket >> np.uint32(32 - BITS)))[whole]] = True
    return seen


@dataclass(frozen=True)
class Model:
    """Languages in order, and the weight of each bucket for each of them."""

    languages: list[str]
    weights: np.ndarray

    def margins(self, seen: np.ndarray) -> np.ndarray:
        size = np.sqrt(np.maximum(seen.sum(axis=1), 1))[:, None]
        return seen.astype(np.float32) @ self.weights / size

    def decide(self, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of the best language and its score between 0 and 1."""
        best, score, _ = self.judge(seen)
        return best, score

    def judge(self, seen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place of the best language, its score between 0 and 1, and its margin."""
        margins = self.margins(seen)
        likely = np.clip((margins + 1) / 2, 1e-6, 1)
        best = likely.argmax(axis=1)
        at = np.arange(len(best))
        return best, (likely[at, best] / likely.sum(axis=1)).astype(float), margins[at, best].astype(float)


def kernel(rows: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised kernel values of presence rows with landmark rows."""
    shared = rows.astype(np.float32) @ landmarks.astype(np.float32).T
    return shared / np.sqrt(np.maximum(np.outer(rows.sum(axis=1), landmarks.sum(axis=1)), 1))


def unpack(packed: list[bytes]) -> np.ndarray:
    """Presence rows from bitmaps."""
    return np.unpackbits(np.array([np.frombuffer(row, np.uint8) for row in packed]), axis=1)


def fit(packed: list[bytes], languages: list[str]) -> Model:
    """Kernel ridge regression of one language against the rest, on Nyström landmarks."""
    names = sorted(set(languages))
    if not names:
        return Model([], np.zeros((1 << BITS, 0), np.float32))
    label = np.array([names.index(x) for x in languages])
    unpacked = lambda rows: unpack([packed[i] for i in rows])
    marks = np.concatenate([np.flatnonzero(label == i)[: min(LANDMARKS, LANDMARKS_IN_ALL // len(names))] for i in range(len(names))])

    landmarks = unpacked(marks)
    among = kernel(landmarks, landmarks).astype(float)
    gram, target = np.zeros_like(among), np.zeros((len(marks), len(names)))
    for rows in np.array_split(np.arange(len(packed)), -(-len(packed) // ROWS)):
        k = kernel(unpacked(rows), landmarks).astype(float)
        balance = len(packed) / len(names) / np.bincount(label, minlength=len(names))[label[rows]]
        gram += k.T @ (k * balance[:, None])
        target += k.T @ (np.where(label[rows][:, None] == np.arange(len(names)), 1.0, -1.0) * balance[:, None])
    ridge = RIDGE * len(packed) * among + 1e-8 * len(packed) * np.eye(len(marks))
    weights = np.linalg.solve(gram + ridge, target)
    scaled = weights / np.sqrt(np.maximum(landmarks.sum(axis=1), 1))[:, None]
    return Model(names, (landmarks.T.astype(np.float32) @ scaled.astype(np.float32)))


def least_margins(packed: list[bytes], languages: list[str]) -> dict[str, float]:
    """The margin by which each language is believed; a row is judged by a model that hasn't seen it.

    Without a clear margin of its own rows, a language has no least.
    """
    own: dict[str, list[float]] = {name: [] for name in languages}
    for half in (0, 1):
        model = fit(packed[1 - half :: 2], languages[1 - half :: 2])
        rows, labels = packed[half::2], languages[half::2]
        for first in range(0, len(rows), ROWS):
            margins = model.margins(unpack(rows[first : first + ROWS]))
            for name, found in zip(labels[first : first + ROWS], margins):
                own[name].append(float(found[model.languages.index(name)]) if name in model.languages else 0.0)
    reached = {name: float(np.quantile(values, STRAYS)) for name, values in own.items()}
    share = ENOUGH if len(own) > 1 else ENOUGH_ALONE
    return {name: share * value if value > 0 else -math.inf for name, value in reached.items()}


def has_letter(text: str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False))


def learnable(documents: DataFrame, remainder: int) -> DataFrame:
    named = by_place(documents, "doc_id", "text", "lang")
    rows = named.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col("lang").cast("string").alias("lang"))
    return rows.filter(~held_out("doc_id", remainder) & F.col("lang").isNotNull() & F.col("text").isNotNull())


def train(documents: DataFrame, remainder: int = 0) -> Model:
    return fit(*sampled(documents, remainder))


def sampled(documents: DataFrame, remainder: int = 0) -> tuple[list[bytes], list[str]]:
    """Bitmaps and languages of labelled rows, sorted by language.

    Counts first, so that a hash of the id thins every language to a bounded number of rows.
    """
    small_batches(documents.sparkSession)
    usable = learnable(documents, remainder)
    by_size = usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), "lang")
    sizes = {row["lang"]: row["n"] for row in by_size.limit(LANGUAGES).collect()}
    if not sizes:
        return [], []
    most = min(PER_LANGUAGE, ROWS_IN_ALL // len(sizes))
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.create_map(*[F.lit(x) for lang, n in sizes.items() for x in (lang, min(1.0, 2.0 * most / n))])
    order = Window.partitionBy("lang").orderBy("draw", "doc_id")
    sample = (
        usable.withColumn("draw", draw)
        .filter(F.col("draw") < share[F.col("lang")])
        .withColumn("place", F.row_number().over(order))
        .filter(F.col("place") <= most)
    )
    schema = pa.schema([("lang", pa.string()), ("draw", pa.float64()), ("doc_id", pa.int64()), ("bits", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch["text"], max_rows=ROWS):
                own = batch.slice(texts.row, len(texts))
                bits = [row.tobytes() for row in np.packbits(presence(texts), axis=1)]
                yield batch_of(schema, lang=own["lang"], draw=own["draw"], doc_id=own["doc_id"], bits=bits)

    rows = sample.select("lang", "draw", "doc_id", "text").mapInArrow(run, "lang string, draw double, doc_id long, bits binary")
    found = sorted(rows.collect(), key=lambda row: (row["lang"], row["draw"], row["doc_id"]))
    return [row["bits"] for row in found], [row["lang"] for row in found]


FIELDS = pa.schema([("lang_pred", pa.string()), ("lang_score", pa.float64()), ("lang_margin", pa.float64())])


def identified(df: DataFrame, model: Model) -> DataFrame:
    """All columns of ``df``, then ``lang_pred``, ``lang_score`` and ``lang_margin``."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def compute(texts: Texts, known: pa.Array) -> dict[str, object]:
        names = np.array([*shared.value.languages, UNKNOWN], object)
        sure = known.to_numpy(zero_copy_only=False) & (len(names) > 1)
        best, score, margin = np.full(len(texts), len(names) - 1), np.zeros(len(texts)), np.zeros(len(texts))
        if sure.any():
            best[sure], score[sure], margin[sure] = (x[sure] for x in shared.value.judge(presence(texts)))
        return {"lang_pred": names[best].tolist(), "lang_score": score, "lang_margin": margin}

    known = has_letter(f"c{df.columns.index('text')}")
    return appended(df, FIELDS, compute, max_rows=ROWS, known=known)


def predict(documents: DataFrame, model: Model, remainder: int = 0) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred`` and ``score`` of every row."""
    source = by_place(documents, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id", remainder).alias("held_out"), "text"
    )
    return identified(source, model).select("doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


def keep_identified(df: DataFrame, least: float = 0.0) -> DataFrame:
    """The rows of ``df`` in one of its labelled languages, columns as they are.

    A text stays if it has the least margin of the language found and a score of ``least`` or
    more; where no language could be learned, every text with a letter stays.
    """
    packed, languages = sampled(df)
    if not packed:
        places = [f"c{i}" for i in range(len(df.columns))]
        return df.toDF(*places).filter(has_letter(f"c{df.columns.index('text')}")).toDF(*df.columns)
    margins = least_margins(packed, languages)
    places = [f"c{i}" for i in range(len(df.columns))]
    found = identified(df, fit(packed, languages)).toDF(*places, "pred", "score", "margin")
    enough = F.create_map(*[F.lit(x) for pair in sorted(margins.items()) for x in pair])[F.col("pred")]
    known = (F.col("pred") != UNKNOWN) & (F.col("margin") >= enough)
    return found.filter(known & (F.col("score") >= least)).select(*places).toDF(*df.columns)


def op3_language_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(documents, train(documents))
