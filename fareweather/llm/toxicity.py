"""Toxicity: logistic regression over hashed word n-grams and skip-grams, trained by FTRL-proximal.

Features of a text are the distinct hashes of its words, of neighbouring pairs and of pairs with
one word between them; a word is a run of letters and digits, A-Z in lower case. Each coordinate
has its own learning rate, and the L1 term leaves few weights other than zero, so the model that
goes to the executors is a short list of places and weights.

The trainer is one pass over a stream in one task: ``EPOCHS`` times a sample of at most
``PER_CLASS`` labelled documents a class. Their weights are divided by the mean weight, as the
penalties are fixed: only the ratio of the classes counts, not how many documents there are.
Scoring covers all rows and shuffles nothing.

Defined cases: null and empty texts have no features and get the score of the intercept; without
labelled rows every score is 0.5 and every prediction 1; rows without an id are held out;
repeated rows are scored alike, a repeated labelled id counts once; very long texts count whole; a
score equal to the threshold is predicted 1; an empty table gives an empty result; other columns
are never read, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareweather.llm.samples import in_one_task, labelled_sample
from fareweather.llm.tasks import batch_of, by_place, held_out, small_batches
from fareweather.llm.text import LETTER_BYTES, Texts, join_hashes, mix, text_chunks

BITS = 20
PER_CLASS = 8000
EPOCHS = 2
THRESHOLD = 0.5


@dataclass(frozen=True)
class Rates:
    """Of FTRL-proximal: learning rate, its smoothing, and both penalties."""

    alpha: float = 0.15
    beta: float = 1.0
    l1: float = 1.5
    l2: float = 1.0


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all n-grams and skip-grams of some documents and their documents, unordered."""
    words, docs = texts.word_hashes(lower=True), texts.word_doc
    parts, owners = [words], [docs]
    for gap in (1, 2):
        if len(words) > gap:
            same = docs[gap:] == docs[:-gap]
            parts.append(mix(join_hashes(words[:-gap], words[gap:])[same], gap))
            owners.append(docs[gap:][same])
    return (np.concatenate(parts) >> np.uint64(64 - BITS)).astype(np.int32), np.concatenate(owners)


def distinct_features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct buckets of each document, and their offsets."""
    buckets, docs = features(texts)
    keys = np.unique((docs.astype(np.int64) << BITS) | buckets)
    return (keys & ((1 << BITS) - 1)).astype(np.int32), np.searchsorted(keys >> BITS, np.arange(len(texts) + 1))


def feature_rows(sample: DataFrame) -> DataFrame:
    """``doc_id``, ``label``, ``weight`` and the distinct buckets as bytes."""
    small_batches(sample.sparkSession)
    schema = pa.schema(
        [("doc_id", pa.int64()), ("label", pa.int32()), ("weight", pa.float64()), ("buckets", pa.binary())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch["text"], word_bytes=LETTER_BYTES):
                values, offsets = distinct_features(texts)
                own = batch.slice(texts.row, len(texts))
                rows = [values[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])]
                yield batch_of(schema, doc_id=own["doc_id"], label=own["label"], weight=own["weight"], buckets=rows)

    return sample.select("doc_id", "label", "weight", "text").mapInArrow(
        run, "doc_id long, label int, weight double, buckets binary"
    )


class Ftrl:
    """The state of the learner; the last coordinate is the intercept, which has no L1 term."""

    def __init__(self, size: int, rates: Rates):
        self.z, self.n, self.rates = np.zeros(size + 1), np.zeros(size + 1), rates

    def weights(self, at: np.ndarray) -> np.ndarray:
        r, z = self.rates, self.z[at]
        l1 = np.where(at == len(self.z) - 1, 0.0, r.l1)
        shrunk = np.sign(z) * np.maximum(np.abs(z) - l1, 0)
        return -shrunk / ((r.beta + np.sqrt(self.n[at])) / r.alpha + r.l2)

    def learn(self, buckets: np.ndarray, label: int, weight: float) -> None:
        at = np.append(buckets, len(self.z) - 1)
        w = self.weights(at)
        slope = weight * (1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label)
        step = (np.sqrt(self.n[at] + slope * slope) - np.sqrt(self.n[at])) / self.rates.alpha
        self.z[at] += slope - step * w
        self.n[at] += slope * slope


def mean_weight(sample: DataFrame) -> float:
    """From the few distinct weights in order, so that the same sample gives the same bits."""
    rows = sorted((row["weight"], row["n"]) for row in sample.groupBy("weight").agg(F.count("*").alias("n")).collect())
    return math.fsum(w * n for w, n in rows) / max(sum(n for _, n in rows), 1) or 1.0


def train(sample: DataFrame, epochs: int = EPOCHS, rates: Rates = Rates()) -> dict[int, float]:
    """Weights other than zero by bucket; the intercept is at ``2 ** BITS``."""
    schema = pa.schema([("bucket", pa.int32()), ("w", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learner = Ftrl(1 << BITS, rates)
        for batch in batches:
            for row in batch.to_pylist():
                learner.learn(np.frombuffer(row["buckets"], np.int32), row["label"], row["weight"])
        w = learner.weights(np.arange(len(learner.z)))
        at = np.flatnonzero(w)
        yield batch_of(schema, bucket=at.astype(np.int32), w=w[at])

    relative = sample.withColumn("weight", F.col("weight") / F.lit(mean_weight(sample)))
    rows = feature_rows(relative).withColumn("epoch", F.explode(F.sequence(F.lit(1), F.lit(epochs))))
    stream = in_one_task(rows, F.col("epoch"), F.xxhash64("doc_id", "epoch"), F.col("doc_id"))
    return {row["bucket"]: row["w"] for row in stream.mapInArrow(run, "bucket int, w double").collect()}


def score(documents: DataFrame, weights: dict[int, float], remainder: int = 0) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    small_batches(documents.sparkSession)
    size = 1 << BITS
    places = np.array(sorted(k for k in weights if k < size), np.int32)
    model = documents.sparkSession.sparkContext.broadcast(
        (places, np.array([weights[int(k)] for k in places]), weights.get(size, 0.0))
    )
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, values, intercept = model.value
        table = np.zeros(size)
        table[at] = values
        for batch in batches:
            for texts in text_chunks(batch["text"], word_bytes=LETTER_BYTES):
                buckets, docs = features(texts)
                hits = np.flatnonzero(table[buckets])  # few weights are left, so few hits are
                keys = np.unique((docs[hits].astype(np.int64) << BITS) | buckets[hits])
                sums = np.bincount(keys >> BITS, table[keys & (size - 1)], len(texts)) + intercept
                own = batch.slice(texts.row, len(texts))
                yield batch_of(
                    schema,
                    doc_id=own["doc_id"],
                    held_out=own["held_out"],
                    score=1 / (1 + np.exp(-np.clip(sums, -35, 35))),
                )

    source = by_place(documents, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id", remainder).alias("held_out"), "text"
    )
    scored = source.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    weights = train(labelled_sample(documents, labels, "toxic", PER_CLASS))
    return score(documents, weights)
