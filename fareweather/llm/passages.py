"""Quality classification by attention-based multiple-instance learning.

A document is a bag of passages: its words are cut into ``ceil(words / PASSAGE_WORDS)`` equal
parts, so every word of every text counts. Only for learning there are at most ``MAX_PASSAGES``,
and the passages of a long document get longer, so that a bag stays bounded. Each passage becomes ``INPUTS`` numbers (shares of
bytes, shares of hashed words, how many of its words are repeats, its length). A tanh layer
encodes it, gated attention weighs it against its bag, and the weighted mean of the codes is
scored by a logistic unit. All weights are learned together from document labels.

Training sees at most ``PER_CLASS`` labelled documents of each class, in one task that holds
their passages (at most ``2 * PER_CLASS * MAX_PASSAGES * INPUTS`` floats). Scoring covers all
rows, batch by batch, and shuffles nothing.

Defined cases: a null, empty or blank text is one passage of zeros and is scored as such; without
labelled rows the model keeps its start weights; rows without an id are held out; repeated rows are scored
alike; a repeated labelled id counts once; very long texts count whole; a score equal to the threshold
is predicted 1; an empty table gives an empty result; other columns are never read, whatever their names.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareweather.llm.samples import in_one_task, labelled_sample
from fareweather.llm.tasks import batch_of, by_place, held_out, small_batches
from fareweather.llm.text import Texts, mix, text_chunks

PASSAGE_WORDS = 64
MAX_PASSAGES = 32
WORD_BUCKETS = 128
INPUTS = 128 + 1 + WORD_BUCKETS + 3
CODE, GATE = 24, 12
PER_CLASS = 1200
EPOCHS = 25
BATCH = 64
THRESHOLD = 0.3


def passages(texts: Texts, most: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Inputs of all passages of some documents, ``most`` of each at most, and where each document's begin."""
    words = texts.n_words
    count = np.clip(-(-words // PASSAGE_WORDS), 1, most)
    first = np.concatenate([[0], np.cumsum(count)])
    docs = texts.word_doc
    within = np.arange(len(docs)) - texts.first_word[docs]
    of_word = first[docs] + within * count[docs] // np.maximum(words[docs], 1)
    total = int(first[-1])
    size = np.maximum(np.bincount(of_word, minlength=total), 1)[:, None]

    start, end = texts.bounds
    length = end - start
    byte = texts.data[np.repeat(start - np.cumsum(length) + length, length) + np.arange(length.sum())]
    of_byte = np.repeat(of_word, length)
    shares = np.bincount(of_byte * 129 + np.minimum(byte, 128), minlength=total * 129).reshape(total, 129)
    hashes = texts.word_hashes()
    bucket = (hashes >> np.uint64(57)).astype(np.int64)
    hashed = np.bincount(of_word * WORD_BUCKETS + bucket, minlength=total * WORD_BUCKETS).reshape(total, WORD_BUCKETS)

    _, seen = np.unique(mix(hashes + mix(docs.astype(np.uint64), 17)), return_index=True)
    fresh = np.bincount(of_word[seen], minlength=total)[:, None]  # words not met before in the document
    n_bytes = np.maximum(shares.sum(axis=1, keepdims=True), 1)
    return np.hstack(
        [
            np.sqrt(shares / n_bytes) * 2,
            np.sqrt(hashed / size),
            fresh / size,
            np.log1p(np.bincount(of_word, minlength=total))[:, None] / 5,
            n_bytes / size / 10,
        ]
    ).astype(np.float32), first


def start_weights(seed: int = 5) -> dict[str, np.ndarray]:
    random = np.random.default_rng(seed)
    shapes = {"E": (INPUTS, CODE), "e": (CODE,), "V": (CODE, GATE), "U": (CODE, GATE), "w": (GATE,), "c": (CODE,), "b": (1,)}
    return {
        name: (random.normal(0, 1 / np.sqrt(shape[0]), shape) if name.isupper() or name in "wc" else np.zeros(shape)).astype(
            np.float32
        )
        for name, shape in shapes.items()
    }


def forward(m: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray) -> dict[str, np.ndarray]:
    """Codes, attention and scores of the bags that ``first`` bounds."""
    code = np.tanh(x @ m["E"] + m["e"])
    tanh, gate = np.tanh(code @ m["V"]), 1 / (1 + np.exp(-(code @ m["U"])))
    raw = (tanh * gate) @ m["w"]
    bag = np.repeat(np.arange(len(first) - 1), np.diff(first))
    exp = np.exp(raw - np.maximum.reduceat(raw, first[:-1])[bag])
    attention = exp / np.add.reduceat(exp, first[:-1])[bag]
    mean = np.add.reduceat(attention[:, None] * code, first[:-1])
    score = 1 / (1 + np.exp(-np.clip(mean @ m["c"] + m["b"], -30, 30)))
    return {"code": code, "tanh": tanh, "gate": gate, "bag": bag, "attention": attention, "mean": mean, "score": score}


def slopes(
    m: dict[str, np.ndarray], x: np.ndarray, first: np.ndarray, label: np.ndarray, weight: np.ndarray
) -> dict[str, np.ndarray]:
    """Gradients of the weighted mean log loss."""
    f = forward(m, x, first)
    code, tanh, gate, bag, attention = (f[k] for k in ("code", "tanh", "gate", "bag", "attention"))
    error = (f["score"] - label) * weight / weight.sum()
    d_mean = error[:, None] * m["c"]
    along = (d_mean[bag] * code).sum(axis=1)
    d_raw = attention * (along - np.add.reduceat(attention * along, first[:-1])[bag])
    d_tanh = d_raw[:, None] * m["w"] * gate * (1 - tanh**2)
    d_gate = d_raw[:, None] * m["w"] * tanh * gate * (1 - gate)
    d_code = attention[:, None] * d_mean[bag] + d_tanh @ m["V"].T + d_gate @ m["U"].T
    d_in = d_code * (1 - code**2)
    return {
        "E": x.T @ d_in,
        "e": d_in.sum(axis=0),
        "V": code.T @ d_tanh,
        "U": code.T @ d_gate,
        "w": (d_raw[:, None] * tanh * gate).sum(axis=0),
        "c": f["mean"].T @ error,
        "b": np.array([error.sum()]),
    }


def fit(bags: list[np.ndarray], label: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Adam over small batches of bags."""
    m = start_weights()
    one = {k: np.zeros_like(v) for k, v in m.items()}
    two = {k: np.zeros_like(v) for k, v in m.items()}
    random, step = np.random.default_rng(6), 0
    for epoch in range(epochs):
        rate = 0.01 * (1 - epoch / epochs) + 0.0005
        for chosen in np.array_split(random.permutation(len(bags)), -(-len(bags) // BATCH)):
            step += 1
            first = np.concatenate([[0], np.cumsum([len(bags[i]) for i in chosen])])
            g = slopes(m, np.concatenate([bags[i] for i in chosen]), first, label[chosen], weight[chosen])
            for k in m:
                slope = (g[k] + 1e-4 * m[k]).astype(np.float32)
                one[k] = 0.9 * one[k] + 0.1 * slope
                two[k] = 0.999 * two[k] + 0.001 * slope * slope
                m[k] -= rate * (one[k] / (1 - 0.9**step)) / (np.sqrt(two[k] / (1 - 0.999**step)) + 1e-8)
    return m


def train(sample: DataFrame) -> dict[str, np.ndarray]:
    """The model for a bounded labelled sample; documents become bags before they meet in one task."""
    small_batches(sample.sparkSession)
    rows = pa.schema([("doc_id", pa.int64()), ("label", pa.int32()), ("weight", pa.float64()), ("bag", pa.binary())])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch["text"]):
                x, first = passages(texts, MAX_PASSAGES)
                own = batch.slice(texts.row, len(texts))
                bags = [x[a:b].tobytes() for a, b in zip(first[:-1], first[1:])]
                yield batch_of(rows, doc_id=own["doc_id"], label=own["label"], weight=own["weight"], bag=bags)

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bags, label, weight = [], [], []
        for batch in batches:
            bags += [np.frombuffer(bag, np.float32).reshape(-1, INPUTS) for bag in batch["bag"].to_pylist()]
            label += batch["label"].to_pylist()
            weight += batch["weight"].to_pylist()
        if not bags:
            return
        file = io.BytesIO()
        np.savez(file, **fit(bags, np.array(label), np.array(weight)))
        yield pa.RecordBatch.from_arrays([pa.array([file.getvalue()], pa.binary())], ["model"])

    encoded = sample.select("doc_id", "label", "weight", "text").mapInArrow(
        encode, "doc_id long, label int, weight double, bag binary"
    )
    stream = in_one_task(encoded, F.xxhash64("doc_id"), F.col("doc_id"))
    found = stream.mapInArrow(learn, "model binary").first()
    if found is None:
        return start_weights()
    with np.load(io.BytesIO(found["model"])) as file:
        return {name: file[name] for name in file.files}


def score(documents: DataFrame, model: dict[str, np.ndarray], remainder: int = 0) -> DataFrame:
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` of every row."""
    small_batches(documents.sparkSession)
    weights = documents.sparkSession.sparkContext.broadcast(model)
    schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch["text"]):
                own = batch.slice(texts.row, len(texts))
                scores = forward(weights.value, *passages(texts))["score"].astype(float)
                yield batch_of(schema, doc_id=own["doc_id"], held_out=own["held_out"], score=scores)

    source = by_place(documents, "doc_id", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id", remainder).alias("held_out"), "text"
    )
    scored = source.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op1_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score(documents, train(labelled_sample(documents, labels, "quality", PER_CLASS)))
