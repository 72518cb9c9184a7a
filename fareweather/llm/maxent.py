"""Language-model scoring by a hashed maximum-entropy model with class-factored softmax.

Counts of all training words come first; they give the base score, and the units that the model
predicts: the end of a text, the ``HEAD`` most frequent words, and ``SUFFIXES`` classes of all
other words by their last two bytes. Units are put into classes of ``WIDTH`` by frequency. The
model is a softmax over classes and one over the units of a class; both sum the weights of
features of the three units before: the last one (n-gram of two), the last two (of three), and
single units further back (skips; the third one for the class only). A rare word's probability is
that of its suffix class times its smoothed share of the class's counts, so every text has a
probability.

Training goes over the training documents once, in ``ROUNDS`` rounds. In a round every task takes
gradient steps on its own documents from the same weights; Spark sums the changes of each row of
weights, weighted by how often the row was touched, and the mean is the next round's start. What
a task sends is the size of the model, whatever the size of the corpus.

Counts are too many to broadcast. The ``FREQUENT`` most frequent words at most go to every task,
which settles most of a text there; other words of a document meet their counts by a join on the
word's hash, each distinct word of a document once.

Defined cases: a null, empty or blank text is the end alone; without training rows all counts are
zero and the model is uniform; rows without an id are held out; repeated rows are scored each;
very long texts count whole; words equally frequent at the edge of the head are taken in the order
of their hashes; an empty table gives an empty result; other columns are never read, whatever their
names. Counts are exact up to collisions of 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareweather.llm.tasks import batch_of, by_place, held_out, small_batches, stored
from fareweather.llm.text import Texts, mix, signed, text_chunks

WIDTH = 32
CLASSES = 32
UNITS = WIDTH * CLASSES
SUFFIXES = 256
HEAD = UNITS - SUFFIXES - 1
END = 0
PAIR_BITS = 13
INNER_BITS = 15
FREQUENT = 1 << 18
ROUNDS = 2
STEP_TOKENS = 8192
RATE = 0.35
SLICES = 64
WORDS_AT_ONCE = 2_500_000
LEVELS_PER_DOUBLING = 16

#: Rows of the weights: a bias, three single units, a pair of units; then those within classes.
OUTER_ROWS = 1 + 3 * UNITS + (1 << PAIR_BITS)
ROWS = OUTER_ROWS + CLASSES + (1 << INNER_BITS)

_FOLD = np.arange(256, dtype=np.int64)
_FOLD[65:91] += 32


def suffixes(texts: Texts) -> np.ndarray:
    """The suffix class of every word."""
    _, end = texts.bounds
    last = _FOLD[texts.data[end - 1]]
    before = np.where(end - texts.bounds[0] > 1, _FOLD[texts.data[np.maximum(end - 2, 0)]], 0)
    return (mix((last * 256 + before).astype(np.uint64), 71) >> np.uint64(32)).astype(np.int64) % SUFFIXES


# --- counts --------------------------------------------------------------------------------


def word_counts(training: DataFrame) -> DataFrame:
    """``h`` (a word's hash), its suffix class and count ``c`` over the training texts."""
    schema = pa.schema([("h", pa.int64()), ("suffix", pa.int32()), ("c", pa.int64())])

    def totals(parts: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
        values, first, counts = np.unique(np.concatenate([p[0] for p in parts]), return_index=True, return_counts=True)
        return batch_of(schema, h=signed(values), suffix=np.concatenate([p[1] for p in parts])[first].astype(np.int32), c=counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, words = [], 0
        for batch in batches:
            for texts in text_chunks(batch["text"]):
                parts.append((texts.word_hashes(lower=True), suffixes(texts).astype(np.int16)))
                words += len(parts[-1][0])
                if words >= WORDS_AT_ONCE:
                    yield totals(parts)
                    parts, words = [], 0
        if words:
            yield totals(parts)

    counted = training.select("text").mapInArrow(run, "h long, suffix int, c long")
    return counted.groupBy("h").agg(F.max("suffix").alias("suffix"), F.sum("c").alias("c"))


@dataclass(frozen=True)
class Lexicon:
    """What every task knows of the counts."""

    texts: int  # training texts, and so the count of the end
    tokens: int  # N
    types: int  # V
    words: np.ndarray  # hashes of the frequent words, in order
    counts: np.ndarray
    units: np.ndarray  # unit of each frequent word; a suffix class if it isn't in the head
    suffix_unit: np.ndarray
    tail: np.ndarray  # log10 of what a count of a suffix class is divided by

    @property
    def base(self) -> float:
        """log10 of what a count is divided by."""
        return math.log10(self.tokens + 0.5 * (self.types + 1))


def lexicon_of(counts: DataFrame, texts: int) -> Lexicon:
    """From sums and a histogram, so that no more than ``FREQUENT`` words reach the driver."""
    level = F.floor(F.log2("c") * LEVELS_PER_DOUBLING).cast("int")
    by_level = counts.groupBy(level.alias("level")).agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()
    lowest, room = 1 << 30, FREQUENT
    for row in sorted(by_level, key=lambda row: -row["level"]):
        room -= row["n"]
        if room < 0:
            break
        lowest = row["level"]
    table = counts.filter(level >= lowest).select("h", "suffix", "c").toArrow()
    h, suffix, c = (table[name].to_numpy() for name in ("h", "suffix", "c"))
    order = np.lexsort((h, -c))
    head = order[:HEAD]
    in_head = np.zeros(len(h), bool)
    in_head[head] = True

    by_suffix = counts.groupBy("suffix").agg(F.count("*").alias("n"), F.sum("c").alias("c")).collect()
    types, tokens = np.zeros(SUFFIXES), np.zeros(SUFFIXES)
    for row in by_suffix:
        types[row["suffix"]], tokens[row["suffix"]] = row["n"], row["c"]
    all_words, all_tokens = int(types.sum()), int(tokens.sum())
    types -= np.bincount(suffix[head], minlength=SUFFIXES)
    tokens -= np.bincount(suffix[head], c[head], SUFFIXES)

    # The end is unit 0; all others follow by falling count, so that classes hold units of like frequency.
    sizes = np.concatenate([c[head], np.zeros(HEAD - len(head)), tokens])
    unit = np.empty(len(sizes), np.int64)
    unit[np.argsort(-sizes, kind="stable")] = np.arange(1, UNITS)
    suffix_unit = unit[HEAD:]
    units = suffix_unit[suffix]
    units[head] = unit[: len(head)]
    by_hash = np.argsort(h.view(np.uint64))
    return Lexicon(
        texts,
        all_tokens + texts,
        all_words + (texts > 0),
        h.view(np.uint64)[by_hash],
        c[by_hash],
        np.where(in_head, units, units + UNITS)[by_hash].astype(np.int32),
        suffix_unit.astype(np.int32),
        np.log10(tokens + 0.5 * (types + 1)),
    )


# --- the model ------------------------------------------------------------------------------


@dataclass
class Tokens:
    """The tokens of some documents: words and an end each."""

    unit: np.ndarray
    doc: np.ndarray
    context: tuple[np.ndarray, ...]


def tokens_of(texts: Texts, word_unit: np.ndarray) -> Tokens:
    n = len(word_unit) + len(texts)
    unit = np.zeros(n, np.int32)
    unit[np.arange(len(word_unit)) + texts.word_doc] = word_unit
    doc = np.repeat(np.arange(len(texts)), texts.n_words + 1)
    place = np.arange(n) - (texts.first_word[:-1] + np.arange(len(texts)))[doc]
    context = []
    for back in (1, 2, 3):
        before = np.zeros(n, np.int32)
        before[back:] = unit[:-back] if n > back else unit[:0]
        before[place < back] = END
        context.append(before)
    return Tokens(unit, doc, tuple(context))


def rows_of(t: Tokens, some: slice) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Weight rows of each token's features, for its class and for the unit within."""
    one, two, *further = (c[some].astype(np.int64) for c in t.context)
    pair = (mix((one * UNITS + two).astype(np.uint64), 81) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)
    outer = [np.zeros(len(one), np.int64), 1 + one, 1 + UNITS + two, 1 + 3 * UNITS + pair]
    outer += [1 + (2 + i) * UNITS + unit for i, unit in enumerate(further)]
    kind = t.unit[some].astype(np.int64) // WIDTH
    inner = [OUTER_ROWS + kind]
    for i, unit in enumerate((one, two)):
        code = mix(((i * CLASSES + kind) * UNITS + unit).astype(np.uint64), 82)
        inner.append(OUTER_ROWS + CLASSES + (code >> np.uint64(64 - INNER_BITS)).astype(np.int64))
    return outer, inner


_ONES = np.ones(WIDTH, np.float32)


def logits(w: np.ndarray, rows: list[np.ndarray]) -> np.ndarray:
    """Sums of the rows of weights; weights stay far from where float32 overflows, but for safety's sake."""
    z = w.take(rows[0], axis=0)
    for r in rows[1:]:
        z += w.take(r, axis=0)
    return np.minimum(z, 80, out=z)


def unit_log_probs(w: np.ndarray, t: Tokens) -> np.ndarray:
    """log10 of the probability of each token's unit."""
    out = np.empty(len(t.unit))
    for first in range(0, len(out), STEP_TOKENS):
        some = slice(first, first + STEP_TOKENS)
        unit = t.unit[some]
        at, total = np.arange(len(unit)), 0.0
        for rows, target in zip(rows_of(t, some), (unit // WIDTH, unit % WIDTH)):
            z = logits(w, rows)
            total = total + z[at, target] - np.log(np.exp(z, out=z.copy()) @ _ONES)
        out[some] = total
    return out / math.log(10)


class Learner:
    """Gradient steps with one rate per row of weights, falling with the row's gradients."""

    def __init__(self, w: np.ndarray):
        self.start, self.w = w, w.copy()
        self.seen = np.full(ROWS, 1e-6, np.float32)
        self.touched = np.zeros(ROWS)

    def learn(self, t: Tokens) -> None:
        for first in range(0, len(t.unit), STEP_TOKENS):
            some = slice(first, first + STEP_TOKENS)
            outer, inner = rows_of(t, some)
            unit = t.unit[some]
            for rows, target in ((outer, unit // WIDTH), (inner, unit % WIDTH)):
                slope = logits(self.w, rows)
                np.exp(slope, out=slope)
                slope *= (1 / (slope @ _ONES))[:, None]
                slope[np.arange(len(unit)), target] -= 1
                for r in rows:
                    self.step(r, slope)

    def step(self, rows: np.ndarray, slope: np.ndarray) -> None:
        if rows[0] == rows[-1] and (rows == rows[0]).all():
            at, n, total = rows[:1], np.array([len(rows)]), (np.ones(len(rows), np.float32) @ slope)[None]
        else:
            order = np.argsort(rows.astype(np.uint16), kind="stable")  # ROWS fits, and 16 bits sort fast
            own = rows[order]
            first = np.flatnonzero(np.diff(own, prepend=own[0] - 1))
            total = np.add.reduceat(slope.take(order, axis=0), first, axis=0)
            at, n = own[first], np.diff(np.append(first, len(own)))
        total = total / np.sqrt(n, dtype=np.float32)[:, None]
        self.seen[at] += (total * total).sum(axis=1) / 2
        self.w[at] -= RATE * total / np.sqrt(self.seen[at])[:, None]
        self.touched[at] += n


def change_rows(learner: Learner) -> Iterator[tuple[int, bytes]]:
    """The weighted change of each slice of the weights, and its weights."""
    change = (learner.w - learner.start) * learner.touched[:, None]
    both = np.hstack([change, learner.touched[:, None]]).astype(np.float32)
    for i, part in enumerate(np.array_split(both, SLICES)):
        if part[:, -1].any():
            yield i, part.tobytes()


class Lookup:
    """The frequent words' places by hash: a table by leading bits, then neighbouring slots in turn."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon = lexicon
        self.bits = max(8, int(4 * len(lexicon.words) + 1).bit_length())
        self.slot = np.full(1 << self.bits, -1, np.int32)
        waiting, at = np.arange(len(lexicon.words)), self._home(lexicon.words)
        self.tries = 0
        while len(waiting):
            free = self.slot[at] < 0
            self.slot[at[free]] = waiting[free]  # of several for one slot the last stays
            seated = self.slot[at] == waiting
            waiting, at = waiting[~seated], (at[~seated] + 1) & (len(self.slot) - 1)
            self.tries += 1

    def _home(self, words: np.ndarray) -> np.ndarray:
        return (words >> np.uint64(64 - self.bits)).astype(np.int64)

    def places(self, words: np.ndarray) -> np.ndarray:
        """Where each word is in the lexicon, or -1."""
        out = np.full(len(words), -1, np.int64)
        if not len(self.lexicon.words):
            return out
        open_words, at = np.arange(len(words)), self._home(words)
        for _ in range(self.tries):
            slot = self.slot[at]
            hit = (slot >= 0) & (self.lexicon.words[np.maximum(slot, 0)] == words[open_words])
            out[open_words[hit]] = slot[hit]
            more = ~hit & (slot >= 0)
            open_words, at = open_words[more], (at[more] + 1) & (len(self.slot) - 1)
        return out


_lookups: dict[int, Lookup] = {}


def lookup_of(lexicon: Lexicon) -> Lookup:
    """The lookup of a lexicon, built once for each Python worker that holds it."""
    if id(lexicon) not in _lookups:
        _lookups.clear()
        _lookups[id(lexicon)] = Lookup(lexicon)
    return _lookups[id(lexicon)]


def units_of(texts: Texts, lexicon: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each word's unit, its count (-1 if it isn't known here), its suffix class, and its hash."""
    hashes, suffix = texts.word_hashes(lower=True), suffixes(texts)
    at = lookup_of(lexicon).places(hashes)
    if not len(lexicon.words):
        return lexicon.suffix_unit[suffix], at, suffix, hashes
    count, unit = np.where(at >= 0, lexicon.counts[at], -1), np.where(at >= 0, lexicon.units[at], UNITS)
    return np.where(unit < UNITS, unit, lexicon.suffix_unit[suffix]), count, suffix, hashes


def train(training: DataFrame, lexicon: Lexicon) -> np.ndarray:
    """The weights after ``ROUNDS`` rounds; every training text is used in one of them."""
    spark = training.sparkSession
    known = spark.sparkContext.broadcast(lexicon)
    schema = pa.schema([("slice", pa.int32()), ("part", pa.binary())])
    weights = np.zeros((ROWS, WIDTH), np.float32)
    turn = F.pmod(F.xxhash64("doc_id"), F.lit(ROUNDS))

    for current in range(ROUNDS):
        start = spark.sparkContext.broadcast(weights)

        def learn(batches: Iterator[pa.RecordBatch], start=start) -> Iterator[pa.RecordBatch]:
            learner = None
            for batch in batches:
                for texts in text_chunks(batch["text"]):
                    learner = learner or Learner(start.value)
                    learner.learn(tokens_of(texts, units_of(texts, known.value)[0]))
            for i, part in change_rows(learner) if learner else ():
                yield batch_of(schema, slice=[i], part=[part])

        def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for i, part in zip(batch["slice"].to_pylist(), batch["part"].to_pylist()):
                    own = np.frombuffer(part, np.float32).astype(float)
                    sums[i] = sums[i] + own if i in sums else own
            for i, total in sums.items():
                yield batch_of(schema, slice=[i], part=[total.astype(np.float32).tobytes()])

        kind = "slice int, part binary"
        changes = training.filter(turn == current).select("text").mapInArrow(learn, kind)
        found = changes.mapInArrow(add, kind).repartition("slice").mapInArrow(add, kind).collect()
        change = [np.zeros((len(part), WIDTH + 1), np.float32) for part in np.array_split(weights, SLICES)]
        for row in found:
            change[row["slice"]] = np.frombuffer(row["part"], np.float32).reshape(-1, WIDTH + 1)
        total = np.concatenate(change)
        weights = weights + total[:, :-1] / np.maximum(total[:, -1:], 1)
        start.unpersist()
    return weights


# --- scores ---------------------------------------------------------------------------------


def score(documents: DataFrame, lexicon: Lexicon, weights: np.ndarray, counts: DataFrame, remainder: int = 1) -> DataFrame:
    """Base score, model score and token counts of every document."""
    shared = documents.sparkSession.sparkContext.broadcast((lexicon, weights))
    names = [("row", "long"), ("doc_id", "long"), ("held_out", "boolean"), ("n_tokens", "long"), ("n_known", "long")]
    names += [("base_score", "double"), ("score", "double"), ("rest", "array<struct<h:long,n:int,suffix:int>>")]
    entry = pa.struct([("h", pa.int64()), ("n", pa.int32()), ("suffix", pa.int32())])
    schema = pa.schema(
        [("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64())]
        + [("base_score", pa.float64()), ("score", pa.float64()), ("rest", pa.list_(entry))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, w = shared.value
        for batch in batches:
            for texts in text_chunks(batch["text"]):
                unit, count, suffix, hashes = units_of(texts, lex)
                t = tokens_of(texts, unit)
                n, doc = len(texts), texts.word_doc
                here = count >= 0
                logs = np.log10(np.maximum(count, 0) + 0.5)
                base = np.bincount(doc[here], logs[here], n) + np.log10(lex.texts + 0.5) - lex.base * (texts.n_words + 1)
                model = np.bincount(t.doc, unit_log_probs(w, t), n)
                in_class = lex.suffix_unit[suffix] == unit
                model -= np.bincount(doc[in_class], lex.tail[suffix[in_class]], n)
                model += np.bincount(doc[in_class & here], logs[in_class & here], n)
                known = np.bincount(doc[count > 0], minlength=n) + (lex.texts > 0)
                yield batch_of(
                    schema,
                    row=batch["row"].slice(texts.row, n),
                    doc_id=batch["doc_id"].slice(texts.row, n),
                    held_out=batch["held_out"].slice(texts.row, n),
                    n_tokens=texts.n_words + 1,
                    n_known=known,
                    base_score=base,
                    score=model,
                    rest=rest_of(entry, n, doc[~here], hashes[~here], suffix[~here]),
                )

    source = by_place(documents, "doc_id", "text").select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        held_out("doc_id", remainder).alias("held_out"),
        "text",
    )
    scored = source.mapInArrow(run, ", ".join(" ".join(name) for name in names))
    return summed(scored, counts, lexicon)


def rest_of(entry: pa.DataType, n: int, doc: np.ndarray, hashes: np.ndarray, suffix: np.ndarray) -> pa.Array:
    """Each document's distinct words that still need their counts."""
    order = np.lexsort((hashes, doc))
    doc, hashes, suffix = doc[order], hashes[order], suffix[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    first = np.flatnonzero(new)
    times = np.diff(np.append(first, len(doc))).astype(np.int32)
    parts = [pa.array(signed(hashes[first])), pa.array(times), pa.array(suffix[first].astype(np.int32))]
    ends = np.searchsorted(doc[first], np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays(parts, fields=list(entry)))


def summed(scored: DataFrame, counts: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Add the words that had to meet their counts; a document's own numbers travel with its first one."""
    own = ["n_tokens", "n_known", "base_score", "score"]
    is_first = F.coalesce(F.col("pos"), F.lit(0)) == 0
    rows = scored.select("row", "doc_id", "held_out", *own, F.posexplode_outer("rest").alias("pos", "w")).select(
        "row", "doc_id", "held_out", *[F.when(is_first, F.col(name)).otherwise(F.lit(0)).alias(name) for name in own],
        F.coalesce("w.h", F.xxhash64("row")).alias("h"),  # else all documents without such words would meet in one task
        F.coalesce("w.n", F.lit(0)).alias("n"),
    )
    log = F.log10(F.coalesce("c", F.lit(0)) + 0.5) * F.col("n")
    return (
        rows.join(counts.select("h", "c"), "h", "left")
        .groupBy("row")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("held_out").alias("held_out"),
            F.sum("n_tokens").alias("n_tokens"),
            F.sum(F.col("n_known") + F.when(F.col("c") > 0, F.col("n")).otherwise(0)).cast("long").alias("n_known"),
            F.sum(F.col("base_score") + log).alias("base_score"),
            F.sum(F.col("score") + log).alias("score"),
        )
        .select(
            "doc_id",
            "held_out",
            "n_tokens",
            "n_known",
            F.lit(lexicon.tokens).cast("long").alias("train_tokens"),
            "base_score",
            "score",
        )
    )


def lm_scores(documents: DataFrame, remainder: int = 1) -> DataFrame:
    """Learn from all rows whose crc32 remainder is not ``remainder``, then score all rows."""
    small_batches(documents.sparkSession)
    documents = by_place(documents, "doc_id", "text")
    texts = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    training = texts.filter(~held_out("doc_id", remainder))
    counts = stored(word_counts(training))
    lexicon = lexicon_of(counts, training.count())
    return score(documents, lexicon, train(training, lexicon), counts, remainder)


def op7_maxent_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))
