"""Quality rules under weak supervision.

Each rule looks at the counts of one whole text and votes good (1), bad (-1) or abstains (0). A
two-class model with one table of vote probabilities per rule is fitted by expectation
maximisation to how often each combination of votes occurs in all documents; the posterior
probability of "good" decides, not one rule alone. Nothing is learned from labels.

Spark counts the combinations (at most ``3 ** len(RULES)``, however many documents there are);
the fit itself sees these counts only. Posterior log odds are a sum over the rules, so they are
computed by built-in functions.

Defined cases: a null or empty text has no words, fails the base rule and is not kept; nulls and
clashing names in other columns don't matter, as columns go by place; repeated rows each get their
own row; very long texts count whole; a posterior of exactly one half is kept; a table without rows
gives no rows; where all documents vote alike the prior stays at its start value.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fareweather.llm.tasks import appended, batch_of, by_place, small_batches, stored
from fareweather.llm.text import Texts, counts_in, hash_spans, mix, text_chunks, window_hashes, windows_of

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
MORE_COUNTS = ["n_letters", "n_upper", "n_bare_words", "n_exclaimed", "n_marked", "n_lines"]
COUNT_SCHEMA = pa.schema([("doc_id", pa.int64())] + [(name, pa.int64()) for name in COUNTS + MORE_COUNTS])

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: Votes are bad from the first share on, good up to the second, and abstain between.
SHARES = {
    "symbols": ("n_symbols", "n_words", 0.20, 0.02),
    "capitals": ("n_upper", "n_letters", 0.30, 0.10),
    "bare_words": ("n_bare_words", "n_words", 0.20, 0.05),
    "exclaimed": ("n_exclaimed", "n_words", 0.20, 0.05),
    "marked": ("n_marked", "n_words", 0.25, 0.05),
    "repeats": ("n_repeat_words", "n_words", 0.40, 0.25),
    "copied_lines": ("n_dup_lines", "n_lines", 0.60, 0.40),
}
RULES = [*SHARES, "word_length"]

#: Where the fit starts: the share of good documents, and how often a rule votes bad, abstains
#: and votes good on a document of either class.
PRIOR_GOOD = 0.8
START_BAD = [0.25, 0.15, 0.6]
START_GOOD = [0.005, 0.045, 0.95]

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LETTER = np.zeros(256, bool)
_LETTER[list(range(65, 91)) + list(range(97, 123)) + list(range(0xC3, 0xF5))] = True  # lead bytes count once
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def text_counts(texts: Texts) -> dict[str, np.ndarray]:
    """The counts of some documents."""
    data, offsets = texts.data, texts.offsets
    start, end = texts.bounds
    if not len(data):
        return dict.fromkeys(COUNTS + MORE_COUNTS, np.zeros(len(texts), np.int64))
    leads = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=leads[1:])
    letters = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_LETTER[data], out=letters[1:])
    last = data[end - 1] if len(end) else data[:0]

    def per_doc(of_words: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(of_words) + 1, np.int64)
        np.cumsum(of_words, out=sums[1:])
        return sums[texts.first_word[1:]] - sums[texts.first_word[:-1]]

    lines, copies = line_counts(texts)
    return {
        "n_words": texts.n_words,
        "word_chars": per_doc(leads[end] - leads[start]),
        "n_symbols": counts_in(_SYMBOL[data], offsets),
        "n_dup_lines": copies,
        "n_repeat_words": per_doc(repeated_words(texts, 3)),
        "n_letters": letters[offsets[1:]] - letters[offsets[:-1]],
        "n_upper": counts_in(_UPPER[data], offsets),
        "n_bare_words": per_doc(letters[end] == letters[start]),
        "n_exclaimed": per_doc((last == ord("!")) & (data[np.maximum(end - 2, 0)] == ord("!"))),
        "n_marked": per_doc(_SYMBOL[last] & (letters[end] > letters[start])),
        "n_lines": lines,
    }


def repeated_words(texts: Texts, size: int) -> np.ndarray:
    """The words that lie in a window of ``size`` words found twice or more in their text."""
    starts, docs = windows_of(texts.first_word, size)
    covered = np.zeros(len(texts.word_doc), bool)
    if not len(starts):
        return covered
    keys = mix(window_hashes(texts.word_hashes(), size)[starts] + mix(docs.astype(np.uint64), 3))
    for i in range(size):
        covered[starts[repeats(keys)] + i] = True
    return covered


def repeats(keys: np.ndarray) -> np.ndarray:
    """The places of keys that occur twice or more."""
    order = np.argsort(keys)
    same = keys[order[1:]] == keys[order[:-1]]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return np.flatnonzero(twice)


def line_counts(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word in each document, and those of them equal to an earlier one."""
    breaks = np.flatnonzero(texts.data == 10)
    begin = np.union1d(breaks + 1, texts.offsets[:-1])
    begin = begin[begin < len(texts.data)]
    docs = np.searchsorted(texts.offsets, begin, "right") - 1
    next_break = np.append(breaks, len(texts.data))[np.searchsorted(breaks, begin)]
    end = np.minimum(next_break, texts.offsets[docs + 1])
    has_word = np.searchsorted(texts.bounds[0], end) > np.searchsorted(texts.bounds[0], begin)
    begin, end, docs = begin[has_word], end[has_word], docs[has_word]
    keys = mix(hash_spans(texts.data, begin, end) + mix(docs.astype(np.uint64), 5))
    _, first = np.unique(keys, return_index=True)
    lines = np.bincount(docs, minlength=len(texts))
    return lines, lines - np.bincount(docs[first], minlength=len(texts))


def count_texts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and the counts of every whole text; nothing is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in text_chunks(batch["text"]):
                ids = batch["doc_id"].slice(texts.row, len(texts))
                yield batch_of(COUNT_SCHEMA, doc_id=ids, **text_counts(texts))

    small_batches(df.sparkSession)
    named = by_place(df, id_column, text_column).toDF("doc_id", "text")
    source = named.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return source.mapInArrow(run, ", ".join(f"{field.name} long" for field in COUNT_SCHEMA))


def votes() -> dict[str, Column]:
    """Each rule's vote from the counts of a text."""
    out = {}
    for name, (part, whole, bad, good) in SHARES.items():
        share = F.col(part) / F.greatest(F.col(whole), F.lit(1))
        out[name] = F.when(F.col(whole) == 0, 0).when(share >= bad, -1).when(share <= good, 1).otherwise(0)
    mean = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    out["word_length"] = (
        F.when((mean < 2) | (mean > 20), -1).when((mean >= 3) & (mean <= 12), 1).otherwise(0)
    )
    return out


def fit_votes(
    patterns: np.ndarray, weights: np.ndarray, rounds: int = 200, prior: float = PRIOR_GOOD, strength: float = 0.02
) -> tuple[float, np.ndarray]:
    """Prior of "good" and ``table[rule, class, vote + 1]`` by expectation maximisation.

    ``patterns`` has a row of votes for each combination, ``weights`` says how often it occurs.
    Every rule starts as one whose bad vote is seldom wrong and whose good vote says little, for
    junk of one kind passes the rules against other kinds. Pseudo-votes to that effect, as many
    as ``strength`` times the documents, keep the classes' meaning and rare votes off probability 0.
    """
    rules = patterns.shape[1]
    start = np.empty((rules, 2, 3))
    start[:, 0] = START_BAD
    start[:, 1] = START_GOOD
    table, total = start.copy(), weights.sum()
    if not total:
        return prior, table
    strength *= total
    shown = np.stack([patterns == vote for vote in (-1, 0, 1)], axis=2).astype(float)
    for _ in range(rounds):
        odds = posterior_odds(patterns, prior, table)
        good = 1 / (1 + np.exp(-odds))
        by_class = np.stack([weights * (1 - good), weights * good])
        counts = np.einsum("cp,prv->rcv", by_class, shown) + strength * start
        table = counts / counts.sum(axis=2, keepdims=True)
        prior = float((by_class[1].sum() + strength * PRIOR_GOOD) / (total + strength))
    return prior, table


def posterior_odds(patterns: np.ndarray, prior: float, table: np.ndarray) -> np.ndarray:
    evidence = np.log(table[:, 1] / table[:, 0])
    chosen = np.take_along_axis(evidence[None], patterns[:, :, None] + 1, axis=2)[:, :, 0]
    return np.log(prior / (1 - prior)) + chosen.sum(axis=1)


def fit(counted: DataFrame) -> Column:
    """The posterior probability that a text is good, as an expression over its counts.

    The fit sees how often each combination of votes occurs, at most ``3 ** len(RULES)`` rows.
    """
    voting = votes()
    seen = counted.groupBy(*[voting[name].alias(name) for name in RULES]).agg(F.count("*").alias("weight")).collect()
    patterns = np.array([[row[name] for name in RULES] for row in seen], int).reshape(len(seen), len(RULES))
    prior, table = fit_votes(patterns, np.array([row["weight"] for row in seen], float))
    evidence = np.log(table[:, 1] / table[:, 0])
    odds = F.lit(float(np.log(prior / (1 - prior))))
    for i, name in enumerate(RULES):
        odds = odds + F.element_at(F.array(*[F.lit(float(x)) for x in evidence[i]]), voting[name] + 2)
    return 1 / (1 + F.exp(-odds))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def quality(df: DataFrame) -> DataFrame:
    """The counts, ``base_failed``, ``quality_prob`` and ``kept`` of every document.

    Counts are computed once, by one scan of the texts, and stored: about 100 bytes a document.
    """
    counted = stored(count_texts(df))
    probability = fit(counted)
    return counted.select(
        "doc_id",
        *COUNTS,
        base_failed().alias("base_failed"),
        (~base_failed() & (probability >= 0.5)).alias("kept"),
        probability.alias("quality_prob"),
    )


def keep_good(df: DataFrame) -> DataFrame:
    """The rows of ``df`` that ``quality`` keeps, with their columns as they are.

    The fit takes one scan of the texts, the decision another, so that no row is shuffled.
    """
    probability = fit(count_texts(df))
    counted = appended(df, pa.schema(list(COUNT_SCHEMA)[1:]), text_counts).toDF(
        *[f"c{i}" for i in range(len(df.columns))], *COUNTS, *MORE_COUNTS
    )
    kept = counted.filter(~base_failed() & (probability >= 0.5))
    return kept.select(*[f"c{i}" for i in range(len(df.columns))]).toDF(*df.columns)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(spark.read.parquet(f"{sf_dir}/documents.parquet"))
