"""Secret scans: fixed patterns, and values in credential contexts that are expensive to guess.

The base kinds are patterns: ``assign`` (a credential's name and its value), ``access`` (access
key ids) and ``hex`` (long hexadecimal runs). The method adds ``guess``: a value behind a wider
set of credential names, with any characters but white space and quotes, whose guess cost is at
least ``LEAST_COST``.

The guess cost of a value is the log10 of the guesses that its cheapest segmentation needs, found
by dynamic programming over its characters. Segments are words (by their rank in the corpus, with
capitals and look-alike digits), dates, repeats of a short block, walks over neighbouring keys,
and single characters by brute force. ``password1234`` costs little, a random value a lot, and so
prose behind the word "token" is no secret.

The words are the ``WORDS`` most frequent ones of all texts, counted over the whole corpus: tasks
add up their counts before the shuffle, and only the finished list, of fixed length, goes to the
driver and is broadcast. Scanning is one pass without a shuffle: whole Arrow columns are searched
by RE2 for any sign of a secret, and only texts that have one are looked at closely.

Defined cases: a null or empty text has no spans; offsets are code points, ends exclusive; spans
of different kinds may overlap, those of one kind don't; ties of start follow the order of
``KINDS``; texts and values count whole, however long; repeated rows get a row each; a null id
stays null; other columns are not read, whatever their names; a table without rows gives no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareweather.llm.tasks import by_place, small_batches, stored
from fareweather.llm.text import hash_spans, signed, text_chunks

KINDS = ("assign", "access", "hex", "guess")

# The base patterns and the least length of what they find.
ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # of greedy runs the same ones as of any length, then at least 24
LEAST_ASSIGNED, LEAST_ACCESS = 6, 20

#: Names of credentials, what may stand between a name and its value, and the value.
NAMES = r"pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|private|auth|client)[_-]?(?:key|secret|token)|credentials?|bearer"
CONTEXT = re.compile(
    rf"(?<![a-z])(?:{NAMES})[\"'`]?(?:\x20*(?::=|=>|[:=])\x20*|\x20(?:is|was)\x20)[\"'`]?([^\x00-\x20\"'`<>]+)",
    re.IGNORECASE | re.ASCII,
)
CLOSING = ".,;:!?)]}"
#: RE2 finds these in every text that any of the patterns matches.
SIGN = r"(?i:pass|pwd|secret|token|key|credential|bearer)|AKIA[A-Z0-9]|[0-9a-f]{24}"

#: Values cheaper than 10 ** LEAST_COST guesses are no secrets.
LEAST_COST = 10.0
#: Words that guessing starts with; the list's fixed length bounds what is broadcast.
WORDS = 1 << 14
LONGEST_WORD = 24
#: Words counted by a task before its sums leave it.
WORDS_AT_ONCE = 1 << 21

SPANS = "array<struct<kind:string,start:bigint,end:bigint,cost:double>>"
_SPAN_TYPE = pa.list_(
    pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("cost", pa.float64())])
)

_LETTERS = np.zeros(256, bool)
_LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True

# Digits and signs that stand for letters, rows of keys, and how wide the classes are.
LOOK_ALIKE = str.maketrans("013457@$", "oleastas")
KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")
WIDTHS = ((str.isdigit, 10), (str.islower, 26), (str.isupper, 26))
OTHER_WIDTH = 33
#: What it takes to try one kind of segment after the other.
KIND_COST = math.log10(5)
YEARS_AROUND, LEAST_YEARS = 2020, 20

DATE = re.compile(r"(\d{4})([-/._]?)(\d{1,2})\2(\d{1,2})|(\d{1,2})([-/._]?)(\d{1,2})\6(\d{4}|\d{2})", re.ASCII)
YEAR = re.compile(r"(?:19|20)\d\d", re.ASCII)


def frequent_words(texts: DataFrame, size: int = WORDS) -> list[str]:
    """The most frequent words of three letters or more in all texts, lower-cased A to Z, in order."""
    small_batches(texts.sparkSession)

    def totals(held: dict[str, list]) -> pa.RecordBatch:
        table = pa.table({"w": pa.chunked_array(held["w"]), "c": pa.chunked_array(held["c"])})
        summed = table.group_by("w").aggregate([("c", "sum")])
        return pa.RecordBatch.from_arrays(
            [summed["w"].combine_chunks().cast(pa.string()), summed["c_sum"].combine_chunks().cast(pa.int64())], ["w", "c"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {"w": [], "c": []}
        rows = 0
        for batch in batches:
            for chunk in text_chunks(batch["text"], word_bytes=_LETTERS):
                words, counts = _chunk_words(chunk)
                held["w"].append(words)
                held["c"].append(counts)
                rows += len(words)
                if rows >= WORDS_AT_ONCE:
                    yield totals(held)
                    held, rows = {"w": [], "c": []}, 0
        if rows:
            yield totals(held)

    counted = stored(texts.mapInArrow(run, "w string, c long").groupBy("w").agg(F.sum("c").alias("c")))
    # Only words of the steps of frequency that hold the first ``size`` ones go to the driver.
    step = F.floor(8 * F.log2("c")).cast("int")
    left, lowest = size, 0
    for row in sorted(counted.groupBy(step.alias("step")).count().collect(), reverse=True):
        lowest, left = row["step"], left - row["count"]
        if left <= 0:
            break
    return [row["w"] for row in counted.filter(step >= lowest).orderBy(F.col("c").desc(), "w").limit(size).collect()]


def _chunk_words(chunk) -> tuple[pa.Array, pa.Array]:
    """The different words of some texts and how often they occur there."""
    start, end = chunk.bounds
    fits = (end - start >= 3) & (end - start <= 4 * LONGEST_WORD)
    start, end = start[fits], end[fits]
    _, first, counts = np.unique(signed(hash_spans(chunk.data, start, end, lower=True)), return_index=True, return_counts=True)
    body = chunk.data.tobytes()
    words = [body[s:e].decode("utf-8", "replace") for s, e in zip(start[first].tolist(), end[first].tolist())]
    return pc.ascii_lower(pa.array(words, pa.string())), pa.array(counts, pa.int64())


def segments(value: str, ranks: Mapping[str, int]) -> Iterator[tuple[int, int, float]]:
    """Every segment that guessing may take ``value`` to be made of: start, end, log10 of its guesses."""
    size = len(value)
    for i, char in enumerate(value):
        yield i, i + 1, brute_cost(char)
    lowered = value.lower()
    plain = lowered.translate(LOOK_ALIKE) if len(lowered) == size else value
    lowered = lowered if len(lowered) == size else value
    for i in range(size):
        for j in range(i + 3, min(size, i + LONGEST_WORD) + 1):
            for letters in {lowered[i:j], plain[i:j]}:
                if letters in ranks:
                    yield i, j, KIND_COST + word_cost(value[i:j], letters, ranks[letters])
    for pattern in (DATE, YEAR):
        for i in range(size):
            found = pattern.match(value, i)
            if found and (cost := date_cost(found)) is not None:
                yield i, found.end(), KIND_COST + cost
    yield from _repeats(value)
    yield from _walks(lowered)


def brute_cost(char: str) -> float:
    return math.log10(next((width for belongs, width in WIDTHS if belongs(char)), OTHER_WIDTH))


def word_cost(written: str, letters: str, rank: int) -> float:
    """By rank; capitals but a first or all, and each look-alike, double the guesses."""
    capitals = sum(map(str.isupper, written))
    plain = capitals == 0 or written.istitle() or written.isupper()
    changed = sum(a != b for a, b in zip(written.lower(), letters))
    return math.log10(rank + 1) + math.log10(2) * ((min(capitals, 1) if plain else capitals) + changed)


def date_cost(found: re.Match) -> float | None:
    """The days of the years around today; a separator is one of four."""
    if found.re is YEAR:
        return math.log10(_years(int(found[0])))
    year, separator, months, days = (found[1], found[2], found[3], found[4]) if found[1] else (found[8], found[6], found[5], found[7])
    a, b = int(months), int(days)
    if not (1 <= a <= 12 and 1 <= b <= 31 or 1 <= b <= 12 and 1 <= a <= 31):
        return None
    number = int(year) + (0 if len(year) == 4 else 2000 if int(year) < 50 else 1900)
    return math.log10(365 * _years(number)) + (math.log10(4) if separator else 0)


def _years(year: int) -> int:
    return max(abs(year - YEARS_AROUND), LEAST_YEARS)


def _repeats(value: str, longest: int = 8) -> Iterator[tuple[int, int, float]]:
    """At each place the longest run of each short block: the block by brute force, and how often."""
    for block in range(1, longest + 1):
        same = 0
        for i in reversed(range(len(value) - block)):
            same = same + 1 if value[i] == value[i + block] else 0
            times = same // block + 1
            if times >= 2 and times * block >= 3:
                cost = sum(map(brute_cost, value[i : i + block]))
                yield i, i + times * block, KIND_COST + cost + math.log10(times)


def _neighbours() -> dict[str, set[str]]:
    at = {key: (row, place + row / 2) for row, keys in enumerate(KEY_ROWS) for place, key in enumerate(keys)}
    return {
        a: {b for b, (r, p) in at.items() if b != a and abs(r - row) <= 1 and abs(p - place) <= 1}
        for a, (row, place) in at.items()
    }


NEIGHBOURS = _neighbours()
STRAIGHT = {keys[i : i + 2] for row in KEY_ROWS for keys in (row, row[::-1]) for i in range(len(row) - 1)}
DIRECTIONS = 6


def _walks(lowered: str) -> Iterator[tuple[int, int, float]]:
    """At each place the longest walk of four neighbouring keys or more: first key, length, steps off a row."""
    end = turns = 0
    for i in reversed(range(len(lowered))):
        step = lowered[i : i + 2]
        if len(step) < 2 or step[1] not in NEIGHBOURS.get(step[0], ()):
            end, turns = i + 1, 0
        elif step not in STRAIGHT:
            turns += 1
        if end - i >= 4:
            yield i, end, KIND_COST + math.log10(len(NEIGHBOURS) * (end - i)) + turns * math.log10(DIRECTIONS)


def guess_cost(value: str, ranks: Mapping[str, int]) -> float:
    """The least sum of costs of segments that make up ``value``."""
    from_here: list[list[tuple[int, float]]] = [[] for _ in value]
    for start, end, cost in segments(value, ranks):
        from_here[start].append((end, cost))
    best = [0.0] + [math.inf] * len(value)
    for i, choices in enumerate(from_here):
        for end, cost in choices:
            best[end] = min(best[end], best[i] + cost)
    return best[-1]


def base_spans(text: str) -> Iterator[tuple[str, int, int, str]]:
    """Kind, start, end and the secret part of what the patterns find."""
    for found in ASSIGN.finditer(text):
        if len(found[2]) >= LEAST_ASSIGNED:
            yield "assign", found.start(), found.end(), found[2]
    for found in ACCESS.finditer(text):
        if len(found[0]) >= LEAST_ACCESS:
            yield "access", found.start(), found.end(), found[0]
    for found in HEX.finditer(text):
        yield "hex", found.start(), found.end(), found[0]


def spans_of(text: str, ranks: Mapping[str, int]) -> list[dict]:
    """All spans of a text in order, each with the guess cost of its secret part."""
    out = [(start, KINDS.index(kind), end, guess_cost(secret, ranks)) for kind, start, end, secret in base_spans(text)]
    for found in CONTEXT.finditer(text):
        value = found[1].rstrip(CLOSING)
        if value and (cost := guess_cost(value, ranks)) >= LEAST_COST:
            out.append((found.start(1), KINDS.index("guess"), found.start(1) + len(value), cost))
    return [{"kind": KINDS[kind], "start": start, "end": end, "cost": cost} for start, kind, end, cost in sorted(out)]


def scan(documents: DataFrame, words: list[str] | None = None) -> DataFrame:
    """``doc_id`` and ``spans`` (kind, start, end, guess cost) of every document.

    ``words`` are those that guessing starts with, the likeliest first; by default the corpus's own.
    """
    source = by_place(documents, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    small_batches(documents.sparkSession)
    listed = frequent_words(source.select("text")) if words is None else words
    ranks = documents.sparkSession.sparkContext.broadcast({word: rank for rank, word in reversed(list(enumerate(listed, 1)))})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch["text"].cast(pa.large_string())
            spans: list[list[dict]] = [[]] * len(text)
            signs = pc.match_substring_regex(text, SIGN).fill_null(False).to_numpy(zero_copy_only=False)
            for row in np.flatnonzero(signs).tolist():
                spans[row] = spans_of(text[row].as_py(), ranks.value)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(spans, _SPAN_TYPE)], ["doc_id", "spans"])

    return source.mapInArrow(run, f"doc_id long, spans {SPANS}")


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))

    def number(kind: str):
        return F.size(F.filter("spans", lambda span: span["kind"] == kind)).cast("long")

    def listed(spans):
        written = F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        )
        return F.array_join(written, ",")

    base = F.filter("spans", lambda span: span["kind"] != "guess")
    weak = F.filter("spans", lambda span: (span["kind"] == "assign") & (span["cost"] < LEAST_COST))
    return found.select(
        "doc_id",
        number("assign").alias("n_assign"),
        number("access").alias("n_access"),
        number("hex").alias("n_hex"),
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
        number("guess").alias("n_guess"),
        F.size(weak).cast("long").alias("n_weak"),
    )
