from __future__ import annotations

import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from fareweather.llm import bpe, packing
from tests.llm.fixtures import documents, no_documents, odd_documents, texts, words

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_parts_give_the_same_ids(library, monkeypatch):
    monkeypatch.setattr(bpe, "PART", 8)
    monkeypatch.setattr(bpe, "LONG_SPACE", 5)
    monkeypatch.setattr(bpe, "_SPACE", regex.compile(r"\p{White_Space}{5,}"))
    codec = bpe.Codec(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    dice = random.Random(1)
    pieces = ["a", "é", "'s", "'", "s", "t", " ", "  ", "\n", "\t", "1", "½", "!", "-", "日本", "ll", "'ll", "     ", "　", "\x1f", "​", "🙂"]
    for _ in range(5000):
        text = "".join(dice.choice(pieces) for _ in range(dice.randint(0, 40)))
        assert codec.encode(text) == library.encode_ordinary(text)
        assert codec.decode(codec.encode(text)) == text.encode()


@pytest.mark.parametrize("text", ["a" * 300_000, " " * 1_500_000 + "x", "\n" * 1_500_000, "x " * 100_000, "!" * 50_000, "日本" * 50_000])
def test_long_texts_come_back(text):
    codec = bpe.codec_of(bpe.read_ranks(PATH), public_tokenizers.PATTERN)
    assert codec.decode(codec.encode(text)) == text.encode()


def test_bpe_rows(spark, library):
    odd = odd_documents(spark)
    rows = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(odd, PATH, public_tokenizers.PATTERN).collect()}
    expected = set()
    for r in odd.select("doc_id", "text").collect():
        ids = library.encode_ordinary(r["text"] or "")
        digests = (hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest())
        expected.add((r["doc_id"], len(ids), *digests))
    assert rows == expected
    assert bpe.digests(no_documents(spark), PATH, public_tokenizers.PATTERN).count() == 0


def test_encode_then_decode(spark):
    ids = bpe.encode(documents(spark), PATH, public_tokenizers.PATTERN)
    back = bpe.decode(ids, PATH, public_tokenizers.PATTERN)
    assert {r["doc_id"]: bytes(r["bytes"]).decode() for r in back.collect()} == {i: t or "" for i, t in enumerate(texts())}


def test_rank_file_has_a_bound(monkeypatch):
    monkeypatch.setattr(bpe, "MAX_RANK_BYTES", 1000)
    with pytest.raises(ValueError):
        bpe.read_ranks(PATH)


# --- packing ----------------------------------------------------------------------------------


def placed(counts: dict[int, int], capacities: tuple[int, ...]):
    """Each piece's length, bin, offset and capacity, by the plan."""
    plan = packing.plan_bins(counts, capacities).arrays(capacities)
    segments = plan["segments"]
    for length, n in counts.items():
        for rank in range(n):
            own = segments[np.searchsorted(segments[:, 0] << 40 | segments[:, 1], length << 40 | rank, "right") - 1]
            within = rank - own[1]
            place = own[2] + within // own[3]
            yield length, place, own[4] + within % own[3] * length, plan["capacity"][np.searchsorted(plan["first"], place, "right") - 1]


def check_bins(rows, capacities) -> float:
    """Bins are filled without a gap and as small as may be; returns the share that is filled."""
    bins: dict[int, list[tuple[int, int, int]]] = {}
    for length, place, offset, capacity in rows:
        bins.setdefault(place, []).append((offset, length, capacity))
    total = room = 0
    for items in bins.values():
        end = 0
        for offset, length, _ in sorted(items):
            assert offset == end
            end += length
        assert {capacity for _, _, capacity in items} == {min(c for c in capacities if c >= end)}
        total, room = total + end, room + items[0][2]
    assert sorted(bins) == list(range(len(bins)))
    return total / max(room, 1)


def test_plans_are_sound():
    random = np.random.default_rng(0)
    for _ in range(150):
        capacities = tuple(sorted(set(random.integers(5, 60, 3).tolist())))
        lengths = random.integers(1, max(capacities) + 1, random.integers(1, 40))
        counts = {int(length): int(random.integers(1, 30)) for length in lengths}
        check_bins(placed(counts, capacities), capacities)


def one_by_one(counts: dict[int, int], capacity: int) -> int:
    """Best fit by falling length, piece by piece: how many bins it takes."""
    rooms: list[int] = []
    for length in sorted((length for length, n in counts.items() for _ in range(n)), reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms)


def test_one_capacity_is_best_fit_by_falling_length():
    random = np.random.default_rng(1)
    for _ in range(60):
        counts = {int(length): int(random.integers(1, 9)) for length in random.integers(1, 41, 15)}
        assert len({place for _, place, _, _ in placed(counts, (40,))}) == one_by_one(counts, 40)


def test_no_pieces_no_plan():
    assert packing.plan_bins({}).segments == []


def test_packed_documents(spark, monkeypatch):
    monkeypatch.setattr(packing, "PIECES_PER_DEAL", 20)
    odd = odd_documents(spark)
    capacities = (64, 256, 1024)
    rows = packing.pack(odd, capacities).collect()
    assert check_bins(((r["n_tokens"], r["bin_id"], r["bin_offset"], r["bin_capacity"]) for r in rows), capacities) > 0.9
    by_doc: dict = {}
    for r in rows:
        if r["doc_id"] is not None and r["doc_id"] >= 4:
            by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["n_tokens"]))
    for i, text in enumerate(texts()):
        if i >= 4:
            tokens = len(words(text)) + 1
            assert sorted(by_doc[i]) == [(k, min(1024, tokens - 1024 * k)) for k in range(-(-tokens // 1024))]
    assert sum(r["n_tokens"] for r in rows) == sum(len(words(r["text"])) + 1 for r in odd.select("text").collect())
    assert packing.pack(no_documents(spark)).count() == 0


def test_packing_does_not_depend_on_partitions(spark):
    one = packing.pack(documents(spark).coalesce(1)).orderBy("doc_id", "piece").collect()
    many = packing.pack(documents(spark).repartition(7, F.col("text"))).orderBy("doc_id", "piece").collect()
    assert one == many
