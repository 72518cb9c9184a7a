from __future__ import annotations

import numpy as np
import pyarrow as pa

from fareweather.llm.text import distinct_shingles, text_chunks, window_hashes
from tests.llm.fixtures import lower, texts, words


def test_words_and_hashes_follow_the_texts():
    rows = texts()
    seen: dict[str, int] = {}
    for size in (40, 5000, 1 << 20):
        done = 0
        for some in text_chunks(pa.array(rows, pa.string()), size):
            hashes = some.word_hashes(lower=True)
            for i in range(len(some)):
                own = words(lower(rows[done + i] or ""))
                found = hashes[some.first_word[i] : some.first_word[i + 1]]
                assert len(own) == len(found)
                for word, value in zip(own, found.tolist()):
                    assert seen.setdefault(word, value) == value
            done += len(some)
        assert done == len(rows)
    assert len(set(seen.values())) == len(seen)


def test_long_words_are_whole():
    (one,) = text_chunks(pa.array(["x" * 3_000_000 + " y", None]), 1 << 30)
    assert one.n_words.tolist() == [2, 0]
    assert one.word_hashes()[1] == next(text_chunks(pa.array(["y"]))).word_hashes()[0]


def test_windows_of_any_size():
    hashes = np.arange(1, 40, dtype=np.uint64)
    for size in (1, 2, 3, 5, 20, 39):
        found = window_hashes(hashes, size)
        assert len(found) == 40 - size and len(set(found.tolist())) == len(found)
    assert len(window_hashes(hashes, 40)) == 0


def test_shingles_count_as_sets():
    rows = texts()
    for size in (1, 3, 5):
        for some in text_chunks(pa.array(rows, pa.string()), 3000):
            _, offsets = distinct_shingles(some, size, lower=True)
            for i, n in enumerate(np.diff(offsets)):
                own = words(lower(rows[some.row + i] or ""))
                assert n == len({tuple(own[k : k + size]) for k in range(max(1, len(own) - size + 1))} - {()})
