"""Join of token sets by signature trees.

Sets that resemble each other are put side by side (by their least hash), and every ``FAN`` of
them under a node, nodes under nodes likewise. A node holds the OR of its sets' token bitmaps,
the range of their sizes, and how many tokens of a set at most share a bit with another. Two
trees are walked down together: a pair of nodes is dropped if no sets of them could overlap
enough. Where only connected sets are asked for, a pair is also dropped if all its sets are
connected already; nodes are therefore joined with themselves and with their neighbours first.
What is left at the bottom is compared exactly. Groups of any size are joined this way.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

FAN = 8

#: Bytes of bitmaps looked at together.
BLOCK = 8 << 20


@dataclass
class Level:
    bits: np.ndarray  # OR of the bitmaps, a row of words for each node
    low: np.ndarray  # sizes
    high: np.ndarray
    slack: np.ndarray  # the most tokens of a set beyond its bits


def linked(tokens: np.ndarray, offsets: np.ndarray, percent: int, known: np.ndarray | None = None, side: np.ndarray | None = None) -> np.ndarray:
    """Pairs of sets that connect all sets with ``100 * overlap >= percent * union``.

    Set i has the distinct tokens ``tokens[offsets[i]:offsets[i + 1]]``. The result is a forest:
    joined to ``known`` (labels of sets already connected), it connects just what all such pairs
    connect. With ``side``, only sets of different sides (0 and 1) are compared.
    """
    return Join(tokens, offsets, percent, known, side).run()


class Join:
    def __init__(self, tokens, offsets, percent, known, side):
        sizes = np.diff(offsets)
        least = np.minimum.reduceat(tokens, offsets[:-1])
        self.order = np.lexsort((sizes, least)) if side is None else np.lexsort((sizes, least, side))
        self.size = sizes[self.order]
        self.percent = percent
        self.offsets = np.concatenate([[0], np.cumsum(self.size)])
        take = np.repeat(offsets[:-1][self.order] - self.offsets[:-1], self.size) + np.arange(self.offsets[-1])
        hashes = tokens[take]
        self.token = np.unique(hashes, return_inverse=True)[1].reshape(-1)
        self.hashes = hashes
        self.marked = np.zeros(int(self.token.max()) + 1, bool)
        n = len(sizes)
        self.label = np.arange(n) if known is None else np.unique(known[self.order], return_inverse=True)[1].reshape(-1)
        self.cut = None if side is None else int((side == 0).sum())
        self.found: list[tuple[int, int]] = []
        self.dropped = self.compared = 0  # pairs of nodes, pairs of sets

    def run(self) -> np.ndarray:
        if self.label.max() > self.label.min():
            self.walk()
        pairs = np.array(self.found, np.int64).reshape(-1, 2)
        return self.order[pairs]

    # --- exact comparison -------------------------------------------------------------------

    def enough(self, overlap: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return 100 * overlap >= self.percent * (self.size[a] + self.size[b] - overlap)

    def compare(self, a: int, b: int) -> bool:
        self.compared += 1
        mark = self.token[self.offsets[a] : self.offsets[a + 1]]
        self.marked[mark] = True
        overlap = np.count_nonzero(self.marked[self.token[self.offsets[b] : self.offsets[b + 1]]])
        self.marked[mark] = False
        return bool(self.enough(overlap, a, b))

    def connect(self, a: int, b: int) -> None:
        self.found.append((a, b))
        one, two = self.label[a], self.label[b]
        self.label[self.label == max(one, two)] = min(one, two)

    # --- the tree ---------------------------------------------------------------------------

    def leaves(self) -> Level:
        width = int(np.clip(1 << int(np.ceil(np.log2(4 * np.median(self.size) + 1))), 256, 8192))
        place = (self.hashes >> np.uint64(20)).astype(np.int64) & (width - 1)
        rows = []
        for first in range(0, len(self.size), 1024):
            last = min(first + 1024, len(self.size))
            own = slice(self.offsets[first], self.offsets[last])
            flags = np.zeros((last - first, width), bool)
            flags[np.repeat(np.arange(last - first), self.size[first:last]), place[own]] = True
            rows.append(np.packbits(flags, axis=1).view(np.uint64))
        bits = np.concatenate(rows)
        slack = self.size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        return Level(bits, self.size, self.size, slack)

    def grow(self, level: Level, cut: int) -> tuple[Level, np.ndarray]:
        """The nodes above; sides don't mix. Also where each one's children begin."""
        n = len(level.low)
        first = np.concatenate([np.arange(0, cut, FAN), np.arange(cut, n, FAN)])
        return (
            Level(
                np.bitwise_or.reduceat(level.bits, first, axis=0),
                np.minimum.reduceat(level.low, first),
                np.maximum.reduceat(level.high, first),
                np.maximum.reduceat(level.slack, first),
            ),
            np.append(first, n),
        )

    def may_link(self, level: Level, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the largest possible overlap of sets under two nodes is enough for the smallest sizes."""
        ok = (100 * level.high[b] >= self.percent * level.low[a]) & (100 * level.high[a] >= self.percent * level.low[b])
        at = np.flatnonzero(ok)
        shared = np.bitwise_count(level.bits[a[at]] & level.bits[b[at]]).sum(axis=1, dtype=np.int64)
        most = np.minimum(level.slack[a[at]], level.slack[b[at]]) + shared
        most = np.minimum(most, np.minimum(level.high[a[at]], level.high[b[at]]))
        ok[at] = (100 + self.percent) * most >= self.percent * (level.low[a[at]] + level.low[b[at]])
        return ok

    def walk(self) -> None:
        cuts = [self.cut if self.cut is not None else len(self.size)]
        levels, children = [self.leaves()], []
        while len(levels[-1].low) > 2 * FAN:
            level, first = self.grow(levels[-1], cuts[-1])
            cuts.append(-(-cuts[-1] // FAN))
            levels.append(level)
            children.append(first)
        top, n = len(levels) - 1, len(levels[-1].low)
        if self.cut is None:
            a, b = np.triu_indices(n)
        else:
            a, b = (x.reshape(-1) for x in np.meshgrid(np.arange(cuts[-1]), np.arange(cuts[-1], n), indexing="ij"))
        far = np.argsort(-np.abs(a - b), kind="stable")  # the last ones are taken first
        stack = [(top, a[far].astype(np.int64), b[far].astype(np.int64))]
        pairs = max(8, BLOCK // (8 * levels[0].bits.shape[1]))
        while stack:
            depth, a, b = stack.pop()
            if len(a) > pairs:
                stack += [(depth, x, y) for x, y in zip(np.array_split(a, 2), np.array_split(b, 2))]
                continue
            low, high = self.labels_of(depth, children)
            open_pairs = ~((low[a] == high[a]) & (low[b] == high[b]) & (low[a] == low[b]))
            a, b = a[open_pairs], b[open_pairs]
            ok = self.may_link(levels[depth], a, b)
            self.dropped += len(ok) - int(ok.sum())
            a, b = a[ok], b[ok]
            if depth == 0:
                self.finish(levels[0], a, b)
            elif len(a):
                x, y = self.below(children[depth - 1], a, b)
                far = np.argsort(-np.abs(x - y), kind="stable")
                stack.append((depth - 1, x[far], y[far]))

    def labels_of(self, depth: int, children: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        low = high = self.label
        for first in children[:depth]:
            low, high = np.minimum.reduceat(low, first[:-1]), np.maximum.reduceat(high, first[:-1])
        return low, high

    def below(self, first: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        wide, tall = first[a + 1] - first[a], first[b + 1] - first[b]
        count = wide * tall
        pair = np.repeat(np.arange(len(a)), count)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        x, y = first[a][pair] + place // tall[pair], first[b][pair] + place % tall[pair]
        half = (a[pair] != b[pair]) | (x <= y)
        return x[half], y[half]

    def finish(self, level: Level, a: np.ndarray, b: np.ndarray) -> None:
        """Compare the sets left, likeliest first; those connected meanwhile are passed over."""
        real = a != b
        a, b = a[real], b[real]
        shared = np.bitwise_count(level.bits[a] & level.bits[b]).sum(axis=1, dtype=np.int64)
        order = np.argsort(-shared / (self.size[a] + self.size[b]))
        a, b = a[order], b[order]
        while len(a):
            some = min(len(a), 512)
            for x, y in zip(a[:some].tolist(), b[:some].tolist()):
                if self.label[x] != self.label[y] and self.compare(x, y):
                    self.connect(x, y)
            a, b = a[some:], b[some:]
            open_pairs = self.label[a] != self.label[b]
            a, b = a[open_pairs], b[open_pairs]
