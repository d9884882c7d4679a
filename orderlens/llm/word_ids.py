"""Ids of many texts from the ids of their distinct words.

Both encoders cut texts where no id can span the cut, so a text's ids are those of its pieces of
text in order. Pieces are told apart by two independent 64-bit hashes of their bytes, made for all of a slice
at once; only those a worker has not met yet go to the tokenizer. What it has met is kept in flat
arrays between slices and tasks, up to a stated number of pieces, after which it starts anew.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from orderlens.llm.common import mix, powers

#: Pieces a worker remembers: about 60 bytes each.
REMEMBERED = 1_000_000


def two_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two hashes of each data[start:end], over the bytes and over a scrambling of them."""
    up, down = powers(len(data) + 1)
    made = []
    for values in (_PLAIN, _OTHER):
        sums = np.zeros(len(data) + 1, np.uint64)
        terms = values[data]
        terms *= up[: len(data)]
        np.cumsum(terms, out=sums[1:])
        made.append(mix((sums[ends] - sums[starts]) * down[starts]))
    return made[0], made[1]


_PLAIN = np.arange(1, 257, dtype=np.uint64)
_OTHER = np.random.default_rng(11).integers(1, 1 << 62, 256, dtype=np.int64).astype(np.uint64)


class WordIds:
    """Known pieces, sorted by their first hash: second hash, place and number of ids."""

    def __init__(self, encode: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]], remembered: int = REMEMBERED):
        """``encode`` gives the ids of some pieces, and where in them each piece's begin and how many they are."""
        self.encode, self.remembered = encode, remembered
        self._forget()

    def _forget(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.begins, self.counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.fresh: list[tuple[np.ndarray, ...]] = []
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0

    def _find(self, keys: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and number of ids of each piece, -1 where it is not known."""
        begins, counts = np.full(len(keys), -1, np.int64), np.zeros(len(keys), np.int64)
        for known, check, begin, count in [(self.keys, self.checks, self.begins, self.counts), *self.fresh]:
            if len(known):
                at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
                hit = np.flatnonzero((known[at] == keys) & (check[at] == checks))
                begins[hit], counts[hit] = begin[at[hit]], count[at[hit]]
        return begins, counts

    def _learn(self, keys, checks, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        coded, begins, counts = self.encode(words)
        total = len(coded)
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(len(self.ids), np.int32)])
        self.ids[self.used: self.used + total] = coded
        begins = begins + self.used
        self.used += total
        self.fresh.append((keys, checks, begins, counts))
        if len(self.fresh) > 8 or sum(len(f[0]) for f in self.fresh) > len(self.keys) // 2:
            every = [(self.keys, self.checks, self.begins, self.counts), *self.fresh]
            keys_, checks_, begins_, counts_ = (np.concatenate([e[i] for e in every]) for i in range(4))
            order = np.argsort(keys_, kind="stable")
            self.keys, self.checks, self.begins, self.counts = keys_[order], checks_[order], begins_[order], counts_[order]
            self.fresh = []
        return begins, counts

    def __call__(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces in order, and how many each piece has."""
        first, second = two_hashes(data, starts, ends)
        keys, sample, place = np.unique(first, return_index=True, return_inverse=True)
        checks = second[sample]
        if not np.array_equal(checks[place], second):
            # Two pieces share a hash: such a slice is encoded piece by piece.
            coded, begins, counts = self.encode([data[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist())])
            return gathered(coded, begins, counts), counts
        if len(self.keys) + sum(len(f[0]) for f in self.fresh) + len(keys) > self.remembered:
            self._forget()
        begins, counts = self._find(keys, checks)
        new = np.flatnonzero(begins < 0)
        if len(new):
            spans = zip(starts[sample[new]].tolist(), ends[sample[new]].tolist())
            begins[new], counts[new] = self._learn(keys[new], checks[new], [data[a:b].tobytes() for a, b in spans])
        sizes = counts[place]
        return gathered(self.ids, begins[place], sizes), sizes


def gathered(ids: np.ndarray, begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The runs of ``ids`` at ``begins``, one after another."""
    ends = np.cumsum(counts)
    at = np.repeat(begins - ends + counts, counts)
    at += np.arange(len(at))
    return ids[at]


def in_order(runs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of ids as one array, with each run's place and size."""
    counts = np.fromiter(map(len, runs), np.int64, len(runs))
    return np.concatenate([np.zeros(0, np.int32), *runs]), np.cumsum(counts) - counts, counts


def per_row(sizes: np.ndarray, starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Number of ids of each row, whose bytes begin at ``offsets``."""
    ahead = np.concatenate([[0], np.cumsum(sizes)])
    return np.diff(ahead[np.searchsorted(starts, offsets)])
