"""Word shingles, MinHash signatures, Bayesian pruning of pairs and exact Jaccard similarity."""

from __future__ import annotations

from math import comb

import numpy as np
import xxhash

WIDTH = 5  # words in a shingle
BANDS, ROWS = 32, 5
HASHES = BANDS * ROWS
STEP = 16  # MinHash values compared at once
PIECE = 4096  # shingles hashed at once
GENERATION = 100_000  # words whose hashes a worker keeps

_rng = np.random.default_rng(20240229)
FACTORS = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
OFFSETS = _rng.integers(0, 2**63, HASHES, dtype=np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)
LINK = np.uint64(0xD6E8FEB86659FD93)


class WordHashes(dict):
    def __missing__(self, word: str) -> int:
        value = xxhash.xxh64_intdigest(word.encode("utf-8", "replace"))
        if len(self) >= GENERATION:
            self.clear()
        self[word] = value
        return value


KNOWN = WordHashes()


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of five words, words being lower-cased and parted by
    white space. Fewer words make one shingle of all of them; no words make the empty one."""
    words = text.lower().split()
    ids = np.fromiter(map(KNOWN.__getitem__, words), np.uint64, len(words))
    if len(ids) < WIDTH:
        ids = np.concatenate([ids, np.full(WIDTH - len(ids), len(ids), np.uint64)])
    runs = ids[:len(ids) - WIDTH + 1].copy()
    for k in range(1, WIDTH):
        runs ^= runs >> np.uint64(29)
        runs *= MIX
        runs += ids[k:len(ids) - WIDTH + 1 + k]
    runs ^= runs >> np.uint64(32)
    runs *= LINK
    runs ^= runs >> np.uint64(29)
    return np.unique(runs)


def minima(values: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(values), PIECE):
        part = values[lo:lo + PIECE]
        np.minimum(least, (part[None, :] * FACTORS[:, None] + OFFSETS[:, None]).min(axis=1), out=least)
    return least


def signature(least: np.ndarray) -> np.ndarray:
    """Sixteen bits of each minimum: two texts agree by chance in one value of 65536."""
    return ((least * MIX) >> np.uint64(48)).astype(np.uint16)


def band_keys(least: np.ndarray) -> np.ndarray:
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * LINK
    for column in least.reshape(BANDS, ROWS).T:
        keys = (keys ^ column) * MIX
        keys ^= keys >> np.uint64(31)
    return keys.view(np.int64)


def least_matches(threshold: float, tolerance: float) -> np.ndarray:
    """For each number of compared values the fewest matches with which a pair goes on.

    With a uniform prior the similarity after m matches in n values is Beta(m + 1, n - m + 1), and the
    chance that it reaches the threshold is that of at most m successes in n + 1 trials.
    """
    needed = []
    for n in range(STEP, HASHES + 1, STEP):
        chance = np.cumsum([comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m) for m in range(n + 1)])
        needed.append(int(np.searchsorted(chance, tolerance)))
    return np.array(needed)


def surviving_pairs(signatures: np.ndarray, sizes: np.ndarray, sides: np.ndarray | None, threshold: float,
                    needed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows that may reach the threshold: sizes close enough, never pruned on the way.

    With ``sides`` only pairs across the two sides are looked at.
    """
    if sides is None or sides.all() or not sides.any():
        if sides is not None:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        left, right = np.triu_indices(len(signatures), 1)
    else:
        left, right = (x.ravel() for x in np.meshgrid(np.flatnonzero(~sides), np.flatnonzero(sides), indexing="ij"))
    small, large = np.minimum(sizes[left], sizes[right]), np.maximum(sizes[left], sizes[right])
    fits = small >= threshold * large
    left, right = left[fits], right[fits]
    matches = np.zeros(len(left), np.int32)
    for step, least in enumerate(needed):
        if not len(left):
            break
        part = signatures[:, step * STEP:(step + 1) * STEP]
        matches += (part[left] == part[right]).sum(axis=1, dtype=np.int32)
        go = matches >= least
        if not go.all():
            left, right, matches = left[go], right[go], matches[go]
    return left, right


def reaches(a: np.ndarray, b: np.ndarray, threshold: float) -> bool:
    """Exact comparison of two sorted sets of shingles."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    common = int((b[at] == a).sum())
    return common >= threshold * (len(a) + len(b) - common)


def roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """The least row of each row's component."""
    parent = np.arange(n)
    while len(left):
        low, high = np.minimum(parent[left], parent[right]), np.maximum(parent[left], parent[right])
        if (low == high).all():
            break
        np.minimum.at(parent, high, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]
    return parent
