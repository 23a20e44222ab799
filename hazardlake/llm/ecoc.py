"""Error-correcting output codes over byte trigrams: features, codewords, classifiers, decoding."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

TABLE_BITS = 13  # trigrams are hashed into this many bits
TABLE = 1 << TABLE_BITS
PIECE = 1 << 20  # bytes of a text that are worked on at once
SMOOTHING = 0.5
STEEPNESS = 4.0


def trigrams(text: str) -> np.ndarray:
    """How often each hashed byte trigram occurs in the lower-cased text, spaces around it."""
    raw = np.frombuffer(f" {text.lower()} ".encode("utf-8", "replace"), np.uint8)
    counts = np.zeros(TABLE, np.int64)
    for lo in range(0, max(1, len(raw) - 2), PIECE):
        b = raw[lo:lo + PIECE + 2].astype(np.uint32)
        keys = b[:-2] | (b[1:-1] << np.uint32(8)) | (b[2:] << np.uint32(16))
        counts += np.bincount((keys * np.uint32(0x9E3779B1)) >> np.uint32(32 - TABLE_BITS), minlength=TABLE)
    return counts


def _least_distance(code: np.ndarray) -> int:
    """Between any two codewords, compared in blocks."""
    signs = 2.0 * code.astype(np.float32) - 1.0
    least = code.shape[1]
    for lo in range(0, len(code), 1024):
        apart = (code.shape[1] - signs[lo:lo + 1024] @ signs.T) / 2
        apart[np.arange(len(apart)), np.arange(lo, lo + len(apart))] = code.shape[1]
        least = min(least, int(round(float(apart.min()))))
    return least


def codewords(n: int, seed: int = 7) -> np.ndarray:
    """A row of bits per class. Up to seven classes get every split of the classes in two,
    more get the best of some random codes, by the least distance between two codewords."""
    if n <= 7:
        splits = range(1 << max(n - 1, 0), (1 << n) - 1)  # the first class always has a 1
        return np.array([[(s >> (n - 1 - c)) & 1 for s in splits] for c in range(n)], np.int8).reshape(n, len(splits))
    rng = np.random.default_rng(seed)
    width = 12 * int(np.ceil(np.log2(n)))
    codes = [rng.integers(0, 2, (n, width), dtype=np.int8) for _ in range(30)]
    best = codes[int(np.argmax([_least_distance(code) for code in codes]))]
    return best[:, (best.min(axis=0) != best.max(axis=0))]


class Model(NamedTuple):
    languages: list[str]
    codes: np.ndarray  # languages x bits
    weights: np.ndarray  # trigrams x bits: log odds of a one
    middle: np.ndarray  # of each bit's mean log odds, halfway between what zeros and ones expect
    reach: np.ndarray  # from there to either


def weigh(counts: np.ndarray, totals: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For some of the trigrams: the log odds of each bit, and what its ones and its zeros expect of their sum.

    ``counts`` has a row per language, ``totals`` the size of its whole table. The languages on either
    side of a bit weigh the same, whatever their share of the corpus.
    """
    shares = (counts + SMOOTHING) / (totals + SMOOTHING * TABLE)[:, None]
    ones, zeros = (np.stack([shares[codes[:, b] == side].mean(axis=0) for b in range(codes.shape[1])], axis=1)
                   if codes.shape[1] else np.ones((counts.shape[1], 0)) for side in (1, 0))
    weights = np.log(ones / zeros)
    return weights, (ones * weights).sum(axis=0), (zeros * weights).sum(axis=0)


def model_of(languages: list[str], codes: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Model:
    """One naive-Bayes classifier for each bit, from what ``weigh`` found for the parts of the table in their order."""
    bits = codes.shape[1]
    weights = np.concatenate([w for w, _, _ in parts]) if parts else np.zeros((TABLE, bits))
    high, low = (np.sum([p[i] for p in parts], axis=0) if parts else np.zeros(bits) for i in (1, 2))
    return Model(languages, codes, weights.astype(np.float32), (high + low) / 2, np.maximum((high - low) / 2, 1e-9))


def predict(model: Model, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row of trigram counts: the chosen language's number, its score, the lead over the next.

    Each bit's margin is one where its side is as clear as the side's own texts are on average.
    A codeword's loss sums log(1 + exp(-margin)) over its bits, weighted by how far apart the
    two sides of the bit lie. The score is the chosen codeword's share of exp(-loss).
    """
    size = np.maximum(counts.sum(axis=1, keepdims=True), 1)
    margins = STEEPNESS * ((counts.astype(np.float32) @ model.weights) / size - model.middle) / model.reach
    signs = 2.0 * model.codes - 1.0
    trust = model.reach / model.reach.sum() * len(model.reach) if len(model.reach) else model.reach
    losses = (np.logaddexp(0.0, -margins[:, None, :] * signs[None]) * trust).sum(axis=2)
    best = losses.argmin(axis=1)
    ordered = np.sort(losses, axis=1)
    lead = ordered[:, 1] - ordered[:, 0] if losses.shape[1] > 1 else np.full(len(losses), np.inf)
    odds = np.exp(ordered[:, :1] - losses)
    return best, 1.0 / odds.sum(axis=1), lead
