"""p-stable hashing of vectors and the order in which perturbed buckets are visited."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from math import ceil, erf, log, sqrt
from typing import NamedTuple

import numpy as np

REACH = 2  # cells to each side that probes go at least
TRIALS = 100  # vectors of the sample whose probing is tried
WITHIN = 0.98  # part of them that shall need no more probes than allowed
DEVIATIONS = 3  # standard deviations of a projection that they go at least


class Tables(NamedTuple):
    """``tables`` hash tables of ``functions`` hashes each: floor((a . v + b) / width)."""
    directions: np.ndarray  # tables x functions x dimension
    shifts: np.ndarray  # tables x functions
    width: float
    radius: float  # distance of the neighbours that are looked for; rounds after the first have one per query
    success: float  # estimated probability per table at which probing stops


def collision(distance: float, width: float) -> float:
    """Probability that two vectors at a distance share the value of one hash function."""
    if distance <= 0:
        return 1.0
    r = width / distance
    return erf(r / sqrt(2)) - sqrt(2 / np.pi) / r * (1 - np.exp(-r * r / 2))


def tables_for(sample: np.ndarray, rows: int, neighbours: int, bucket: int, tables: int, recall: float,
               probes: int, seed: int = 11) -> Tables:
    """Parameters from a sample and the number of rows.

    The radius is the typical distance of the wanted neighbours within the sample, which is not
    below that among all rows. Buckets shall hold ``bucket`` rows on average, whatever the number
    of rows, so the number of functions grows with its logarithm; but it stays so small that most
    of the sample's vectors reach the wanted success within ``probes`` buckets of a table.
    """
    squares = (sample**2).sum(axis=1)
    distances = np.sqrt(np.maximum(squares[:, None] + squares[None] - 2 * sample @ sample.T, 0))
    np.fill_diagonal(distances, np.inf)
    near = np.sort(distances, axis=1)[:, min(neighbours, len(sample) - 1) - 1] if len(sample) > 1 else np.ones(1)
    # copies lie at distance zero and are found in any case
    radius = float(np.median(near[near > 0])) if (near > 0).any() and np.isfinite(near).all() else 1.0
    finite = distances[np.isfinite(distances)]
    far = float(np.median(finite)) if len(finite) else 1.0
    width = 2.0 * radius
    chance = min(max(collision(max(far, radius), width), 1e-3), 0.99)
    functions = max(1, int(np.ceil(log(max(rows / bucket, 1.0)) / -log(chance)))) if rows > bucket else 1
    rng = np.random.default_rng(seed)
    dimension = sample.shape[1]
    hashes = Tables(rng.standard_normal((tables, functions, dimension)), rng.random((tables, functions)) * width,
                    width, radius, 1 - (1 - recall) ** (1 / tables))
    _, inside = buckets(sample[:TRIALS], hashes)
    while functions > 1:
        within = [visited(row[0, :functions], hashes, probes) is not None for row in inside]
        if np.mean(within) >= WITHIN:
            break
        functions -= 1
    return hashes._replace(directions=hashes.directions[:, :functions], shifts=hashes.shifts[:, :functions])


def buckets(vectors: np.ndarray, hashes: Tables) -> tuple[np.ndarray, np.ndarray]:
    """Hash values (rows x tables x functions) and where in its cell each projection lies (0 to 1)."""
    scaled = (np.einsum("nd,tfd->ntf", vectors, hashes.directions) + hashes.shifts) / hashes.width
    cells = np.floor(scaled)
    return cells.astype(np.int64), scaled - cells


def key(cells: np.ndarray) -> np.ndarray:
    """A 64-bit key of each row of hash values."""
    keys = np.full(cells.shape[:-1], 0x9E3779B97F4A7C15, np.uint64)
    for column in np.moveaxis(cells, -1, 0):
        keys = (keys ^ column.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
        keys ^= keys >> np.uint64(29)
    return keys.view(np.int64)


def probes(inside: np.ndarray, hashes: Tables) -> Iterator[tuple[float, tuple[int, ...]]]:
    """Offsets of buckets from that of the query, the most promising first, with their chance.

    A neighbour at the radius is projected a normally distributed way off, so the chance of each
    offset of each function is known, and that of a bucket is the product. A heap over the ranks of
    the offsets in each function yields the products in descending order.
    """
    def cumulative(x: float) -> float:
        return 0.5 * (1 + erf(x * hashes.width / hashes.radius / sqrt(2)))

    reach = max(REACH, ceil(DEVIATIONS * hashes.radius / hashes.width))
    ranked = []
    for x in inside:
        chances = [(cumulative(o + 1 - x) - cumulative(o - x), o) for o in range(-reach, reach + 1)]
        ranked.append(sorted(chances, reverse=True))
    ranked_best = float(np.prod([r[0][0] for r in ranked]))
    heap = [(-ranked_best, (0,) * len(ranked), 0)]
    while heap:
        chance, ranks, first = heapq.heappop(heap)
        yield -chance, tuple(ranked[f][r][1] for f, r in enumerate(ranks))
        # each combination is reached once: only functions from the last changed one on move further
        for f in range(first, len(ranks)):
            if ranks[f] + 1 < len(ranked[f]):
                now, then = ranked[f][ranks[f]][0], ranked[f][ranks[f] + 1][0]
                if then > 0:
                    heapq.heappush(heap, (chance / now * then, ranks[:f] + (ranks[f] + 1,) + ranks[f + 1:], f))


def visited(inside: np.ndarray, hashes: Tables, limit: int | None = None) -> list[tuple[int, ...]] | None:
    """Offsets in the order of probing until their chances add up to the wanted success; None past the limit."""
    offsets, total = [], 0.0
    for chance, offset in probes(inside, hashes):
        if limit is not None and len(offsets) >= limit:
            return None
        offsets.append(offset)
        total += chance
        if total >= hashes.success:
            return offsets
    return offsets if limit is None else None
