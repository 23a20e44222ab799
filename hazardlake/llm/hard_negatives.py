"""Hard negatives by a vertical scan of columnar vectors (BOND).

Usable rows are stored once in blocks, dimension by dimension. An anchor reads a block's dimensions
in descending order of its own magnitudes. After each few of them every candidate has a partial
product, and the least and largest value that the block holds in each remaining dimension bound what
is still to come. Candidates whose bounds cannot reach what is sought leave the anchor's bitmap; what
remains is resolved exactly.

The scan runs twice over pairs of a block and a group of anchors: first for the best rows of the
anchor's own label, then for the best rows of other labels within the window of scores below each
positive. A pair returns a few rows for each anchor, which windows merge. Components are integers, so
all products are exact and bounds need no tolerance.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from hazardlake.llm.common import column, enter, settle, ship

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
LOW_PERCENT, HIGH_PERCENT, BASE_PERCENT = 80, 100, 100
BLOCK_ROWS = 4096  # rows of a block: with 64 dimensions, 1 MB
GROUP_ANCHORS = 512
STRIDE = 8  # dimensions read between two looks at the bounds
EXACT_DOUBLE = 2 ** 53

BLOCK = ("dims int, block int, n int, places array<bigint>, ids array<bigint>, known array<boolean>, "
         "labels array<bigint>, wide boolean, cells binary")
# ``anchor`` and ``place`` are addresses of rows, ``part`` the positive score whose window a negative is in
HIT = "anchor long, part long, score long, id long, place long"


# --- storage ----------------------------------------------------------------------------------

def usable(rows: DataFrame, is_anchor: Column, id_col: str, label_col: str, vector_col: str,
           label: Column | None = None) -> DataFrame:
    """Rows that take part: ``at`` (a stable address), ``id``, ``label``, ``vector`` of doubles, ``anchor``."""
    kept = rows.filter(
        column(label_col).isNotNull() & F.coalesce(F.forall(
            column(vector_col), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False)))
    return kept.select(
        F.monotonically_increasing_id().alias("at"), column(id_col).cast("long").alias("id"),
        (column(label_col) if label is None else label).cast("long").alias("label"),
        column(vector_col).cast("array<double>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("anchor"))


def _scaled(vectors: np.ndarray) -> np.ndarray:
    """floor(256 x), exactly: as doubles, or as Python integers where doubles can't hold a product of two rows."""
    if np.abs(vectors).max(initial=0) < 2.0 ** 16:
        return np.floor(vectors * SCALE)
    return np.array([[int(np.floor(x * SCALE)) if abs(x) < 2.0 ** 60 else int(x) * SCALE for x in row] for row in vectors],
                    dtype=object).reshape(vectors.shape)


def _store(group: pd.DataFrame) -> pd.DataFrame:
    """Rows of a block, sorted by label, as one row of columns."""
    group = group.sort_values(["label", "at"])
    vectors = np.array(group.vector.to_list(), np.float64).reshape(len(group), -1)
    narrow = vectors.astype(np.float32)
    wide = bool((narrow != vectors).any())
    return pd.DataFrame({
        "dims": [vectors.shape[1]], "block": group.block.iloc[:1].to_numpy(), "n": [len(group)],
        "places": [group["at"].to_numpy()], "labels": [group.label.to_numpy()],
        "ids": [group.id.to_numpy()], "known": [group.known.to_numpy()],
        "wide": [wide], "cells": [np.ascontiguousarray((vectors if wide else narrow).T).tobytes()]})


class Stored(NamedTuple):
    """Blocks (BLOCK) of all usable rows and the anchors among them, with the numbers both are dealt by."""
    columnar: DataFrame
    anchors: DataFrame
    blocks: int
    groups: int


def stored(rows: DataFrame) -> Stored:
    spark = rows.sparkSession
    ship(spark)
    rows = settle(rows.withColumn("dims", F.size("vector")), "bond-rows")
    counts = rows.agg(F.count("*").alias("n"), F.count_if("anchor").alias("anchors")).first()
    blocks, groups = max(1, -(-counts.n // BLOCK_ROWS)), max(1, -(-counts.anchors // GROUP_ANCHORS))

    def dealt(parts: int) -> Column:
        return F.pmod(F.xxhash64("at"), F.lit(parts)).cast("int")

    columnar = rows.select(
        "dims", "at", "label", "vector", F.coalesce("id", F.lit(0)).alias("id"), F.col("id").isNotNull().alias("known"),
        dealt(blocks).alias("block")).groupBy("dims", "block").applyInPandas(_store, BLOCK)
    anchors = rows.filter("anchor").select("dims", "at", "id", "label", "vector", dealt(groups).alias("group"))
    return Stored(settle(columnar, "bond-blocks"), settle(anchors, "bond-anchors"), blocks, groups)


# --- the scan ---------------------------------------------------------------------------------

class _Block:
    """One stored block, ready to be read by dimension."""

    def __init__(self, row):
        self.labels = np.asarray(row.labels, np.int64)
        # null ids travel apart, as an array of numbers has no place for them
        self.ids = [int(i) if known else None for i, known in zip(row.ids, row.known)]
        self.places = row.places
        kind = np.float64 if row.wide else np.float32
        self.cells = _scaled(np.frombuffer(row.cells, kind).reshape(row.dims, row.n).astype(np.float64))
        self.least = self.cells.min(axis=1) if row.dims else np.zeros(0)
        self.most = self.cells.max(axis=1) if row.dims else np.zeros(0)

    def as_exact(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Anchor, cells and their limits in a type that holds every partial product."""
        parts = (anchor, self.cells, self.least, self.most)
        if all(p.dtype != object for p in parts):
            reach = np.maximum(np.abs(self.least), np.abs(self.most))
            if float(np.abs(anchor) @ reach) < EXACT_DOUBLE:
                return parts
        whole = np.vectorize(int, otypes=[object])
        return tuple(whole(p) if p.size and p.dtype != object else p.astype(object) for p in parts)


def _scan(block: _Block, anchor: np.ndarray, lo: int, hi: int, wanted: Callable) -> tuple[np.ndarray, np.ndarray]:
    """Which of the block's rows from ``lo`` to ``hi`` may be sought, and their exact scores.

    ``wanted(low, high)`` tells from bounds on scores which candidates still may be sought.
    """
    anchor, cells, least, most = block.as_exact(anchor)
    order = np.argsort(-np.abs(anchor), kind="stable")
    at_least = np.minimum(anchor * least, anchor * most)[order]
    at_most = np.maximum(anchor * least, anchor * most)[order]
    # what the dimensions from the i-th on can add
    rest_low = np.append(np.cumsum(at_least[::-1])[::-1], 0)
    rest_high = np.append(np.cumsum(at_most[::-1])[::-1], 0)
    alive, score = np.arange(lo, hi), np.zeros(hi - lo, cells.dtype)
    for start in range(0, len(order), STRIDE):
        read = order[start:start + STRIDE]
        stop = start + len(read)
        # a full run is read as it lies
        part = cells[read, lo:hi] if len(alive) == hi - lo else cells[read[:, None], alive]
        score = score + anchor[read] @ part
        stays = wanted(score + rest_low[stop], score + rest_high[stop])
        kept = np.count_nonzero(stays)
        # a small cut waits, as picking rows costs more than reading on
        if kept < len(alive) and (stop == len(order) or kept < 0.7 * len(alive)):
            alive, score = alive[stays], score[stays]
        if not kept:
            break
    return alive, score


def _best(k: int) -> Callable:
    """Candidates that may be among the ``k`` of largest score; ties stay."""
    def wanted(low, high):
        if len(low) <= k:
            return np.ones(len(low), bool)
        floor = np.sort(low)[-k] if low.dtype == object else np.partition(low, -k)[-k]
        return (high >= floor).astype(bool)

    return wanted


def _within(windows: list[tuple[int, int]], k: int) -> Callable:
    """Candidates that may be among the ``k`` of largest score within one of the windows."""
    def wanted(low, high):
        stays = np.zeros(len(low), bool)
        for bottom, top in windows:
            may = ((high >= bottom) & (low <= top)).astype(bool)
            sure = low[((low >= bottom) & (high <= top)).astype(bool)]
            if len(sure) >= k:
                may &= (high >= np.sort(sure)[-k]).astype(bool)
            stays |= may
        return stays

    return wanted


def _window(positive: int) -> tuple[int, int]:
    """The least and largest score of a negative; empty below zero."""
    return -(-LOW_PERCENT * positive // BASE_PERCENT), HIGH_PERCENT * positive // BASE_PERCENT


def _ordered(block: _Block, at: np.ndarray, scores: np.ndarray, k: int) -> list[tuple]:
    """The first ``k`` by score descending, then id, null ids last, then address: (score, id, address)."""
    if len(at) > k:
        near = (scores >= np.sort(scores)[-k]).astype(bool)
        at, scores = at[near], scores[near]
    found = [(int(s), block.ids[p], int(block.places[p])) for s, p in zip(scores, at)]
    found.sort(key=lambda f: (-f[0], f[1] is None, f[1] or 0, f[2]))
    return found[:k]


def _positives(block: _Block, anchor, vector: np.ndarray) -> Iterator[tuple]:
    """The block's best rows of the anchor's label; its own row, for which one more is kept, is none."""
    lo, hi = np.searchsorted(block.labels, [anchor.label, anchor.label + 1])
    found = _ordered(block, *_scan(block, vector, lo, hi, _best(POSITIVES + 1)), POSITIVES + 1) if lo < hi else []
    for score, id_, place in [f for f in found if f[2] != anchor.at][:POSITIVES]:
        yield anchor.at, 0, score, id_, place


def _negatives(block: _Block, anchor, vector: np.ndarray) -> Iterator[tuple]:
    """The block's best rows of other labels in the window of each positive score."""
    windows = {p: _window(p) for p in map(int, anchor.positives) if p >= 0}
    lo, hi = np.searchsorted(block.labels, [anchor.label, anchor.label + 1])
    runs = [(a, b) for a, b in ((0, lo), (hi, len(block.labels))) if a < b]
    if not windows or not runs:
        return
    scanned = [_scan(block, vector, a, b, _within(list(windows.values()), NEGATIVES)) for a, b in runs]
    at, scores = (np.concatenate(parts) for parts in zip(*scanned))
    for positive, (bottom, top) in windows.items():
        inside = ((scores >= bottom) & (scores <= top)).astype(bool)
        for score, id_, place in _ordered(block, at[inside], scores[inside], NEGATIVES):
            yield anchor.at, positive, score, id_, place


def _compared(store: Stored, anchors: DataFrame, of_block: Callable) -> DataFrame:
    """What ``of_block`` finds for every anchor in every block of its length (HIT).

    Pairs of a block and a group of anchors are dealt over tasks by their numbers; a task holds one at a time.
    """
    def compare(key: tuple, group: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        enter("bond")
        vectors = [_scaled(np.asarray(v, np.float64).reshape(1, -1))[0] for v in group.vector]
        found = []
        for row in rows.itertuples(index=False) if len(group) else ():
            block = _Block(row)
            for anchor, vector in zip(group.itertuples(index=False), vectors):
                found += of_block(block, anchor, vector)
        return pd.DataFrame(found, columns=["anchor", "part", "score", "id", "place"]).astype({"id": "Int64"})

    key = ("dims", "group", "block")
    left = anchors.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(store.blocks - 1))))
    right = store.columnar.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(store.groups - 1))))
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(compare, HIT)


def _first(hits: DataFrame, k: int) -> DataFrame:
    """The first ``k`` hits of each anchor and part, ranked. A task sends no more than that to the shuffle."""
    order = Window.partitionBy("anchor", "part").orderBy(F.desc("score"), F.asc_nulls_last("id"), "place")
    return hits.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def mined(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", label_col: str = "label",
          vector_col: str = "embedding", label: Column | None = None) -> DataFrame:
    """For each anchor row and each of its positives, the hardest negatives.

    Components count as floor(256 x), and a row's score is its integer inner product with the anchor; higher
    scores come first, ties by smaller id, null ids last, then by place. The positives are the first 5 other rows of the
    anchor's label; the negatives of a positive are the first 5 rows of other labels whose score is between 80 % and
    100 % of its own, so a positive with a negative score has none. ``label`` may replace the label column.

    Rows with a null label, a null vector or a component that is null or not finite take no part. Scores are defined
    between vectors of one length, so each anchor is compared with the rows of its own. Rows that repeat an id are
    rows of their own; null ids are candidates but, where ``is_anchor`` is null for them, no anchors. A score that no long holds raises.
    An empty table gives no rows; other columns do not matter.
    Columns: anchor_id, positive_id, rank, negative_id, positive_score, negative_score.
    """
    store = stored(usable(rows, is_anchor, id_col, label_col, vector_col, label))
    positives = settle(_first(_compared(store, store.anchors, _positives), POSITIVES).select(
        "anchor", F.col("score").alias("positive_score"), F.col("id").alias("positive_id")), "bond-positives")
    sought = positives.groupBy(F.col("anchor").alias("at")).agg(F.collect_set("positive_score").alias("positives"))
    negatives = _first(_compared(store, store.anchors.join(sought, "at"), _negatives), NEGATIVES).select(
        "anchor", F.col("part").alias("positive_score"), "rank", F.col("score").alias("negative_score"),
        F.col("id").alias("negative_id"))
    names = store.anchors.select(F.col("at").alias("anchor"), F.col("id").alias("anchor_id"))
    return positives.join(negatives, ["anchor", "positive_score"]).join(names, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
