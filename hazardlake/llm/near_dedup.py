"""Similarity join on word shingles with Bayesian pruning of candidates.

Texts with the same set of shingles form a class; one text stands for it, so copies cost
nothing further. The join runs in two steps.

1. MinHash bands propose candidates. In every bucket the signatures are compared sixteen values
   at a time, and a pair is dropped as soon as the posterior probability that it reaches the
   threshold is below the tolerance. What survives ties texts into families.
2. Within a family each pair passes the same pruning and is then verified on whole shingle sets.
   That gives exact links, and the classes they connect.

Buckets and families are dealt out in blocks of bounded size: a large one becomes many pairs of
blocks, so no task holds more than two blocks, and pairs leave a task only as counts per text
and as the edges of a spanning forest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from hazardlake.llm import minhash
from hazardlake.llm.common import (
    ROW_BITS, carried, enter, is_marked, marks_of, settle, ship, stage, unpacked, with_marks,
)
from hazardlake.llm.graph import components

THRESHOLD = 0.8
TOLERANCE = 1e-7  # posterior probability below which a pair is dropped
BLOCK = 256  # texts in a block

SKETCH = "digest binary, size int, signature binary, bands array<bigint>"


def _sketch(texts: pa.Array) -> pa.Array:
    enter("near", minhash.KNOWN.clear)
    digests, sizes, signatures, bands = [], [], [], []
    for text in texts:
        values = minhash.shingles(text.as_py() or "")
        least = minhash.minima(values)
        digests.append(hashlib.blake2b(values.tobytes(), digest_size=16).digest())
        sizes.append(len(values))
        signatures.append(minhash.signature(least).tobytes())
        bands.append(minhash.band_keys(least))
    lists = pa.ListArray.from_arrays(
        np.arange(len(bands) + 1, dtype=np.int32) * minhash.BANDS,
        np.concatenate(bands) if bands else np.empty(0, np.int64))
    return pa.StructArray.from_arrays(
        [pa.array(digests, pa.binary()), pa.array(sizes, pa.int32()), pa.array(signatures, pa.binary()), lists],
        names=["digest", "size", "signature", "bands"])


def _shingles(texts: pa.Array) -> pa.Array:
    enter("near", minhash.KNOWN.clear)
    return pa.array([minhash.shingles(t.as_py() or "").tobytes() for t in texts], pa.binary())


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of rows with the same (pool, i, j) from sorted batches."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        rest.append(batch)
        table = pa.Table.from_batches(rest)
        keys = [table[c].to_numpy() for c in ("pool", "i", "j")]
        change = np.flatnonzero(np.any([k[1:] != k[:-1] for k in keys], axis=0)) + 1
        starts = [0, *change.tolist()]
        for lo, hi in zip(starts, starts[1:]):
            yield table.slice(lo, hi - lo)
        rest = table.slice(starts[-1]).to_batches()
    if rest:
        yield pa.Table.from_batches(rest)


def _arrays(group: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray | None]:
    at = group["at"].to_numpy()
    sizes = group["size"].to_numpy()
    signatures = np.frombuffer(b"".join(group["signature"].to_pylist()), np.uint16).reshape(len(at), minhash.HASHES)
    across = group["i"][0].as_py() != group["j"][0].as_py()
    return at, sizes, signatures, group["second"].to_numpy(zero_copy_only=False) if across else None


def _propose(threshold: float, tolerance: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed = minhash.least_matches(threshold, tolerance)
        a, b = [], []
        for group in _groups(batches):
            at, sizes, signatures, sides = _arrays(group)
            left, right = minhash.surviving_pairs(signatures, sizes, sides, threshold, needed)
            if len(left):
                root = minhash.roots(len(at), left, right)
                tied = np.flatnonzero(root != np.arange(len(at)))
                a.append(at[root[tied]])
                b.append(at[tied])
            if len(a) >= 4096:
                yield pa.RecordBatch.from_pydict({"a": np.concatenate(a), "b": np.concatenate(b)})
                a, b = [], []
        if a:
            yield pa.RecordBatch.from_pydict({"a": np.concatenate(a), "b": np.concatenate(b)})

    return run


def _verify(threshold: float, tolerance: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        needed = minhash.least_matches(threshold, tolerance)
        for group in _groups(batches):
            at, sizes, signatures, sides = _arrays(group)
            copies = group["copies"].to_numpy()
            sets = [np.frombuffer(s, np.uint64) for s in group["shingles"].to_pylist()]
            left, right = minhash.surviving_pairs(signatures, sizes, sides, threshold, needed)
            holds = np.array([minhash.reaches(sets[x], sets[y], threshold) for x, y in zip(left, right)], bool)
            left, right = left[holds], right[holds]
            links = np.zeros(len(at), np.int64)
            np.add.at(links, left, copies[right])
            np.add.at(links, right, copies[left])
            root = minhash.roots(len(at), left, right)
            yield pa.RecordBatch.from_pydict({"at": at, "root": at[root], "links": links})

    return run


def _dealt(members: DataFrame) -> DataFrame:
    """Members of pools (``pool``, ``n`` of them) in pairs of blocks, sorted by pair of blocks.

    A pool of up to a block's size is one pair. In a larger one each text is in the pair of its own
    block with itself and with every other block; ``second`` tells the two blocks of a pair apart.
    """
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("at"), blocks).cast("int")
    placed = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return placed.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")) \
        .withColumn("second", F.col("own") != F.col("i")).drop("own", "other", "n") \
        .repartition("pool", "i", "j").sortWithinPartitions("pool", "i", "j", "at")


def _address():
    return F.shiftleft(F.col("sender").cast("bigint"), ROW_BITS).bitwiseOR(F.col("seq")).alias("at")


def _place(at: str):
    return [F.shiftright(at, ROW_BITS).cast("int").alias("sender"),
            F.col(at).bitwiseAND((1 << ROW_BITS) - 1).alias("seq")]


def _families(sketches: DataFrame, threshold: float, tolerance: float, representatives: DataFrame) -> DataFrame:
    """Candidate families of two texts or more: (node, root)."""
    entries = representatives.select("at", F.explode("sketch.bands").alias("key"))
    # most buckets hold one text and end here
    crowded = entries.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    shared = settle(entries.join(crowded.hint("merge"), "key"), "near-buckets")
    # a bucket is told by the number of its members and by sums over their hashes; of buckets with
    # the same members only one is worked on
    buckets = shared.groupBy("key", "n").agg(
        F.bit_xor(F.xxhash64("at")).alias("x"), F.sum(F.shiftright(F.xxhash64("at", F.lit(1)), 20)).alias("s"))
    chosen = buckets.groupBy("n", "x", "s").agg(F.min("key").alias("key")).select("key")
    found = settle(shared.join(chosen, "key"), "near-buckets")
    marks = marks_of(found.select(*_place("at")).distinct())
    signed = with_marks(sketches, marks).filter(is_marked()).select(_address(), "sketch.size", "sketch.signature")
    members = found.join(signed, "at").select(F.col("key").alias("pool"), "n", "at", "size", "signature")
    edges = _dealt(members).mapInArrow(_propose(threshold, tolerance), "a bigint, b bigint")
    return components(edges)


def _joined(docs: DataFrame, id_col: str, text_col: str, threshold: float, tolerance: float):
    ship(docs.sparkSession)
    text = F.col("row").getField(text_col)
    staged = stage(docs, "near", sketch=F.arrow_udf(_sketch, SKETCH)(text))
    identity = F.col("row").getField(id_col).alias("id")
    rows = staged.select(_address(), identity, "sketch.digest")
    classes = settle(rows.groupBy("digest").agg(
        F.count("*").alias("copies"), F.min("at").alias("at"), F.min("id").alias("id")), "near-classes")
    first = marks_of(classes.select(*_place("at")))
    representatives = with_marks(staged, first).filter(is_marked()).select(_address(), "sketch")
    families = _families(staged, threshold, tolerance, representatives)
    sizes = families.groupBy("root").agg(F.count("*").alias("n"))
    pools = families.join(sizes, "root").join(classes, F.col("node") == F.col("at")).select(
        *_place("node"), F.col("root").alias("pool"), "n", "copies")
    members = carried(staged, pools, ["pool", "n", "copies"]).select(
        _address(), "sketch.size", "sketch.signature", F.arrow_udf(_shingles, "binary")(text).alias("shingles"),
        "pool", "n", "copies")
    verified = settle(_dealt(members).mapInArrow(
        _verify(threshold, tolerance), "at bigint, root bigint, links bigint"), "near-links")
    links = verified.groupBy("at").agg(F.sum("links").alias("links"))
    tied = components(verified.select(F.col("root").alias("a"), F.col("at").alias("b")))
    resolved = classes.join(links, "at", "left").join(tied.withColumnRenamed("node", "at"), "at", "left").select(
        "digest", "copies", "at", "id", F.coalesce("root", "at").alias("root"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    # the least id of the class, and the row that has it
    least = resolved.groupBy("root").agg(F.min("id").alias("class_id"), F.sum("copies").alias("class_size"))
    # written out, so that both sides of the last join are plain shuffles, which AQE splits when skewed
    result = settle(resolved.join(least, "root").filter("class_size > 1").select(
        "digest", "root", "class_id", "class_size", "links"), "near-result")
    return staged, rows, result


def joined(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD,
           tolerance: float = TOLERANCE) -> DataFrame:
    """One row per document: its class, the class's size, and its number of links.

    Two documents are linked when the Jaccard similarity of their sets of five-word shingles is
    at least ``threshold``; a class is what links connect, named by its least id. Links count
    copies. Texts of one to four words have one shingle of all their words, and texts without words
    (null among them) share the empty one. Repeated rows are copies of each other. A class whose
    ids are all null has a null name. An empty table gives no rows; other columns do not matter.
    """
    _, rows, result = _joined(docs, id_col, text_col, threshold, tolerance)
    return rows.join(result, "digest", "left").select(
        F.col("id").alias(id_col), F.when(F.col("class_size").isNull(), F.col("id")).otherwise(F.col("class_id"))
        .alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"),
        F.coalesce("links", F.lit(0)).alias("links"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                         threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """One document of each class, that of the least id, with all its columns.

    Texts without words (null among them) are one class, so one of them stays. Null ids give way to others; of rows that
    repeat the id one stays. An empty table stays empty. For classes see :func:`joined`.
    """
    staged, rows, result = _joined(docs, id_col, text_col, threshold, tolerance)
    classed = rows.join(result.select("digest", "root"), "digest")
    # a null id gives way to any other; among rows that repeat the id the first written stays
    place = F.struct(F.col("id").isNull(), "id", "at")
    stays = classed.groupBy("root").agg(F.min(place).alias("least")).select(F.col("least.at").alias("at"))
    dropped = classed.join(stays, "at", "left_anti").select(*_place("at"))
    return unpacked(with_marks(staged, marks_of(dropped), "left").filter(~is_marked()))
