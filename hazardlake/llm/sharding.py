"""Sharding by histogram sort, in DataFrame functions only. Law ``bytes``: shard sizes are near equal.

The sort key is (hash of the text, hash of the id, hash of the row's address). Splitters are found by
counting the exact bytes below evenly spaced probes of the key, first over its whole range, then within
the probe interval that holds a wanted splitter, until every splitter is within the tolerance. Then whole
rows are exchanged once, by range of shard and key, and written as one set of files per shard. Equal texts
stay in one shard, unless the copies of one text take a larger part of a shard; only then do probes go on
into the second part of the key, and into the third where rows that repeat both take that much.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F

from hazardlake.llm.common import SCRATCH_CODEC, free, stage
from hazardlake.session import new_folder

SHARDS = 16
DIGIT = 12  # bits of the key that one round of probes resolves
CELLS = 1 << DIGIT
TOLERANCE = 0.002  # of a shard's bytes
WHOLE = 0.05  # of a shard's bytes: by default, copies of a text that take no more stay in one shard
BITS = 64  # of each part of the key
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
PARTS = ("text_hash", "id_hash", "row_hash")


class Splitter(NamedTuple):
    """The first key of a shard; its parts are signed 64-bit numbers."""
    text_hash: int
    id_hash: int
    row_hash: int


def _digit(part: str, level: int) -> Column:
    """Bits of one level from the top, in the order of the signed value."""
    shift = max(BITS - DIGIT * (level + 1), 0)
    if level == 0:
        return F.shiftright(part, shift) + CELLS // 2
    width = min(DIGIT, BITS - DIGIT * level)
    return F.shiftrightunsigned(part, shift).bitwiseAND((1 << width) - 1)


def _prefix(part: str, level: int) -> Column:
    """All bits above a level."""
    return F.shiftright(part, BITS - DIGIT * level) if level else F.lit(0).cast("bigint")


def _size(text: Column) -> Column:
    return (F.octet_length(F.coalesce(text, F.lit(""))) + 1).cast("bigint")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows, staged, with key and size of each."""
    text, name = F.col("row").getField(text_col), F.col("row").getField(id_col)
    return stage(docs, "sharding", size=_size(text), text_hash=F.xxhash64(F.coalesce(text, F.lit(""))),
                 id_hash=F.xxhash64(name)).withColumn("row_hash", F.xxhash64("sender", "seq"))


LEVELS = -(-BITS // DIGIT)


def splitters(rows: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, whole: float = WHOLE) -> list[Splitter]:
    """The first keys of shards 1, 2 and so on. For ``whole`` see :func:`sharded`.

    Each round is one aggregate; the driver gets at most one count for each of the 4096 probes of
    every splitter still open.
    """
    total = rows.agg(F.sum("size")).first()[0] or 0
    allowed = tolerance * total / shards
    open_ = {n: (total * n / shards, 0, None) for n in range(1, shards)}  # target, bytes below the interval, prefix
    found: dict[int, Splitter] = {}
    within: dict[int, tuple[int, ...]] = {}  # the one text, or text and id, in which a splitter must fall
    for step in range(len(PARTS) * LEVELS):
        if not open_ or not total:
            break
        at_part, level = divmod(step, LEVELS)
        part = PARTS[at_part]
        shift = max(BITS - DIGIT * (level + 1), 0)
        width = min(DIGIT, BITS - DIGIT * level)
        keys = [k.alias(f"k{i}") for i, k in enumerate([*map(F.col, PARTS[:at_part]), _prefix(part, level)])]
        wanted = sorted({(*within.get(n, ()), prefix or 0) for n, (_, _, prefix) in open_.items()})
        inside = rows
        if step:
            inside = rows.filter(F.struct(*keys).isin(
                *[F.struct(*[F.lit(v).cast("bigint").alias(f"k{i}") for i, v in enumerate(w)]) for w in wanted]))
        counted = inside.groupBy(*keys, _digit(part, level).alias("digit")).agg(F.sum("size").alias("bytes")).collect()
        cells: dict[tuple[int, ...], dict[int, int]] = {}
        for r in counted:
            cells.setdefault(tuple(r)[:len(keys)], {})[r.digit] = r.bytes
        for n, (target, below, prefix) in list(open_.items()):
            held = cells[(*within.get(n, ()), prefix or 0)]
            start = below
            for digit in sorted(held):
                after = start + held[digit]
                if after >= target:
                    break
                start = after
            # the interval's own two probes first, whichever is nearer
            low_first = target - start <= after - target
            for bytes_below, at in ((start, digit), (after, digit + 1))[::1 if low_first else -1]:
                if abs(bytes_below - target) <= allowed:
                    found[n] = _probe(level, within.get(n, ()), prefix, at, shift, width)
                    del open_[n]
                    break
            else:
                value = digit - CELLS // 2 if level == 0 else ((prefix or 0) << width) | digit
                end = level == LEVELS - 1
                if step == len(PARTS) * LEVELS - 1 or (end and held[digit] <= whole * total / shards):
                    found[n] = _probe(level, within.get(n, ()), prefix, digit if low_first else digit + 1, shift, width)
                    del open_[n]
                elif end:
                    within[n] = (*within.get(n, ()), value)
                    open_[n] = (target, start, None)
                else:
                    open_[n] = (target, start, value)
    return [found[n] for n in sorted(found)]


def _probe(level: int, within: tuple[int, ...], prefix: int | None, at: int, shift: int, width: int) -> Splitter:
    """The least key of a cell; past the last value of a part the next key follows."""
    value = (at - CELLS // 2 if level == 0 else ((prefix or 0) << width) + at) << shift
    known = (*within, value)
    if value > HIGHEST:
        if not within:
            return Splitter(HIGHEST, HIGHEST, HIGHEST)
        known = (*within[:-1], min(within[-1] + 1, HIGHEST))
    return Splitter(*known, *[LOWEST] * (len(PARTS) - len(known)))


def _shard(first_keys: list[Splitter]) -> Column:
    """How many splitters a key has reached."""
    def reached(s: Splitter) -> Column:
        text, name, row = (F.col(p) for p in PARTS)
        return (text > s.text_hash) | ((text == s.text_hash) & (
            (name > s.id_hash) | ((name == s.id_hash) & (row >= s.row_hash))))

    return sum((reached(s).cast("int") for s in first_keys), F.lit(0))


def _exchanged(staged: DataFrame, first_keys: list[Splitter]) -> DataFrame:
    """Whole rows (row) in the files of their shard, with the task that wrote them (part) and their place there.

    Tasks hold ranges of (shard, key) in rising order, sorted. Small ranges are not merged, so a task's rows stay few.
    """
    spark = staged.sparkSession
    order = ["shard", *PARTS]
    rows = staged.select("row", *PARTS).withColumn("shard", _shard(first_keys).cast("int"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(
        "row", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("place"), "shard")
    path = new_folder(spark, "sharded")
    placed.write.partitionBy("shard").parquet(path, compression=SCRATCH_CODEC)
    return spark.read.schema(placed.schema).parquet(path)


def sharded(docs: DataFrame, shards: int = SHARDS, tolerance: float = TOLERANCE, id_col: str = "doc_id",
            text_col: str = "text", whole: float = WHOLE) -> DataFrame:
    """The sharded documents: whole rows, read from the files of their shard, with their slot there.

    The columns of ``docs`` come back with ``shard_number`` and ``shard_slot``, which has no gaps and follows
    the order of the key. A document's size is its UTF-8 bytes plus one; a null text has none and counts as empty,
    null ids have a key like any other. Shards differ from an equal share by the tolerance at each end,
    or by the one document, or the copies of the one text, at the border. Rows that repeat both id and text
    are told apart by their staged address, which also sets their slots. An empty table gives no rows. An underscore is
    added to a new name that ``docs`` has itself.

    ``whole`` says which law gives way where a shard's border falls within the copies of one text. Copies that take no
    more than this part of a shard's bytes stay in one shard, which may then miss its share by them; copies that take
    more are parted by id, and by address where the id repeats, and sizes stay within the tolerance.
    """
    staged = keyed(docs, id_col, text_col)
    rows = _exchanged(staged, splitters(staged.select("size", *PARTS), shards, tolerance, whole))
    # a row per task and shard; a task's rows of a shard stand together
    runs = rows.groupBy("shard", "part").agg(F.count("*").alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select("shard", "part", (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("offset"))
    return rows.join(F.broadcast(offsets), ["shard", "part"]).select(
        *[F.col("row").getField(c).alias(c) for c in docs.columns],
        F.col("shard").alias(free("shard_number", docs)), (F.col("place") + F.col("offset")).alias(free("shard_slot", docs)))


def placements(docs: DataFrame) -> DataFrame:
    """Where each document went, with size and checksum of the text that its shard holds."""
    return sharded(docs).select(
        "doc_id", _size(F.col("text")).alias("size"), F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        F.lit("bytes").alias("law"), F.col("shard_number").alias("shard"), F.col("shard_slot").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
