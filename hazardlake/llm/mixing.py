"""Mixing sources to target weights along a time-varying curriculum.

Each source has a weight schedule over training time 0 to 1. The integral of the schedule
sets the source's share of all words, its running integral the demand at any time. Documents of
a source stand in a fixed pseudo-random order and are read in whole, again from the start when
the source ends. The words read up to a document, as a share of the source's target, are its
cumulative demand; inverting the schedule's running integral there gives its training position,
and documents are range-sorted by position.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from hazardlake.llm.common import carried, column, enter, free, quoted, settle, ship, stage

WORD = r"[^\x20\x09-\x0D]+"
# A source's documents in its fixed order. The last two are the row's address, so rows that repeat an id or have none
# are told apart and may stand in several slices.
ORDER = ("key", "size", "crc", "sender", "seq")
PACKING = 6  # zstd level of texts on their way
MAX_COPIES = 2
SHARE_OF_ALL = 1.5
WEIGHTS = (3.0, 1.0, 2.0)
# Relative weight at the start, the middle and the end of training, in turn for the sources.
SHAPES = ((1.5, 1.0, 0.5), (1.0, 1.0, 1.0), (0.25, 0.75, 2.25))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _measures(of: Callable[[str], Column], id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    """What the mix needs to know of a document: its source key, size and place in the source's order."""
    order = F.md5(F.coalesce(of(id_col).cast("string"), F.lit("")))
    return {
        "id": of(id_col), "source": of(source_col).cast("string"),
        "src": F.coalesce(of(source_col).cast("string"), F.lit("")), "none": of(source_col).isNull(),
        "size": word_count(of(text_col)), "key": order,
        "crc": F.crc32(F.coalesce(of(text_col), F.lit("")))}


def default_schedules(sources: DataFrame) -> DataFrame:
    """Weights 3, 1, 2, repeating, for the sources by code point, null last; the time-average of a
    source's schedule is its weight. One row per source is ranked, not one per document."""
    rank = F.row_number().over(Window.orderBy("none", "src")) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int"))
    shapes = F.array(*[F.array(*map(F.lit, s)) for s in SHAPES])
    shape = F.element_at(shapes, (rank % len(SHAPES) + 1).cast("int"))
    # the trapezoid integral of each shape is one
    return sources.select("src", "none", "total", weight.alias("weight"), shape.alias("shape")).select(
        "src", "none", "total", F.array(F.lit(0.0), F.lit(0.5), F.lit(1.0)).alias("times"),
        F.expr("transform(shape, v -> v * weight)").alias("rates"))


def integrated(schedules: DataFrame) -> DataFrame:
    """The running integral of each piecewise linear schedule at its knots."""
    steps = F.expr("transform(sequence(0, size(times) - 2), i -> "
                   "(rates[i] + rates[i + 1]) / 2 * (times[i + 1] - times[i]))")
    running = F.expr("transform(sequence(0, size(steps)), i -> aggregate(slice(steps, 1, i), 0D, (a, x) -> a + x))")
    return schedules.withColumn("steps", steps).withColumn("running", running).drop("steps") \
        .withColumn("weight", F.expr("element_at(running, -1)"))


def targets(schedules: DataFrame) -> DataFrame:
    """Words wanted of each source: its share by integrated weight, at most twice its size.

    What lies above goes to the others by weight until none is above. With sources in the order
    of their limit per weight, the limited ones come first, so one running sum finds them all.
    """
    limit = F.col("total") * float(MAX_COPIES)
    order = Window.orderBy("fill", "none", "src")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("total").over(everything) * SHARE_OF_ALL - F.coalesce(F.sum("limit").over(before), F.lit(0.0))) \
        / F.sum("weight").over(after)
    ranked = schedules.withColumn("limit", limit).withColumn("fill", F.col("limit") / F.col("weight")) \
        .withColumn("level", level).withColumn("full", F.col("fill") <= F.col("level"))
    # the first source that is not full sets the level of all that are not
    shared = ranked.withColumn("share", F.min_by("level", F.when(~F.col("full"), F.struct("fill", "none", "src")))
                               .over(everything))
    return shared.withColumn("target", F.when(F.col("full"), F.col("limit")).otherwise(F.col("share") * F.col("weight"))) \
        .select("src", "none", "total", "target", "times", "rates", "running", "weight")


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          schedules=default_schedules) -> DataFrame:
    """Each document with its size, its source's size and target, and how many copies the mix takes.

    ``schedules`` maps the sources (src, none, total) to knots: arrays ``times`` from 0 to 1 and
    positive ``rates``. A document is taken in whole: as often as the target holds the whole
    source, and once more if its middle lies within the rest. Null texts have no words, null ids
    stand where an empty one would, rows that repeat an id stand beside each other, an empty table gives
    no rows.
    """
    measures = _measures(column, id_col, text_col, source_col)
    return _placed(docs.select(*[value.alias(name) for name, value in measures.items()],
                               F.lit(0).alias("sender"), F.monotonically_increasing_id().alias("seq")), schedules)


def _placed(sized: DataFrame, schedules) -> DataFrame:
    """Measured documents with the plan of their source, their start in its order and their copies.

    The order is cut by range into slices of about equal numbers of rows, whatever ids repeat. Words are summed per
    slice, then within it.
    """
    parts = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sliced = settle(sized.repartitionByRange(parts, "src", "none", *ORDER).withColumn("slice", F.spark_partition_id()),
                    "mixing-order")
    sums = sliced.groupBy("src", "none", "slice").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("src", "none").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("src", "none", "slice", F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("offset"))
    sources = sums.groupBy("src", "none").agg(F.sum("words").alias("total"))
    # a row per source, and one more per slice
    plan = settle(offsets.join(targets(integrated(schedules(sources))), ["src", "none"]), "mixing-plan")
    rows = Window.partitionBy("src", "none", "slice").orderBy(*ORDER).rowsBetween(Window.unboundedPreceding, -1)
    placed = sliced.withColumn("start", F.coalesce(F.sum("size").over(rows), F.lit(0))) \
        .join(plan, ["src", "none", "slice"]).withColumn("start", F.col("start") + F.col("offset"))
    whole = F.when(F.col("total") > 0, F.floor(F.col("target") / F.col("total"))).otherwise(F.lit(0)).cast("bigint")
    rest = F.col("target") - F.col("whole") * F.col("total")
    return placed.withColumn("whole", whole).withColumn(
        "copies", (F.col("whole") + (F.col("start") + F.col("size") / 2 < rest).cast("bigint")).cast("int"))


def position(demand: Column) -> Column:
    """The time at which a schedule's running integral reaches a share ``demand`` of its end."""
    wanted = demand * F.col("weight")
    # the last knot below, but not the end
    at = F.least(F.size("times") - 2, F.greatest(F.lit(0), F.size(F.filter("running", lambda r: r <= wanted)) - 1))
    at = at.cast("int")
    begin, rate = F.get("times", at), F.get("rates", at)
    slope = (F.get("rates", at + 1) - rate) / (F.get("times", at + 1) - begin)
    left = wanted - F.get("running", at)
    # the root of rate * x + slope / 2 * x * x = left, in the form that is stable for small slopes
    root = F.sqrt(F.greatest(rate * rate + slope * left * 2, F.lit(0.0)))
    return F.least(F.lit(1.0), begin + F.when(rate + root > 0, left * 2 / (rate + root)).otherwise(0.0))


def _packed(texts: pa.Array) -> pa.Array:
    enter("mixing")
    pack = zstandard.ZstdCompressor(level=PACKING).compress
    return pa.array([None if t is None else pack(t) for t in texts.cast(pa.binary()).to_pylist()], pa.binary())


def _unpacked(texts: pa.Array) -> pa.Array:
    enter("mixing")
    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([None if t is None else unpack(t) for t in texts.to_pylist()], pa.binary()).cast(pa.string())


def _dealt(staged: DataFrame, rows: DataFrame, text_col: str, *parts: int) -> DataFrame:
    """Every copy of every staged row (sender, seq, row) with its training position ``at``, range-sorted by it.

    Texts move compressed, as they were staged, and every copy of a document moves. A number of ``parts`` keeps small ranges from being merged
    into larger tasks.
    """
    def at(copy: int) -> Column:
        demand = (F.col("start") + F.col("size") / 2 + F.col("total") * (copy - 1)) / F.col("target")
        return F.coalesce(position(F.least(F.lit(1.0), demand)), F.lit(0.0))

    places = [f"at{copy}" for copy in range(1, MAX_COPIES + 1)]
    placed = settle(rows.filter("copies > 0").select(
        "sender", "seq", "copies", *[at(i).alias(p) for i, p in enumerate(places, 1)]), "mixing-at")
    copies = carried(staged.select("sender", "seq", "row", "packed", "key"), placed, ["copies", *places]).select(
        "sender", "seq", "row", "packed", "key", F.posexplode(F.slice(F.array(*places), 1, F.col("copies"))).alias("copy", "at")) \
        .withColumn("copy", F.col("copy") + 1)
    ordered = copies.repartitionByRange(*parts, "at", "key", "copy").sortWithinPartitions("at", "key", "copy")
    return ordered.withColumn("text", F.arrow_udf(_unpacked, "string")("packed")).select(
        "sender", "seq", F.col("row").withField(quoted(text_col), F.col("text")).alias("row"), "key", "copy", "at")


def _staged(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """Rows with their measures, the text apart and compressed."""
    ship(docs.sparkSession)
    measures = _measures(lambda c: F.col("row").getField(c), id_col, text_col, source_col)
    return stage(docs, "mixing", lambda row: row.withField(quoted(text_col), F.lit(None).cast("string")),
                 packed=F.arrow_udf(_packed, "binary")(F.col("row").getField(text_col)), **measures)


def scheduled(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              schedules=default_schedules) -> DataFrame:
    """The mix itself: every copy of every document with its training position, range-sorted by it.

    The columns of ``docs`` come back with ``mix_position`` and ``mix_copy`` (an underscore is added to a name that
    ``docs`` has itself). Null texts and ids, ties, repeated rows and empty tables are as in :func:`mixed`. Positions are worked
    out on measures alone; whole rows move once, to their place.
    """
    staged = _staged(docs, id_col, text_col, source_col)
    ordered = _dealt(staged, _placed(staged.drop("row", "packed"), schedules), text_col)
    return ordered.select(*[F.col("row").getField(c).alias(c) for c in docs.columns],
                          F.col("at").alias(free("mix_position", docs)), F.col("copy").alias(free("mix_copy", docs)))


def taken(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
          schedules=default_schedules) -> DataFrame:
    """One row per document: how many words of it the mix takes, repeats counted.

    The mix is written in training order, and words and copies are counted in what was written, by
    the address of the document. Documents that the mix leaves out have none.
    """
    staged = _staged(docs, id_col, text_col, source_col)
    rows = _placed(staged.drop("row", "packed"), schedules)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    mix = settle(_dealt(staged, rows, text_col, parts), "mixing-mix")
    counted = mix.groupBy("sender", "seq").agg(
        F.count("*").cast("int").alias("counted"), F.sum(word_count(F.col("row").getField(text_col))).alias("words"))
    return rows.join(counted, ["sender", "seq"], "left").select(
        F.col("id").alias("doc_id"), "size", F.col("total").alias("source_size"), "target",
        F.coalesce("words", F.lit(0)).cast("bigint").alias("taken"), F.coalesce("counted", F.lit(0)).alias("copies"))
