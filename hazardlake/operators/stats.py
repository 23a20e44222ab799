"""Distribution statistics that stay exact and distributed on large inputs."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, Window
from pyspark.sql.types import ArrayType, StructType

# The bracketing sketch has a rank error of 1 / SKETCH_ACCURACY per group; brackets reach
# four times as far to either side of a wanted rank.
SKETCH_ACCURACY = 2000
BINS = 256
BIT_WORDS = 1 << 18  # 64-bit words of the table of repeated fingerprints: 4 MB with their numbers


def attach(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of a one-row frame as a scalar subquery, evaluated once."""
    packed = one_row.select(F.struct(*one_row.columns).alias("_row"))
    return df.withColumn("_row", packed.scalar()).select(*df.columns, "_row.*")


def held(few: DataFrame) -> DataFrame:
    """The rows of a small result as constants of the plan: whoever uses them does not run again what made them."""
    def literal(value, kind) -> Column:
        if value is not None and isinstance(kind, StructType):
            return F.struct(*[literal(v, f.dataType).alias(f.name) for v, f in zip(value, kind.fields)])
        if value is not None and isinstance(kind, ArrayType):
            return F.array(*[literal(v, kind.elementType) for v in value])
        return F.lit(value).cast(kind)

    spark, rows = few.sparkSession, [literal(r, few.schema) for r in few.collect()]
    if not rows:
        return spark.createDataFrame([], few.schema)
    return spark.range(1).select(F.inline(F.array(*rows)))


def rows_of(weight: str | None, where: Column | None = None) -> Column:
    """The number of rows, or of those that hold a condition; a weight says how many each row stands for."""
    if weight is None:
        return F.count(F.lit(1)) if where is None else F.count_if(where)
    return F.coalesce(F.sum(weight if where is None else F.when(where, F.col(weight))), F.lit(0))


# --- quantiles --------------------------------------------------------------------------

def quantiles(df: DataFrame, value: str | Column, probs: dict[str, float], by: str | None = None,
              weight: str | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation: one row (per group), one column per entry.

    Missing values (null or NaN) do not count; a null group is a group. ``by`` must take values of
    a short fixed list (chart categories, column names), since one row per group is broadcast.

    No task holds the values of a group. Pass 1 brackets each wanted rank with a small mergeable
    sketch and counts the rows. Pass 2 counts the rows below each bracket and, per distinct value,
    the rows inside it; both counts combine before the shuffle, and values above the bracket are
    dropped there. Of rows with a weight, which are counted values already, all are kept. What is left is a sliver of the distinct values. A second sketch cuts it into
    bins of about equally many, whatever their spacing, and only the bins that hold a wanted rank
    are put in order. A bracket that misses its rank on either side raises instead of returning a
    wrong value.
    """
    column = (F.col(value) if isinstance(value, str) else value).cast("double")
    # inside a struct a null group is equal to itself
    group = F.struct((F.col(by) if by else F.lit(0)).alias("key"))
    counted = [F.col(weight).alias("_w")] if weight else []
    values = df.select(group.alias("_g"), column.alias("_v"), *counted).filter("_v IS NOT NULL AND NOT isnan(_v)")
    # a row per group; small results of passes are kept on the driver, not nested in the plan of the next
    targets = held(_brackets(values, list(probs.values())))
    found = _ranked(values, targets, grouped=by is not None)
    # every group and quantile that is wanted, whether or not its rank was found
    wanted = targets.select("_g", F.inline("targets")).select("_g", "i", "rank")
    # one row per group and quantile
    joined = wanted.join(F.broadcast(found), ["_g", "i"], "left")
    interpolated = F.expr("low + (high - low) * (rank - floor(rank))")
    missed = F.raise_error(F.lit("a quantile lies outside its bracket")).cast("double")
    checked = F.when(F.col("low").isNull() | F.col("high").isNull(), missed).otherwise(interpolated)
    result = joined.groupBy("_g").agg(*[
        F.max(F.when(F.col("i") == i, checked)).alias(name) for i, name in enumerate(probs)])
    return held(result.select(*([F.col("_g.key").alias(by)] if by else []), *probs))


def _brackets(values: DataFrame, probs: list[float]) -> DataFrame:
    """One row per group: for each quantile its rank and the edges of its bracket."""
    margin = 4.0 / SKETCH_ACCURACY
    sides = [min(1.0, max(0.0, p + side)) for p in probs for side in (-margin, margin)]
    weight = "_w" if "_w" in values.columns else None
    sketch = F.percentile_approx("_v", sides, SKETCH_ACCURACY) if weight is None else F.lit(None).cast("array<double>")
    edges = values.groupBy("_g").agg(
        rows_of(weight).alias("n"), F.min("_v").alias("least"), F.max("_v").alias("most"), sketch.alias("e"))
    # among few values the two ranks to interpolate between are far apart in share of rows
    few = (F.col("n") < 2 * SKETCH_ACCURACY) | F.lit(weight is not None)
    return edges.select("_g", F.array(*[
        F.struct(
            F.lit(i).alias("i"),
            F.when(few | (sides[2 * i] == 0.0), F.col("least")).otherwise(F.col("e")[2 * i]).alias("lo"),
            F.when(few | (sides[2 * i + 1] == 1.0), F.col("most")).otherwise(F.col("e")[2 * i + 1]).alias("hi"),
            (p * (F.col("n") - 1)).alias("rank"),
        ) for i, p in enumerate(probs)]).alias("targets"))


def _ranked(values: DataFrame, targets: DataFrame, grouped: bool) -> DataFrame:
    """The values at the ranks around each wanted one: (_g, i, low, high)."""
    if grouped:
        bracketed = values.join(F.broadcast(targets), "_g")
    else:
        bracketed = values.withColumn("targets", targets.select("targets").scalar())
    # each value once per quantile whose bracket it does not exceed
    weight = [c for c in ("_w",) if c in values.columns]
    hits = bracketed.select("_g", "_v", *weight, F.inline("targets")).filter("_v <= hi")
    # all values below a bracket count as one
    counted = hits.groupBy("_g", "i", "rank", F.expr("CASE WHEN _v >= lo THEN _v END").alias("v")).agg(
        rows_of(*weight or [None]).alias("c"))
    shares = ", ".join(str(n / BINS) for n in range(1, BINS))
    # the count is taken along, so that both uses of the counts read one exchange
    cuts = counted.groupBy("_g", "i").agg(
        F.expr(f"percentile_approx(v, array({shares}), {4 * SKETCH_ACCURACY})").alias("cuts"),
        F.sum("c").alias("total")).select("_g", "i", F.expr("CASE WHEN total > 0 THEN cuts END").alias("cuts"))
    # one row per group and quantile
    binned = counted.join(F.broadcast(cuts), ["_g", "i"]).select(
        "_g", "i", "rank", "v", "c",
        F.expr("CASE WHEN v IS NULL THEN -1 ELSE size(filter(cuts, cut -> cut <= v)) END").alias("bin"))
    # at most BINS + 1 rows per group and quantile
    bins = binned.groupBy("_g", "i", "rank", "bin").agg(F.sum("c").alias("c")).select(
        "_g", "i", "rank", "bin", "c", _total_before("_g", "i", order="bin").alias("start"))
    wanted = bins.filter("start <= ceil(rank) AND start + c > floor(rank)").select("_g", "i", "bin", "start")
    placed = binned.join(wanted, ["_g", "i", "bin"]).select(
        "_g", "i", "rank", "v", "c", (F.col("start") + _total_before("_g", "i", "bin", order="v")).alias("at"))
    return placed.groupBy("_g", "i").agg(
        F.expr("max(CASE WHEN at <= floor(rank) AND at + c > floor(rank) THEN v END)").alias("low"),
        F.expr("max(CASE WHEN at <= ceil(rank) AND at + c > ceil(rank) THEN v END)").alias("high"))


def _total_before(*partition: str, order: str) -> Column:
    """Sum of the counts ``c`` of the rows before this one."""
    rows = Window.partitionBy(*partition).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum("c").over(rows), F.lit(0))


def clip_upper(df: DataFrame, value: str, prob: float = 0.99, name: str | None = None) -> DataFrame:
    """Limit a column to its own quantile; nulls stay null."""
    capped = df.withColumn("_cap", quantiles(df, value, {"_cap": prob}).scalar())
    limited = F.when(F.col(value).isNotNull(), F.least(value, "_cap"))
    return capped.withColumn(name or value, limited).drop("_cap")


# --- box statistics ------------------------------------------------------------------------

def box_statistics(df: DataFrame, value: str, group: str, categories, weight: str | None = None) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers and outlier count per category.

    ``categories`` lists the groups to report, which bounds the fence table that is
    broadcast against the data to its length.
    """
    rows = df.filter(F.col(group).isin(*categories) & F.col(value).isNotNull()).select(group, value, *([weight] if weight else []))
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    fences = quantiles(rows, value, {"q1": 0.25, "median": 0.5, "q3": 0.75}, by=group, weight=weight).withColumns(
        {"low_fence": F.col("q1") - reach, "high_fence": F.col("q3") + reach})
    inside = F.col(value).between(F.col("low_fence"), F.col("high_fence"))
    return (
        rows.join(F.broadcast(fences), group)
        .groupBy(group, "q1", "median", "q3")
        .agg(rows_of(weight).alias("n"),
             F.min(F.when(inside, F.col(value))).alias("_low"),
             F.max(F.when(inside, F.col(value))).alias("_high"),
             rows_of(weight, ~inside).alias("outliers"))
        .select(group, "n", "q1", "median", "q3",
                F.least("q1", "_low").alias("whisker_low"),
                F.greatest("q3", "_high").alias("whisker_high"), "outliers")
    )


# --- histograms -----------------------------------------------------------------------------

def histogram(df: DataFrame, columns, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum of each column, empty bins included.

    The maximum falls in the last bin; a constant column gets a range of one around it.
    """
    limits = df.agg(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.min(c).cast("double").alias("lo"),
                 F.max(c).cast("double").alias("hi")) for c in columns
    ]).alias("limits")).select(F.inline("limits"))
    # one row per column of the request
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("v")) for c in columns])))
    return bars(long, limits, bins)


def bars(long: DataFrame, limits: DataFrame, bins: int) -> DataFrame:
    """Bin counts of ``v`` per ``variable`` within limits ``lo`` and ``hi``.

    ``limits`` has one row per variable, with any further columns to carry along. Values
    above the upper limit count in the last bin, as if clipped.
    """
    return _bars(long.join(F.broadcast(_ranges(limits)), "variable"), limits, bins)


def bars_of_one(values: DataFrame, limits: DataFrame, bins: int, weight: str | None = None) -> DataFrame:
    """As ``bars`` for a single variable, whose one row of limits enters as a scalar."""
    return _bars(attach(values, _ranges(limits)).filter("lo IS NOT NULL"), limits, bins, weight)


def _ranges(limits: DataFrame) -> DataFrame:
    flat = F.col("lo") == F.col("hi")
    return limits.filter("lo IS NOT NULL").withColumns({
        "lo": F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")),
        "hi": F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi"))})


def _bars(ranged: DataFrame, limits: DataFrame, bins: int, weight: str | None = None) -> DataFrame:
    name = [c for c in limits.columns if c == "variable"]
    carried = [c for c in limits.columns if c not in ("variable", "lo", "hi")]
    position = F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counts = (
        ranged.filter("v IS NOT NULL")
        .groupBy(*name, "lo", "hi", *carried, F.least(F.lit(bins - 1), position).cast("int").alias("bin"))
        .agg(rows_of(weight).alias("n"))
    )
    # at most one entry per bin
    per_variable = counts.groupBy(*name, "lo", "hi", *carried).agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "n"))).alias("filled"))
    width = (F.col("hi") - F.col("lo")) / bins
    return per_variable.select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    ).select(
        *name, "bin", (F.col("lo") + width * F.col("bin")).alias("lower"),
        (F.col("lo") + width * (F.col("bin") + 1)).alias("upper"),
        F.coalesce(F.try_element_at("filled", F.col("bin")), F.lit(0)).alias("n"), *carried)


# --- whole-table profiles ---------------------------------------------------------------------

def correlations(df: DataFrame, columns) -> DataFrame:
    """Lower triangle of the Pearson matrix over the present columns, from one pass without further rows.

    Each task adds up the co-moments of all pairs, a batch at a time, and sends one row per pair.
    Each row counts for the pairs it has both values of. Fewer than three columns give no
    rows, and a pair without variance has no coefficient.
    """
    present = [c for c in columns if c in df.columns]
    names = [(b, a) for a, b in combinations(present, 2)] if len(present) >= 3 else []
    if not names:
        return df.sparkSession.createDataFrame([], "column_a string, column_b string, r double")
    numbers = df.select(*[F.col(c).cast("double").alias(f"c{i}") for i, c in enumerate(present)])
    parts = numbers.mapInArrow(_co_moments([(present.index(a), present.index(b)) for a, b in names]), _CO_MOMENTS)
    whole = parts.groupBy("pair").agg(
        F.sum(F.col("n") * F.col("mx")).alias("sx"), F.sum(F.col("n") * F.col("my")).alias("sy"), F.sum("n").alias("all"))
    # around the common means: what each task found around its own, and the distance of those
    dx, dy = F.col("mx") - F.col("sx") / F.col("all"), F.col("my") - F.col("sy") / F.col("all")
    moments = parts.join(whole, "pair").groupBy("pair").agg(
        F.sum(F.col("cxx") + F.col("n") * dx * dx).alias("xx"), F.sum(F.col("cyy") + F.col("n") * dy * dy).alias("yy"),
        F.sum(F.col("cxy") + F.col("n") * dx * dy).alias("xy"),
        ((F.min("lx") < F.max("hx")) & (F.min("ly") < F.max("hy"))).alias("varies"))
    pairs = df.sparkSession.createDataFrame([(i, *n) for i, n in enumerate(names)], "pair int, column_a string, column_b string")
    # at most one row per pair on either side
    return pairs.join(F.broadcast(moments), "pair", "left").select(
        "column_a", "column_b", F.expr("CASE WHEN varies THEN try_divide(xy, sqrt(xx * yy)) END").alias("r"))


_CO_MOMENTS = ("pair int, n double, mx double, my double, cxx double, cyy double, cxy double, lx double, hx double, "
               "ly double, hy double")


def _co_moments(pairs: list[tuple[int, int]]):
    """One row per task and pair of columns: rows with both values, their means, co-moments, and limits.

    Sums are taken around a task's first values, so that they lose no digits to large means.
    """
    def scan(batches):
        # within, so that workers need nothing of this package
        import numpy as np
        import pyarrow as pa

        names = ("pair", "n", "mx", "my", "cxx", "cyy", "cxy", "lx", "hx", "ly", "hy")
        sums, around = {}, {}
        for batch in batches:
            valid = [c.is_valid().to_numpy(zero_copy_only=False) for c in batch.columns]
            values = [c.fill_null(0).to_numpy(zero_copy_only=False) for c in batch.columns]
            for i, (a, b) in enumerate(pairs):
                both = valid[a] & valid[b]
                x, y = (values[a], values[b]) if both.all() else (values[a][both], values[b][both])
                if not len(x):
                    continue
                around.setdefault(i, (x[0], y[0]))
                dx, dy = x - around[i][0], y - around[i][1]
                found = np.array([len(x), dx.sum(), dy.sum(), dx @ dx, dy @ dy, dx @ dy])
                limits = np.array([x.min(), y.min(), -x.max(), -y.max()])
                before = sums.get(i)
                sums[i] = (found, limits) if before is None else (before[0] + found, np.minimum(before[1], limits))
        rows = []
        for i, ((n, sx, sy, xx, yy, xy), (lx, ly, hx, hy)) in sums.items():
            rows.append((i, n, around[i][0] + sx / n, around[i][1] + sy / n, xx - sx * sx / n, yy - sy * sy / n,
                         xy - sx * sy / n, lx, -hx, ly, -hy))
        kinds = [pa.int32()] + [pa.float64()] * 10
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(c), k) for c, k in zip(zip(*rows) if rows else [[]] * 11, kinds)], names=list(names))

    return scan


def describe(df: DataFrame, columns, decimals: int = 2) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum of each column."""
    names = [c for c in columns if c in df.columns]
    numbers = df.select(*[F.col(c).cast("double").alias(c) for c in names])
    moments = numbers.agg(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.count(c).alias("count"), F.avg(c).alias("mean"),
                 F.stddev_samp(c).alias("std"), F.min(c).alias("min"), F.max(c).alias("max"))
        for c in names]).alias("m")).select(F.inline("m"))
    long = numbers.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).alias("v")) for c in names])))
    quartiles = quantiles(long, "v", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, by="variable")
    return moments.join(F.broadcast(quartiles), "variable", "left").select(
        "variable", "count",
        *[F.round(c, decimals).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def null_profile(df: DataFrame, columns=None) -> DataFrame:
    """Null count and percentage per column plus their total, from a single pass."""
    names = list(columns or df.columns)
    counts = df.agg(F.count("*").alias("_rows"),
                    *[F.count_if(F.col(c).isNull()).alias(f"_{i}") for i, c in enumerate(names)])
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"_{i}").alias("nulls")) for i, c in enumerate(names)]
    total = F.struct(F.lit("TOTAL").alias("column_name"),
                     sum((F.col(f"_{i}") for i in range(len(names))), F.lit(0)).cast("bigint").alias("nulls"))
    share = F.round(F.col("c.nulls") * 100.0 / F.greatest(F.col("_rows"), F.lit(1)), 2)
    return counts.select("_rows", F.explode(F.array(*cells, total)).alias("c")).select(
        "c.*", F.when(F.col("c.column_name") != "TOTAL", share).alias("null_pct"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows equal to an earlier one: their count and percentage. Nulls compare equal.

    One pass counts 64-bit fingerprints, which gives the number of rows as well. Whole rows are moved and
    grouped only where a fingerprint repeats, which keeps the count exact when fingerprints collide; a bit table of
    fixed size tells where that may be, before any row moves.
    """
    marked = df.withColumn("_print", F.xxhash64(*df.columns))
    prints = marked.groupBy("_print").agg(F.count("*").alias("_c"))
    repeated = prints.filter("_c > 1").select("_print")
    # a bit table of the repeated ones, at most BIT_WORDS rows, keeps rows out that cannot repeat
    place = F.pmod(F.col("_print"), F.lit(64 * BIT_WORDS))
    table = repeated.groupBy(F.floor(place / 64).alias("_word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST(pmod(_print, {64 * BIT_WORDS}) % 64 AS INT))")).alias("_bits"))
    likely = marked.withColumn("_word", F.floor(place / 64)).join(F.broadcast(table), "_word") \
        .filter(F.getbit("_bits", (place % 64).cast("int")) == 1)
    rows = likely.join(repeated, "_print", "left_semi").select(*df.columns)
    extra = rows.groupBy(*df.columns).agg(F.count("*").alias("_c")).agg(
        F.coalesce(F.sum(F.col("_c") - 1), F.lit(0)).alias("duplicates"))
    total = prints.agg(F.coalesce(F.sum("_c"), F.lit(0)).alias("rows"))
    counted = extra.withColumn("rows", total.scalar())
    return counted.select(
        "duplicates",
        F.when(F.col("rows") > 0, F.round(F.col("duplicates") * 100.0 / F.col("rows"), 2)).otherwise(0.0)
        .alias("duplicates_pct"))


# --- dense calendars -----------------------------------------------------------------------------

def every_month(per_month: DataFrame) -> DataFrame:
    """One row per month 1..12, null where there is no data."""
    months = per_month.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("mes"))
    return months.join(per_month, "mes", "left")


def dense_months(per_month: DataFrame, fill: dict[str, float]) -> DataFrame:
    """One row per month 1..12; months without data get the fill value."""
    return every_month(per_month).select(
        "mes", *[F.coalesce(F.col(c), F.lit(value)).alias(c) for c, value in fill.items()])
