"""Detections joined with the reanalysis, and features of cells and zones for a risk model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from hazardlake import constants as k
from hazardlake.functions.geo import cell_area, cell_centre, neighbours

DAY = "dia"
# an array within a row has fewer rows than twice the first step: a row ends at 2 GB, and an instant takes 24 bytes
SEARCH_STEPS = tuple(2 ** power for power in reversed(range(27)))


# --- as-of join -------------------------------------------------------------------------------

def asof_join(left: DataFrame, right: DataFrame, keys: tuple[str, ...], left_time: str, right_time: str,
              tolerance_seconds: int, values: tuple[str, ...]) -> DataFrame:
    """Each left row with the ``values`` of the latest right row of its keys, not after it and not older than the tolerance.

    The right side has one row per keys and time. Time is cut into slots as long as the tolerance; the right rows of
    a slot travel as one sorted array, which begins with the last row of the slot before. Whatever a left row may
    match stands in the array of its slot, so the join is on keys and slot alone: left rows are neither sorted nor
    gathered, and AQE splits a slot that many of them share. A left row halves its array until the match is found, by
    plain expressions, which read the array in place: its work grows with the logarithm of the slot's instants, and the
    array is not copied per row. The instants of one tolerance must fit into a row. A left row without a match keeps
    null values; so does one with a null key or time. Adds ``matched_time`` and ``values``.
    """
    def slot(time: Column) -> Column:
        return F.floor(F.unix_seconds(time) / tolerance_seconds)

    by = [*keys, "_slot"]
    # partitioned first: rows are gathered once, not per map task and again
    gathered = right.filter(F.col(right_time).isNotNull()).select(
        *keys, slot(F.col(right_time)).alias("_slot"), F.struct(F.col(right_time).alias("at"), *values).alias("_row")) \
        .repartition(*by).groupBy(*by).agg(F.sort_array(F.collect_list("_row")).alias("_own"))
    entered = gathered.select(*keys, F.inline(F.array(
        F.struct(F.col("_slot").alias("_slot"), F.col("_own").alias("_part")),
        F.struct((F.col("_slot") + 1).alias("_slot"), F.slice("_own", -1, 1).alias("_part")))))
    slots = entered.repartition(*by).groupBy(*by).agg(F.flatten(F.sort_array(F.collect_list("_part"))).alias("_rows"))

    joined = left.withColumn("_slot", slot(F.col(left_time))).join(slots, by, "left").withColumn("_n", F.lit(0))
    for step in SEARCH_STEPS:  # _n rows are known to be not after the left row
        fits = F.get("_rows", F.col("_n") + (step - 1))["at"] <= F.col(left_time)
        joined = joined.withColumn("_n", F.col("_n") + F.when(fits, step).otherwise(0))
    last = F.get("_rows", F.col("_n") - 1)
    age = F.expr(f"INTERVAL {int(tolerance_seconds)} SECONDS")
    joined = joined.withColumn("_last", F.when(last["at"] >= F.col(left_time) - age, last))
    return joined.select(*[F.col(c) for c in left.columns], F.col("_last")["at"].alias("matched_time"),
                         *[F.col("_last")[v].alias(v) for v in values])


def on_grid(df: DataFrame, step: float = k.GRID_STEP) -> DataFrame:
    """Adds the row and column (``ponto_lat``, ``ponto_lon``) of the reanalysis point nearest to each location."""
    def snapped(value: str, origin: float) -> Column:
        return F.floor((F.col(value) - origin) / step + 0.5).cast("int")

    return df.withColumns({"ponto_lat": snapped("latitude", k.LATITUDE_RANGE.low),
                           "ponto_lon": snapped("longitude", k.LONGITUDE_RANGE.low)})


GRID_VALUES = ("temp_c", "rh", "wind_speed_kmh")


def detections_with_weather(detections: DataFrame, points: DataFrame, time: str = "event_time",
                            tolerance_hours: int = k.WEATHER_TOLERANCE_HOURS,
                            values: tuple[str, ...] = GRID_VALUES) -> DataFrame:
    """Detections with the reanalysis of their grid point at the last instant before them.

    Several values of one point and instant are averaged; points without an instant have no part.
    """
    weather = on_grid(points).groupBy("ponto_lat", "ponto_lon", "time").agg(*[F.avg(v).alias(v) for v in values])
    return asof_join(on_grid(detections), weather, ("ponto_lat", "ponto_lon"), time, "time",
                     tolerance_hours * 3600, values)


# --- rolling means ------------------------------------------------------------------------------

def rolling_means(df: DataFrame, key: str, date: str, value: str, days: tuple[int, ...]) -> DataFrame:
    """For each key and day with rows: the mean of ``value`` over the last 7, 30 or other ``days``, that day included.

    Days are summed first. They are then cut into blocks as long as the longest window; a day enters its own
    block and the next, so a window's days stand in one block and no key fills a task. Days without
    rows count as no data, not as zero; a window without values is null.
    Columns: key, ``dia``, ``observacoes``, and ``media_{n}d`` for each window.
    """
    span = max(days)
    daily = df.filter(F.col(date).isNotNull()).groupBy(F.col(key), F.to_date(date).alias(DAY)).agg(
        F.sum(F.col(value).cast("double")).alias("_sum"), F.count(value).alias("_n"), F.count("*").alias("observacoes"))
    number = F.unix_date(DAY)
    block = F.floor(number / span)
    entered = daily.withColumn("_day", number).select(
        "*", F.posexplode(F.array(block, block + 1)).alias("_later", "_block"))
    # a key that is null has windows of its own, like any other
    in_block = Window.partitionBy(key, "_block").orderBy("_day")
    means = {}
    for n in days:
        window = in_block.rangeBetween(1 - n, Window.currentRow)
        means[f"media_{n}d"] = F.try_divide(F.sum("_sum").over(window), F.sum("_n").over(window))
    return entered.select("*", *[m.alias(name) for name, m in means.items()]).filter("_later = 0") \
        .select(key, DAY, "observacoes", *means)


# --- equal-area cells -----------------------------------------------------------------------------

def per_cell(df: DataFrame) -> DataFrame:
    """Detections per 5 x 5 km cell: count, mean and largest FRP, and the same over the cell and its eight neighbours.

    Cells are aggregated first; only these few rows are sent to their neighbours. A cell beyond the box's edge
    without detections has no row but counts as empty for those inside. Rows without a location are left out.
    """
    located = df.filter(F.col("latitude").isNotNull() & F.col("longitude").isNotNull())
    cells = located.select(cell_area(F.col("latitude"), F.col("longitude")).alias("celula"), "frp").groupBy("celula").agg(
        F.count("*").alias("hotspots"), F.sum("frp").alias("_sum"), F.count("frp").alias("_n"), F.max("frp").alias("frp_max"))
    sent = cells.select(F.explode(neighbours(F.col("celula"))).alias("vizinho"), "celula", "hotspots", "_sum", "_n", "frp_max")
    own = F.col("vizinho") == F.col("celula")
    gathered = sent.groupBy("vizinho").agg(
        F.max(F.when(own, F.col("hotspots"))).alias("hotspots"),
        F.max(F.when(own & (F.col("_n") > 0), F.col("_sum") / F.col("_n"))).alias("frp_medio"),
        F.max(F.when(own, F.col("frp_max"))).alias("frp_max"),
        F.sum("hotspots").alias("hotspots_vizinhanca"),
        F.try_divide(F.sum("_sum"), F.sum("_n")).alias("frp_vizinhanca"),
        F.max("frp_max").alias("frp_max_vizinhanca")).filter("hotspots IS NOT NULL")
    latitude, longitude = cell_centre(F.col("vizinho"))
    return gathered.select(
        F.col("vizinho.x").alias("celula_x"), F.col("vizinho.y").alias("celula_y"), latitude.alias("latitude"),
        longitude.alias("longitude"), "hotspots", "frp_medio", "frp_max", "hotspots_vizinhanca", "frp_vizinhanca",
        "frp_max_vizinhanca")
