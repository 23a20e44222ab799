"""Risk predictions per zone, day and horizon from a fitted and stored model.

The features of a zone's day are its sensor means and the rolling means of fire power; the target is
the zone's mean risk score one, two or three days later. One ridge regression is fitted per horizon. Its sums
are made in one aggregate over the days, so the fit reads them once and gives the same model whatever
the partitions, up to rounding; solving is a matter of the features alone.
"""

from __future__ import annotations

import hashlib
import json
import math
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hazardlake import constants as k
from hazardlake.operators.features import rolling_means

MEASURES = ("risk_score", "temp_celsius", "humidity_pct", "wind_kmh", "hotspot_count")
FEATURES = (*MEASURES, *(f"media_{n}d" for n in k.ROLLING_DAYS), "sazonal_sen", "sazonal_cos")
TRAIN_SHARE = 0.7
RIDGE = 1e-3


# --- features -----------------------------------------------------------------------------------

def zone_days(sensors: DataFrame, detections: DataFrame, horizons: tuple[int, ...] = k.HORIZON_HOURS) -> DataFrame:
    """One row per zone and day: the features, and the mean risk score ``alvo_{h}`` of the day that lies ``h`` hours on.

    Days are aggregated first; targets come by joining them with themselves on zone and day. Missing
    measures stay null here. Events without a zone or time take no part.
    """
    events = sensors.filter(F.col("grid_id").isNotNull() & F.col("event_time").isNotNull())
    daily = events.groupBy("grid_id", F.to_date("event_time").alias("dia")).agg(*[F.avg(m).alias(m) for m in MEASURES])
    fires = rolling_means(detections.filter(F.col("grid_id").isNotNull()).withColumn("_date", F.to_date("event_time")),
                          "grid_id", "_date", "frp", k.ROLLING_DAYS).drop("observacoes")
    angle = 2 * math.pi * F.dayofyear("dia") / 365.25
    rows = daily.join(fires, ["grid_id", "dia"], "left").withColumns({"sazonal_sen": F.sin(angle), "sazonal_cos": F.cos(angle)})
    for hours in horizons:
        later = daily.select("grid_id", F.date_sub("dia", hours // 24).alias("dia"), F.col("risk_score").alias(f"alvo_{hours}"))
        rows = rows.join(later, ["grid_id", "dia"], "left")
    return rows


def split_by_time(days: DataFrame, share: float = TRAIN_SHARE,
                  horizons: tuple[int, ...] = k.HORIZON_HOURS) -> tuple[DataFrame, DataFrame]:
    """The first days for fitting and the rest for testing. Targets that lie beyond the cut are not fitted on."""
    span = days.agg(F.min("dia").alias("a"), F.max("dia").alias("b")).first()
    if span.a is None:
        return days, days
    cut = F.date_add(F.lit(span.a), int((span.b - span.a).days * share))
    known = {f"alvo_{h}": F.when(F.date_add("dia", h // 24) <= cut, F.col(f"alvo_{h}")) for h in horizons}
    return days.filter(F.col("dia") <= cut).withColumns(known), days.filter(F.col("dia") > cut)


# --- the model ------------------------------------------------------------------------------------

class Horizon(NamedTuple):
    hours: int
    intercept: float
    weights: list[float]
    error: float  # root mean square on the days fitted
    rows: int


class Model(NamedTuple):
    """Means and spreads that scale the features, and one regression per horizon."""
    means: list[float]
    spreads: list[float]
    horizons: list[Horizon]

    @property
    def version(self) -> str:
        return "ridge-" + hashlib.sha256(json.dumps(self.rounded()).encode()).hexdigest()[:12]

    def rounded(self) -> list:
        """What the version depends on: figures without the noise of the order of sums."""
        def plain(values):
            return [float(f"{v:.6g}") for v in values]

        return [plain(self.means), plain(self.spreads), [[h.hours, *plain([h.intercept, *h.weights]), h.rows] for h in self.horizons]]

    def save(self, path: str) -> None:
        spark = SparkSession.active()
        text = json.dumps([self.means, self.spreads, [list(h) for h in self.horizons]])
        spark.createDataFrame([(self.version, text)], "model_version string, model string").coalesce(1).write.parquet(path)


def load(spark: SparkSession, path: str) -> Model:
    means, spreads, horizons = json.loads(spark.read.parquet(path).first().model)
    return Model(means, spreads, [Horizon(*h) for h in horizons])


def _scaled(means: list[float], spreads: list[float]) -> list[Column]:
    """Features in units of their spread; a missing one counts as its mean."""
    return [F.coalesce((F.col(f).cast("double") - m) / s, F.lit(0.0)) for f, m, s in zip(FEATURES, means, spreads)]


def fit(days: DataFrame, horizons: tuple[int, ...] = k.HORIZON_HOURS) -> Model:
    """Fit on days with targets. Where no day has a horizon's target, its regression is the constant zero."""
    stats = days.agg(*[f(c).alias(f"{n}_{c}") for c in FEATURES for n, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    means = [stats[f"m_{c}"] or 0.0 for c in FEATURES]
    spreads = [stats[f"s_{c}"] or 1.0 for c in FEATURES]
    terms = [F.lit(1.0), *_scaled(means, spreads)]
    size = len(terms)
    sums = []
    for hours in horizons:
        target, known = F.col(f"alvo_{hours}"), F.col(f"alvo_{hours}").isNotNull()
        # upper triangle of the products of features, those with the target, and the target's own
        products = [terms[i] * terms[j] for i in range(size) for j in range(i, size)] + [t * target for t in terms] + [target * target]
        sums.append(F.array(*[F.coalesce(F.sum(F.when(known, p)), F.lit(0.0)) for p in products]).alias(f"h{hours}"))
    found = days.agg(*sums).first()
    return Model(means, spreads, [_solved(hours, np.array(found[f"h{hours}"]), size) for hours in horizons])


def _solved(hours: int, sums: np.ndarray, size: int) -> Horizon:
    gram = np.zeros((size, size))
    gram[np.triu_indices(size)] = sums[:size * (size + 1) // 2]
    gram = gram + np.triu(gram, 1).T
    moments, square = sums[-size - 1:-1], sums[-1]
    rows = gram[0, 0]
    if not rows:
        return Horizon(hours, 0.0, [0.0] * (size - 1), 0.0, 0)
    penalty = RIDGE * rows * np.diag([0.0] + [1.0] * (size - 1))
    weights = np.linalg.solve(gram + penalty, moments)
    rest = square - 2 * weights @ moments + weights @ gram @ weights
    return Horizon(hours, float(weights[0]), [float(w) for w in weights[1:]], math.sqrt(max(rest, 0.0) / rows), int(rows))


def predictions(model: Model, days: DataFrame, created_at: Column | None = None) -> DataFrame:
    """The prediction table: a risk score of 0 to 100 per zone, day and horizon.

    ``confidence`` falls from 1 to 0 as the model's error on the fitted days grows to the whole range of scores.
    ``observed`` is the score that came, where it is known.
    """
    terms = _scaled(model.means, model.spreads)
    rows = [F.struct(
        F.lit(h.hours).alias("horizon_hours"),
        F.least(F.lit(100.0), F.greatest(F.lit(0.0), sum((w * t for w, t in zip(h.weights, terms)), F.lit(h.intercept))))
        .alias("predicted_risk"),
        F.lit(max(0.0, 1 - h.error / 100)).alias("confidence"), F.col(f"alvo_{h.hours}").alias("observed"))
        for h in model.horizons]
    found = days.select("grid_id", F.col("dia").alias("prediction_date"), F.explode(F.array(*rows)).alias("p")).select(
        "grid_id", "prediction_date", "p.*", F.lit(model.version).alias("model_version"))
    return found if created_at is None else found.withColumn("created_at", created_at)


def held_out_error(scored: DataFrame) -> DataFrame:
    """Root mean square error per horizon, over rows whose observed score is known."""
    gap = F.col("predicted_risk") - F.col("observed")
    return scored.filter("observed IS NOT NULL").groupBy("horizon_hours").agg(F.sqrt(F.avg(gap * gap)).alias("erro"))
