"""Slowly changing measurements (tree volume, leaf counts, regimes) looked up at the time of a cycle.

Cycles and measurements are put on one time line per key and each cycle takes its neighbours, so a lookup costs one
shuffle of both tables whatever the gaps between measurements are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respira.functions.units import absolute_flux, floor_area, leaf_area
from respira.plans.series import micros
from respira.plans.timejoin import neighbours

DAY_US = 86_400_000_000


def nearest_measurement(
    rows: DataFrame, dim: DataFrame, key: str, ts: str, dim_key: str, dim_date: str, cols: list[str], max_days: int = 30
) -> DataFrame:
    """Columns of the measurement nearest in time, at most ``max_days`` away; the earlier one on ties."""
    d = dim.select(F.col(dim_key).alias(key), micros(dim_date).alias("_m"), *cols).dropDuplicates([key, "_m"])
    j = neighbours(rows.withColumn("_us", micros(ts)), d, [key], "_us", "_m", cols)
    back, ahead = F.col("_us") - F.col("_prev._m"), F.col("_next._m") - F.col("_us")
    reach = max_days * DAY_US
    pick = F.when((back <= reach) & (ahead.isNull() | (back <= ahead)), F.col("_prev")).when(ahead <= reach, F.col("_next"))
    return j.withColumn("_pick", pick).withColumns({c: F.col("_pick")[c] for c in cols}).drop("_us", "_prev", "_next", "_pick")


def interpolated_measurement(
    rows: DataFrame, dim: DataFrame, key: str, ts: str, dim_key: str, dim_date: str, value: str, out: str
) -> DataFrame:
    """Value at the time of the row, linear between measurements; none before the first, the last one after it."""
    known = dim.filter(F.col(value).isNotNull()).groupBy(F.col(dim_key).alias(key), micros(dim_date).alias("_m")).agg(
        F.first(value).alias("_v")
    )
    j = neighbours(rows.withColumn("_us", micros(ts)), known, [key], "_us", "_m", ["_v"])
    p, n = F.col("_prev"), F.col("_next")
    mid = p["_v"] + (n["_v"] - p["_v"]) * F.try_divide(F.col("_us") - p["_m"], n["_m"] - p["_m"])
    return j.withColumn(out, F.when(n.isNull(), p["_v"]).otherwise(mid)).drop("_us", "_prev", "_next")


def correct_for_tree_volume(
    cycles: DataFrame, dim: DataFrame, key: str, ts: str, dim_key: str, dim_date: str, value: str
) -> DataFrame:
    """Recompute the absolute flux with the air the tree displaces, where its volume is known."""
    d = interpolated_measurement(cycles, dim, key, ts, dim_key, dim_date, value, "tree_volume")
    flux = absolute_flux(F.col("flux_slope"), F.col("mean_temp"), F.col(ts), F.col("tree_volume"))
    return d.withColumn(
        "flux_absolute", F.when(F.col("tree_volume").isNotNull(), flux).otherwise(F.col("flux_absolute"))
    )


def effective_leaf_area_index(
    cycles: DataFrame,
    dim: DataFrame,
    key: str,
    ts: str,
    dim_key: str,
    dim_date: str,
    n_leaves: str = "n_leaves",
    method: str = "conservative",
    floor_areas: DataFrame | None = None,
) -> DataFrame:
    """Leaf count, leaf area, floor area and leaf area index from the nearest measurement within 30 days.

    ``floor_areas`` (key, ts, floor_area) overrides the built-in floor area for given cycles.
    """
    d = nearest_measurement(cycles, dim, key, ts, dim_key, dim_date, [n_leaves])
    known = F.col(n_leaves).isNotNull()
    area = floor_area(F.col(ts))
    if floor_areas is not None:
        f = floor_areas.select(F.col(key).alias("_fk"), F.col(ts).alias("_ft"), F.col("floor_area").alias("_fa"))
        d = d.join(f, (d[key] == f["_fk"]) & (d[ts] == f["_ft"]), "left").drop("_fk", "_ft")
        area = F.coalesce(F.col("_fa"), area)
    d = d.withColumn("leaf_area_m2", leaf_area(F.col(n_leaves), method))
    d = d.withColumn("chamber_floor_area_m2", F.when(known, area)).drop("_fa")
    return d.withColumn("lai_effective", F.col("leaf_area_m2") / F.col("chamber_floor_area_m2"))


def regime_scores(audit: DataFrame) -> DataFrame:
    """Agreement score per calendar day from regimes ``start, end, slope, r2, quality, agreement_score, slope_warning``
    with ``position``; where regimes overlap the later row counts."""
    r2, slope = F.coalesce("r2", F.lit(0.0)), F.coalesce("slope", F.lit(1.0))
    derived = 0.5 * F.greatest(F.lit(0.0), r2) + 0.5 * F.greatest(F.lit(0.0), 1 - 2 * F.abs(slope - 1))
    poor = (F.coalesce(F.col("quality"), F.lit("")) != "good") | F.coalesce("slope_warning", F.lit(False))
    score = F.when(poor, 0.0).otherwise(F.coalesce(F.col("agreement_score"), derived))
    days = audit.withColumn("_score", score).withColumn(
        "date", F.explode(F.sequence(F.col("start").cast("date"), F.col("end").cast("date")))
    )
    return days.groupBy("date").agg(F.max_by("_score", "position").alias("regime_score"))


def attach_regime_score(cycles: DataFrame, scores: DataFrame, ts: str) -> DataFrame:
    """Score of the cycle's day, 0.5 for days no regime covers."""
    d = cycles.withColumn("date", F.col(ts).cast("date")).join(scores, "date", "left")
    return d.withColumn("regime_score", F.coalesce("regime_score", F.lit(0.5))).drop("date")
