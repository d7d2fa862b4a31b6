"""Anomaly scores of cycles: rolling z, seasonal residuals, robust covariance and the rank ensemble."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respira.functions.numeric import true
from respira.operators.drift import centred, full_frame
from respira.operators.integrate import HOUR_US, attach_nearest_hour, interpolate, time_grid
from respira.operators.robust import robust_covariance
from respira.plans.quantiles import exact_medians, exact_quantiles
from respira.plans.series import Series, join_few, micros, null_safe_join
from respira.plans.sizing import cut_lineage

# Detector column and whether high values are the odd ones; None means both ends are.
DETECTORS = {
    "ml_if": ("ml_if_score", False),
    "ml_mcd": ("ml_mcd_dist", True),
    "lof": ("lof_score", False),
    "tif": ("tif_score", False),
    "stl": ("stl_residual_zscore", None),
    "rz": ("rolling_zscore", None),
}
# Weight of each detector.
ENSEMBLE_WEIGHTS = {"ml_if": 0.15, "ml_mcd": 0.15, "lof": 0.20, "tif": 0.15, "stl": 0.20, "rz": 0.15}


def rolling_zscore(
    cycles: DataFrame, keys: list[str], order: list[str], slope: str, width: int = 12, need: int = 4, limit: float = 3.0
) -> DataFrame:
    """``rolling_zscore`` against the centred window of ``width`` cycles of the chamber, flagged beyond ``limit``."""
    before, after = centred(width)
    frames = {"_m": full_frame(F.avg, slope, need), "_s": full_frame(F.stddev_samp, slope, need)}
    d = Series.of(cycles, keys, order).rows_frame(before, after, frames).df
    z = F.try_divide(F.col(slope) - F.col("_m"), F.col("_s"))
    d = d.withColumn("rolling_zscore", z).drop("_m", "_s")
    return d.withColumn("rolling_zscore_flag", true(F.abs("rolling_zscore") > limit).cast("int"))


def seasonal_residuals(
    cycles: DataFrame, keys: list[str], ts: str, slope: str, period: int = 24, max_gap_hours: int = 3
) -> DataFrame:
    """Hourly residuals ``keys, hour_us, residual, zscore`` of the chamber's daily pattern.

    A robust classical decomposition: centred 24-hour mean as trend, median of the detrended values per hour of day as
    season. It does not reproduce a LOESS decomposition digit by digit. Gaps are bridged up to ``max_gap_hours`` from
    either side; chambers with under three days of hours or no spread give no rows.
    """
    hour = (F.floor(micros(ts) / HOUR_US) * HOUR_US).alias("hour_us")
    med = exact_quantiles(cycles.select(*keys, hour, F.col(slope)), [*keys, "hour_us"], slope, {"_x": 0.5}).drop("n")
    grid = time_grid(med, keys, "hour_us", HOUR_US).join(med, [*keys, "hour_us"], "left")
    s = interpolate(Series.of(grid, keys, ["hour_us"]), ["_x"], limit_us=max_gap_hours * HOUR_US)
    d = s.df.filter("_x IS NOT NULL")
    n = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= 3 * period)
    d = join_few(d, n, keys, "inner")
    before, after = centred(period)
    d = Series.of(d, keys, ["hour_us"]).rows_frame(before, after, {"_t": lambda w: F.avg("_x").over(w)}).df
    d = d.withColumn("_detr", F.col("_x") - F.col("_t")).withColumn("_hod", (F.col("hour_us") / HOUR_US) % period)
    season = exact_quantiles(d, [*keys, "_hod"], "_detr", {"_season": 0.5}).drop("n")
    d = null_safe_join(d, season, [*keys, "_hod"]).withColumn("residual", F.col("_detr") - F.col("_season"))
    q = exact_quantiles(d, keys, "residual", {"_q1": 0.25, "_q3": 0.75}).filter("_q3 - _q1 >= 1e-9")
    d = join_few(d, q.drop("n"), keys, "inner")
    sigma = (F.col("_q3") - F.col("_q1")) / 1.3489
    return d.select(*keys, "hour_us", "residual", (F.col("residual") / sigma).alias("zscore"))


def seasonal_residual_scores(
    cycles: DataFrame, keys: list[str], ts: str, slope: str, soft: float = 2.0, hard: float = 3.5
) -> DataFrame:
    """Residual and z of the nearest hour (within 90 minutes) on every cycle, with soft and hard flags."""
    res = seasonal_residuals(cycles, keys, ts, slope)
    res = res.select(
        *keys,
        F.timestamp_micros("hour_us").alias("_hour"),
        F.col("residual").alias("stl_residual"),
        F.col("zscore").alias("stl_residual_zscore"),
    )
    d = attach_nearest_hour(cycles, res, keys, ts, "_hour", ["stl_residual", "stl_residual_zscore"])
    z = F.abs("stl_residual_zscore")
    return d.withColumns(
        {"stl_soft_flag": true(z > soft).cast("int"), "stl_hard_flag": true(z > hard).cast("int")}
    )


def rank_share(df: DataFrame, value: Column, out: str, high_is_odd: bool = True) -> DataFrame:
    """Average rank of ``value`` over the whole table scaled to [0, 1]; unknown values rank at the median and score 0.

    Ranks come from a running count over distinct values, so the table itself is never ordered in one task.
    """
    d = df.withColumn("_all", F.lit(1)).withColumn("_v", value)
    med = exact_quantiles(d, ["_all"], "_v", {"_med": 0.5}).select("_all", "_med")
    d = d.join(med, "_all", "left").withColumn("_f", F.coalesce("_v", "_med") + F.lit(0.0))
    counts = d.filter("_f IS NOT NULL").groupBy("_all", "_f").agg(F.count(F.lit(1)).alias("_c"))
    ranks = Series.of(counts, ["_all"], ["_f"]).running_sum({"_cum": F.col("_c")}).df
    ranks = ranks.select(F.col("_f").alias("_j"), F.lit(True).alias("_k"), (F.col("_cum") - (F.col("_c") - 1) / 2.0).alias("_rank"))
    # Unknown rows meet no rank, so their join key only has to spread them.
    spread = F.xxhash64(*df.columns).cast("double")
    d = d.withColumn("_k", F.col("_v").isNotNull()).withColumn("_j", F.when(F.col("_k"), F.col("_f")).otherwise(spread))
    n = df.agg(F.greatest(F.count(F.lit(1)) - 1, F.lit(1)).alias("_n1")).withColumn("_all", F.lit(1))
    d = d.join(n, "_all").join(ranks, ["_j", "_k"], "left")
    share = (F.col("_rank") - 1) / F.col("_n1")
    share = share if high_is_odd else 1 - share
    return d.withColumn(out, F.when(F.col("_v").isNull(), 0.0).otherwise(share)).drop(
        "_all", "_v", "_med", "_f", "_rank", "_n1", "_j", "_k"
    )


def ensemble_score(
    df: DataFrame, weights: dict[str, float] | None = None, flag_above: float = 0.65
) -> DataFrame:
    """``<detector>_norm`` for every detector column present, their weighted mean and a flag."""
    weights = weights or ENSEMBLE_WEIGHTS
    used = []
    for key, (col, high) in DETECTORS.items():
        if col not in df.columns:
            continue
        value = F.abs(col) if high is None else F.col(col)
        df = rank_share(df, value, f"{key}_norm", high is not False)
        used.append(key)
    total = sum(weights[k] for k in used)
    score = F.lit(0.0)
    for k in used:
        score = score + F.col(f"{k}_norm") * weights[k]
    df = df.withColumn("anomaly_ensemble_score", score / total if total > 0 else F.lit(0.0))
    return df.withColumn("anomaly_ensemble_flag", (F.col("anomaly_ensemble_score") > flag_above).cast("int"))


def impute_features(df: DataFrame, features: list[str], train: Column) -> tuple[DataFrame, list[str]]:
    """Replace unknown features by the median of the training rows; adds ``_train``."""
    d = df.withColumn("_train", true(train)).withColumn("_all", F.lit(1))
    # One row, stored: its quantiles are not searched again by every reader of the result.
    med = cut_lineage(exact_medians(d.filter("_train"), ["_all"], {f"_md_{f}": F.col(f) for f in features}))
    d = d.join(F.broadcast(med), "_all", "left")
    cols = {f"_x_{f}": F.coalesce(F.col(f).cast("double"), F.col(f"_md_{f}")) for f in features}
    return d.withColumns(cols).drop("_all", *[f"_md_{f}" for f in features]), list(cols)


def _distance(cols: list[str], mean: np.ndarray, precision: np.ndarray) -> Column:
    """Squared Mahalanobis distance as a plain expression."""
    diff = [F.col(c) - F.lit(float(m)) for c, m in zip(cols, mean, strict=True)]
    out = F.lit(0.0)
    for i in range(len(cols)):
        for j in range(i, len(cols)):
            w = float(precision[i, j]) * (1 if i == j else 2)
            out = out + F.lit(w) * diff[i] * diff[j]
    return out


def mahalanobis_scores(
    df: DataFrame, cols: list[str], train: str = "_train", support: float = 0.75, percentile: float = 0.95,
    max_fit_rows: int | None = None, id_cols: tuple[str, ...] = (),
) -> DataFrame:
    """``ml_mcd_dist`` for all rows and ``mcd_flag`` above the training percentile.

    The fit uses all training rows, or ``max_fit_rows`` of them in a fixed hash order where that is given. A row with an
    unknown column has no distance and no flag.
    """
    base = df.filter(train)
    if max_fit_rows is not None:
        base = base.orderBy(F.xxhash64(*(id_cols or cols))).limit(max_fit_rows)
    mean, precision = robust_covariance(base, cols, support)
    square = _distance(cols, mean, precision)
    d = df.withColumn("ml_mcd_dist", F.when(square < float("inf"), F.sqrt(F.greatest(F.lit(0.0), square))))
    cut = exact_quantiles(d.filter(train).withColumn("_all", F.lit(1)), ["_all"], "ml_mcd_dist", {"_cut": percentile})
    d = d.withColumn("_all", F.lit(1)).join(F.broadcast(cut_lineage(cut.drop("n"))), "_all", "left")
    return d.withColumn("mcd_flag", true(F.col("ml_mcd_dist") > F.col("_cut")).cast("int")).drop("_all", "_cut")


__all__ = [
    "rolling_zscore", "seasonal_residuals", "seasonal_residual_scores", "rank_share", "ensemble_score",
    "impute_features", "mahalanobis_scores",
]
