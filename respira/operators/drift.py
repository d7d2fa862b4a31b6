"""Slow sensor drift: rolling scores, offset correction between breakpoints, daily baselines."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respira.functions.numeric import ratio, true
from respira.operators.integrate import time_grid
from respira.plans.series import Series, _position, join_few, micros, null_safe_join

DAY_US = 86_400_000_000


def full_frame(fn: Callable[[str], Column], col: str, need: int):
    """Window aggregate that is null unless the frame holds ``need`` non-null values."""
    return lambda w: F.when(F.count(col).over(w) >= need, fn(col).over(w))


def centred(width: int) -> tuple[int, int]:
    """Rows before and after the current one in a centred window; even widths lean back."""
    return width // 2, width - width // 2 - 1


def drift_scores(
    df: DataFrame,
    keys: list[str],
    ts: str,
    value: str,
    flag: str | None = None,
    window: int = 48,
    tie: str | None = None,
) -> DataFrame:
    """Rolling mean of ``window`` rows (half of them known) as a z-score of the whole series; flagged rows are ignored."""
    clean = F.when(F.col(flag) == 0, F.col(value)) if flag else F.col(value)
    d = df.withColumn("_us", micros(ts)).withColumn("_v", clean)
    g = d.groupBy(*keys).agg(F.avg("_v").alias("_gm"), F.stddev_samp("_v").alias("_gs"))
    s = Series.of(d, keys, ["_us", tie] if tie else ["_us"])
    s = s.rows_frame(window - 1, 0, {"rolling_mean": full_frame(F.avg, "_v", window // 2)})
    out = join_few(s.df, g, keys)
    z = ratio(F.col("rolling_mean") - F.col("_gm"), F.col("_gs"))
    return out.withColumn("drift_score", z).drop("_us", "_v", "_gm", "_gs")


def assign_segments(df: DataFrame, keys: list[str], at: str, breakpoints: DataFrame, bp_at: str) -> DataFrame:
    """Add ``segment``: how many breakpoints of the series lie at or before the row.

    The breakpoints of a series travel as one sorted array, so rows are only joined by key.
    """
    cuts = breakpoints.groupBy(*keys).agg(F.array_sort(F.collect_set(bp_at)).alias("_cuts"))
    return join_few(df, cuts, keys).withColumn("segment", _position(F.col("_cuts"), F.col(at))).drop("_cuts")


def correct_offsets(
    df: DataFrame,
    keys: list[str],
    ts: str,
    value: str,
    breakpoints: DataFrame,
    bp_ts: str,
    reference: float | None = None,
) -> DataFrame:
    """Shift every segment so that its mean equals the reference (the mean of the first segment by default)."""
    bps = breakpoints.select(*keys, micros(bp_ts).alias("_bp"))
    d = assign_segments(df.withColumn("_us", micros(ts)), keys, "_us", bps, "_bp")
    m = d.groupBy(*keys, "segment").agg(F.avg(value).alias("_m"))
    if reference is None:
        base = m.filter("segment = 0").select(*keys, F.col("_m").alias("_ref"))
        m = null_safe_join(m, base, keys)
    else:
        m = m.withColumn("_ref", F.lit(float(reference)))
    # Series without breakpoints are left alone.
    known = bps.select(*keys).distinct().withColumn("_has", F.lit(True))
    m = null_safe_join(m, known, keys)
    m = m.select(*keys, "segment", F.when(F.col("_has"), F.col("_m") - F.col("_ref")).otherwise(0.0).alias("offset"))
    out = null_safe_join(d, m, [*keys, "segment"])
    return out.withColumn("corrected", F.col(value) - F.col("offset")).drop("_us")


def daily_baseline(
    df: DataFrame, keys: list[str], ts: str, value: str, expected_min: float | None = None, tolerance: float = 50.0
) -> DataFrame:
    """Daily minimum, maximum, mean and range on every calendar day, the change of the 7-day mean and a drift flag."""
    day = F.floor(micros(ts) / DAY_US) * DAY_US
    g = df.groupBy(*keys, day.alias("_day")).agg(
        F.min(value).alias("daily_min"), F.max(value).alias("daily_max"), F.avg(value).alias("daily_mean")
    )
    d = time_grid(g, keys, "_day", DAY_US).join(g, [*keys, "_day"], "left")
    w = Window.partitionBy(*keys).orderBy("_day")
    week = w.rowsBetween(-6, 0)
    d = d.withColumn("daily_range", F.col("daily_max") - F.col("daily_min"))
    d = d.withColumn("_roll", full_frame(F.avg, "daily_mean", 7)(week))
    d = d.withColumn("trend", F.col("_roll") - F.lag("_roll").over(w))
    if expected_min is not None:
        d = d.withColumn("baseline_drift", true(F.abs(F.col("daily_min") - expected_min) > tolerance))
    return d.withColumn("date", F.timestamp_micros("_day").cast("date")).drop("_roll", "_day")


def trend_line(
    df: DataFrame, keys: list[str], order: list[str], value: str, width: int, out: str = "trend"
) -> DataFrame:
    """Centred moving average over ``width`` rows, null until the window is full."""
    before, after = centred(width)
    return Series.of(df, keys, order).rows_frame(before, after, {out: full_frame(F.avg, value, width)}).df


def cumulative(df: DataFrame, keys: list[str], order: list[str], value: str, out: str = "cumulative") -> DataFrame:
    """Running sum per series."""
    return Series.of(df, keys, order).running_sum({out: F.col(value)}).df
