"""Gap sessions (measurement cycles), gap and integrity reports, thinning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respira.functions.numeric import true
from respira.plans.quantiles import exact_quantiles
from respira.plans.series import Series, join_few, micros, null_safe_join

SECOND = 1_000_000.0


def add_cycles(
    df: DataFrame,
    keys: list[str],
    ts: str,
    gap_sec: float = 300.0,
    tie: str | None = None,
    start_columns: bool = False,
    small: bool | None = None,
) -> DataFrame:
    """Number the cycles of each series from 1: a new one starts after a pause longer than ``gap_sec``.

    Adds ``delta_t_sec, new_cycle, cycle_id``, and with ``start_columns`` also the microseconds ``_us`` of the row and
    ``_start_us`` of its cycle.
    """
    order = ["_us", tie] if tie else ["_us"]
    s = Series.of(df.withColumn("_us", micros(ts)), keys, order, small=small).previous({"_pt": "_us"})
    delta = (F.col("_us") - F.col("_pt")) / SECOND
    s = s.with_columns({"delta_t_sec": delta})
    s = s.with_columns({"new_cycle": F.coalesce(F.col("delta_t_sec") > gap_sec, F.lit(True))})
    s = s.running_sum({"cycle_id": F.col("new_cycle").cast("bigint")})
    if start_columns:
        s = s.with_columns({"_mark": F.when(F.col("new_cycle"), F.col("_us"))})
        s = s.nearest_known({"_start_us": "_mark"})
        return s.df.drop("_pt", "_mark")
    return s.df.drop("_pt", "_us")


def missing_report(df: DataFrame, keys: list[str], ts: str, value: str, freq_sec: float) -> DataFrame:
    """Per series: known readings, share missing against the nominal rate, and gaps above 2.5 intervals."""
    known = df.filter(F.col(value).isNotNull()).withColumn("_us", micros(ts))
    d = Series.of(known, keys, ["_us"]).previous({"_pt": "_us"}).df
    dt = (F.col("_us") - F.col("_pt")) / SECOND
    gap = true(dt > 2.5 * freq_sec)
    out = d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_valid"),
        F.count(F.when(gap, 1)).alias("n_gaps"),
        F.coalesce(F.sum(F.when(gap, dt)), F.lit(0.0)).alias("gap_seconds"),
        F.max(F.when(gap, dt)).alias("longest_gap_sec"),
        ((F.max("_us") - F.min("_us")) / SECOND).alias("duration_sec"),
    )
    expected = F.col("duration_sec") / freq_sec
    pct = F.greatest(F.lit(0.0), 1 - F.try_divide(F.col("n_valid"), expected)) * 100
    return out.withColumn("expected_points", expected).withColumn("missing_pct", pct)


def integrity_report(
    df: DataFrame, keys: list[str], ts: str, tracked: list[str], gap_sec: float = 300.0, valid: str | None = None
) -> DataFrame:
    """Rows, span, median step, share of duplicate times, share of gaps and missing shares, per series."""
    s = Series.of(df.withColumn("_us", micros(ts)), keys, ["_us"]).previous({"_pt": "_us"})
    d = s.df.withColumn("_dt", (F.col("_us") - F.col("_pt")) / SECOND)
    n = F.count(F.lit(1))
    have = [c for c in tracked if c in df.columns]
    aggs = [
        n.alias("n_rows"),
        F.min(ts).alias("start"),
        F.max(ts).alias("end"),
        (F.count(F.when(F.col("_dt") == 0, 1)) / n * 100).alias("duplicate_pct"),
        (F.count(F.when(F.col("_dt") > gap_sec, 1)) / n * 100).alias("gap_pct"),
        *[(F.count(F.when(F.col(c).isNull(), 1)) / n * 100).alias(f"missing_{c}_pct") for c in have],
    ]
    if valid:
        aggs.append((F.avg(F.coalesce(F.col(valid), F.lit(0))) * 100).alias("valid_pct"))
    out = d.groupBy(*keys).agg(*aggs)
    out = null_safe_join(out, exact_quantiles(d, keys, "_dt", {"median_dt_sec": 0.5}).drop("n"), keys)
    return out.withColumns({f"missing_{c}_pct": F.lit(None).cast("double") for c in tracked if c not in have})


def thin(df: DataFrame, keys: list[str], order: list[str], max_points: int) -> DataFrame:
    """Every ceil(n / max_points)-th row of each series, starting with the first."""
    s = Series.of(df, keys, order).row_number("_rn")
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    d = join_few(s.df, n, keys)
    step = F.greatest(F.lit(1), F.ceil(F.col("_n") / max_points))
    return d.filter((F.col("_rn") - 1) % step == 0).drop("_rn", "_n")
