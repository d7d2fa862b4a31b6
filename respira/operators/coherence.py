"""Cycle-to-cycle coherence and daily quality of scored cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respira.functions.numeric import true
from respira.plans.quantiles import exact_quantiles
from respira.plans.series import Series, micros, null_safe_join

# Fixed value: hours around sunrise and sunset when slopes may change sign.
TRANSITION_HOURS = (6, 7, 8, 17, 18, 19)


def temporal_coherence(
    cycles: DataFrame,
    ts: str = "flux_datetime",
    slope: str = "flux_slope",
    qc: str = "flux_qc",
    tie: tuple[str, ...] = (),
    max_ratio: float = 3.0,
    cv_threshold: float = 0.5,
) -> DataFrame:
    """Add ``temporal_coherence_flag`` and ``hourly_cv_flag``.

    A cycle is compared with the one before it in time, over all chambers. Only pairs within a day count, so days are
    independent and run in parallel, and a day of very many cycles is cut like any long series.
    """
    d = cycles.withColumn("_d", F.col(ts).cast("date")).withColumn("_h", F.hour(ts)).withColumn("_us", micros(ts))
    before = {"_ps": slope, "_ph": "_h", "_pq": qc}
    known = Series.of(d.filter("_d IS NOT NULL"), ["_d"], ["_us", *tie]).previous(before).df
    unknown = d.filter("_d IS NULL").withColumns({o: F.lit(None).cast(d.schema[c].dataType) for o, c in before.items()})
    d = known.unionByName(unknown).drop("_us")
    cur, prev = F.col(slope), F.col("_ps")
    usable = (
        F.col("_d").isNotNull()
        & ~true(F.col(qc) > 1)
        & ~true(F.col("_pq") > 1)
        & prev.isNotNull()
        & (prev != 0)
        & ~F.col("_h").isin(*TRANSITION_HOURS)
        & ~F.col("_ph").isin(*TRANSITION_HOURS)
    )
    same = true(cur * prev > 0)
    jump = same & (F.abs(F.try_divide(cur, prev)) > max_ratio)
    flip = ~same & F.col("_h").between(8, 16) & (F.abs(cur) > 0.005)
    d = d.withColumn("temporal_coherence_flag", true(usable & (jump | flip)).cast("int"))
    hour = d.groupBy("_d", "_h").agg(F.stddev_samp(slope).alias("_sd"), F.avg(F.abs(slope)).alias("_ma"))
    hour = hour.withColumn("_cv", true((F.col("_ma") >= 1e-9) & (F.col("_sd") / F.col("_ma") > cv_threshold)).cast("int"))
    d = null_safe_join(d, hour.select("_d", "_h", "_cv"), ["_d", "_h"])
    d = d.withColumn("hourly_cv_flag", F.when(F.col("_d").isNotNull(), F.col("_cv")).otherwise(0))
    return d.drop("_d", "_h", "_ps", "_ph", "_pq", "_cv")


def day_quality(
    cycles: DataFrame,
    keys: list[str],
    ts: str = "flux_datetime",
    slope: str = "flux_slope",
    r2: str = "r2",
    nrmse: str = "nrmse",
    hours: tuple[int, int] = (7, 18),
) -> DataFrame:
    """Quality of each (keys, date) from its clean daytime cycles; days under 3 cycles or 4 hours give no row."""
    by = [*keys, "date"]
    d = cycles.withColumn("date", F.col(ts).cast("date")).withColumn("_h", F.hour(ts)).filter(F.col("_h").between(*hours))
    day = d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_cycles_daytime"),
        F.countDistinct("_h").alias("n_hours_covered"),
        F.avg((F.col(slope) < 0).cast("double")).alias("_neg"),
        F.avg(nrmse).alias("_nz"),
    )
    hourly = exact_quantiles(d, [*by, "_h"], slope, {"_med": 0.5})
    hourly = hourly.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_nh"), F.min_by("_h", F.when(F.col("_med").isNotNull(), F.struct("_med", "_h"))).alias("_peak")
    )
    med = exact_quantiles(d, by, r2, {"_r2": 0.5}).drop("n")
    out = null_safe_join(null_safe_join(day, hourly, by), med, by)
    out = out.filter("n_cycles_daytime >= 3 AND n_hours_covered >= 4")
    shape = F.when((F.col("_nh") >= 3) & F.col("_peak").between(9, 14), 1.0).otherwise(0.5)
    parts = {
        "coverage_score": F.least(F.col("n_hours_covered") / 11, F.lit(1.0)),
        "quality_score": F.coalesce("_r2", F.lit(0.0)),
        "frac_negative": F.coalesce("_neg", F.lit(0.0)),
        "shape_score": shape,
        "nrmse_score": F.greatest(F.lit(0.0), 1 - F.coalesce("_nz", F.lit(0.2)) / 0.2),
    }
    out = out.withColumns(parts)
    score = sum(
        (wt * F.col(c) for wt, c in zip((0.3, 0.3, 0.2, 0.1, 0.1), parts, strict=True)), F.lit(0.0)
    )
    return out.select(
        *by, "n_cycles_daytime", "n_hours_covered", *[F.bround(c, 4).alias(c) for c in parts], F.bround(score, 4).alias("day_score")
    )


def attach_day_scores(
    cycles: DataFrame,
    keys: list[str],
    ts: str = "flux_datetime",
    slope: str = "flux_slope",
    r2: str = "r2",
    nrmse: str = "nrmse",
    qc: str = "flux_qc",
) -> DataFrame:
    """Day score of every cycle from the clean cycles of its day; days without a score get 0."""
    clean = F.col(qc) <= 1
    for c in ("temporal_coherence_flag", "hourly_cv_flag"):
        if c in cycles.columns:
            clean = clean & (F.col(c) == 0)
    days = day_quality(cycles.filter(clean), keys, ts, slope, r2, nrmse)
    days = days.select(*keys, "date", "day_score", "n_cycles_daytime", "n_hours_covered")
    out = null_safe_join(cycles.withColumn("date", F.col(ts).cast("date")), days, [*keys, "date"])
    return out.withColumn("day_score", F.coalesce("day_score", F.lit(0.0))).drop("date")
