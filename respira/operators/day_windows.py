"""Confidence of cycles and selection of multi-day windows of good data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respira.functions import thresholds as TH
from respira.functions.numeric import clip, true
from respira.operators.drift import centred, full_frame
from respira.plans.quantiles import exact_medians
from respira.plans.series import null_safe_join, number_rows

SIGNALS = {
    "co2_slope": "co2_slope_zscore",
    "night_intercept": "night_intercept_zscore",
    "h2o_slope": "h2o_slope_zscore",
    "slope_divergence": "slope_div_zscore",
}
_SOURCE = {"co2_slope": "co2_slope", "h2o_slope": "h2o_slope", "slope_divergence": "slope_diff_pct"}


def is_night(ts: str, hours: tuple[int, int] = (6, 18)) -> Column:
    return (F.hour(ts) < hours[0]) | (F.hour(ts) >= hours[1])


def drift_severity(
    cycles: DataFrame,
    chamber: str,
    ts: str,
    active: tuple[str, ...] = ("night_intercept", "slope_divergence"),
    cfg: dict = TH.WINDOW_SETTINGS,
) -> DataFrame:
    """Severity 0, 0.5 or 1 per chamber and day, with the z-score of each signal.

    Daily medians lose a centred 90-row median (season) and become z-scores of the trailing 30 rows. Rows are days with
    data, not calendar days, so windows run over one short row per chamber and day.
    """
    have = [s for s in active if (s == "night_intercept" and "flux_intercept" in cycles.columns) or _SOURCE.get(s) in cycles.columns]
    cols = {
        s: F.when(is_night(ts, cfg["daytime_hours"]), F.col("flux_intercept")) if s == "night_intercept" else F.col(_SOURCE[s])
        for s in have
    }
    d = cycles.withColumn("date", F.col(ts).cast("date"))
    by = [chamber, "date"]
    daily = exact_medians(d, by, cols) if cols else d.select(*by).distinct()
    order = Window.partitionBy(chamber).orderBy("date")
    season, short = cfg["seasonal_detrend_days"], cfg["drift_window_days"]
    before, after = centred(season)
    long_w, short_w = order.rowsBetween(-before, after), order.rowsBetween(1 - short, 0)
    whole = Window.partitionBy(chamber)
    bad, mod = cfg["drift_zscore_bad"], cfg["drift_zscore_moderate"]
    severities = [F.lit(0.0), F.lit(0.0)]
    for s, out in SIGNALS.items():
        if s not in have:
            daily = daily.withColumn(out, F.lit(None).cast("double"))
            continue
        base = full_frame(lambda c: F.percentile(c, F.lit(0.5)), s, max(3, season // 4))(long_w)
        daily = daily.withColumn("_v", F.col(s) - base)
        m, sd = full_frame(F.avg, "_v", 3)(short_w), full_frame(F.stddev_samp, "_v", 3)(short_w)
        z = F.when(F.count(s).over(whole) >= 3, F.try_divide(F.col("_v") - m, sd))
        daily = daily.withColumn(out, z).drop("_v")
        a = F.abs(out)
        severities.append(F.when(a >= bad, 1.0).when(a >= mod, 0.5).otherwise(0.0))
    daily = daily.withColumn("drift_severity", F.greatest(*severities))
    zs = [F.when(F.col(o) != 0, F.col(o)).alias(o) for o in SIGNALS.values()]
    return daily.select(*by, "drift_severity", *zs)


def _rounded(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.bround(c, digits)


def _tier(x: Column, good: float, ok: float, high: bool, unknown: float) -> Column:
    first, second = (x >= good, x >= ok) if high else (x <= good, x <= ok)
    return F.when(x.isNull(), unknown).when(first, 1.0).when(second, 0.5).otherwise(0.0)


def score_cycles(
    cycles: DataFrame,
    chamber: str,
    ts: str,
    drift: DataFrame | None = None,
    regime: DataFrame | None = None,
    cfg: dict = TH.WINDOW_SETTINGS,
    digits: int | None = 4,
) -> DataFrame:
    """``cycle_confidence`` and its parts per cycle, rounded half-even to ``digits`` (``None``: not rounded).

    Columns used where present: ``co2_r2, co2_nrmse, co2_snr, co2_outlier_frac, slope_diff_pct, delta_aicc,
    sensor_co2_qc_mean, sensor_h2o_qc_mean, closure_confidence, anomaly_ensemble_score``. Without regime scores their
    weight is spread over the other parts. Closure and anomaly scores are shown but carry no weight.
    """

    def col(name: str) -> Column:
        return F.col(name) if name in cycles.columns else F.lit(None).cast("double")

    c = cfg
    regression = (
        _tier(col("co2_r2"), c["r2_good"], c["r2_ok"], True, 0.0)
        + _tier(col("co2_nrmse"), c["nrmse_good"], c["nrmse_ok"], False, 0.0)
        + _tier(col("co2_snr"), c["snr_good"], c["snr_ok"], True, 0.0)
        + _tier(col("co2_outlier_frac"), c["outlier_good"], c["outlier_ok"], False, 0.0)
    ) / 4
    robustness = (
        _tier(col("slope_diff_pct"), c["slope_diff_good"], c["slope_diff_ok"], False, 0.5)
        + _tier(col("delta_aicc"), c["aicc_good"], c["aicc_ok"], True, 0.5)
    ) / 2
    sensor = sum((F.coalesce(clip(1 - col(f) / 2, 0.0, 1.0), F.lit(0.5)) for f in ("sensor_co2_qc_mean", "sensor_h2o_qc_mean")), F.lit(0.0)) / 2
    d = cycles.withColumn("date", F.col(ts).cast("date"))
    if drift is not None:
        d = null_safe_join(d, drift.select(chamber, "date", F.col("drift_severity").alias("_sev")), [chamber, "date"])
        drift_score = 1 - F.coalesce("_sev", F.lit(0.0))
    else:
        drift_score = F.lit(1.0)
    w = c["weights"]
    parts = {"regression": regression, "robustness": robustness, "sensor_qc": sensor, "drift": drift_score}
    if regime is not None:
        d = d.join(regime.select("date", F.col("regime_score").alias("_reg")), "date", "left")
        cross = F.coalesce("_reg", F.lit(0.5))
        conf = sum((w[k] * v for k, v in parts.items()), w["cross_chamber"] * cross)
    else:
        cross = F.lit(None).cast("double")
        base = sum(w[k] for k in parts)
        conf = sum((w[k] * v for k, v in parts.items()), F.lit(0.0)) * ((base + w["cross_chamber"]) / base)
    out = {f"score_{k}": v for k, v in parts.items()}
    out["score_cross_chamber"] = cross
    out["score_closure"] = F.coalesce(clip(col("closure_confidence"), 0.0, 1.0), F.lit(0.5))
    out["score_anomaly"] = F.coalesce(clip(1 - col("anomaly_ensemble_score"), 0.0, 1.0), F.lit(0.5))
    out["cycle_confidence"] = conf
    out = {k: _rounded(v, digits) for k, v in out.items()}
    return d.withColumns(out).drop("date", "_sev", "_reg")


def daily_statistics(
    cycles: DataFrame,
    chamber: str,
    ts: str,
    qc: str | None = "co2_qc",
    regime_change: str | None = "is_instrumental_regime_change",
    cfg: dict = TH.WINDOW_SETTINGS,
) -> DataFrame:
    """Coverage, confidence, hours and grades per chamber and day, and whether the day qualifies."""
    by = [chamber, "date"]
    d = cycles.withColumn("date", F.col(ts).cast("date")).withColumn("_h", F.hour(ts))
    conf = F.col("cycle_confidence")
    aggs = [
        F.count(F.lit(1)).alias("n_cycles"),
        F.avg((conf >= cfg["confidence_good"]).cast("double")).alias("good_frac"),
        F.avg(conf).alias("mean_confidence"),
        F.sum(conf).alias("_conf_sum"),
        (F.countDistinct(F.when(F.col("_h").between(5, 18), F.col("_h"))) / 14.0).alias("diurnal_cov"),
    ]
    has_regime = regime_change is not None and regime_change in cycles.columns
    aggs.append((F.max(true(F.col(regime_change)).cast("int")) if has_regime else F.lit(0)).alias("_regime"))
    if qc and qc in cycles.columns:
        ok, top = true(F.col(qc) <= 1).cast("double"), true(F.col(qc) == 0).cast("double")
        day = F.avg(F.when(~is_night(ts, cfg["daytime_hours"]), ok))
        aggs += [
            F.avg(ok).alias("all_grade_ab_frac"),
            F.coalesce(day, F.avg(ok)).alias("grade_ab_frac"),
            F.avg(top).alias("grade_a_frac"),
        ]
    else:
        aggs += [F.lit(1.0).alias(x) for x in ("all_grade_ab_frac", "grade_ab_frac", "grade_a_frac")]
    g = d.groupBy(*by).agg(*aggs)
    top = g.groupBy(chamber).agg(F.percentile("n_cycles", F.lit(0.95)).alias("_max")).filter("_max >= 1")
    g = null_safe_join(g, top, [chamber], "inner")
    g = g.withColumn("coverage", F.least(F.col("n_cycles") / F.col("_max"), F.lit(1.0)))
    good = (F.col("coverage") >= cfg["min_cycle_coverage"]) & (F.col("good_frac") >= cfg["min_good_fraction"])
    return g.withColumn("qualifying", good & (F.col("_regime") == 0)).drop("_max", "_regime")


def _greedy_starts(n_days: Column, flags: Column, need: int, span: int) -> Column:
    """Start positions (0-based) of windows: first fit of ``need`` good days within ``span`` rows, then on by ``need``."""
    state = F.struct(F.lit(0).alias("nxt"), F.array().cast("array<int>").alias("out"))

    def step(acc: Column, i: Column) -> Column:
        total = F.aggregate(F.slice(flags, i + 1, F.lit(span)), F.lit(0), lambda a, q: a + q)
        take = (i >= acc["nxt"]) & (total >= need)
        return F.when(
            take, F.struct((i + need).alias("nxt"), F.concat(acc["out"], F.array(i)).alias("out"))
        ).otherwise(acc)

    spots = F.when(n_days >= need, F.sequence(F.lit(0), n_days - need)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(spots, state, step, lambda a: a["out"])


def select_windows(
    daily: DataFrame,
    chamber: str,
    drift: DataFrame | None = None,
    cfg: dict = TH.WINDOW_SETTINGS,
    digits: int | None = 4,
) -> DataFrame:
    """Scored windows of consecutive data days, best first; windows may overlap by the flexibility buffer.

    The fold runs over the short list of day flags of one chamber; everything else is joins and aggregates.
    """
    need, span = cfg["min_window_days"], cfg["min_window_days"] + cfg["flexibility_buffer"]
    lists = daily.groupBy(chamber).agg(
        F.array_sort(F.collect_list(F.struct("date", F.col("qualifying").cast("int").alias("q")))).alias("_l")
    )
    starts = lists.select(
        chamber,
        "_l",
        F.explode(_greedy_starts(F.size("_l"), F.transform("_l", lambda x: x["q"]), need, span)).alias("_i"),
    )
    days = starts.select(chamber, "_i", F.explode(F.slice("_l", F.col("_i") + 1, F.lit(span))).alias("_d"))
    days = days.select(chamber, "_i", F.col("_d.date").alias("date"))
    d = null_safe_join(days, daily, [chamber, "date"], "inner")
    if drift is not None:
        d = null_safe_join(d, drift.select(chamber, "date", "drift_severity"), [chamber, "date"])
    else:
        d = d.withColumn("drift_severity", F.lit(0.0))
    w = d.groupBy(chamber, "_i").agg(
        F.min("date").alias("start_date"),
        F.max("date").alias("end_date"),
        F.count(F.lit(1)).alias("n_days"),
        F.sum("n_cycles").alias("n_cycles"),
        (F.sum("_conf_sum") / F.sum("n_cycles")).alias("_conf"),
        F.avg("coverage").alias("_cov"),
        F.avg(F.coalesce("drift_severity", F.lit(0.0))).alias("_drift"),
        F.avg("diurnal_cov").alias("_diur"),
        F.avg("grade_ab_frac").alias("_gab"),
        F.avg("all_grade_ab_frac").alias("_gall"),
        F.avg("grade_a_frac").alias("_ga"),
    )
    score = 0.40 * F.col("_conf") + 0.25 * F.col("_cov") + 0.20 * (1 - F.col("_drift")) + 0.15 * F.col("_diur")
    w = number_rows(w.withColumn("_score", score), [F.col(chamber), F.col("start_date")], "window_id")
    named = {
        "mean_confidence": "_conf",
        "mean_coverage": "_cov",
        "mean_drift_severity": "_drift",
        "mean_daytime_grade_ab_frac": "_gab",
        "mean_all_grade_ab_frac": "_gall",
        "mean_grade_a_frac": "_ga",
        "diurnal_hour_coverage": "_diur",
        "window_score": "_score",
    }
    return w.select(
        "window_id",
        chamber,
        "start_date",
        "end_date",
        "n_days",
        "n_cycles",
        *[_rounded(F.col(v), digits).alias(k) for k, v in named.items()],
        (F.col("_score") >= cfg["min_score_for_export"]).alias("qualifies_for_export"),
    ).orderBy(F.desc("window_score"), "window_id")


def chosen_windows(
    windows: DataFrame, approvals: DataFrame | None = None, excluded: DataFrame | None = None
) -> DataFrame:
    """Windows to export: the approved ones if approvals ``(window_id, approved)`` are given, else the qualifying ones;
    minus the excluded ids."""
    if approvals is not None:
        out = windows.join(approvals.filter("approved").select("window_id").distinct(), "window_id", "left_semi")
    else:
        out = windows.filter("qualifies_for_export")
    return out.join(excluded.select("window_id"), "window_id", "left_anti") if excluded is not None else out


def export_cycles(cycles: DataFrame, windows: DataFrame, chamber: str, ts: str) -> DataFrame:
    """Cycles inside the windows with ``window_id, window_score``; in overlaps the lower score stays, as written last."""
    days = windows.select(
        chamber, F.explode(F.sequence("start_date", "end_date")).alias("date"), "window_id", "window_score"
    )
    pick = days.groupBy(chamber, "date").agg(
        F.min(F.struct("window_score", (-F.col("window_id")).alias("_neg"))).alias("_w")
    )
    d = null_safe_join(cycles.withColumn("date", F.col(ts).cast("date")), pick, [chamber, "date"], "inner")
    return d.withColumns({"window_id": -F.col("_w._neg"), "window_score": F.col("_w.window_score")}).drop("_w", "date")


def window_manifest(windows: DataFrame, chamber: str) -> DataFrame:
    """One JSON document per window."""
    doc = F.to_json(
        F.struct(
            "window_id",
            F.col(chamber).alias("chamber"),
            F.col("start_date").cast("string").alias("start_date"),
            F.col("end_date").cast("string").alias("end_date"),
            "n_days",
            "n_cycles",
            "mean_confidence",
            "window_score",
        )
    )
    return windows.select("window_id", doc.alias("entry"))


def selection_summary(
    cycles: DataFrame, windows: DataFrame, drift: DataFrame | None = None, cfg: dict = TH.WINDOW_SETTINGS
) -> DataFrame:
    """One row: cycles, mean confidence, confident cycles, severe drift days, windows, qualifying windows, top score."""
    good = F.count(F.when(F.col("cycle_confidence") >= cfg["confidence_good"], 1))
    a = cycles.agg(F.count(F.lit(1)).alias("n_cycles"), F.avg("cycle_confidence").alias("mean_confidence"), good.alias("n_confident"))
    b = windows.agg(
        F.count(F.lit(1)).alias("n_windows"),
        F.count(F.when(F.col("qualifies_for_export"), 1)).alias("n_qualifying"),
        F.max("window_score").alias("top_score"),
    )
    frames = [a, b]
    if drift is not None:
        frames.append(drift.agg(F.count(F.when(F.col("drift_severity") == 1.0, 1)).alias("n_severe_drift_days")))
    keyed = [f.withColumn("_one", F.lit(1)) for f in frames]
    return reduce(lambda x, y: x.join(y, "_one"), keyed).drop("_one")


__all__ = [
    "drift_severity", "score_cycles", "daily_statistics", "select_windows", "chosen_windows", "export_cycles",
    "window_manifest", "selection_summary", "is_night",
]
