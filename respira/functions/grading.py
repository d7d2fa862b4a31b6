"""Cycle grades: 0 good, 1 moderate, 2 bad, each with the reasons that led to it.

A grade is an ordered list of checks. Every check is first one small integer column, its level; worst level, number of
moderate findings and reasons are then read off those columns, so no condition is evaluated twice. Unknown conditions
count as not met. Day and night limits are chosen per row, so a frame with both is graded in one pass.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respira.functions import thresholds as T

# A check: condition for level 2 and its reason, condition for level 1 and its reason (either may be missing).
Check = tuple[Column | None, Column | None, Column | None, Column | None]


def _limits(day: dict, night: dict | None, is_night: Column | None):
    def limit(key: str) -> Column:
        if night is None or is_night is None or night.get(key) == day.get(key):
            return F.lit(day[key])
        return F.when(is_night, F.lit(night[key])).otherwise(F.lit(day[key]))

    return limit


def _bad(cond: Column, reason: str) -> Check:
    return cond, F.lit(reason), None, None


def _both(bad: Column, bad_reason: str, fair: Column, fair_reason: str) -> Check:
    return bad, F.lit(bad_reason), fair, F.lit(fair_reason)


def _levels(df: DataFrame, checks: list[Check], prefix: str) -> tuple[DataFrame, list[str]]:
    """Add the level of every check as a column."""
    cols = {}
    for i, (bad, _, fair, _) in enumerate(checks):
        level = F.when(bad, 2) if bad is not None else None
        if fair is not None:
            level = level.when(fair, 1) if level is not None else F.when(fair, 1)
        cols[f"{prefix}{i}"] = level.otherwise(0)
    return df.withColumns(cols), list(cols)


def _worst(levels: list[str]) -> Column:
    return F.greatest(F.lit(0), *levels)


def _reasons(checks: list[Check], levels: list[str]) -> list[Column]:
    out = []
    for (bad, why_bad, fair, why_fair), c in zip(checks, levels, strict=True):
        text = F.when(F.col(c) == 2, why_bad) if bad is not None else None
        if fair is not None:
            text = text.when(F.col(c) == 1, why_fair) if text is not None else F.when(F.col(c) == 1, why_fair)
        out.append(text)
    return out


def co2_grade(
    df: DataFrame,
    is_night: Column | None = None,
    raw_flag: Column | None = None,
    day: dict = T.CO2_DAY,
    night: dict | None = T.CO2_NIGHT,
    snr: str = "snr",
    hard_limits: bool = False,
) -> DataFrame:
    """Add ``model_qc``, ``flux_qc`` (with the sensor flag) and ``qc_reason`` to a table of CO2 cycles."""
    lim = _limits(day, night, is_night)
    c = F.col
    mono, slope, dur = c("monotonicity"), c("flux_slope"), c("duration_sec")
    signal, guard = F.abs(slope) * dur, lim("signal_ppm_guard")
    mono_b = F.when(
        (signal > 0) & (signal < guard), F.greatest(F.lit(0.30), lim("monotonic_B") * (signal / guard))
    ).otherwise(lim("monotonic_B"))
    r2, nrmse, s = c("r2"), c("nrmse"), c(snr)
    out, curve, diff = c("outlier_frac"), c("delta_aicc"), c("slope_diff_pct")
    checks: list[Check] = [
        _bad(c("n_points_used") < lim("min_points"), "too_few_points"),
        _bad(dur < lim("min_duration_sec"), "short_duration"),
        _both(r2.isNull() | (r2 < lim("r2_B")), "low_r2", r2 < lim("r2_A"), "r2_moderate"),
        _both(nrmse.isNull() | (nrmse > lim("nrmse_B")), "high_nrmse", nrmse > lim("nrmse_A"), "nrmse_moderate"),
        _both(s.isNull() | (s < lim("snr_B")), "low_snr", s < lim("snr_A"), "snr_moderate"),
        _both(mono < mono_b, "non_monotonic", mono < lim("monotonic_A"), "monotonic_moderate"),
        _both(out > lim("outlier_B"), "many_outliers", out > lim("outlier_A"), "some_outliers"),
        (None, None, curve <= lim("curvature_aicc"), F.lit("curvature")),
    ]
    if "curvature_aicc_C" in day:
        checks.append(_bad(curve <= lim("curvature_aicc_C"), "strong_curvature"))
    checks.append(_both(diff > lim("slope_diff_B"), "slope_disagreement", diff > lim("slope_diff_A"), "slope_disagreement"))
    d, levels = _levels(df, checks, "_a")
    raw = F.coalesce(raw_flag, F.lit(0)) if raw_flag is not None else F.lit(0)
    d = d.withColumn("_raw", F.least(raw.cast("int"), F.lit(2)))
    more: list[Check] = []
    if "b_count_C" in day:
        moderate = reduce(lambda a, b: a + b, [(c(k) == 1).cast("int") for k in levels])
        d = d.withColumn("_mod", moderate)
        reason = F.concat(F.lit("many_moderate_issues:"), c("_mod").cast("string"))
        more.append((c("_mod") >= lim("b_count_C"), reason, None, None))
    if hard_limits:
        more += [
            _bad(F.abs(slope) > T.HARD_LIMITS["max_abs_slope"], "extreme_slope"),
            _bad(F.abs(c("flux_absolute")) > T.HARD_LIMITS["max_abs_flux"], "extreme_flux"),
            (None, None, c("co2_range") > T.HARD_LIMITS["max_co2_range"], F.lit("large_co2_range")),
        ]
    d, extra = _levels(d, more, "_b")
    why = _reasons([*checks, *more], [*levels, *extra])
    why.append(F.when(c("_raw") > 0, F.concat(F.lit("sensor_flag_"), c("_raw").cast("string"))))
    d = d.withColumns({"model_qc": _worst([*levels, *extra]), "qc_reason": F.concat_ws(";", *why)})
    return d.withColumn("flux_qc", F.greatest("model_qc", "_raw")).drop("_raw", "_mod", *levels, *extra)


def h2o_grade(
    df: DataFrame, is_night: Column | None = None, day: dict = T.H2O_DAY, night: dict = T.H2O_NIGHT
) -> DataFrame:
    """Add ``h2o_qc, h2o_qc_label, h2o_qc_reason``; strict limits count only once a mild one is broken."""
    lim = _limits(day, night, is_night)
    c = F.col
    r2, nrmse, snr = c("h2o_r2"), c("h2o_nrmse"), c("h2o_snr")
    out, mono, rng = c("h2o_outlier_frac"), c("h2o_monotonic_frac"), c("h2o_conc_range")

    def text(label: str, x: Column, digits: int, op: str, key: str) -> Column:
        number = F.format_string(f"%.{digits}f", F.bround(x, digits))
        return F.concat(F.lit(f"{label}="), number, F.lit(op), lim(key).cast("string"))

    mild: list[Check] = [
        (None, None, r2 < lim("r2_A"), text("R2", r2, 2, "<", "r2_A")),
        (None, None, nrmse > lim("nrmse_A"), text("NRMSE", nrmse, 2, ">", "nrmse_A")),
        (None, None, snr < lim("snr_A"), text("SNR", snr, 1, "<", "snr_A")),
        (None, None, out > lim("outlier_A"), text("Outliers", out, 2, ">", "outlier_A")),
        (None, None, mono < lim("monotonic_A"), text("Monotonic", mono, 2, "<", "monotonic_A")),
    ]
    part = rng / lim("signal_mmol_guard")
    weak = (rng > 0) & (part < 1)
    nrmse_b = F.when(weak, F.least(F.lit(0.50), lim("nrmse_B") / F.greatest(part, F.lit(0.3)))).otherwise(lim("nrmse_B"))
    mono_b = F.when(weak, F.greatest(F.lit(0.25), lim("monotonic_B") * part)).otherwise(lim("monotonic_B"))
    strict: list[Check] = [
        _bad(r2 < lim("r2_B"), ""),
        _bad(nrmse > nrmse_b, ""),
        _bad(snr < lim("snr_B"), ""),
        _bad(out > lim("outlier_B"), ""),
        _bad(mono < mono_b, ""),
    ]
    d, levels = _levels(df, mild, "_a")
    d, hard = _levels(d, strict, "_b")
    tier = F.when(_worst(levels) == 0, 0).otherwise(F.greatest(F.lit(1), _worst(hard)))
    d = d.withColumns({"h2o_qc": tier, "h2o_qc_reason": F.concat_ws(";", *_reasons(mild, levels))})
    labels = F.when(c("h2o_qc") == 0, "A").when(c("h2o_qc") == 1, "B").otherwise("C")
    return d.withColumn("h2o_qc_label", labels).drop(*levels, *hard)


def dilution_overrides(
    df: DataFrame, reason: str = "qc_reason", limits: dict = T.WPL_LIMITS, h2o_max: float = 60.0
) -> DataFrame:
    """Add ``wpl_qc`` and raise ``model_qc``, ``flux_qc`` and the reasons from per-cycle dilution metrics."""
    c = F.col
    valid, p95 = c("wpl_valid_fraction"), c("wpl_abs_rel_change_p95")
    checks: list[Check] = [
        _bad(valid.isNull(), "wpl_missing_fraction"),
        _both(
            valid < limits["valid_frac_B"], "wpl_low_valid_fraction",
            valid < limits["valid_frac_A"], "wpl_valid_fraction_moderate",
        ),
        _both(
            p95 > limits["rel_change_p95_B"], "wpl_large_adjustment",
            p95 > limits["rel_change_p95_A"], "wpl_adjustment_moderate",
        ),
        _bad(c("wpl_factor_max") > limits["factor_max_B"], "wpl_factor_high"),
        _bad(c("h2o_max") > h2o_max, "h2o_out_of_range"),
    ]
    d, levels = _levels(df, checks, "_a")
    d = d.withColumn("wpl_qc", _worst(levels))
    old = F.filter(F.transform(F.split(F.coalesce(c(reason), F.lit("")), ";"), F.trim), lambda r: r != "")
    new = F.array_compact(F.array(*_reasons(checks, levels)))
    return d.withColumns(
        {
            "model_qc": F.greatest(c("model_qc"), c("wpl_qc")),
            "flux_qc": F.greatest(c("flux_qc"), c("wpl_qc")),
            reason: F.array_join(F.array_distinct(F.concat(old, new)), ";"),
        }
    ).drop(*levels)


def status_in_range(x: Column, lo: float, hi: float) -> Column:
    """PASS inside [lo, hi], BORDERLINE within 30 % beyond, else FAIL; N/A where unknown."""
    return (
        F.when(x.isNull(), "N/A")
        .when(x.between(lo, hi), "PASS")
        .when(x.between(lo * 0.7, hi * 1.3), "BORDERLINE")
        .otherwise("FAIL")
    )


def status_at_least(x: Column, threshold: float) -> Column:
    return F.when(x.isNull(), "N/A").when(x >= threshold, "PASS").otherwise("BORDERLINE")
