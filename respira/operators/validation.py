"""Checks of scored cycles against published response curves."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respira.functions.grading import status_at_least, status_in_range
from respira.functions.numeric import clip
from respira.functions.special import correlation_p_value
from respira.operators.curve_fit import Parameter, fit_curve
from respira.plans.quantiles import exact_quantiles
from respira.plans.series import join_few, null_safe_join
from respira.plans.sizing import cut_lineage

# Accepted ranges and the least data a test needs.
SETTINGS = {
    "Amax_range": (5.0, 35.0),
    "alpha_range": (0.02, 0.12),
    "Q10_range": (1.5, 3.0),
    "Q10_r2_min": 0.10,
    "Q10_min_n": 50,
    "Q10_min_T_iqr": 3.0,
    "WUE_range": (2.0, 8.0),
    "WUE_VPD_r_max": -0.10,
    "WUE_min_n": 20,
    "chamber_r_min": 0.70,
    "chamber_min_pairs": 20,
    "T_ref": 25.0,
    "light_min_n": 200,
    "light_par_iqr_min": 300.0,
    "rad_to_par": 2.02,
    "alpha_max": 0.20,
    "Amax_max": 50.0,
    "Rd_max": 15.0,
}


# Where the search for alpha, Amax and Rd starts.
LIGHT_START = (0.04, 12.0, 2.0)


def light_response(cycles: DataFrame, chamber: str, flux: str, radiation: str, day: str, cfg: dict = SETTINGS) -> DataFrame:
    """Rectangular hyperbola ``alpha I Amax / (alpha I + Amax) - Rd`` per chamber, by least squares within bounds.

    Uptake counts positive. A chamber with too few points or too little spread of light is not fitted.
    """
    d = cycles.filter(F.col(day) & F.col(flux).isNotNull() & (F.col(radiation) >= 0))
    d = d.select(chamber, (F.col(radiation) * cfg["rad_to_par"]).alias("_p"), (-F.col(flux)).alias("_y"))
    d = cut_lineage(d)  # read by the gate and every round
    q = exact_quantiles(d, [chamber], "_p", {"_q1": 0.25, "_q3": 0.75})
    all_chambers = cycles.select(chamber).filter(F.col(chamber).isNotNull()).distinct()
    gate = null_safe_join(all_chambers, q, [chamber]).withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    gate = cut_lineage(gate.select(chamber, "n", (F.col("_q3") - F.col("_q1")).alias("par_iqr")))
    fit_ok = (F.col("n") >= cfg["light_min_n"]) & (F.col("par_iqr") >= cfg["light_par_iqr_min"])
    light, p = join_few(d, gate.filter(fit_ok).select(chamber), [chamber], "left_semi"), F.col("_p")

    def uptake(alpha: Column, a_max: Column, rd: Column) -> Column:
        return F.coalesce(F.try_divide(alpha * p * a_max, alpha * p + a_max), F.lit(0.0)) - rd

    def slopes(alpha: Column, a_max: Column, rd: Column) -> list[Column]:
        low = alpha * p + a_max
        part = F.coalesce(F.try_divide(alpha * p, low), F.lit(0.0))
        rest = F.coalesce(F.try_divide(a_max, low), F.lit(0.0))
        return [p * rest * rest, part * part, F.lit(-1.0)]

    names = (("alpha", "alpha_max"), ("Amax", "Amax_max"), ("Rd", "Rd_max"))
    wanted = [Parameter(c, start, 0.0, cfg[most]) for (c, most), start in zip(names, LIGHT_START, strict=True)]
    fitted = fit_curve(light, [chamber], "_y", uptake, slopes, wanted).drop("n", "rss", "converged", "Rd_se")
    out = null_safe_join(gate, fitted, [chamber])
    out = out.withColumn("Amax_status", status_in_range(F.col("Amax"), *cfg["Amax_range"]))
    out = out.withColumn("alpha_status", status_in_range(F.col("alpha"), *cfg["alpha_range"]))
    good = (F.col("Amax_status") == "PASS") & (F.col("alpha_status") == "PASS") & (F.col("Rd") > 0)
    bad = (F.col("Amax_status") == "FAIL") | (F.col("alpha_status") == "FAIL")
    status = F.when(F.col("Amax").isNull(), "N/A").when(good, "PASS").when(bad, "FAIL").otherwise("BORDERLINE")
    return out.withColumn("status", status)


def q10_response(cycles: DataFrame, by: list[str], flux: str, temp: str, day: str, cfg: dict = SETTINGS) -> DataFrame:
    """Temperature response of night respiration per group: ln R against T, with 95 % interval and p-value."""
    ok = ~F.col(day) & (F.col(flux) > 0) & F.col(temp).isNotNull()
    groups = cycles.select(*by).distinct()
    d = cycles.filter(ok).withColumn("_x", F.col(temp) - cfg["T_ref"]).withColumn("_l", F.ln(F.col(flux)))
    q = exact_quantiles(d, by, temp, {"_q1": 0.25, "_q3": 0.75}).drop("n")
    g = d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope("_l", "_x").alias("_b"), F.regr_intercept("_l", "_x").alias("_a"),
        F.regr_sxx("_l", "_x").alias("_sxx"), F.regr_syy("_l", "_x").alias("_syy"), F.corr("_l", "_x").alias("_r"),
    )
    g = null_safe_join(null_safe_join(groups, g, by), q, by)
    g = g.withColumn("n", F.coalesce("n", F.lit(0).cast("bigint"))).withColumn("t_iqr", F.col("_q3") - F.col("_q1"))
    use = (F.col("n") >= cfg["Q10_min_n"]) & (F.col("t_iqr") >= cfg["Q10_min_T_iqr"])
    b, r = F.when(use, F.col("_b")), F.when(use, F.col("_r"))
    se = F.sqrt((1 - r * r) * F.try_divide(F.col("_syy"), F.col("_sxx")) / (F.col("n") - 2))
    out = g.withColumns(
        {
            "Q10": F.exp(b * 10),
            "Q10_ci_lo": F.exp((b - 1.96 * se) * 10),
            "Q10_ci_hi": F.exp((b + 1.96 * se) * 10),
            "R_ref": F.when(use, F.exp("_a")),
            "r2": r * r,
        }
    )
    out = out.withColumn("p", correlation_p_value(F.when(use, F.col("_r")), F.col("n")))
    out = out.withColumn("Q10_status", status_in_range(F.col("Q10"), *cfg["Q10_range"]))
    fit = F.col("r2") >= cfg["Q10_r2_min"]
    out = out.withColumn("r2_status", F.when(F.col("r2").isNull(), "N/A").when(fit, "PASS").otherwise("FAIL"))
    status = (
        F.when(F.col("Q10").isNull(), "N/A")
        .when((F.col("Q10_status") == "PASS") & fit, "PASS")
        .when((F.col("Q10_status") == "FAIL") | ~fit, "FAIL")
        .otherwise("BORDERLINE")
    )
    return out.withColumn("status", status).drop("_b", "_a", "_sxx", "_syy", "_r", "_q1", "_q3")


def water_use_efficiency(
    cycles: DataFrame,
    by: list[str],
    flux: str,
    co2_slope: str,
    h2o: str,
    day: str,
    vpd: str | None = None,
    cfg: dict = SETTINGS,
) -> DataFrame:
    """Median water use efficiency per group with quartiles and its correlation with vapour pressure deficit."""
    d = cycles.filter(F.col(day) & (F.col(flux) < 0) & (F.col(h2o) > 0))
    d = d.withColumn("_w", clip(-F.col(co2_slope) / F.col(h2o), 0.1, 30.0))
    q = exact_quantiles(d, by, "_w", {"median": 0.5, "p25": 0.25, "p75": 0.75}).drop("n")
    pair = F.col(vpd).isNotNull() & F.col("_w").isNotNull() if vpd else F.lit(False)
    v = F.when(pair, F.col(vpd)) if vpd else F.lit(None).cast("double")
    g = d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.count(v).alias("_nv"), F.corr(v, F.when(pair, F.col("_w"))).alias("_r")
    )
    g = null_safe_join(g, q, by)
    use = F.col("n") >= cfg["WUE_min_n"]
    g = g.withColumns({c: F.when(use, F.col(c)) for c in ("median", "p25", "p75")})
    g = g.withColumn("vpd_r", F.when(use & (F.col("_nv") > 20), F.col("_r")))
    g = g.withColumn("vpd_p", correlation_p_value(F.col("vpd_r"), F.col("_nv")))
    g = g.withColumn("wue_status", status_in_range(F.col("median"), *cfg["WUE_range"]))
    vs = F.when(F.col("vpd_r").isNull(), "N/A").when(F.col("vpd_r") <= cfg["WUE_VPD_r_max"], "PASS").otherwise("BORDERLINE")
    g = g.withColumn("vpd_status", vs)
    status = (
        F.when(F.col("median").isNull(), "N/A")
        .when((F.col("wue_status") == "PASS") & (F.col("vpd_status") == "PASS"), "PASS")
        .when(F.col("wue_status") == "FAIL", "FAIL")
        .otherwise("BORDERLINE")
    )
    return g.withColumn("status", status).drop("_nv", "_r")


def chamber_agreement(
    cycles: DataFrame, by: list[str], chamber: str, ts: str, flux: str, hours: tuple[int, int] = (6, 18), cfg: dict = SETTINGS
) -> DataFrame:
    """Correlation of the first two chambers' hourly means, day and night, over hours known for all chambers."""
    named = cycles.filter(F.col(chamber).isNotNull())
    chambers = named.groupBy(*by).agg(F.array_sort(F.collect_set(chamber)).alias("_all"))
    hour = named.groupBy(*by, F.col(ts).cast("date").alias("_d"), F.hour(ts).alias("_h"), chamber).agg(F.avg(flux).alias("_f"))
    hour = null_safe_join(hour.filter("_f IS NOT NULL"), chambers, by, "inner")
    c = F.col(chamber)
    full = hour.groupBy(*by, "_d", "_h").agg(
        F.count(F.lit(1)).alias("_k"),
        F.first(F.size("_all")).alias("_need"),
        F.max(F.when(c == F.col("_all")[0], F.col("_f"))).alias("_x"),
        F.max(F.when(c == F.try_element_at("_all", F.lit(2)), F.col("_f"))).alias("_y"),
    )
    full = full.filter((F.col("_k") == F.col("_need")) & (F.col("_need") >= 2))
    light = F.col("_h").between(hours[0], hours[1] - 1)
    g = full.groupBy(*by).agg(
        F.count(F.when(light, 1)).alias("n_day_pairs"),
        F.count(F.when(~light, 1)).alias("n_night_pairs"),
        F.corr(F.when(light, F.col("_x")), F.when(light, F.col("_y"))).alias("r_daytime"),
        F.corr(F.when(~light, F.col("_x")), F.when(~light, F.col("_y"))).alias("r_nighttime"),
    )
    # From all groups, so that one without a complete hour still gives its line.
    g = null_safe_join(cycles.select(*by).distinct(), g, by).fillna(0, ["n_day_pairs", "n_night_pairs"])
    enough = F.col("n_day_pairs") + F.col("n_night_pairs") >= cfg["chamber_min_pairs"]
    g = g.withColumn("r_daytime", F.when(enough & (F.col("n_day_pairs") > 10), F.col("r_daytime")))
    g = g.withColumn("r_nighttime", F.when(enough & (F.col("n_night_pairs") > 10), F.col("r_nighttime")))
    g = g.withColumn("p_daytime", correlation_p_value(F.col("r_daytime"), F.col("n_day_pairs")))
    return g.withColumn("status", status_at_least(F.col("r_daytime"), cfg["chamber_r_min"]))


def _lines(df: DataFrame, section: str, label: Column, expected: str, observed: Column, status: str, fmt: str) -> DataFrame:
    text = F.coalesce(F.format_string(fmt, observed), F.lit("N/A"))
    text = F.when(observed.isNull(), "N/A").otherwise(text)
    return df.select(
        F.lit(section).alias("section"), label.alias("test"), F.lit(expected).alias("expected"), text.alias("observed"),
        F.col(status).alias("status"),
    )


def scorecard(
    light: DataFrame, q10: DataFrame, wue: DataFrame, agreement: DataFrame, chamber: str, cfg: dict = SETTINGS
) -> DataFrame:
    """All checks as lines ``section, test, expected, observed, status``."""

    def named(text: str) -> Column:
        return F.concat(F.lit(f"{text} ("), F.col(chamber).cast("string"), F.lit(")"))

    def span(key: str) -> str:
        return f"{cfg[key][0]}-{cfg[key][1]}"

    parts = [
        _lines(light, "1 Light Response", named("Amax"), f"{span('Amax_range')} umol/m2/s", F.col("Amax"), "Amax_status", "%.2f"),
        _lines(light, "1 Light Response", named("alpha"), span("alpha_range"), F.col("alpha"), "alpha_status", "%.3f"),
        _lines(q10, "2 Q10", named("Q10"), span("Q10_range"), F.col("Q10"), "Q10_status", "%.2f"),
        _lines(q10, "2 Q10", named("Q10 R2"), f">= {cfg['Q10_r2_min']}", F.col("r2"), "r2_status", "%.3f"),
        _lines(wue, "3 WUE", F.lit("WUE median"), f"{span('WUE_range')} mmol/mol", F.col("median"), "wue_status", "%.2f"),
        _lines(wue, "3 WUE", F.lit("WUE-VPD r"), f"<= {cfg['WUE_VPD_r_max']}", F.col("vpd_r"), "vpd_status", "%.3f"),
        _lines(
            agreement, "4 Inter-chamber", F.lit("Daytime Pearson r"), f">= {cfg['chamber_r_min']}", F.col("r_daytime"), "status", "%.3f"
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def scorecard_counts(card: DataFrame) -> DataFrame:
    names = {"n_pass": "PASS", "n_borderline": "BORDERLINE", "n_fail": "FAIL", "n_na": "N/A"}
    return card.agg(*[F.count(F.when(F.col("status") == s, 1)).alias(o) for o, s in names.items()])


def validate_cycles(
    cycles: DataFrame, chamber: str, ts: str, flux: str, co2_slope: str, h2o: str, radiation: str, temp: str,
    vpd: str | None = None, day: str = "is_daytime", cfg: dict = SETTINGS,
) -> DataFrame:
    """Scorecard of all four checks; ``day`` must already be a column."""
    one = cycles.withColumn("_run", F.lit(1))
    return scorecard(
        light_response(cycles, chamber, flux, radiation, day, cfg),
        q10_response(cycles, [chamber], flux, temp, day, cfg),
        water_use_efficiency(one, ["_run"], flux, co2_slope, h2o, day, vpd, cfg),
        chamber_agreement(one, ["_run"], chamber, ts, flux, cfg=cfg),
        chamber,
        cfg,
    )


def threshold_sweep(
    cycles: DataFrame, scores: dict[str, list[float]], check: Callable[[DataFrame, list[str]], DataFrame]
) -> DataFrame:
    """Run a grouped check once for every combination of score thresholds.

    Each cycle is repeated for the combinations it passes (the grid is a few fixed numbers) and the check runs grouped by
    the threshold columns, so the whole sweep is one job.
    """
    d, by = cycles, []
    for col, grid in scores.items():
        name = f"{col}_min"
        passed = F.array_compact(F.array(*[F.when(F.col(col) >= float(g), F.lit(float(g))) for g in grid]))
        d = d.withColumn(name, F.explode(passed))
        by.append(name)
    return check(d, by)
