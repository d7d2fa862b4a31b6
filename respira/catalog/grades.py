"""Flux conversion and grading expressions, on line items standing in for cycles."""

from __future__ import annotations

from pyspark.sql import functions as F

from respira.catalog.base import READINGS, r, readings, registry, sr, table
from respira.functions import grading, labels, units
from respira.functions import thresholds as T

QUERIES, query = registry()
ID = ["l_orderkey", "l_linenumber", "l_partkey"]
IDS = ", ".join(ID)
CYC = {
    "n_points_used": "l_quantity",
    "duration_sec": "l_quantity * 10",
    "r2": "CASE WHEN l_discount < 0.01 THEN NULL ELSE 1 - l_discount * 5 END",
    "nrmse": "l_tax * 4",
    "snr": "l_extendedprice / 5000",
    "monotonicity": "CASE WHEN l_quantity > 45 THEN NULL ELSE 0.2 + l_quantity / 60 END",
    "outlier_frac": "l_discount * 2",
    "delta_aicc": "2 - l_quantity / 3",
    "slope_diff_pct": "l_tax * 10",
    "flux_slope": "(l_discount - 0.05) / 5",
    "mean_temp": "CASE WHEN l_tax > 0.07 THEN NULL ELSE 20 + l_quantity / 5 END",
    "raw_flag": "CASE WHEN l_linenumber > 5 THEN l_linenumber - 5 ELSE 0 END",
    "flux_absolute": "l_extendedprice / 900",
    "co2_range": "l_extendedprice / 40",
    "night": "l_linestatus = 'O'",
    "wpl_valid_fraction": "CASE WHEN l_discount < 0.01 THEN NULL ELSE 1 - l_tax END",
    "wpl_abs_rel_change_p95": "CASE WHEN l_tax < 0.01 THEN NULL ELSE l_discount END",
    "wpl_factor_max": "1 + l_discount",
    "h2o_max": "l_quantity + 15",
    "radiation": "CASE WHEN l_tax > 0.06 THEN NULL ELSE l_extendedprice / 100 END",
}
CYC_SQL = f"cy AS (SELECT *, {', '.join(f'{e} AS {c}' for c, e in CYC.items())} FROM lineitem)"


def cyc(spark, sf):
    return table(spark, sf, "lineitem").withColumns({c: F.expr(e.replace("NULL", "CAST(NULL AS DOUBLE)")) for c, e in CYC.items()})


def _lim(k: str) -> str:
    a, b = T.CO2_DAY[k], T.CO2_NIGHT[k]
    return f"(CASE WHEN night THEN {b} ELSE {a} END)"


def _two(x: str, bad: str, fair: str, rb: str, rf: str, null_bad: bool) -> list[tuple[str, int, str]]:
    nb = f"{x} IS NULL OR {bad}" if null_bad else bad
    return [(nb, 2, f"'{rb}'"), (f"NOT coalesce({nb}, false) AND {fair}", 1, f"'{rf}'")]


CHECKS = [
    (f"n_points_used < {_lim('min_points')}", 2, "'too_few_points'"),
    (f"duration_sec < {_lim('min_duration_sec')}", 2, "'short_duration'"),
    *_two("r2", f"r2 < {_lim('r2_B')}", f"r2 < {_lim('r2_A')}", "low_r2", "r2_moderate", True),
    *_two("nrmse", f"nrmse > {_lim('nrmse_B')}", f"nrmse > {_lim('nrmse_A')}", "high_nrmse", "nrmse_moderate", True),
    *_two("snr", f"snr < {_lim('snr_B')}", f"snr < {_lim('snr_A')}", "low_snr", "snr_moderate", True),
    *_two(
        "monotonicity",
        f"monotonicity < CASE WHEN abs(flux_slope) * duration_sec > 0 AND abs(flux_slope) * duration_sec < {_lim('signal_ppm_guard')} "
        f"THEN greatest(0.30, {_lim('monotonic_B')} * (abs(flux_slope) * duration_sec / {_lim('signal_ppm_guard')})) ELSE {_lim('monotonic_B')} END",
        f"monotonicity < {_lim('monotonic_A')}", "non_monotonic", "monotonic_moderate", False,
    ),
    *_two("outlier_frac", f"outlier_frac > {_lim('outlier_B')}", f"outlier_frac > {_lim('outlier_A')}", "many_outliers", "some_outliers", False),
    (f"delta_aicc <= {_lim('curvature_aicc')}", 1, "'curvature'"),
    (f"delta_aicc <= {_lim('curvature_aicc_C')}", 2, "'strong_curvature'"),
    *_two("slope_diff_pct", f"slope_diff_pct > {_lim('slope_diff_B')}", f"slope_diff_pct > {_lim('slope_diff_A')}", "slope_disagreement", "slope_disagreement", False),
]
BCOUNT = " + ".join(f"CAST(coalesce({c}, false) AS INT)" for c, lv, _ in CHECKS if lv == 1)
HARD = [
    ("abs(flux_slope) > 10", 2, "'extreme_slope'"),
    ("abs(flux_absolute) > 100", 2, "'extreme_flux'"),
    ("co2_range > 2000", 1, "'large_co2_range'"),
]


def grade_sql(hard: bool) -> str:
    checks = [*CHECKS, (f"bc >= {_lim('b_count_C')}", 2, "'many_moderate_issues:' || bc"), *(HARD if hard else [])]
    level = "greatest(0, " + ", ".join(f"CASE WHEN {c} THEN {lv} ELSE 0 END" for c, lv, _ in checks) + ")"
    reasons = ", ".join(f"CASE WHEN {c} THEN {t} END" for c, _, t in checks)
    return f"""gr AS (SELECT *, {level} AS model_qc, CAST(least(raw_flag, 2) AS INT) AS rw,
   array_to_string(list_filter([{reasons}, CASE WHEN raw_flag > 0 THEN 'sensor_flag_' || CAST(least(raw_flag, 2) AS INT) END], lambda x: x IS NOT NULL), ';') AS qc_reason
  FROM (SELECT *, {BCOUNT} AS bc FROM cy)), gd AS (SELECT *, greatest(model_qc, rw) AS flux_qc FROM gr)"""


@query("co2_cycle_grade", f"WITH {CYC_SQL}, {grade_sql(False)} SELECT {IDS}, model_qc, flux_qc, qc_reason FROM gd")
def co2_cycle_grade(spark, sf):
    d = grading.co2_grade(cyc(spark, sf), F.col("night"), F.col("raw_flag"))
    return d.select(*ID, "model_qc", "flux_qc", "qc_reason")


@query("co2_cycle_grade_hard_limits", f"WITH {CYC_SQL}, {grade_sql(True)} SELECT {IDS}, model_qc, flux_qc, qc_reason FROM gd")
def co2_cycle_grade_hard_limits(spark, sf):
    d = grading.co2_grade(cyc(spark, sf), F.col("night"), F.col("raw_flag"), hard_limits=True)
    return d.select(*ID, "model_qc", "flux_qc", "qc_reason")


WPL_SQL = """wp AS (SELECT *, [CASE WHEN wpl_valid_fraction IS NULL THEN 'wpl_missing_fraction' END, CASE WHEN wpl_valid_fraction < 0.95 THEN 'wpl_low_valid_fraction' END,
   CASE WHEN wpl_valid_fraction >= 0.95 AND wpl_valid_fraction < 0.98 THEN 'wpl_valid_fraction_moderate' END,
   CASE WHEN wpl_abs_rel_change_p95 > 0.07 THEN 'wpl_large_adjustment' END,
   CASE WHEN wpl_abs_rel_change_p95 <= 0.07 AND wpl_abs_rel_change_p95 > 0.04 THEN 'wpl_adjustment_moderate' END,
   CASE WHEN wpl_factor_max > 1.08 THEN 'wpl_factor_high' END, CASE WHEN h2o_max > 60 THEN 'h2o_out_of_range' END] AS rs,
   greatest(0, CASE WHEN wpl_valid_fraction IS NULL OR wpl_valid_fraction < 0.95 THEN 2 WHEN wpl_valid_fraction < 0.98 THEN 1 ELSE 0 END,
    CASE WHEN wpl_abs_rel_change_p95 > 0.07 THEN 2 WHEN wpl_abs_rel_change_p95 > 0.04 THEN 1 ELSE 0 END,
    CASE WHEN wpl_factor_max > 1.08 OR h2o_max > 60 THEN 2 ELSE 0 END) AS wpl_qc,
   CASE WHEN l_linenumber = 1 THEN 'low_r2;h2o_out_of_range' ELSE '' END AS old, CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END AS m FROM cy)"""


@query(
    "dilution_grade_overrides",
    f"""WITH {CYC_SQL}, {WPL_SQL} SELECT {IDS}, wpl_qc, greatest(m, wpl_qc) AS model_qc, greatest(m, wpl_qc) AS flux_qc,
 array_to_string(list_filter(list_concat(CASE WHEN old = '' THEN [] ELSE ['low_r2', 'h2o_out_of_range'] END,
  CASE WHEN old <> '' THEN list_filter(rs, lambda x: x IS NOT NULL AND x <> 'h2o_out_of_range') ELSE rs END), lambda x: x IS NOT NULL), ';') AS qc_reason FROM wp""",
)
def dilution_grade_overrides(spark, sf):
    first = F.col("l_linenumber") == 1
    d = cyc(spark, sf).withColumns(
        {
            "qc_reason": F.when(first, "low_r2;h2o_out_of_range").otherwise(""),
            "model_qc": F.when(first, 1).otherwise(0),
            "flux_qc": F.when(first, 1).otherwise(0),
        }
    )
    d = grading.dilution_overrides(d)
    return d.select(*ID, "wpl_qc", "model_qc", "flux_qc", "qc_reason")


H = {
    "h2o_r2": "1 - l_discount * 6",
    "h2o_nrmse": "l_tax * 4",
    "h2o_snr": "l_extendedprice / 8000",
    "h2o_outlier_frac": "l_discount * 3",
    "h2o_monotonic_frac": "CASE WHEN l_quantity > 45 THEN NULL ELSE l_quantity / 50 END",
    "h2o_conc_range": "l_quantity / 60",
}


def _h(k: str) -> str:
    return f"(CASE WHEN night THEN {T.H2O_NIGHT[k]} ELSE {T.H2O_DAY[k]} END)"


def _ht(k: str) -> str:
    return f"(CASE WHEN night THEN '{T.H2O_NIGHT[k]}' ELSE '{T.H2O_DAY[k]}' END)"


MILD = [
    (f"h2o_r2 < {_h('r2_A')}", f"'R2=' || printf('%.2f', round(h2o_r2, 2)) || '<' || {_ht('r2_A')}"),
    (f"h2o_nrmse > {_h('nrmse_A')}", f"'NRMSE=' || printf('%.2f', round(h2o_nrmse, 2)) || '>' || {_ht('nrmse_A')}"),
    (f"h2o_snr < {_h('snr_A')}", f"'SNR=' || printf('%.1f', round(h2o_snr, 1)) || '<' || {_ht('snr_A')}"),
    (f"h2o_outlier_frac > {_h('outlier_A')}", f"'Outliers=' || printf('%.2f', round(h2o_outlier_frac, 2)) || '>' || {_ht('outlier_A')}"),
    (f"h2o_monotonic_frac < {_h('monotonic_A')}", f"'Monotonic=' || printf('%.2f', round(h2o_monotonic_frac, 2)) || '<' || {_ht('monotonic_A')}"),
]
PART = f"(h2o_conc_range / {_h('signal_mmol_guard')})"
H_SQL = f"""hh AS (SELECT {IDS}, night, {', '.join(f'{e} AS {c}' for c, e in H.items())} FROM cy),
 hm AS (SELECT *, {' OR '.join(f'coalesce({c}, false)' for c, _ in MILD)} AS mild,
  coalesce(h2o_r2 < {_h('r2_B')} OR h2o_nrmse > CASE WHEN h2o_conc_range > 0 AND {PART} < 1 THEN least(0.5, {_h('nrmse_B')} / greatest({PART}, 0.3)) ELSE {_h('nrmse_B')} END
   OR h2o_snr < {_h('snr_B')} OR h2o_outlier_frac > {_h('outlier_B')}
   OR h2o_monotonic_frac < CASE WHEN h2o_conc_range > 0 AND {PART} < 1 THEN greatest(0.25, {_h('monotonic_B')} * {PART}) ELSE {_h('monotonic_B')} END, false) AS strict FROM hh)"""


@query(
    "h2o_cycle_grade",
    f"""WITH {CYC_SQL}, {H_SQL} SELECT {IDS}, CASE WHEN mild AND strict THEN 2 WHEN mild THEN 1 ELSE 0 END AS h2o_qc,
 CASE WHEN mild AND strict THEN 'C' WHEN mild THEN 'B' ELSE 'A' END AS h2o_qc_label,
 len(list_filter([{', '.join(f'CASE WHEN {c} THEN 1 END' for c, _ in MILD)}], lambda x: x IS NOT NULL)) AS n_reasons FROM hm""",
)
def h2o_cycle_grade(spark, sf):
    d = cyc(spark, sf).withColumns({c: F.expr(e) for c, e in H.items()})
    d = grading.h2o_grade(d, F.col("night"))
    n = F.when(F.col("h2o_qc_reason") == "", 0).otherwise(F.size(F.split("h2o_qc_reason", ";")))
    return d.select(*ID, "h2o_qc", "h2o_qc_label", n.cast("bigint").alias("n_reasons"))


FLUX = "(101325.0 / (8.314 * (coalesce(mean_temp, 25.0) + 273.15)))"


@query(
    "absolute_flux_conversion",
    f"""WITH {CYC_SQL}, x AS (SELECT *, l_shipdate + INTERVAL 9200 DAY AS fdate FROM cy)
SELECT {IDS}, {sr(f"flux_slope * {FLUX} * CASE WHEN fdate < TIMESTAMP '2025-07-01' THEN 2.0 ELSE 6.0 END")} AS co2_flux,
 {sr(f"CASE WHEN l_tax > 0 THEN l_tax * {FLUX} * CASE WHEN fdate < TIMESTAMP '2025-07-01' THEN 2.0 ELSE 6.0 END END")} AS h2o_flux FROM x""",
)
def absolute_flux_conversion(spark, sf):
    d = cyc(spark, sf).withColumn("at", F.expr("l_shipdate + INTERVAL 9200 DAYS"))
    h2o = F.when(F.col("l_tax") > 0, F.col("l_tax"))
    return d.select(
        *ID,
        r(units.absolute_flux(F.col("flux_slope"), F.col("mean_temp"), F.col("at"))).alias("co2_flux"),
        r(units.absolute_flux(h2o, F.col("mean_temp"), F.col("at"))).alias("h2o_flux"),
    )


@query(
    "leaf_area_and_par",
    f"""WITH {CYC_SQL} SELECT {IDS}, {sr('l_quantity * 4')} AS leaf_conservative, {sr('l_quantity * 12')} AS leaf_literature_max,
 {sr('l_quantity * 6')} AS leaf_fixed, {sr('radiation * 0.45 * 4.57', 4)} AS par FROM cy""",
)
def leaf_area_and_par(spark, sf):
    q = F.col("l_quantity")
    return cyc(spark, sf).select(
        *ID,
        *[r(units.leaf_area(q, m)).alias(f"leaf_{m}") for m in ("conservative", "literature_max", "fixed")],
        r(units.par_from_radiation(F.col("radiation")), 4).alias("par"),
    )


@query(
    "closure_confidence",
    f"""WITH {CYC_SQL}, x AS (SELECT *, coalesce(least(greatest(CASE WHEN radiation IS NOT NULL THEN radiation / 800 END, 0), 1), 0) AS rad,
  CASE WHEN r2 IS NULL THEN 0 ELSE least(greatest((r2 - 0.25) / 0.69, 0), 1) END AS c, least(greatest(nrmse / 0.2, 0), 1) AS nz FROM cy),
 y AS (SELECT *, CASE WHEN radiation IS NULL THEN 0 ELSE rad END AS g FROM x)
SELECT {IDS}, {sr('least(greatest(c - g * (1 - c) * 0.4 - g * nz * 0.2, 0), 1)')} AS closure_confidence FROM y""",
)
def closure_confidence(spark, sf):
    c = units.closure_confidence(F.col("r2"), F.col("nrmse"), F.col("radiation"))
    return cyc(spark, sf).select(*ID, r(c).alias("closure_confidence"))


@query(
    "daytime_derivation",
    f"""WITH {READINGS} SELECT event_id, coalesce(value >= 10, hour(ts) >= 6 AND hour(ts) < 18) AS is_daytime FROM readings""",
)
def daytime_derivation(spark, sf):
    return readings(spark, sf).select("event_id", units.is_daytime("ts", "value").alias("is_daytime"))


@query(
    "status_labels",
    f"""WITH {CYC_SQL} SELECT {IDS}, CASE WHEN r2 IS NULL THEN 'N/A' WHEN r2 BETWEEN 0.7 AND 0.8 THEN 'PASS'
  WHEN r2 BETWEEN 0.7 * 0.7 AND 0.8 * 1.3 THEN 'BORDERLINE' ELSE 'FAIL' END AS in_range,
 CASE WHEN r2 IS NULL THEN 'N/A' WHEN r2 >= 0.7 THEN 'PASS' ELSE 'BORDERLINE' END AS at_least FROM cy""",
)
def status_labels(spark, sf):
    r2 = F.col("r2")
    return cyc(spark, sf).select(
        *ID, grading.status_in_range(r2, 0.7, 0.8).alias("in_range"), grading.status_at_least(r2, 0.7).alias("at_least")
    )


@query(
    "calendar_derivations",
    f"""SELECT {IDS}, l_shipdate, CASE WHEN month(l_shipdate) BETWEEN 5 AND 9 THEN 'dry' ELSE 'wet' END AS season,
 {sr("(epoch_us(l_shipdate) - epoch_us(TIMESTAMP '1995-01-01')) / 86400e6 / 365.25")} AS age_years,
 {sr("(epoch_us(l_shipdate) - epoch_us(TIMESTAMP '1995-01-01')) / 86400e6 / 30.44")} AS months_after,
 CAST(floor(date_diff('day', TIMESTAMP '1995-01-01', l_shipdate) / 90.0) * 90 AS INT) AS age_bin FROM lineitem""",
)
def calendar_derivations(spark, sf):
    o = F.lit("1995-01-01").cast("timestamp_ntz")
    return table(spark, sf, "lineitem").select(
        *ID,
        "l_shipdate",
        labels.season("l_shipdate").alias("season"),
        r(labels.age_years("l_shipdate", o)).alias("age_years"),
        r(labels.months_after("l_shipdate", o)).alias("months_after"),
        labels.age_bin("l_shipdate", o, 90).alias("age_bin"),
    )


@query(
    "label_prettifier",
    """SELECT p_partkey, replace(replace(replace(CASE p_size % 4 WHEN 0 THEN 'CO2_' WHEN 1 THEN 'H2O ' WHEN 2 THEN 'CH4-' ELSE 'C1_' END || p_brand,
 'CO2', 'CO<sub>2</sub>'), 'H2O', 'H<sub>2</sub>O'), 'CH4', 'CH<sub>4</sub>') AS label FROM part""",
)
def label_prettifier(spark, sf):
    s = F.col("p_size") % 4
    pre = F.when(s == 0, "CO2_").when(s == 1, "H2O ").when(s == 2, "CH4-").otherwise("C1_")
    return table(spark, sf, "part").select(
        "p_partkey", labels.pretty_formula(F.concat(pre, F.col("p_brand"))).alias("label")
    )
