"""Drift severity, cycle confidence and window selection; line items at an hour of their ship date stand in for cycles."""

from __future__ import annotations

from pyspark.sql import functions as F

from respira.catalog.base import r, registry, sr, table
from respira.functions import thresholds as T
from respira.operators import day_windows as dw
from respira.plans.sizing import cut_lineage

QUERIES, query = registry()
CFG = {**T.WINDOW_SETTINGS, "confidence_good": 0.60, "min_good_fraction": 0.45, "min_cycle_coverage": 0.40}
ID = ["l_orderkey", "l_linenumber", "l_partkey"]
IDS = ", ".join(ID)
COLS = {
    "co2_r2": "1 - l_discount * 3",
    "co2_nrmse": "l_tax * 2.2",
    "co2_snr": "l_extendedprice / 8000",
    "co2_outlier_frac": "l_discount",
    "slope_diff_pct": "l_tax * 8",
    "delta_aicc": "CASE WHEN l_quantity > 45 THEN NULL ELSE 0 - l_quantity / 5 END",
    "sensor_co2_qc_mean": "CASE WHEN l_linenumber = 7 THEN NULL ELSE l_linenumber / 4.0 END",
    "sensor_h2o_qc_mean": "l_tax * 10",
    "flux_intercept": "l_extendedprice / 1000",
    "closure_confidence": "l_discount * 12 - 0.1",
    "anomaly_ensemble_score": "l_tax * 10",
    "co2_qc": "CAST(l_linenumber % 3 AS INT)",
    "is_instrumental_regime_change": "l_quantity = 50 AND l_discount > 0.095",
}
BASE = f"""cyc AS (SELECT {IDS}, l_returnflag AS chamber, l_shipdate + to_hours(CAST(l_partkey % 24 AS INT)) AS ts, CAST(l_shipdate AS DATE) AS d,
   CAST(l_partkey % 24 AS INT) AS h, {', '.join(f'{e} AS {c}' for c, e in COLS.items())} FROM lineitem)"""


def cyc(spark, sf):
    return table(spark, sf, "lineitem").select(
        *ID,
        F.col("l_returnflag").alias("chamber"),
        F.expr("timestampadd(HOUR, CAST(l_partkey % 24 AS INT), l_shipdate)").cast("timestamp_ntz").alias("ts"),
        *[F.expr(e.replace("NULL", "CAST(NULL AS DOUBLE)")).alias(c) for c, e in COLS.items()],
    )


DRIFT = """dm AS (SELECT chamber, d, median(flux_intercept) FILTER (h < 6 OR h >= 18) AS ni, median(slope_diff_pct) AS sd FROM cyc GROUP BY 1, 2),
 dv AS (SELECT chamber, d, ni - CASE WHEN count(ni) OVER w >= 22 THEN median(ni) OVER w END AS nv, sd - CASE WHEN count(sd) OVER w >= 22 THEN median(sd) OVER w END AS sv
  FROM dm WINDOW w AS (PARTITION BY chamber ORDER BY d ROWS BETWEEN 45 PRECEDING AND 44 FOLLOWING)),
 dz AS (SELECT chamber, d, CASE WHEN count(nv) OVER w >= 3 THEN (nv - avg(nv) OVER w) / nullif(stddev_samp(nv) OVER w, 0) END AS nz,
   CASE WHEN count(sv) OVER w >= 3 THEN (sv - avg(sv) OVER w) / nullif(stddev_samp(sv) OVER w, 0) END AS sz FROM dv WINDOW w AS (PARTITION BY chamber ORDER BY d ROWS BETWEEN 29 PRECEDING AND CURRENT ROW)),
 dr AS (SELECT chamber, d, nz, sz, greatest(0.0, CASE WHEN abs(nz) >= 2.5 THEN 1.0 WHEN abs(nz) >= 1.5 THEN 0.5 ELSE 0.0 END, CASE WHEN abs(sz) >= 2.5 THEN 1.0 WHEN abs(sz) >= 1.5 THEN 0.5 ELSE 0.0 END) AS sev FROM dz)"""


@query(
    "drift_severity",
    f"""WITH {BASE}, {DRIFT} SELECT chamber, d AS date, sev AS drift_severity, {sr('CASE WHEN abs(nz) > 1e-9 THEN nz END')} AS night_intercept_zscore, {sr('CASE WHEN abs(sz) > 1e-9 THEN sz END')} AS slope_div_zscore FROM dr""",
)
def drift_severity(spark, sf):
    d = dw.drift_severity(cyc(spark, sf), "chamber", "ts")
    z = [r(F.when(F.abs(c) > 1e-9, F.col(c))).alias(c) for c in ("night_intercept_zscore", "slope_div_zscore")]
    return d.select("chamber", "date", "drift_severity", *z)


def _t(x: str, good: float, ok: float, op: str, unknown: float) -> str:
    return f"CASE WHEN {x} IS NULL THEN {unknown} WHEN {x} {op} {good} THEN 1.0 WHEN {x} {op} {ok} THEN 0.5 ELSE 0.0 END"


SCORE = f"""pt AS (SELECT cyc.*, ({_t('co2_r2', 0.9, 0.7, '>=', 0.0)} + {_t('co2_nrmse', 0.1, 0.2, '<=', 0.0)} + {_t('co2_snr', 5.0, 1.5, '>=', 0.0)} + {_t('co2_outlier_frac', 0.05, 0.15, '<=', 0.0)}) / 4 AS s_reg,
   ({_t('slope_diff_pct', 0.3, 0.6, '<=', 0.5)} + {_t('delta_aicc', -4.0, -8.0, '>=', 0.5)}) / 2 AS s_rob,
   (CASE WHEN sensor_co2_qc_mean IS NULL THEN 0.5 ELSE greatest(0, least(1, 1 - sensor_co2_qc_mean / 2)) END + CASE WHEN sensor_h2o_qc_mean IS NULL THEN 0.5 ELSE greatest(0, least(1, 1 - sensor_h2o_qc_mean / 2)) END) / 2 AS s_qc,
   1 - coalesce(sev, 0) AS s_dr FROM cyc LEFT JOIN dr ON cyc.chamber = dr.chamber AND cyc.d = dr.d),
 sc AS (SELECT *, (0.35 * s_reg + 0.25 * s_rob + 0.15 * s_qc + 0.15 * s_dr) * (1.0 / 0.9) AS conf FROM pt)"""


def scored(spark, sf, regime=None):
    d = cyc(spark, sf)
    drift = cut_lineage(dw.drift_severity(d, "chamber", "ts"))
    return dw.score_cycles(d, "chamber", "ts", drift, regime, CFG, digits=None), drift


@query(
    "cycle_confidence",
    f"""WITH {BASE}, {DRIFT}, {SCORE} SELECT {IDS}, {sr('s_reg')} AS score_regression, {sr('s_rob')} AS score_robustness, {sr('s_qc')} AS score_sensor_qc, {sr('s_dr')} AS score_drift,
 {sr('greatest(0, least(1, closure_confidence))')} AS score_closure, {sr('greatest(0, least(1, 1 - anomaly_ensemble_score))')} AS score_anomaly,
 {sr('(0.35 * s_reg + 0.25 * s_rob + 0.15 * s_qc + 0.15 * s_dr) / 0.9')} AS cycle_confidence FROM sc""",
)
def cycle_confidence(spark, sf):
    d, _ = scored(spark, sf)
    cols = ("score_regression", "score_robustness", "score_sensor_qc", "score_drift", "score_closure", "score_anomaly")
    return d.select(*ID, *[r(c).alias(c) for c in cols], r("cycle_confidence").alias("cycle_confidence"))


REG = """rg AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) % 10 / 10.0 AS rs FROM orders GROUP BY 1)"""


@query(
    "cycle_confidence_with_regimes",
    f"""WITH {BASE}, {DRIFT}, {SCORE}, {REG} SELECT {IDS}, {sr('coalesce(rs, 0.5)')} AS score_cross_chamber,
 {sr('0.35 * s_reg + 0.25 * s_rob + 0.15 * s_qc + 0.15 * s_dr + 0.1 * coalesce(rs, 0.5)')} AS cycle_confidence FROM sc LEFT JOIN rg ON sc.d = rg.d""",
)
def cycle_confidence_with_regimes(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date"))
    reg = o.agg((F.count(F.lit(1)) % 10 / 10.0).alias("regime_score"))
    d, _ = scored(spark, sf, reg)
    return d.select(
        *ID, r("score_cross_chamber").alias("score_cross_chamber"), r("cycle_confidence").alias("cycle_confidence")
    )


DAILY = f"""dg AS (SELECT chamber, d, count(*) AS n, avg(CAST(conf >= {CFG['confidence_good']} AS INT)) AS good, avg(conf) AS mc, sum(conf) AS cs, count(DISTINCT CASE WHEN h BETWEEN 5 AND 18 THEN h END) / 14.0 AS dc,
   bool_or(is_instrumental_regime_change) AS rgm, avg(CAST(co2_qc <= 1 AS INT)) AS gall, coalesce(avg(CAST(co2_qc <= 1 AS INT)) FILTER (h >= 6 AND h < 18), avg(CAST(co2_qc <= 1 AS INT))) AS gab, avg(CAST(co2_qc = 0 AS INT)) AS ga
  FROM sc GROUP BY 1, 2),
 mx AS (SELECT chamber, quantile_cont(n, 0.95) AS mx FROM dg GROUP BY 1),
 dy AS (SELECT dg.*, least(n / mx, 1.0) AS cov, least(n / mx, 1.0) >= {CFG['min_cycle_coverage']} AND good >= {CFG['min_good_fraction']} AND NOT rgm AS q FROM dg JOIN mx USING (chamber))"""


@query(
    "daily_cycle_statistics",
    f"""WITH {BASE}, {DRIFT}, {SCORE}, {DAILY} SELECT chamber, d AS date, n AS n_cycles, {sr('cov')} AS coverage, {sr('good')} AS good_frac, {sr('mc')} AS mean_confidence, {sr('dc')} AS diurnal_cov,
 {sr('gall')} AS all_grade_ab_frac, {sr('gab')} AS grade_ab_frac, {sr('ga')} AS grade_a_frac, q AS qualifying FROM dy""",
)
def daily_cycle_statistics(spark, sf):
    d = dw.daily_statistics(scored(spark, sf)[0], "chamber", "ts", cfg=CFG)
    num = "coverage good_frac mean_confidence diurnal_cov all_grade_ab_frac grade_ab_frac grade_a_frac".split()
    return d.select("chamber", "date", "n_cycles", *[r(c).alias(c) for c in num], "qualifying")


WIN = f"""wi AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY chamber) AS nd, sum(CAST(q AS INT)) OVER (PARTITION BY chamber ORDER BY d ROWS BETWEEN CURRENT ROW AND 6 FOLLOWING) AS s7
   FROM dy WINDOW w AS (PARTITION BY chamber ORDER BY d)),
 walk AS (SELECT chamber, i, s7, nd FROM wi WHERE i = 0 AND nd >= 5
  UNION ALL SELECT wi.chamber, wi.i, wi.s7, wi.nd FROM walk JOIN wi ON wi.chamber = walk.chamber AND wi.i = walk.i + CASE WHEN walk.s7 >= 5 THEN 5 ELSE 1 END WHERE wi.i <= wi.nd - 5),
 st AS (SELECT chamber, i AS a FROM walk WHERE s7 >= 5),
 ws AS (SELECT st.chamber, a, min(wi.d) AS sd, max(wi.d) AS ed, count(*) AS n_days, sum(n) AS nc, sum(cs) / sum(n) AS conf, avg(cov) AS cov, avg(coalesce(sev, 0)) AS drf, avg(dc) AS diur, avg(gab) AS gab, avg(gall) AS gall, avg(ga) AS ga
  FROM st JOIN wi ON wi.chamber = st.chamber AND wi.i BETWEEN a AND a + 6 LEFT JOIN dr ON dr.chamber = wi.chamber AND dr.d = wi.d GROUP BY 1, 2),
 wf AS (SELECT *, 0.4 * conf + 0.25 * cov + 0.2 * (1 - drf) + 0.15 * diur AS score, row_number() OVER (ORDER BY chamber, sd) AS window_id FROM ws)"""
RW = f"WITH RECURSIVE {BASE}, {DRIFT}, {SCORE}, {DAILY}, {WIN}"


def windows(spark, sf):
    d, drift = scored(spark, sf)
    # One row per chamber and day: stored, since selection, scoring and export all read it.
    daily = cut_lineage(dw.daily_statistics(d, "chamber", "ts", cfg=CFG))
    return d, drift, dw.select_windows(daily, "chamber", drift, CFG, digits=None)


WNUM = {
    "mean_confidence": "conf",
    "mean_coverage": "cov",
    "mean_drift_severity": "drf",
    "mean_daytime_grade_ab_frac": "gab",
    "mean_all_grade_ab_frac": "gall",
    "mean_grade_a_frac": "ga",
    "diurnal_hour_coverage": "diur",
    "window_score": "score",
}


@query(
    "window_selection",
    f"""{RW} SELECT window_id, chamber, sd AS start_date, ed AS end_date, n_days, CAST(nc AS BIGINT) AS n_cycles, {', '.join(f"{sr(e)} AS {k}" for k, e in WNUM.items())}, score >= 0.55 AS qualifies_for_export FROM wf""",
)
def window_selection(spark, sf):
    w = windows(spark, sf)[2]
    return w.select(
        "window_id", "chamber", "start_date", "end_date", "n_days", "n_cycles", *[r(c).alias(c) for c in WNUM], "qualifies_for_export"
    )


@query(
    "window_export",
    f"""{RW}, ex AS (SELECT * FROM wf WHERE score >= 0.55 AND window_id % 4 <> 0),
 cd AS (SELECT chamber, d, arg_min(window_id, (score, -window_id)) AS window_id FROM (SELECT ex.*, unnest(generate_series(CAST(sd AS TIMESTAMP), CAST(ed AS TIMESTAMP), INTERVAL 1 DAY)) AS d FROM ex) GROUP BY 1, 2)
SELECT {IDS}, window_id FROM cyc JOIN cd ON cyc.chamber = cd.chamber AND cyc.d = CAST(cd.d AS DATE)""",
)
def window_export(spark, sf):
    d, _, w = windows(spark, sf)
    chosen = dw.chosen_windows(w, excluded=w.filter("window_id % 4 = 0"))
    return dw.export_cycles(d, chosen, "chamber", "ts").select(*ID, "window_id")


@query(
    "window_manifest",
    f"""{RW} SELECT window_id, chamber, CAST(sd AS VARCHAR) AS start_date, CAST(ed AS VARCHAR) AS end_date, CAST(nc AS BIGINT) AS n_cycles FROM wf WHERE score >= 0.55""",
)
def window_manifest(spark, sf):
    m = dw.window_manifest(dw.chosen_windows(windows(spark, sf)[2]), "chamber")
    e = F.from_json("entry", "chamber STRING, start_date STRING, end_date STRING, n_cycles BIGINT")
    return m.select("window_id", e.alias("e")).select("window_id", "e.*")


@query(
    "selection_summary",
    f"""{RW}, a AS (SELECT count(*) AS n_cycles, {sr('avg(conf)')} AS mean_confidence, count(*) FILTER (conf >= {CFG['confidence_good']}) AS n_confident FROM sc),
 b AS (SELECT count(*) AS n_windows, count(*) FILTER (score >= 0.55) AS n_qualifying, {sr('max(score)')} AS top_score FROM wf), c AS (SELECT count(*) FILTER (sev = 1) AS n_severe_drift_days FROM dr)
SELECT * FROM a, b, c""",
)
def selection_summary(spark, sf):
    d, drift, w = windows(spark, sf)
    s = dw.selection_summary(d, w, drift, CFG)
    return s.withColumns({"mean_confidence": r("mean_confidence"), "top_score": r("top_score")})
