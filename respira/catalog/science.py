"""Response-curve checks; events stand in for cycles (chamber = event type)."""

from __future__ import annotations

from pyspark.sql import functions as F

from respira.catalog.base import READINGS, r, readings, registry, sr
from respira.operators import validation as va

QUERIES, query = registry()
CFG = {**va.SETTINGS, "light_min_n": 20, "Q10_min_n": 20, "Q10_min_T_iqr": 1.0, "light_par_iqr_min": 100.0}

CYC = f"""{READINGS}, cyc AS (SELECT event_id, sensor AS chamber, ts, CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN -(10.0 * aux / (aux + 30.0)) + value / 200 ELSE 1 + exp(aux / 50.0) + value / 100 END AS flux,
   CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN -value / 10 ELSE value / 20 END AS co2_slope, (aux - 5) / 30.0 AS h2o, aux * 10.0 AS rad, 20 + aux / 10.0 AS temp, value / 30 AS vpd,
   hour(ts) BETWEEN 6 AND 17 AS is_daytime, aux / 100.0 AS conf, value / 100 AS day_score FROM readings)"""


def cyc(spark, sf):
    a, v, day = F.col("aux"), F.col("value"), F.hour("ts").between(6, 17)
    return readings(spark, sf).select(
        "event_id",
        F.col("sensor").alias("chamber"),
        "ts",
        F.when(day, -(10.0 * a / (a + 30.0)) + v / 200).otherwise(1 + F.exp(a / 50.0) + v / 100).alias("flux"),
        F.when(day, -v / 10).otherwise(v / 20).alias("co2_slope"),
        ((a - 5) / 30.0).alias("h2o"),
        (a * 10.0).alias("rad"),
        (20 + a / 10.0).alias("temp"),
        (v / 30).alias("vpd"),
        day.alias("is_daytime"),
        (a / 100.0).alias("conf"),
        (v / 100).alias("day_score"),
    )


def _q10(by: str, src: str) -> str:
    return f"""g AS (SELECT {by}, count(*) AS n, regr_slope(ln(flux), temp - 25) AS b, regr_intercept(ln(flux), temp - 25) AS a, corr(ln(flux), temp - 25) AS c,
   regr_sxx(ln(flux), temp - 25) AS sxx, regr_syy(ln(flux), temp - 25) AS syy, quantile_cont(temp, 0.75) - quantile_cont(temp, 0.25) AS t_iqr
  FROM {src} WHERE NOT is_daytime AND flux > 0 AND temp IS NOT NULL GROUP BY ALL),
 q AS (SELECT *, n >= 20 AND t_iqr >= 1 AS ok, sqrt((1 - c * c) * syy / sxx / (n - 2)) AS se FROM g)"""


Q10_OUT = f"""{sr('CASE WHEN ok THEN exp(b * 10) END')} AS Q10, {sr('CASE WHEN ok THEN exp((b - 1.96 * se) * 10) END', 5)} AS Q10_ci_lo, {sr('CASE WHEN ok THEN exp((b + 1.96 * se) * 10) END', 5)} AS Q10_ci_hi,
 {sr('CASE WHEN ok THEN exp(a) END')} AS R_ref, {sr('CASE WHEN ok THEN c * c END')} AS r2"""
Q10_NUM = {"Q10": 6, "Q10_ci_lo": 5, "Q10_ci_hi": 5, "R_ref": 6, "r2": 6}


@query(
    "q10_temperature_response",
    f"""WITH {CYC}, {_q10('chamber', 'cyc')} SELECT chamber, n, {sr('t_iqr')} AS t_iqr, {Q10_OUT},
 CASE WHEN exp(b * 10) BETWEEN 1.5 AND 3 THEN 'PASS' WHEN exp(b * 10) BETWEEN 1.5 * 0.7 AND 3 * 1.3 THEN 'BORDERLINE' ELSE 'FAIL' END AS Q10_status FROM q""",
)
def q10_temperature_response(spark, sf):
    d = va.q10_response(cyc(spark, sf), ["chamber"], "flux", "temp", "is_daytime", CFG)
    return d.select("chamber", "n", r("t_iqr").alias("t_iqr"), *[r(c, k).alias(c) for c, k in Q10_NUM.items()], "Q10_status")


@query(
    "water_use_efficiency",
    f"""WITH {CYC}, w AS (SELECT *, CASE WHEN co2_slope IS NOT NULL THEN greatest(0.1, least(30.0, -co2_slope / h2o)) END AS wue FROM cyc WHERE is_daytime AND flux < 0 AND h2o > 0)
SELECT chamber, count(*) AS n, {sr('median(wue)')} AS median, {sr('quantile_cont(wue, 0.25)')} AS p25, {sr('quantile_cont(wue, 0.75)')} AS p75, {sr('corr(vpd, wue)')} AS vpd_r,
 CASE WHEN median(wue) BETWEEN 2 AND 8 THEN 'PASS' WHEN median(wue) BETWEEN 2 * 0.7 AND 8 * 1.3 THEN 'BORDERLINE' ELSE 'FAIL' END AS wue_status FROM w GROUP BY chamber""",
)
def water_use_efficiency(spark, sf):
    d = va.water_use_efficiency(cyc(spark, sf), ["chamber"], "flux", "co2_slope", "h2o", "is_daytime", "vpd", CFG)
    return d.select("chamber", "n", *[r(c).alias(c) for c in ("median", "p25", "p75", "vpd_r")], "wue_status")


@query(
    "inter_chamber_agreement",
    f"""WITH {CYC}, h AS (SELECT CAST(ts AS DATE) AS d, hour(ts) AS h, chamber, avg(flux) AS f FROM cyc GROUP BY 1, 2, 3 HAVING avg(flux) IS NOT NULL),
 p AS (SELECT d, h, max(CASE WHEN chamber = 'click' THEN f END) AS x, max(CASE WHEN chamber = 'error' THEN f END) AS y FROM h GROUP BY 1, 2 HAVING count(*) = (SELECT count(DISTINCT chamber) FROM cyc))
SELECT count(*) FILTER (h BETWEEN 6 AND 17) AS n_day_pairs, count(*) FILTER (h NOT BETWEEN 6 AND 17) AS n_night_pairs, {sr('corr(x, y) FILTER (h BETWEEN 6 AND 17)')} AS r_daytime, {sr('corr(x, y) FILTER (h NOT BETWEEN 6 AND 17)')} AS r_nighttime FROM p""",
)
def inter_chamber_agreement(spark, sf):
    d = va.chamber_agreement(cyc(spark, sf).withColumn("run", F.lit(1)), ["run"], "chamber", "ts", "flux", cfg=CFG)
    return d.select("n_day_pairs", "n_night_pairs", r("r_daytime").alias("r_daytime"), r("r_nighttime").alias("r_nighttime"))


@query(
    "threshold_sensitivity_sweep",
    f"""WITH {CYC}, t AS (SELECT unnest([0.2, 0.4, 0.6, 0.8]) AS conf_min), u AS (SELECT unnest([0.1, 0.3, 0.5]) AS day_score_min),
 x AS (SELECT cyc.*, CAST(conf_min AS DOUBLE) AS conf_min, CAST(day_score_min AS DOUBLE) AS day_score_min FROM cyc JOIN t ON conf >= conf_min JOIN u ON day_score >= day_score_min), {_q10('conf_min, day_score_min', 'x')}
SELECT conf_min, day_score_min, n, {Q10_OUT} FROM q""",
)
def threshold_sensitivity_sweep(spark, sf):
    d = va.threshold_sweep(
        cyc(spark, sf),
        {"conf": [0.2, 0.4, 0.6, 0.8], "day_score": [0.1, 0.3, 0.5]},
        lambda x, by: va.q10_response(x, by, "flux", "temp", "is_daytime", CFG),
    )
    return d.select("conf_min", "day_score_min", "n", *[r(c, k).alias(c) for c, k in Q10_NUM.items()])


# Damped Gauss-Newton with a fixed small damping, one recursion a round; the optimum lies inside the bounds.
_MINORS = "b * c - f * f AS m11, e * f - d * c AS m12, d * f - b * e AS m13, a * c - e * e AS m22, d * e - a * f AS m23, a * b - d * d AS m33"
LIGHT = f"""WITH RECURSIVE {CYC}, pts AS (SELECT chamber, rad * 2.02 AS p, -flux AS y FROM cyc WHERE is_daytime AND flux IS NOT NULL AND rad >= 0),
 gate AS (SELECT chamber, count(p) AS n, quantile_cont(p, 0.75) - quantile_cont(p, 0.25) AS par_iqr
   FROM (SELECT DISTINCT chamber FROM cyc) LEFT JOIN pts USING (chamber) WHERE chamber IS NOT NULL GROUP BY chamber),
 fit(it, chamber, al, am, rd) AS (SELECT 0, chamber, 0.04::DOUBLE, 12::DOUBLE, 2::DOUBLE FROM gate WHERE n >= 20 AND par_iqr >= 100
  UNION ALL SELECT it + 1, chamber, least(greatest(al + (m11 * u + m12 * v + m13 * w) / det, 1e-6), 0.2), least(greatest(am + (m12 * u + m22 * v + m23 * w) / det, 1e-3), 50),
    least(greatest(rd + (m13 * u + m23 * v + m33 * w) / det, 0), 15)
   FROM (SELECT *, a * m11 + d * m12 + e * m13 AS det FROM (SELECT *, {_MINORS}
    FROM (SELECT it, chamber, al, am, rd, sum(g * g) * 1.001 AS a, sum(h * h) * 1.001 AS b, count(*) * 1.001 AS c, sum(g * h) AS d, sum(-g) AS e, sum(-h) AS f, sum(g * z) AS u, sum(h * z) AS v, sum(-z) AS w
     FROM (SELECT *, p * am * am / ((al * p + am) * (al * p + am)) AS g, al * p * al * p / ((al * p + am) * (al * p + am)) AS h, y - (al * p * am / (al * p + am) - rd) AS z
      FROM fit JOIN pts USING (chamber) WHERE it < 60) GROUP BY it, chamber, al, am, rd)))),
 fin AS (SELECT chamber, al, am, rd, rss, (b * c - f * f) / det * rss / (c - 3) AS va, (a * c - e * e) / det * rss / (c - 3) AS vm, 1 - rss / syy AS r2 FROM (
  SELECT *, a * (b * c - f * f) - d * (d * c - f * e) + e * (d * f - b * e) AS det FROM (
   SELECT chamber, al, am, rd, sum(g * g) AS a, sum(h * h) AS b, count(*) AS c, sum(g * h) AS d, sum(-g) AS e, sum(-h) AS f, sum(z * z) AS rss, var_pop(y) * count(*) AS syy
   FROM (SELECT *, p * am * am / ((al * p + am) * (al * p + am)) AS g, al * p * al * p / ((al * p + am) * (al * p + am)) AS h, y - (al * p * am / (al * p + am) - rd) AS z
    FROM fit JOIN pts USING (chamber) WHERE it = 60) GROUP BY chamber, al, am, rd)))
SELECT chamber, n, {sr('par_iqr')} AS par_iqr, {sr('al', 5)} AS alpha, {sr('am', 4)} AS Amax, {sr('rd', 4)} AS Rd, {sr('sqrt(va)', 5)} AS alpha_se, {sr('sqrt(vm)', 3)} AS Amax_se, {sr('r2', 5)} AS r2
 FROM gate LEFT JOIN fin USING (chamber)"""


@query("light_response_fit", LIGHT)
def light_response_fit(spark, sf):
    d = va.light_response(cyc(spark, sf), "chamber", "flux", "rad", "is_daytime", CFG)
    digits = {"par_iqr": 6, "alpha": 5, "Amax": 4, "Rd": 4, "alpha_se": 5, "Amax_se": 3, "r2": 5}
    return d.select("chamber", "n", *[r(c, k).alias(c) for c, k in digits.items()])


@query("science_scorecard")
def science_scorecard(spark, sf):
    return va.validate_cycles(
        cyc(spark, sf), "chamber", "ts", "flux", "co2_slope", "h2o", "rad", "temp", "vpd", "is_daytime", CFG
    )


@query("correlation_p_values")
def correlation_p_values(spark, sf):
    from respira.functions.special import correlation_p_value

    g = cyc(spark, sf).groupBy("chamber").agg(F.count("vpd").alias("n"), F.corr("vpd", "temp").alias("r"))
    return g.withColumn("p", correlation_p_value(F.col("r"), F.col("n")))
