"""Coherence, day quality and anomaly scores; line items and events stand in for cycles."""

from __future__ import annotations

from pyspark.sql import functions as F

from respira.catalog.base import READINGS, r, readings, registry, sr, table
from respira.operators import anomaly, coherence
from respira.operators.ml_flags import anomaly_flags
from respira.plans.series import micros

QUERIES, query = registry()

SCORED = f"""{READINGS}, sc AS (SELECT event_id, sensor AS chamber, ts, (aux - 60) / 1000.0 AS slope, CASE WHEN value > 120 THEN 2 WHEN value > 60 THEN 1 ELSE 0 END AS qc,
   1 - aux / 250.0 AS r2, CASE WHEN value IS NOT NULL THEN least(value / 400, 0.5) END AS nrmse, CAST(ts AS DATE) AS d, hour(ts) AS h FROM readings)"""


def scored(spark, sf):
    v, a = F.col("value"), F.col("aux")
    return readings(spark, sf).select(
        "event_id",
        F.col("sensor").alias("chamber"),
        "ts",
        ((a - 60) / 1000.0).alias("slope"),
        F.when(v > 120, 2).when(v > 60, 1).otherwise(0).alias("qc"),
        (1 - a / 250.0).alias("r2"),
        F.when(v.isNotNull(), F.least(v / 400, F.lit(0.5))).alias("nrmse"),
    )


COH = """co AS (SELECT *, lag(slope) OVER w AS ps, lag(h) OVER w AS ph, lag(qc) OVER w AS pq FROM sc WINDOW w AS (PARTITION BY d ORDER BY ts, event_id)),
 tc AS (SELECT *, CASE WHEN NOT (qc > 1) AND coalesce(pq, 0) <= 1 AND ps IS NOT NULL AND ps <> 0 AND h NOT IN (6,7,8,17,18,19) AND ph NOT IN (6,7,8,17,18,19)
   AND ((slope * ps > 0 AND abs(slope / ps) > 3) OR (NOT (slope * ps > 0) AND h BETWEEN 8 AND 16 AND abs(slope) > 0.005)) THEN 1 ELSE 0 END AS tcf FROM co),
 hc AS (SELECT d, h, CASE WHEN avg(abs(slope)) >= 1e-9 AND stddev_samp(slope) / avg(abs(slope)) > 0.5 THEN 1 ELSE 0 END AS cv FROM sc GROUP BY 1, 2),
 fl AS (SELECT tc.*, cv FROM tc JOIN hc USING (d, h))"""


def coherent(spark, sf, cv=0.5):
    return coherence.temporal_coherence(scored(spark, sf), "ts", "slope", "qc", ("event_id",), cv_threshold=cv)


@query(
    "temporal_coherence_flags",
    f"WITH {SCORED}, {COH} SELECT event_id, tcf AS temporal_coherence_flag, cv AS hourly_cv_flag FROM fl",
)
def temporal_coherence_flags(spark, sf):
    return coherent(spark, sf).select("event_id", "temporal_coherence_flag", "hourly_cv_flag")


DAYQ = """cl AS (SELECT * FROM fl WHERE qc <= 1 AND tcf = 0 AND h BETWEEN 7 AND 18),
 dq AS (SELECT chamber, d, count(*) AS n, count(DISTINCT h) AS nh, median(r2) AS r2, avg(CASE WHEN slope < 0 THEN 1.0 ELSE 0.0 END) AS neg, avg(nrmse) AS nz FROM cl GROUP BY 1, 2),
 hm AS (SELECT chamber, d, h, median(slope) AS m FROM cl GROUP BY 1, 2, 3),
 pk AS (SELECT chamber, d, arg_min(h, (m, h)) AS peak FROM hm GROUP BY 1, 2),
 ds AS (SELECT *, least(nh / 11.0, 1.0) AS cov, CASE WHEN peak BETWEEN 9 AND 14 THEN 1.0 ELSE 0.5 END AS shape, greatest(0.0, 1 - coalesce(nz, 0.2) / 0.2) AS ns
  FROM dq JOIN pk USING (chamber, d) WHERE n >= 3 AND nh >= 4),
 dd AS (SELECT *, 0.3 * cov + 0.3 * r2 + 0.2 * neg + 0.1 * shape + 0.1 * ns AS score FROM ds)"""


def clean_days(spark, sf):
    return coherent(spark, sf).drop("hourly_cv_flag")


@query(
    "day_quality_scores",
    f"""WITH {SCORED}, {COH}, {DAYQ} SELECT chamber, d AS date, n AS n_cycles_daytime, nh AS n_hours_covered, round_even(cov, 4) + 0.0 AS coverage_score, round_even(r2, 4) + 0.0 AS quality_score,
 round_even(neg, 4) + 0.0 AS frac_negative, round_even(shape, 4) + 0.0 AS shape_score, round_even(ns, 4) + 0.0 AS nrmse_score, round_even(score, 4) + 0.0 AS day_score FROM dd""",
)
def day_quality_scores(spark, sf):
    d = clean_days(spark, sf).filter("qc <= 1 AND temporal_coherence_flag = 0")
    d = coherence.day_quality(d, ["chamber"], "ts", "slope", "r2", "nrmse")
    num = ("coverage_score", "quality_score", "frac_negative", "shape_score", "nrmse_score", "day_score")
    return d.select("chamber", "date", "n_cycles_daytime", "n_hours_covered", *num)


@query(
    "cycle_day_scores",
    f"""WITH {SCORED}, {COH}, {DAYQ} SELECT event_id, round_even(coalesce(dd.score, 0), 4) + 0.0 AS day_score, CAST(dd.n AS DOUBLE) AS n_cycles_daytime FROM sc LEFT JOIN dd ON sc.chamber = dd.chamber AND sc.d = dd.d""",
)
def cycle_day_scores(spark, sf):
    d = coherence.attach_day_scores(clean_days(spark, sf), ["chamber"], "ts", "slope", "r2", "nrmse", "qc")
    return d.select("event_id", "day_score", F.col("n_cycles_daytime").cast("double"))


@query(
    "rolling_slope_zscore",
    f"""WITH {READINGS}, f AS (SELECT event_id, value, CASE WHEN count(value) OVER w >= 4 THEN avg(value) OVER w END AS m, CASE WHEN count(value) OVER w >= 4 THEN stddev_samp(value) OVER w END AS s
  FROM readings WINDOW w AS (PARTITION BY sensor ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)),
 z AS (SELECT event_id, (value - m) / nullif(s, 0) AS z FROM f)
SELECT event_id, {sr('z')} AS rolling_zscore, CASE WHEN abs(z) > 3 THEN 1 ELSE 0 END AS rolling_zscore_flag FROM z""",
)
def rolling_slope_zscore(spark, sf):
    d = readings(spark, sf).withColumn("us", micros("ts"))
    d = anomaly.rolling_zscore(d, ["sensor"], ["us", "event_id"], "value")
    return d.select("event_id", r("rolling_zscore").alias("rolling_zscore"), "rolling_zscore_flag")


STL = f"""{READINGS}, hb AS (SELECT sensor, date_trunc('hour', ts) AS h, median(value) AS x FROM readings GROUP BY 1, 2),
 b AS (SELECT sensor, min(h) AS a, max(h) AS z FROM hb GROUP BY 1),
 g AS (SELECT sensor, h FROM b, LATERAL (SELECT unnest(generate_series(a, z, INTERVAL 1 HOUR)) AS h)),
 j AS (SELECT g.sensor, g.h, x, CASE WHEN x IS NOT NULL THEN epoch_us(g.h) END AS k FROM g LEFT JOIN hb USING (sensor, h)),
 f AS (SELECT *, last_value(x IGNORE NULLS) OVER p AS pv, last_value(k IGNORE NULLS) OVER p AS pk, first_value(x IGNORE NULLS) OVER n AS nv, first_value(k IGNORE NULLS) OVER n AS nk FROM j
  WINDOW p AS (PARTITION BY sensor ORDER BY h ROWS UNBOUNDED PRECEDING), n AS (PARTITION BY sensor ORDER BY h ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
 i AS (SELECT sensor, h, coalesce(x, CASE WHEN least(epoch_us(h) - pk, nk - epoch_us(h)) <= 10800000000 THEN coalesce(pv + (nv - pv) * (epoch_us(h) - pk) / (nk - pk), nv, pv) END) AS x FROM f),
 t AS (SELECT *, x - avg(x) OVER w AS dt FROM (SELECT *, count(*) OVER (PARTITION BY sensor) AS n FROM i WHERE x IS NOT NULL) WHERE n >= 72
  WINDOW w AS (PARTITION BY sensor ORDER BY h ROWS BETWEEN 12 PRECEDING AND 11 FOLLOWING)),
 s AS (SELECT *, dt - median(dt) OVER (PARTITION BY sensor, hour(h)) AS res FROM t),
 q AS (SELECT sensor, quantile_cont(res, 0.75) - quantile_cont(res, 0.25) AS iqr FROM s GROUP BY 1),
 rz AS (SELECT s.sensor, h, res, res / (iqr / 1.3489) AS z FROM s JOIN q USING (sensor) WHERE iqr >= 1e-9)"""


@query(
    "seasonal_residuals",
    f"WITH {STL} SELECT sensor, epoch_us(h) AS hour_us, {sr('res')} AS residual, {sr('z')} AS zscore FROM rz",
)
def seasonal_residuals(spark, sf):
    d = anomaly.seasonal_residuals(readings(spark, sf), ["sensor"], "ts", "value")
    return d.select("sensor", "hour_us", r("residual").alias("residual"), r("zscore").alias("zscore"))


@query(
    "seasonal_residual_scores",
    f"""WITH {STL}, n AS (SELECT e.event_id, res, z, row_number() OVER (PARTITION BY e.event_id ORDER BY abs(epoch_us(rz.h) - epoch_us(date_trunc('hour', e.ts))), rz.h) AS rn
  FROM readings e JOIN rz ON e.sensor = rz.sensor AND rz.h BETWEEN date_trunc('hour', e.ts) - INTERVAL 1 HOUR AND date_trunc('hour', e.ts) + INTERVAL 1 HOUR)
SELECT e.event_id, {sr('z')} AS stl_residual_zscore, CASE WHEN abs(z) > 2 THEN 1 ELSE 0 END AS stl_soft_flag, CASE WHEN abs(z) > 3.5 THEN 1 ELSE 0 END AS stl_hard_flag
FROM readings e LEFT JOIN n ON e.event_id = n.event_id AND rn = 1""",
)
def seasonal_residual_scores(spark, sf):
    d = anomaly.seasonal_residual_scores(readings(spark, sf), ["sensor"], "ts", "value")
    return d.select("event_id", r("stl_residual_zscore").alias("stl_residual_zscore"), "stl_soft_flag", "stl_hard_flag")


def _norm(expr: str, name: str, high: bool) -> str:
    return f"""{name}_v AS (SELECT event_id, {expr} AS v FROM readings), {name}_f AS (SELECT event_id, v, coalesce(v, (SELECT median(v) FROM {name}_v)) AS f FROM {name}_v),
 {name} AS (SELECT event_id, CASE WHEN v IS NULL THEN 0 ELSE {'' if high else '1 - '}((rank() OVER (ORDER BY f) + (count(*) OVER (PARTITION BY f) - 1) / 2.0) - 1) / (count(*) OVER () - 1) END AS {name} FROM {name}_f)"""


@query(
    "rank_ensemble_score",
    f"""WITH {READINGS}, {_norm('-aux * 1.0', 'ml_if_norm', False)}, {_norm('value', 'ml_mcd_norm', True)}, {_norm('abs(value - 50)', 'rz_norm', True)},
 j AS (SELECT *, (0.15 * ml_if_norm + 0.15 * ml_mcd_norm + 0.15 * rz_norm) / 0.45 AS s FROM ml_if_norm JOIN ml_mcd_norm USING (event_id) JOIN rz_norm USING (event_id))
SELECT event_id, {sr('ml_if_norm')} AS ml_if_norm, {sr('ml_mcd_norm')} AS ml_mcd_norm, {sr('rz_norm')} AS rz_norm, {sr('s')} AS anomaly_ensemble_score, CASE WHEN s > 0.65 THEN 1 ELSE 0 END AS anomaly_ensemble_flag FROM j""",
)
def rank_ensemble_score(spark, sf):
    d = readings(spark, sf).select(
        "event_id",
        (-F.col("aux") * 1.0).alias("ml_if_score"),
        F.col("value").alias("ml_mcd_dist"),
        (F.col("value") - 50).alias("rolling_zscore"),
    )
    d = anomaly.ensemble_score(d)
    num = ("ml_if_norm", "ml_mcd_norm", "rz_norm", "anomaly_ensemble_score")
    return d.select("event_id", *[r(c).alias(c) for c in num], "anomaly_ensemble_flag")


def features(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.avg("l_discount").alias("r2"),
        F.avg("l_tax").alias("nrmse"),
        F.avg("l_extendedprice").alias("snr"),
        F.max("l_quantity").alias("co2_range"),
        F.sum("l_quantity").alias("n_points_total"),
        F.max("l_quantity").alias("n_points_used"),
        F.max(F.when(F.col("l_returnflag") == "R", 2).otherwise(0)).alias("flux_qc"),
    )


@query("isolation_forest_and_mcd_flags")
def isolation_forest_and_mcd_flags(spark, sf):
    d = anomaly_flags(features(spark, sf), ["l_orderkey"])
    return d.select("l_orderkey", "ml_if_score", "ml_mcd_dist", "ml_anomaly_flag")


@query("robust_covariance_distance")
def robust_covariance_distance(spark, sf):
    cols = ["r2", "nrmse", "snr", "co2_range"]
    d = features(spark, sf).withColumn("_train", F.col("flux_qc") <= 1)
    return anomaly.mahalanobis_scores(d, cols, max_fit_rows=None).select("l_orderkey", "ml_mcd_dist", "mcd_flag")
