"""Rule flags, sessions, gap and integrity reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from respira.catalog.base import READINGS, r, readings, registry, sr, table
from respira.operators import rules, sessions

QUERIES, query = registry()
HARD, SOFT = (2.0, 300.0), (5.0, 150.0)
BOUNDS_SQL = """CASE WHEN value < 2 OR value > 300 THEN 2 WHEN value < 5 OR value > 150 THEN 1 ELSE 0 END"""
CONFIG_SQL = """config(sensor, hard_lo, hard_hi, soft_lo, soft_hi, iqr_factor, roc_limit, window_hours, epsilon) AS (
  SELECT sensor, 2.0, 300.0, 5.0, 150.0, 1.5, 120.0, CASE WHEN avg(value) > 50 THEN 3.0 ELSE 2.0 END, 1.0
  FROM readings WHERE sensor <> 'signup' GROUP BY sensor)"""
EXCL_SQL = """excl AS (
  SELECT sensor, CAST(min(ts) AS DATE) + CAST(5 AS INT) AS start_d, CAST(min(ts) AS DATE) + CAST(7 AS INT) AS end_d,
         CASE WHEN sensor < 'e' THEN 1 ELSE 2 END AS flag
  FROM readings GROUP BY sensor
  UNION ALL
  SELECT sensor, CAST(min(ts) AS DATE) + CAST(7 AS INT), CAST(min(ts) AS DATE) + CAST(9 AS INT), 2
  FROM readings GROUP BY sensor)"""


def bounds():
    return rules.bounds_flag(F.col("value"), *[F.lit(x) for x in (HARD[0], HARD[1], SOFT[0], SOFT[1])])


def config(df):
    """A configuration row per sensor; one sensor has none."""
    g = df.filter("sensor <> 'signup'").groupBy("sensor").agg(F.avg("value").alias("_m"))
    return g.select(
        "sensor",
        *[F.lit(v).alias(k) for k, v in zip(("hard_lo", "hard_hi", "soft_lo", "soft_hi"), (*HARD, *SOFT), strict=True)],
        F.lit(1.5).alias("iqr_factor"),
        F.lit(120.0).alias("roc_limit"),
        F.when(F.col("_m") > 50, 3.0).otherwise(2.0).alias("window_hours"),
        F.lit(1.0).alias("epsilon"),
    )


def exclusions(df):
    """Two touching exclusion windows per sensor, placed relative to its first day."""
    first = df.groupBy("sensor").agg(F.min("ts").cast("date").alias("d"))
    flag = F.when(F.col("sensor") < "e", 1).otherwise(2)
    spans = F.array(
        F.struct(F.date_add("d", 5).alias("start"), F.date_add("d", 7).alias("end"), flag.alias("flag")),
        F.struct(F.date_add("d", 7).alias("start"), F.date_add("d", 9).alias("end"), F.lit(2).alias("flag")),
    )
    return first.select("sensor", F.explode(spans).alias("w")).select("sensor", "w.*")


@query("physical_bounds_flags", f"WITH {READINGS} SELECT event_id, {BOUNDS_SQL} AS flag FROM readings")
def physical_bounds_flags(spark, sf):
    return readings(spark, sf).select("event_id", bounds().alias("flag"))


IQR_CTE = """q AS (SELECT sensor, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3, count(value) AS n
  FROM readings GROUP BY sensor)"""


@query(
    "iqr_outlier_flags",
    f"""WITH {READINGS}, {IQR_CTE}
SELECT event_id, CASE WHEN n >= 4 AND q3 > q1 AND (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))
  THEN 1 ELSE 0 END AS flag
FROM readings JOIN q USING (sensor)""",
)
def iqr_outlier_flags(spark, sf):
    d = rules.iqr_flags(readings(spark, sf), ["sensor"], "value")
    return d.select("event_id", F.col("iqr_flag").alias("flag"))


ROC_CTES = """st AS (SELECT *, lag(value) OVER w AS pv, epoch_us(ts) - epoch_us(lag(ts) OVER w) AS dt
  FROM readings WINDOW w AS (PARTITION BY sensor ORDER BY ts, event_id)),
 med AS (SELECT sensor, median(dt) AS m FROM st GROUP BY sensor)"""


@query(
    "rate_of_change_flags",
    f"""WITH {READINGS}, {ROC_CTES}
SELECT event_id, CASE WHEN abs(value - pv) > 60 AND coalesce(dt <= 3 * m, true) THEN 1 ELSE 0 END AS flag
FROM st JOIN med USING (sensor)""",
)
def rate_of_change_flags(spark, sf):
    d = rules.rate_of_change_flags(readings(spark, sf), ["sensor"], "ts", "value", 60.0, tie="event_id")
    return d.select("event_id", F.col("roc_flag").alias("flag"))


PERSIST_SQL = """max(value) OVER (PARTITION BY sensor ORDER BY ts
    RANGE BETWEEN INTERVAL 7199999999 MICROSECONDS PRECEDING AND CURRENT ROW)
  - min(value) OVER (PARTITION BY sensor ORDER BY ts
    RANGE BETWEEN INTERVAL 7199999999 MICROSECONDS PRECEDING AND CURRENT ROW)"""


@query(
    "persistence_flags",
    f"""WITH {READINGS}, f AS (SELECT event_id, value, {PERSIST_SQL} AS spread FROM readings)
SELECT event_id, CASE WHEN value IS NOT NULL AND spread <= 1.0 THEN 1 ELSE 0 END AS flag FROM f""",
)
def persistence_flags(spark, sf):
    d = rules.persistence_flags(readings(spark, sf), ["sensor"], "ts", "value", 2.0, 1.0)
    return d.select("event_id", F.col("persistence_flag").alias("flag"))


EXCL_FLAG = """(SELECT max(flag) FROM excl WHERE excl.sensor = readings.sensor AND ts >= start_d
    AND ts <= CAST(end_d AS TIMESTAMP) + INTERVAL 86399 SECONDS)"""


@query(
    "exclusion_window_flags",
    f"WITH {READINGS}, {EXCL_SQL} SELECT event_id, CAST(coalesce({EXCL_FLAG}, 0) AS INT) AS flag FROM readings",
)
def exclusion_window_flags(spark, sf):
    d = readings(spark, sf)
    return rules.exclusion_flags(d, exclusions(d), "sensor", "ts").select(
        "event_id", F.col("exclusion_flag").alias("flag")
    )


FULL_SQL = f"""WITH {READINGS}, {CONFIG_SQL}, {EXCL_SQL}, {IQR_CTE}, {ROC_CTES},
 fr AS (SELECT event_id,
   max(value) OVER w2 - min(value) OVER w2 AS s2, max(value) OVER w3 - min(value) OVER w3 AS s3
  FROM readings
  WINDOW w2 AS (PARTITION BY sensor ORDER BY ts RANGE BETWEEN INTERVAL 7199999999 MICROSECONDS PRECEDING AND CURRENT ROW),
         w3 AS (PARTITION BY sensor ORDER BY ts RANGE BETWEEN INTERVAL 10799999999 MICROSECONDS PRECEDING AND CURRENT ROW)),
 x AS (SELECT event_id, sensor, ts,
   CASE WHEN value < hard_lo OR value > hard_hi THEN 2 WHEN value < soft_lo OR value > soft_hi THEN 1 ELSE 0 END AS b,
   CASE WHEN n >= 4 AND q3 > q1 AND (value < q1 - iqr_factor * (q3 - q1) OR value > q3 + iqr_factor * (q3 - q1))
     THEN 1 ELSE 0 END AS i,
   CASE WHEN abs(value - pv) > roc_limit AND coalesce(dt <= 3 * m, true) THEN 1 ELSE 0 END AS rc,
   CASE WHEN value IS NOT NULL AND CASE WHEN window_hours = 2 THEN s2 WHEN window_hours = 3 THEN s3 END <= epsilon
     THEN 1 ELSE 0 END AS p
  FROM st AS readings LEFT JOIN config USING (sensor) JOIN q USING (sensor) JOIN med USING (sensor)
  JOIN fr USING (event_id)),
 fl AS (SELECT event_id, sensor, b AS bounds_flag, i AS iqr_flag, rc AS roc_flag, p AS persistence_flag,
   CAST(coalesce((SELECT max(flag) FROM excl WHERE excl.sensor = x.sensor AND ts >= start_d
    AND ts <= CAST(end_d AS TIMESTAMP) + INTERVAL 86399 SECONDS), 0) AS INT) AS exclusion_flag FROM x),
 rf AS (SELECT *, greatest(CASE WHEN bounds_flag < 2 AND (iqr_flag = 1 OR roc_flag = 1 OR persistence_flag = 1)
   THEN 1 ELSE bounds_flag END, exclusion_flag) AS rule_flag FROM fl)"""


def flagged(spark, sf):
    d = readings(spark, sf)
    return rules.flag_readings(d, ["sensor"], "sensor", "ts", "value", config(d), exclusions(d))


@query(
    "rule_flags_all_variables",
    f"""{FULL_SQL} SELECT event_id, sensor, bounds_flag, iqr_flag, roc_flag, persistence_flag, exclusion_flag, rule_flag
FROM rf""",
)
def rule_flags_all_variables(spark, sf):
    cols = "event_id sensor bounds_flag iqr_flag roc_flag persistence_flag exclusion_flag rule_flag".split()
    return flagged(spark, sf).select(*cols)


@query(
    "qc_summary",
    f"""{FULL_SQL} SELECT sensor, count(*) AS total_points,
 count(*) FILTER (rule_flag = 0) AS flag_0_count, {sr('100.0 * count(*) FILTER (rule_flag = 0) / count(*)')} AS flag_0_percent,
 count(*) FILTER (rule_flag = 1) AS flag_1_count, {sr('100.0 * count(*) FILTER (rule_flag = 1) / count(*)')} AS flag_1_percent,
 count(*) FILTER (rule_flag = 2) AS flag_2_count, {sr('100.0 * count(*) FILTER (rule_flag = 2) / count(*)')} AS flag_2_percent,
 count(*) FILTER (bounds_flag > 0) AS bounds_failures, count(*) FILTER (iqr_flag > 0) AS iqr_outliers
FROM rf GROUP BY sensor""",
)
def qc_summary(spark, sf):
    s = rules.qc_summary(flagged(spark, sf), "sensor")
    return s.withColumns({f"flag_{i}_percent": r(f"flag_{i}_percent") for i in range(3)})


@query(
    "flag_combination_and_merge",
    f"""WITH {READINGS}, b AS (SELECT event_id, {BOUNDS_SQL} AS b,
  CASE WHEN aux > 90 THEN 1 ELSE 0 END AS i, CASE WHEN aux < 10 THEN 1 ELSE 0 END AS p FROM readings),
 c AS (SELECT *, CASE WHEN b < 2 AND (i = 1 OR p = 1) THEN 1 ELSE b END AS rule_flag FROM b)
SELECT event_id, rule_flag, greatest(rule_flag, i * 2) AS qc_flag FROM c""",
)
def flag_combination_and_merge(spark, sf):
    d = readings(spark, sf)
    i, p = F.when(F.col("aux") > 90, 1).otherwise(0), F.when(F.col("aux") < 10, 1).otherwise(0)
    d = d.withColumn("rule_flag", rules.combine_flags(bounds(), [i, p]))
    return d.select("event_id", "rule_flag", rules.merge_rule_flag(i * 2, F.col("rule_flag")).alias("qc_flag"))


@query(
    "variable_config_lookup",
    """WITH names AS (SELECT DISTINCT replace(p_type, ' ', '_') AS variable FROM part),
 config(position, columns, pattern) AS (
  SELECT CAST(row_number() OVER (ORDER BY replace(p_type, ' ', '_')) AS INT), [replace(p_type, ' ', '_')],
   split_part(p_type, ' ', 1) FROM (SELECT DISTINCT p_type FROM part WHERE p_size > 25)),
 m AS (SELECT variable, CASE WHEN list_contains(columns, variable) THEN 0 ELSE 1 END AS rk, position
  FROM names JOIN config ON list_contains(columns, variable) OR starts_with(variable, pattern || '_')),
 b AS (SELECT variable, min((rk, position)) AS x FROM m GROUP BY variable)
SELECT names.variable, x[2] AS position FROM names LEFT JOIN b USING (variable)""",
)
def variable_config_lookup(spark, sf):
    from pyspark.sql import Window

    parts = table(spark, sf, "part")
    names = parts.select(F.translate("p_type", " ", "_").alias("variable"))
    some = parts.filter("p_size > 25").select("p_type").distinct()
    v = F.translate("p_type", " ", "_")
    conf = some.select(
        F.row_number().over(Window.orderBy(v)).alias("position"),
        F.array(v).alias("columns"),
        F.split("p_type", " ")[0].alias("pattern"),
    )
    return rules.resolve_config(names, conf).select("variable", "position")


BATT = """bt AS (SELECT event_id, 10.0 + aux / 25.0 AS batt, CASE WHEN value > 100 THEN 1 ELSE 0 END AS rf,
  CASE WHEN value > 200 THEN 2 ELSE 0 END AS qf FROM readings)"""


def battery(spark, sf):
    return readings(spark, sf).select(
        "event_id",
        (10.0 + F.col("aux") / 25.0).alias("batt"),
        F.when(F.col("value") > 100, 1).otherwise(0).alias("x_rule_flag"),
        F.when(F.col("value") > 200, 2).otherwise(0).alias("x_qc_flag"),
    )


@query(
    "battery_flag_escalation",
    f"""WITH {READINGS}, {BATT}, l AS (SELECT *, CASE WHEN batt < 11.0 THEN 2 WHEN batt < 11.8 THEN 1 ELSE 0 END AS lv FROM bt)
SELECT event_id, greatest(rf, lv) AS x_rule_flag, greatest(rf, lv, qf) AS x_qc_flag FROM l""",
)
def battery_flag_escalation(spark, sf):
    d = rules.battery_escalation(battery(spark, sf), "batt", 11.8, 11.0, [("x_rule_flag", "x_qc_flag")])
    return d.select("event_id", "x_rule_flag", "x_qc_flag")


@query(
    "battery_summary",
    f"""WITH {READINGS}, {BATT} SELECT count(*) FILTER (batt < 11.8) AS warn_count,
 count(*) FILTER (batt < 11.0) AS bad_count FROM bt""",
)
def battery_summary(spark, sf):
    return rules.battery_summary(battery(spark, sf), "batt", 11.8, 11.0)


HOURLY = """hv AS (SELECT date_trunc('hour', ts) AS h,
  avg(CASE WHEN sensor = 'click' THEN value END) AS click, avg(CASE WHEN sensor = 'view' THEN value END) AS "view",
  avg(CASE WHEN sensor = 'error' THEN value END) AS error, avg(aux) * 1.1 AS rh
 FROM readings GROUP BY 1)"""


def hourly_wide(spark, sf):
    d = readings(spark, sf)
    cols = {s: F.avg(F.when(F.col("sensor") == s, F.col("value"))).alias(s) for s in ("click", "view", "error")}
    return d.groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h")).agg(
        *cols.values(), (F.avg("aux") * 1.1).alias("rh")
    )


@query(
    "cross_variable_consistency",
    f"""WITH {READINGS}, {HOURLY} SELECT h, coalesce(rh > 100 OR rh < 0, false) AS rh_invalid,
 coalesce(abs(click - "view") > 10, false) AS temp_chamber_mismatch,
 coalesce(abs(click - error) > 40, false) AS co2_chamber_mismatch FROM hv""",
)
def cross_variable_consistency(spark, sf):
    d = rules.consistency_flags(
        hourly_wide(spark, sf), ["rh"], ("click", "view"), ("click", "error"), max_gas_gap=40.0
    )
    return d.select("h", "rh_invalid", "temp_chamber_mismatch", "co2_chamber_mismatch")


@query(
    "soil_gradient_anomaly",
    f"""WITH {READINGS}, {HOURLY}, s AS (SELECT h, stddev_samp(click) OVER w AS sh, stddev_samp(error) OVER w AS de FROM hv
 WINDOW w AS (ORDER BY h RANGE BETWEEN INTERVAL 86399999999 MICROSECONDS PRECEDING AND CURRENT ROW))
SELECT h, coalesce(de > sh * 1.5, false) AS soil_gradient_anomaly FROM s""",
)
def soil_gradient_anomaly(spark, sf):
    d = hourly_wide(spark, sf).withColumn("site", F.lit("s"))
    return rules.gradient_anomaly(d, ["site"], "h", "click", "error").select("h", "soil_gradient_anomaly")


AUDIT = """audit AS (SELECT o_orderpriority AS variable, CAST(row_number() OVER (ORDER BY o_orderpriority, date_trunc('month', o_orderdate)) AS INT) AS regime,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) AS e,
  count(*) FILTER (o_orderstatus = 'F') * 1.0 / count(*) AS agreement, max(o_totalprice) > 499800 AS warn,
  CASE WHEN o_orderpriority < '3' THEN 'C1' ELSE 'C2' END AS ref
 FROM orders GROUP BY o_orderpriority, date_trunc('month', o_orderdate))"""


def audit(spark, sf):
    from pyspark.sql import Window

    o = table(spark, sf, "orders")
    g = o.groupBy(
        F.col("o_orderpriority").alias("variable"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("start")
    ).agg(
        F.max("o_orderdate").cast("date").alias("end"),
        (F.count(F.when(F.col("o_orderstatus") == "F", 1)) * 1.0 / F.count(F.lit(1))).alias("agreement_score"),
        (F.max("o_totalprice") > 499800).alias("slope_warning"),
    )
    # One regime per priority and month: a fixed calendar, not one row per order.
    return g.withColumn("regime", F.row_number().over(Window.orderBy("variable", "start"))).withColumn(
        "reference", F.when(F.col("variable") < "3", "C1").otherwise("C2")
    )


@query(
    "exclusion_recommendations",
    f"""WITH {AUDIT}, bad AS (SELECT *, variable || '_' || CASE WHEN ref = 'C1' THEN 'C2' ELSE 'C1' END AS sensor
  FROM audit WHERE agreement < 0.32 OR warn),
 m AS (SELECT *, CASE WHEN s <= max(e) OVER (PARTITION BY sensor ORDER BY s, e, regime ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + CAST(1 AS INT)
   THEN 0 ELSE 1 END AS nw FROM bad),
 i AS (SELECT *, sum(nw) OVER (PARTITION BY sensor ORDER BY s, e, regime) AS isl FROM m)
SELECT sensor, min(s) AS "start", max(e) AS "end", 2 AS flag,
 'regimes ' || string_agg(CAST(regime AS VARCHAR), ',' ORDER BY s, e, regime) || '; avg agreement=' || printf('%.2f', round_even(avg(agreement), 2))
  || CASE WHEN bool_or(warn) THEN '; slope_warning=True' ELSE '' END AS reason,
 count(*) AS n_regimes, {sr('avg(agreement)')} AS avg_agreement
FROM i GROUP BY sensor, isl""",
)
def exclusion_recommendations(spark, sf):
    d = rules.exclusion_recommendations(audit(spark, sf), 0.32)
    return d.withColumn("avg_agreement", r("avg_agreement"))


@query(
    "gap_sessions",
    f"""WITH {READINGS}, d AS (SELECT event_id, chamber, ts, (epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1e6 AS dt
  FROM readings WINDOW w AS (PARTITION BY chamber ORDER BY ts, event_id)),
 n AS (SELECT *, coalesce(dt > 86400, true) AS nw FROM d)
SELECT event_id, {sr('dt')} AS delta_t_sec, nw AS new_cycle,
 CAST(sum(CAST(nw AS INT)) OVER (PARTITION BY chamber ORDER BY ts, event_id) AS BIGINT) AS cycle_id FROM n""",
)
def gap_sessions(spark, sf):
    d = sessions.add_cycles(readings(spark, sf), ["chamber"], "ts", 86400.0, tie="event_id")
    return d.select("event_id", r("delta_t_sec").alias("delta_t_sec"), "new_cycle", "cycle_id")


@query(
    "missing_data_report",
    f"""WITH {READINGS}, d AS (SELECT sensor, ts, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY sensor ORDER BY ts))) / 1e6 AS dt
  FROM readings WHERE value IS NOT NULL),
 g AS (SELECT sensor, count(*) AS n_valid, count(*) FILTER (dt > 2250) AS n_gaps,
  coalesce(sum(dt) FILTER (dt > 2250), 0) AS gap_seconds, max(dt) FILTER (dt > 2250) AS longest_gap_sec,
  (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS duration_sec FROM d GROUP BY sensor)
SELECT sensor, n_valid, n_gaps, {sr('gap_seconds', 3)} AS gap_seconds, {sr('longest_gap_sec')} AS longest_gap_sec,
 {sr('duration_sec')} AS duration_sec, {sr('duration_sec / 900')} AS expected_points,
 {sr('greatest(0, 1 - n_valid / (duration_sec / 900)) * 100')} AS missing_pct FROM g""",
)
def missing_data_report(spark, sf):
    d = sessions.missing_report(readings(spark, sf), ["sensor"], "ts", "value", 900.0)
    return d.select(
        "sensor", "n_valid", "n_gaps", r("gap_seconds", 3).alias("gap_seconds"),
        *[r(c).alias(c) for c in ("longest_gap_sec", "duration_sec", "expected_points", "missing_pct")],
    )


@query(
    "data_integrity_report",
    f"""WITH {READINGS}, d AS (SELECT *, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY sensor ORDER BY ts))) / 1e6 AS dt FROM readings)
SELECT sensor, count(*) AS n_rows, min(ts) AS "start", max(ts) AS "end", {sr('median(dt)')} AS median_dt_sec,
 {sr('count(*) FILTER (dt = 0) * 100.0 / count(*)')} AS duplicate_pct,
 {sr('count(*) FILTER (dt > 3600) * 100.0 / count(*)')} AS gap_pct,
 {sr('count(*) FILTER (value IS NULL) * 100.0 / count(*)')} AS missing_value_pct,
 {sr('avg(CASE WHEN aux > 5 THEN 1 ELSE 0 END) * 100')} AS valid_pct,
 CAST(NULL AS DOUBLE) AS missing_pressure_pct
FROM d GROUP BY sensor""",
)
def data_integrity_report(spark, sf):
    d = readings(spark, sf).withColumn("ok", F.when(F.col("aux") > 5, 1).otherwise(0))
    out = sessions.integrity_report(d, ["sensor"], "ts", ["value", "pressure"], 3600.0, valid="ok")
    num = ("median_dt_sec", "duplicate_pct", "gap_pct", "missing_value_pct", "valid_pct")
    return out.withColumns({c: r(c) for c in num})


@query(
    "uniform_downsample",
    f"""WITH {READINGS}, n AS (SELECT event_id, row_number() OVER (PARTITION BY sensor ORDER BY ts, event_id) - 1 AS i,
  count(*) OVER (PARTITION BY sensor) AS n FROM readings)
SELECT event_id FROM n WHERE i % CAST(greatest(1, ceil(n / 500.0)) AS BIGINT) = 0""",
)
def uniform_downsample(spark, sf):
    from respira.plans.series import micros

    d = readings(spark, sf).withColumn("us", micros("ts"))
    return sessions.thin(d, ["sensor"], ["us", "event_id"], 500).select("event_id")
