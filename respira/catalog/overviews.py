"""Summary tables on events (sensors, chambers) and line items (long calendars)."""

from __future__ import annotations

from pyspark.sql import functions as F

from respira.catalog.base import READINGS, r, readings, registry, sr, table
from respira.catalog.cycle_fits import KNOWN, cycle_rows
from respira.catalog.qc import FULL_SQL, flagged
from respira.operators import changepoints, drift, summaries
from respira.plans.series import micros

QUERIES, query = registry()
FLAG_SQL = "CASE WHEN value > 120 THEN 2 WHEN value > 60 THEN 1 ELSE 0 END"
R = f"{READINGS}, f AS (SELECT *, {FLAG_SQL} AS flag FROM readings)"
ORIGIN = "1995-01-01"


def flags(spark, sf):
    v = F.col("value")
    return readings(spark, sf).withColumn("flag", F.when(v > 120, 2).when(v > 60, 1).otherwise(0))


def ship(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("l_returnflag").alias("chamber"), F.col("l_shipdate").alias("ts"),
        (F.col("l_extendedprice") / 1000).alias("v"),
        (F.col("l_orderkey") * 10_000_000 + F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("tie"),
    )


SHIP = "s AS (SELECT l_orderkey, l_linenumber, l_partkey, l_returnflag AS chamber, l_shipdate AS ts, l_extendedprice / 1000 AS v, l_orderkey * 10000000 + l_partkey * 10 + l_linenumber AS tie FROM lineitem)"
SID = ["l_orderkey", "l_linenumber", "l_partkey"]
SIDS = ", ".join(SID)


def origin():
    return F.lit(ORIGIN).cast("timestamp_ntz")


@query(
    "qc_tier_overview",
    f"""WITH {R}, t AS (SELECT sensor, value, 'all' AS tier FROM f UNION ALL SELECT sensor, value, 'high_and_medium' FROM f WHERE flag <= 1 UNION ALL SELECT sensor, value, 'high' FROM f WHERE flag = 0)
SELECT sensor, tier, count(*) AS n, min(value) AS min_value, max(value) AS max_value FROM t GROUP BY 1, 2""",
)
def qc_tier_overview(spark, sf):
    d = summaries.qc_tiers(flags(spark, sf), ["sensor"], "value", "flag")
    return d.withColumn("n", F.col("n").cast("bigint"))


@query(
    "seasonal_diurnal_cycle",
    f"""SELECT o_orderpriority, CASE WHEN month(o_orderdate) BETWEEN 5 AND 9 THEN 'dry' ELSE 'wet' END AS season, CAST(hour(o_orderdate + to_hours(CAST(o_custkey % 24 AS INT))) AS INT) AS hour,
 {sr('avg(o_totalprice)', 3)} AS mean, {sr('stddev_samp(o_totalprice)', 3)} AS sd, count(o_totalprice) AS n FROM orders GROUP BY 1, 2, 3""",
)
def seasonal_diurnal_cycle(spark, sf):
    o = table(spark, sf, "orders").withColumn(
        "ts", F.expr("timestampadd(HOUR, CAST(o_custkey % 24 AS INT), o_orderdate)").cast("timestamp_ntz")
    )
    d = summaries.seasonal_diurnal(o, ["o_orderpriority"], "ts", "o_totalprice")
    return d.select("o_orderpriority", "season", "hour", r("mean", 3).alias("mean"), r("sd", 3).alias("sd"), "n")


@query(
    "hour_month_heatmap",
    f"""SELECT CAST(hour(ts) AS INT) AS hour, CAST(month(ts) AS INT) AS month, event_type, {sr('avg(value)')} AS mean, count(value) AS n, CAST(grouping(event_type) AS INT) AS overall FROM events
GROUP BY GROUPING SETS ((hour(ts), month(ts)), (hour(ts), month(ts), event_type))""",
)
def hour_month_heatmap(spark, sf):
    d = summaries.hour_month_means(table(spark, sf, "events"), "event_type", "ts", "value")
    return d.select("hour", "month", "event_type", r("mean").alias("mean"), "n", F.col("overall").cast("int"))


@query(
    "value_vs_age_trend",
    f"""WITH {SHIP} SELECT {SIDS}, {sr(f"(epoch_us(ts) - epoch_us(TIMESTAMP '{ORIGIN}')) / 86400e6 / 365.25")} AS age_years,
 {sr('CASE WHEN count(v) OVER w >= 200 THEN avg(v) OVER w END', 5)} AS trend FROM s WINDOW w AS (PARTITION BY chamber ORDER BY ts, tie ROWS BETWEEN 100 PRECEDING AND 99 FOLLOWING)""",
)
def value_vs_age_trend(spark, sf):
    d = summaries.value_by_age(ship(spark, sf), ["chamber"], "ts", "v", origin(), 200, "tie")
    return d.select(*SID, r("age_years").alias("age_years"), r("trend", 5).alias("trend"))


@query(
    "cumulative_by_month",
    f"""WITH {SHIP} SELECT {SIDS}, {sr('sum(v) OVER (PARTITION BY chamber ORDER BY ts, tie ROWS UNBOUNDED PRECEDING)', 3)} AS cumulative,
 {sr(f"(epoch_us(ts) - epoch_us(TIMESTAMP '{ORIGIN}')) / 86400e6 / 30.44")} AS months FROM s""",
)
def cumulative_by_month(spark, sf):
    d = summaries.cumulative_by_month(ship(spark, sf), ["chamber"], "ts", "v", origin(), "tie")
    return d.select(*SID, r("cumulative", 3).alias("cumulative"), r("months").alias("months"))


def _box_sql(src: str, by: str) -> str:
    return f"""q AS (SELECT {by}, count(v) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3 FROM {src} GROUP BY ALL)
SELECT {by}, any_value(n) AS n, {sr('any_value(q1)', 5)} AS q1, {sr('any_value(med)', 5)} AS median, {sr('any_value(q3)', 5)} AS q3,
 min(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low, max(v) FILTER (v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high
FROM {src} JOIN q USING ({by}) GROUP BY {by}"""


def _box(d, *by):
    return d.select(*by, "n", *[r(c, 5).alias(c) for c in ("q1", "median", "q3")], "whisker_low", "whisker_high")


@query(
    "box_by_age_bin",
    f"""WITH {SHIP}, b AS (SELECT chamber, v, CAST(floor(date_diff('day', TIMESTAMP '{ORIGIN}', ts) / 30.0) * 30 AS INT) AS age_bin FROM s), {_box_sql('b', 'chamber, age_bin')}""",
)
def box_by_age_bin(spark, sf):
    return _box(summaries.box_by_age(ship(spark, sf), ["chamber"], "ts", "v", origin()), "chamber", "age_bin")


@query(
    "box_by_month",
    f"""WITH {SHIP}, b AS (SELECT chamber, v, strftime(ts, '%Y-%m') AS month FROM s), {_box_sql('b', 'chamber, month')}""",
)
def box_by_month(spark, sf):
    return _box(summaries.box_by_month(ship(spark, sf), ["chamber"], "ts", "v"), "chamber", "month")


AROUND = f"""{SHIP}, a AS (SELECT *, CASE WHEN ts < TIMESTAMP '1998-07-01' THEN 'before' ELSE 'after' END AS side, CASE WHEN count(v) OVER w >= 50 THEN avg(v) OVER w END AS trend
  FROM s WHERE ts BETWEEN TIMESTAMP '1998-07-01' - INTERVAL 60 DAY AND TIMESTAMP '1998-07-01' + INTERVAL 60 DAY WINDOW w AS (PARTITION BY chamber ORDER BY ts, tie ROWS BETWEEN 25 PRECEDING AND 24 FOLLOWING))"""


def around(spark, sf):
    return summaries.around_date(ship(spark, sf), ["chamber"], "ts", "v", F.lit("1998-07-01"), tie="tie")


@query("resize_comparison_trend", f"WITH {AROUND} SELECT {SIDS}, side, {sr('trend', 5)} AS trend FROM a")
def resize_comparison_trend(spark, sf):
    return around(spark, sf).select(*SID, "side", r("trend", 5).alias("trend"))


@query(
    "resize_before_after",
    f"WITH {AROUND} SELECT chamber, side, count(v) AS n, {sr('avg(v)', 5)} AS mean, {sr('stddev_samp(v)', 5)} AS sd FROM a GROUP BY 1, 2",
)
def resize_before_after(spark, sf):
    d = summaries.before_after(around(spark, sf), ["chamber"], "v")
    return d.select("chamber", "side", "n", r("mean", 5).alias("mean"), r("sd", 5).alias("sd"))


@query(
    "cycle_drilldown",
    f"""WITH {READINGS}, {KNOWN}, c AS (SELECT chamber, cycle_id, min(us) AS a, max(t) AS dur, regr_slope(y, t) AS s, regr_intercept(y, t) AS b FROM cyc GROUP BY 1, 2 HAVING count(*) > 2),
 j AS (SELECT k.event_id, c.cycle_id, k.value, (k.us - min(k.us) OVER (PARTITION BY c.chamber, c.cycle_id)) / 1e6 AS t, dur, s, b FROM known k JOIN c ON k.chamber = c.chamber AND k.us BETWEEN c.a AND c.a + CAST(trunc((dur + 5) * 1e6) AS BIGINT))
SELECT event_id, cycle_id, {sr('t')} AS t, t BETWEEN 3600 AND dur * 0.9 AS in_window, {sr('CASE WHEN t BETWEEN 3600 AND dur * 0.9 THEN s * t + b END', 5)} AS fitted,
 {sr('value - CASE WHEN t BETWEEN 3600 AND dur * 0.9 THEN s * t + b END', 5)} AS residual FROM j""",
)
def cycle_drilldown(spark, sf):
    rows = cycle_rows(spark, sf)
    c = rows.groupBy("chamber", "cycle_id").agg(
        F.min("ts").alias("flux_date"), F.max("t").alias("cycle_duration_sec"), F.regr_slope("value", "t").alias("flux_slope"),
        F.regr_intercept("value", "t").alias("flux_intercept"), F.count(F.lit(1)).alias("n"),
    )
    c = c.filter("n > 2").withColumn("window_start_sec", F.lit(3600.0)).withColumn("window_end_sec", F.col("cycle_duration_sec") * 0.9)
    raw = readings(spark, sf).filter("value IS NOT NULL")
    d = summaries.cycle_drilldown(raw, c, "chamber", "ts", "value", bucket_sec=86_400.0)
    return d.select(
        "event_id", "cycle_id", r("t").alias("t"), "in_window", r("fitted", 5).alias("fitted"), r("residual", 5).alias("residual")
    )


@query(
    "sample_cycles_per_tier",
    f"""WITH {R}, n AS (SELECT event_id, flag, row_number() OVER (PARTITION BY flag ORDER BY md5(event_id || ':42'), event_id) AS rn FROM f) SELECT event_id, flag FROM n WHERE rn <= 5""",
)
def sample_cycles_per_tier(spark, sf):
    return summaries.sample_per_tier(flags(spark, sf), "flag", "event_id", 5).select("event_id", "flag")


@query(
    "rule_method_counts",
    f"""{FULL_SQL} SELECT sensor, count(*) AS n, count(*) FILTER (bounds_flag > 0) AS bounds_hits, count(*) FILTER (iqr_flag > 0) AS iqr_hits, count(*) FILTER (roc_flag > 0) AS roc_hits,
 count(*) FILTER (persistence_flag > 0) AS persistence_hits FROM rf GROUP BY 1""",
)
def rule_method_counts(spark, sf):
    return summaries.method_counts(flagged(spark, sf), "sensor", ["bounds_flag", "iqr_flag", "roc_flag", "persistence_flag"])


@query(
    "flag_timeline",
    f"WITH {R} SELECT sensor, CAST(ts AS DATE) AS date, flag, count(*) AS n FROM f WHERE flag > 0 GROUP BY 1, 2, 3",
)
def flag_timeline(spark, sf):
    return summaries.flag_timeline(flags(spark, sf), ["sensor"], "ts", "flag")


@query(
    "flag_share_matrix",
    f"""WITH {R} SELECT sensor, {', '.join(f"{sr(f'count(*) FILTER (flag = {i}) * 100.0 / count(*)')} AS flag_{i}_pct" for i in range(3))} FROM f GROUP BY 1""",
)
def flag_share_matrix(spark, sf):
    d = summaries.flag_matrix(flags(spark, sf), "sensor", "flag")
    return d.select("sensor", *[r(f"flag_{i}_pct").alias(f"flag_{i}_pct") for i in range(3)])


@query(
    "physical_limit_series",
    f"WITH {READINGS} SELECT event_id, CASE WHEN value BETWEEN 5 AND 100 THEN value END AS value, CASE WHEN aux BETWEEN 10 AND 90 THEN aux * 1.0 END AS aux FROM readings",
)
def physical_limit_series(spark, sf):
    d = readings(spark, sf).withColumn("aux", F.col("aux") * 1.0)
    return summaries.within_limits(d, {"value": (5.0, 100.0), "aux": (10.0, 90.0)}).select("event_id", "value", "aux")


@query(
    "high_quality_hourly_series",
    f"WITH {R} SELECT sensor, date_trunc('hour', ts) AS hour, {sr('avg(value)')} AS mean, count(value) AS n FROM f WHERE flag = 0 GROUP BY 1, 2",
)
def high_quality_hourly_series(spark, sf):
    d = summaries.hourly_means(flags(spark, sf), ["sensor"], "ts", "value", "flag")
    return d.select("sensor", "hour", r("mean").alias("mean"), "n")


@query(
    "drift_with_high_quality_series",
    f"""WITH {R}, v AS (SELECT *, CASE WHEN flag = 0 THEN value END AS x FROM f), g AS (SELECT sensor, avg(x) AS m, stddev_samp(x) AS s FROM v GROUP BY 1),
 w AS (SELECT event_id, sensor, flag, value, CASE WHEN count(x) OVER w >= 24 THEN avg(x) OVER w END AS rm FROM v WINDOW w AS (PARTITION BY sensor ORDER BY ts, event_id ROWS BETWEEN 47 PRECEDING AND CURRENT ROW))
SELECT event_id, value, {sr('(rm - m) / s')} AS drift_score FROM w JOIN g USING (sensor) WHERE flag = 0""",
)
def drift_with_high_quality_series(spark, sf):
    d = drift.drift_scores(flags(spark, sf), ["sensor"], "ts", "value", "flag", 48, "event_id").filter("flag = 0")
    return d.select("event_id", "value", r("drift_score").alias("drift_score"))


@query(
    "baseline_band_table",
    f"""SELECT CAST(ts AS DATE) AS date, event_type AS sensor, min(value) AS daily_min, -30.0 AS band_low, 70.0 AS band_high, abs(min(value) - 20) > 50 AS baseline_drift FROM events GROUP BY 1, 2""",
)
def baseline_band_table(spark, sf):
    e = table(spark, sf, "events").withColumnRenamed("event_type", "sensor")
    d = summaries.baseline_band(drift.daily_baseline(e, ["sensor"], "ts", "value", 20.0), 20.0)
    return d.select("date", "sensor", "daily_min", "band_low", "band_high", "baseline_drift")


@query(
    "dashboard_detail_series",
    f"""WITH {R}, x AS (SELECT *, row_number() OVER (PARTITION BY sensor ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY sensor) AS n FROM f
  WHERE flag <= 1 AND ts >= TIMESTAMP '2024-01-05' AND ts <= TIMESTAMP '2024-01-25')
SELECT event_id, value, flag FROM x WHERE i % CAST(greatest(1, ceil(n / 300.0)) AS BIGINT) = 0""",
)
def dashboard_detail_series(spark, sf):
    d = flags(spark, sf).withColumn("us", micros("ts"))
    lo, hi = F.lit("2024-01-05").cast("timestamp_ntz"), F.lit("2024-01-25").cast("timestamp_ntz")
    return summaries.dashboard_series(d, ["sensor"], "ts", ["us", "event_id"], 1, "flag", lo, hi, 300).select(
        "event_id", "value", "flag"
    )


PAIR = f"""{READINGS}, p AS (SELECT date_trunc('hour', ts) AS h, avg(value) FILTER (sensor = 'click') AS c1, avg(value) FILTER (sensor = 'view') AS c2 FROM readings GROUP BY 1 HAVING c1 IS NOT NULL AND c2 IS NOT NULL)"""


def pairs(spark, sf):
    d = readings(spark, sf).filter(F.col("sensor").isin("click", "view"))
    h = F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h")
    p = d.groupBy(h).pivot("sensor", ["click", "view"]).agg(F.avg("value"))
    return p.select("h", F.col("click").alias("c1"), F.col("view").alias("c2")).filter("c1 IS NOT NULL AND c2 IS NOT NULL")


@query(
    "cross_chamber_bias",
    f"""WITH {PAIR} SELECT CAST(h AS DATE) AS date, count(*) AS n_pairs, {sr('avg(c2 - c1)')} AS mean_diff, {sr('median(c2 / c1)')} AS median_ratio, {sr('CASE WHEN count(*) > 1 THEN regr_slope(c2, c1) END')} AS slope,
 {sr('sqrt(avg((c2 - c1) * (c2 - c1)))')} AS rmse FROM p GROUP BY 1""",
)
def cross_chamber_bias(spark, sf):
    d = summaries.chamber_bias(pairs(spark, sf).withColumn("date", F.col("h").cast("date")), "c1", "c2", ["date"])
    return d.select("date", "n_pairs", *[r(c).alias(c) for c in ("mean_diff", "median_ratio", "slope", "rmse")])


@query(
    "segmented_chamber_bias",
    f"""WITH {PAIR}, g AS (SELECT h, c2 - c1 AS x, row_number() OVER (ORDER BY h) - 1 AS i, count(*) OVER () AS n FROM p),
 s AS (SELECT *, sum(x) OVER (ORDER BY i) - x AS s1, sum(x) OVER () AS t1 FROM g),
 k AS (SELECT i, s1 * s1 / i + (t1 - s1) * (t1 - s1) / (n - i) - t1 * t1 / n AS gain FROM s WHERE i >= 12 AND n - i >= 12)
SELECT CAST(i AS BIGINT) AS k, {sr('gain', 3)} AS gain FROM k ORDER BY gain DESC, i DESC LIMIT 1""",
)
def segmented_chamber_bias(spark, sf):
    p = pairs(spark, sf).select(F.lit("bias").alias("pair"), micros("h").alias("us"), (F.col("c2") - F.col("c1")).alias("x"))
    s = changepoints.prepare_signal(p, ["pair"], ["us"], "x")
    d = changepoints.binary_segmentation(s, ["pair"], n_breaks=1, min_size=12)
    return d.select("k", r("gain", 3).alias("gain"))


@query("flag_totals", f"WITH {R} SELECT CAST(sum(flag) AS BIGINT) AS flag, CAST(sum(CASE WHEN aux > 90 THEN 1 ELSE 0 END) AS BIGINT) AS aux_flag FROM f")
def flag_totals(spark, sf):
    d = flags(spark, sf).withColumn("aux_flag", F.when(F.col("aux") > 90, 1).otherwise(0))
    return summaries.flag_totals(d, ["flag", "aux_flag"])


@query(
    "cycle_metric_description",
    f"""WITH l AS (SELECT l_returnflag AS chamber, unnest(['quantity', 'price', 'discount']) AS metric, unnest([l_quantity, l_extendedprice, l_discount]) AS v FROM lineitem)
SELECT chamber, metric, count(v) AS count, {sr('avg(v)', 5)} AS mean, {sr('stddev_samp(v)', 5)} AS std, min(v) AS min, max(v) AS max, {sr('quantile_cont(v, 0.25)', 5)} AS q25, {sr('quantile_cont(v, 0.5)', 5)} AS q50, {sr('quantile_cont(v, 0.75)', 5)} AS q75
FROM l GROUP BY 1, 2""",
)
def cycle_metric_description(spark, sf):
    li = table(spark, sf, "lineitem").select(
        F.col("l_returnflag").alias("chamber"), F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.col("l_discount").alias("discount"),
    )
    d = summaries.describe(li, ["chamber"], ["quantity", "price", "discount"])
    num = ("mean", "std", "q25", "q50", "q75")
    return d.select("chamber", "metric", "count", *[r(c, 5).alias(c) for c in num], "min", "max")


HEALTH = f"""{R}, h AS (SELECT sensor, count(*) AS n, count(*) FILTER (flag = 0) * 100.0 / count(*) AS p0, count(*) FILTER (flag = 1) * 100.0 / count(*) AS p1, count(*) FILTER (flag = 2) * 100.0 / count(*) AS p2 FROM f GROUP BY 1)"""


def health(spark, sf):
    return summaries.sensor_health(flags(spark, sf), "sensor", "flag", 71.0, 50.0)


@query(
    "sensor_health_table",
    f"""WITH {HEALTH} SELECT sensor, n AS total_points, {sr('p0')} AS score, {sr('p1')} AS flag_1_percent, {sr('p2')} AS flag_2_percent, CASE WHEN p0 >= 71 THEN 'Healthy' WHEN p0 >= 50 THEN 'Warning' ELSE 'Critical' END AS status FROM h""",
)
def sensor_health_table(spark, sf):
    d = health(spark, sf)
    return d.select("sensor", "total_points", *[r(c).alias(c) for c in ("score", "flag_1_percent", "flag_2_percent")], "status")


@query(
    "health_recommendations",
    f"""WITH {HEALTH} SELECT sensor, 'critical' AS severity FROM h WHERE p2 > 8 UNION ALL SELECT sensor, 'warning' FROM h WHERE p1 > 20""",
)
def health_recommendations(spark, sf):
    return summaries.health_recommendations(health(spark, sf), "sensor", 8.0, 20.0).select("sensor", "severity")


@query(
    "system_status",
    f"""WITH {HEALTH} SELECT {sr('avg(p0)')} AS avg_score, count(*) AS total_sensors, count(*) FILTER (p0 >= 71) AS healthy_count, (SELECT min(ts) FROM f) AS window_start, (SELECT max(ts) FROM f) AS window_end,
 CASE WHEN avg(p0) >= 71 THEN 'HEALTHY' WHEN avg(p0) >= 50 THEN 'WARNING' ELSE 'CRITICAL' END AS system_status FROM h""",
)
def system_status(spark, sf):
    d = summaries.system_status(health(spark, sf), flags(spark, sf), "ts", 71.0, 50.0)
    return d.withColumn("avg_score", r("avg_score"))


@query(
    "consistency_issue_shares",
    f"""WITH {READINGS} SELECT 'Rh Invalid' AS name, {sr('avg(CASE WHEN aux > 95 THEN 1.0 ELSE 0.0 END) * 100')} AS pct FROM readings
UNION ALL SELECT 'Low Value', {sr('avg(CASE WHEN coalesce(value < 3, false) THEN 1.0 ELSE 0.0 END) * 100')} FROM readings""",
)
def consistency_issue_shares(spark, sf):
    d = readings(spark, sf).select(
        (F.col("aux") > 95).alias("cv_rh_invalid"), F.coalesce(F.col("value") < 3, F.lit(False)).alias("cv_low_value"),
        F.lit(False).alias("cv_never"),
    )
    out = summaries.consistency_issues(d, ["cv_rh_invalid", "cv_low_value", "cv_never"])
    return out.withColumn("pct", r("pct"))


