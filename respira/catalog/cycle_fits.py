"""Chamber preparation and cycle regressions; a chamber is a user, a cycle ends with a pause of 36 hours."""

from __future__ import annotations

from pyspark.sql import functions as F

from respira.catalog.base import READINGS, r, readings, registry, sr
from respira.functions.units import dilution_columns
from respira.operators import cycles, sessions

QUERIES, query = registry()
GAP = 129_600.0
CUT, MIN_POINTS, MIN_DUR, ZLIM = 10_800.0, 8, 86_400.0, 2.0

KNOWN = f"""known AS (SELECT *, epoch_us(ts) AS us FROM readings WHERE value IS NOT NULL),
 lagged AS (SELECT *, CASE WHEN (us - lag(us) OVER w) / 1e6 > {GAP} OR lag(us) OVER w IS NULL THEN 1 ELSE 0 END AS nw
  FROM known WINDOW w AS (PARTITION BY chamber ORDER BY us, event_id)),
 numbered AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY chamber ORDER BY us, event_id) AS BIGINT) AS cycle_id FROM lagged),
 cyc AS (SELECT *, (us - min(us) OVER c) / 1e6 AS t, value AS y, row_number() OVER (PARTITION BY chamber, cycle_id ORDER BY us, event_id) - 1 AS i,
  count(*) OVER c AS n FROM numbered WINDOW c AS (PARTITION BY chamber, cycle_id))"""
FLUX_SQL = """flux_slope * (101325.0 / (8.314 * (coalesce(mean_temp, 25.0) + 273.15)))
 * CASE WHEN flux_date < TIMESTAMP '2025-07-01' THEN 8.0 / 4.0 ELSE 96.0 / 16.0 END"""


def cycle_rows(spark, sf):
    """Known readings with cycle id and seconds since the start of the cycle."""
    d = readings(spark, sf).filter("value IS NOT NULL")
    d = sessions.add_cycles(d, ["chamber"], "ts", GAP, "event_id", start_columns=True)
    return d.withColumn("t", (F.col("_us") - F.col("_start_us")) / 1e6)


BY = ["chamber", "cycle_id"]


@query(
    "simple_cycle_regression",
    f"""WITH {READINGS}, {KNOWN}, g AS (SELECT chamber, cycle_id, min(ts) AS flux_date, regr_slope(y, t) FILTER (t >= 3600) AS flux_slope,
  regr_r2(y, t) FILTER (t >= 3600) AS r_squared, avg(aux) AS mean_temp, max(CASE WHEN y > 200 THEN 1 ELSE 0 END) AS qc_flag,
  count(*) FILTER (t >= 3600) AS n_points, max(t) AS duration_sec, min(t) FILTER (t >= 3600) AS t0 FROM cyc GROUP BY 1, 2)
SELECT chamber, cycle_id, flux_date, {sr('flux_slope', 10)} AS flux_slope, {sr('coalesce(r_squared, 0)')} AS r_squared,
 {sr('mean_temp')} AS mean_temp, qc_flag, n_points, {sr('duration_sec')} AS duration_sec, {sr(FLUX_SQL, 8)} AS flux_absolute
FROM g WHERE n_points >= 5 AND duration_sec > t0""",
)
def simple_cycle_regression(spark, sf):
    d = readings(spark, sf).withColumn("flag", F.when(F.col("value") > 200, 1).otherwise(0))
    out = cycles.simple_cycle_fit(
        d, ["chamber"], "ts", "value", "aux", "flag", gap_sec=GAP, start_cutoff=3600.0, tie="event_id"
    )
    return out.select(
        "chamber",
        "cycle_id",
        "flux_date",
        r("flux_slope", 10).alias("flux_slope"),
        r("r_squared").alias("r_squared"),
        r("mean_temp").alias("mean_temp"),
        "qc_flag",
        "n_points",
        r("duration_sec").alias("duration_sec"),
        r("flux_absolute", 8).alias("flux_absolute"),
    )


@query(
    "linear_fit_metrics",
    f"""WITH {READINGS}, {KNOWN}, f AS (SELECT chamber, cycle_id, count(*) AS n, regr_slope(y, t) AS s, regr_intercept(y, t) AS a FROM cyc GROUP BY 1, 2),
 g AS (SELECT f.chamber, f.cycle_id, any_value(f.n) AS n, any_value(s) AS s, any_value(a) AS a, sum((y - a - s * t) * (y - a - s * t)) AS rss,
   var_pop(y) * count(*) AS ss FROM f JOIN cyc USING (chamber, cycle_id) WHERE f.n >= 2 GROUP BY 1, 2)
SELECT chamber, cycle_id, n, {sr('s', 10)} AS slope, {sr('a', 5)} AS intercept, {sr('CASE WHEN ss > 0 THEN 1 - rss / ss ELSE 0 END')} AS r2,
 {sr('sqrt(rss / n)', 5)} AS rmse, {sr('CASE WHEN n > 3 AND rss > 1e-6 THEN n * ln(rss / n) + 4 + 12.0 / (n - 3) END', 5)} AS aicc FROM g""",
)
def linear_fit_metrics(spark, sf):
    d = cycles.linear_fit(cycle_rows(spark, sf), BY, "t", "value")
    return d.select(
        *BY, "n", r("slope", 10).alias("slope"), r("intercept", 5).alias("intercept"), r("r2").alias("r2"),
        r("rmse", 5).alias("rmse"), r(F.when(F.col("rss") > 1e-6, F.col("aicc")), 5).alias("aicc"),
    )


WIDE = """wide AS (SELECT date_trunc('hour', ts) AS TIMESTAMP,
   avg(CASE WHEN sensor = 'click' THEN value END) + 400 AS co2_1, avg(CASE WHEN sensor = 'view' THEN value END) + 400 AS co2_2,
   avg(CASE WHEN sensor <> 'view' THEN aux END) / 1.4 AS h2o_1, avg(CASE WHEN sensor <> 'click' THEN aux END) / 1.4 AS h2o_2,
   max(CASE WHEN sensor = 'click' AND value > 150 THEN 1 ELSE 0 END) AS f1, max(CASE WHEN sensor = 'view' AND value > 150 THEN 1 ELSE 0 END) AS f2,
   CASE WHEN max(aux) > 98 THEN 2 WHEN max(aux) > 90 THEN 1 ELSE 0 END AS g FROM readings GROUP BY 1),
 long AS (SELECT TIMESTAMP, 'C1' AS chamber, co2_1 AS raw, h2o_1 AS h, f1 AS cf, g AS hf FROM wide
  UNION ALL SELECT TIMESTAMP, 'C2', co2_2, h2o_2, f2, g FROM wide),
 prep AS (SELECT TIMESTAMP, chamber, raw, CASE WHEN h BETWEEN 0 AND 60 THEN h END AS h2o, greatest(cf, hf) AS flag
  FROM long WHERE cf = 0 AND hf IN (0, 1)),
 dry AS (SELECT *, 1 + h2o / (1000 - h2o) AS factor, raw * (1 + h2o / (1000 - h2o)) AS co2 FROM prep),
 fin AS (SELECT *, co2 - raw AS delta, CASE WHEN raw <> 0 THEN (co2 - raw) / raw END AS rel FROM dry WHERE co2 IS NOT NULL)"""


def wide(spark, sf):
    s, v, a = F.col("sensor"), F.col("value"), F.col("aux")
    return readings(spark, sf).groupBy(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("TIMESTAMP")).agg(
        (F.avg(F.when(s == "click", v)) + 400).alias("CO2_C1"),
        (F.avg(F.when(s == "view", v)) + 400).alias("CO2_C2"),
        (F.avg(F.when(s != "view", a)) / 1.4).alias("H2O_C1"),
        (F.avg(F.when(s != "click", a)) / 1.4).alias("H2O_C2"),
        F.max(F.when((s == "click") & (v > 150), 1).otherwise(0)).alias("CO2_C1_qc_flag"),
        F.max(F.when((s == "view") & (v > 150), 1).otherwise(0)).alias("CO2_C2_qc_flag"),
        *[
            F.when(F.max("aux") > 98, 2).when(F.max("aux") > 90, 1).otherwise(0).alias(f"H2O_{c}_qc_flag")
            for c in ("C1", "C2")
        ],
    )


def prepared(spark, sf, **kw):
    return cycles.prepare_chambers(cycles.stack_chambers(wide(spark, sf)), max_rel_change=0.055, **kw)


@query(
    "chamber_preparation",
    f"""WITH {READINGS}, {WIDE} SELECT TIMESTAMP, chamber, {sr('raw')} AS CO2_raw, {sr('co2')} AS CO2, {sr('h2o')} AS H2O,
 {sr('factor')} AS wpl_factor, {sr('delta')} AS wpl_delta_ppm, {sr('rel')} AS wpl_rel_change, 1 AS wpl_valid_input,
 CAST(CASE WHEN abs(rel) > 0.055 THEN 2 ELSE flag END AS INT) AS Flag FROM fin""",
)
def chamber_preparation(spark, sf):
    d = prepared(spark, sf)
    num = ("CO2_raw", "CO2", "H2O", "wpl_factor", "wpl_delta_ppm", "wpl_rel_change")
    return d.select("TIMESTAMP", "chamber", *[r(c).alias(c) for c in num], "wpl_valid_input", "Flag")


@query(
    "chamber_stacking",
    f"""WITH {READINGS}, {WIDE} SELECT TIMESTAMP, chamber, {sr('raw')} AS CO2_raw, {sr('h')} AS H2O, CAST(cf AS DOUBLE) AS CO2_Flag,
 CAST(hf AS DOUBLE) AS H2O_Flag FROM long""",
)
def chamber_stacking(spark, sf):
    d = cycles.stack_chambers(wide(spark, sf))
    return d.select("TIMESTAMP", "chamber", r("CO2_raw").alias("CO2_raw"), r("H2O").alias("H2O"), "CO2_Flag", "H2O_Flag")


@query(
    "dilution_correction",
    f"""WITH {READINGS}, x AS (SELECT event_id, value, aux * 0.8 AS w FROM readings), v AS (SELECT *, CASE WHEN w BETWEEN 0 AND 60 THEN w END AS h FROM x)
SELECT event_id, {sr('1 + h / (1000 - h)', 8)} AS wpl_factor, {sr('value * (1 + h / (1000 - h))')} AS co2_corrected,
 {sr('value * (1 + h / (1000 - h)) - value')} AS wpl_delta_ppm,
 {sr('CASE WHEN value <> 0 THEN (value * (1 + h / (1000 - h)) - value) / value END', 8)} AS wpl_rel_change,
 CASE WHEN h IS NOT NULL AND value IS NOT NULL THEN 1 ELSE 0 END AS wpl_valid_input FROM v""",
)
def dilution_correction(spark, sf):
    d = readings(spark, sf).withColumn("w", F.col("aux") * 0.8).withColumns(dilution_columns("value", "w"))
    return d.select(
        "event_id",
        r("wpl_factor", 8).alias("wpl_factor"),
        r("co2_corrected").alias("co2_corrected"),
        r("wpl_delta_ppm").alias("wpl_delta_ppm"),
        r("wpl_rel_change", 8).alias("wpl_rel_change"),
        "wpl_valid_input",
    )


WPL_COLS = (
    "wpl_factor_mean wpl_factor_max wpl_delta_ppm_mean wpl_delta_ppm_max wpl_valid_fraction wpl_abs_rel_change_p95 "
    "h2o_mean h2o_max"
).split()


@query(
    "cycle_dilution_metrics",
    f"""WITH {READINGS}, {WIDE}, d AS (SELECT *, CASE WHEN (epoch_us(TIMESTAMP) - lag(epoch_us(TIMESTAMP)) OVER w) / 1e6 <= 10800 THEN 0 ELSE 1 END AS nw
  FROM fin WINDOW w AS (PARTITION BY chamber ORDER BY TIMESTAMP)),
 c AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY chamber ORDER BY TIMESTAMP) AS BIGINT) AS cycle_id FROM d)
SELECT chamber, cycle_id, {sr('avg(factor)')} AS wpl_factor_mean, {sr('max(factor)')} AS wpl_factor_max, {sr('avg(delta)')} AS wpl_delta_ppm_mean,
 {sr('max(delta)')} AS wpl_delta_ppm_max, {sr('avg(CASE WHEN co2 IS NOT NULL THEN 1.0 ELSE 0.0 END)')} AS wpl_valid_fraction,
 {sr('quantile_cont(abs(rel), 0.95)')} AS wpl_abs_rel_change_p95, {sr('avg(h2o)')} AS h2o_mean, {sr('max(h2o)')} AS h2o_max FROM c GROUP BY 1, 2""",
)
def cycle_dilution_metrics(spark, sf):
    d = sessions.add_cycles(prepared(spark, sf), ["chamber"], "TIMESTAMP", 10_800.0)
    return cycles.dilution_by_cycle(d, ["chamber"]).select(*BY, *[r(c).alias(c) for c in WPL_COLS])


@query(
    "dilution_summary",
    f"""WITH {READINGS}, {WIDE} SELECT chamber, count(*) AS n_points, count(co2) AS valid_points, {sr('median(factor)')} AS median_factor,
 {sr('median(delta)')} AS median_delta_ppm, {sr('quantile_cont(abs(rel), 0.95)')} AS p95_abs_rel_change FROM fin GROUP BY chamber""",
)
def dilution_summary(spark, sf):
    d = cycles.dilution_summary(prepared(spark, sf), ["chamber"])
    num = ("median_factor", "median_delta_ppm", "p95_abs_rel_change")
    return d.select("chamber", "n_points", "valid_points", *[r(c).alias(c) for c in num])


@query(
    "theil_sen_slope",
    f"""WITH {READINGS}, {KNOWN}, p AS (SELECT a.chamber, a.cycle_id, (b.y - a.y) / (b.t - a.t) AS s FROM cyc a JOIN cyc b
  ON a.chamber = b.chamber AND a.cycle_id = b.cycle_id AND b.t > a.t),
 m AS (SELECT chamber, cycle_id, median(s) AS s FROM p GROUP BY 1, 2),
 g AS (SELECT chamber, cycle_id, count(*) AS n_points, median(y) AS my, median(t) AS mt FROM cyc GROUP BY 1, 2)
SELECT chamber, cycle_id, n_points, {sr('s', 10)} AS slope_ts, {sr('my - s * mt', 5)} AS intercept_ts FROM g LEFT JOIN m USING (chamber, cycle_id)""",
)
def theil_sen_slope(spark, sf):
    d = cycles.theil_sen_by_group(cycle_rows(spark, sf), BY, "_us", "value")
    return d.select(*BY, "n_points", r("slope_ts", 10).alias("slope_ts"), r("intercept_ts", 5).alias("intercept_ts"))


@query(
    "quadratic_criterion_gain",
    f"""WITH {READINGS}, {KNOWN}, c AS (SELECT *, (t - avg(t) OVER w) / nullif(stddev_pop(t) OVER w, 0) AS x, y - avg(y) OVER w AS v FROM cyc
  WINDOW w AS (PARTITION BY chamber, cycle_id)),
 s AS (SELECT chamber, cycle_id, count(x)::DOUBLE AS n, sum(x*x) AS s2, sum(x*x*x) AS s3, sum(x*x*x*x) AS s4, sum(v*v) AS yy, sum(x*v) AS xy, sum(x*x*v) AS xxy
  FROM c WHERE x IS NOT NULL GROUP BY 1, 2 HAVING count(x) > 5),
 q AS (SELECT *, yy - xy * xy / s2 AS rl, s2 AS a11, s3 AS a12, s4 - s2 * s2 / n AS a22 FROM s),
 z AS (SELECT *, yy - (xy*xy*a22 - 2*xy*xxy*a12 + xxy*xxy*a11) / (a11*a22 - a12*a12) AS rq FROM q)
SELECT chamber, cycle_id, CAST(n AS BIGINT) AS n, {sr('n * ln(rl / n) + 4 + 12 / (n - 3)', 4)} AS aicc_linear,
 {sr('n * ln(rq / n) + 6 + 24 / (n - 4)', 4)} AS aicc_quadratic FROM z""",
)
def quadratic_criterion_gain(spark, sf):
    d = cycles.quadratic_gain(cycle_rows(spark, sf), BY, "t", "value").filter("n > 5")
    return d.select(*BY, "n", r("aicc_linear", 4).alias("aicc_linear"), r("aicc_quadratic", 4).alias("aicc_quadratic"))


@query(
    "mad_outlier_mask",
    f"""WITH {READINGS}, m AS (SELECT sensor, median(value) AS m FROM readings GROUP BY 1),
 d AS (SELECT sensor, median(abs(value - m)) AS mad FROM readings JOIN m USING (sensor) GROUP BY 1)
SELECT event_id, coalesce(mad > 0 AND 0.6745 * abs(value - m) / mad > 3.5, false) AS is_outlier
FROM readings JOIN m USING (sensor) JOIN d USING (sensor)""",
)
def mad_outlier_mask(spark, sf):
    return cycles.mad_outliers(readings(spark, sf), ["sensor"], "value").select("event_id", "is_outlier")


@query(
    "monotonic_fraction",
    f"""WITH {READINGS}, {KNOWN}, s AS (SELECT *, y - lag(y) OVER (PARTITION BY chamber, cycle_id ORDER BY us, event_id) AS d FROM cyc),
 g AS (SELECT chamber, cycle_id, count(*) AS n_points, regr_slope(y, t) AS slope, count(*) FILTER (d > 0.5) AS up, count(*) FILTER (d < -0.5) AS dn
  FROM s GROUP BY 1, 2)
SELECT chamber, cycle_id, n_points, {sr('CASE WHEN n_points >= 3 AND up + dn > 0 THEN CASE WHEN slope > 0 THEN up WHEN slope < 0 THEN dn END * 1.0 / (up + dn) END')} AS monotonicity FROM g""",
)
def monotonic_fraction(spark, sf):
    d = cycles.monotonic_share(cycle_rows(spark, sf), BY, ["t", "event_id"], "value")
    return d.select(*BY, "n_points", r("monotonicity").alias("monotonicity"))


@query(
    "bimodal_cycles",
    f"""WITH {READINGS}, {KNOWN}, b AS (SELECT chamber, cycle_id, floor(y / 5) AS bin, count(*) AS c, sum(y) AS s, min(y) AS lo, max(y) AS hi FROM cyc GROUP BY 1, 2, 3),
 e AS (SELECT *, lead(bin) OVER (PARTITION BY chamber, cycle_id ORDER BY bin) - bin - 1 AS gap FROM b),
 m AS (SELECT chamber, cycle_id, sum(c) AS n, max(hi) - min(lo) AS rng, arg_max(bin, (coalesce(gap, -1), -bin)) AS cut, max(gap) AS len FROM e GROUP BY 1, 2),
 j AS (SELECT m.chamber, m.cycle_id, any_value(n) AS n, any_value(rng) AS rng, any_value(len) AS len, sum(c) FILTER (bin <= cut) AS nl, sum(c) FILTER (bin > cut) AS nh,
   sum(s) FILTER (bin <= cut) AS sl, sum(s) FILTER (bin > cut) AS sh FROM m JOIN e USING (chamber, cycle_id) GROUP BY 1, 2),
 f AS (SELECT *, coalesce(n >= 10 AND rng >= 30 AND len >= 4 AND nl >= 3 AND nh >= 3, false) AS yes FROM j)
SELECT chamber, cycle_id, CAST(n AS BIGINT) AS n_values, yes AS bimodal_flag, {sr('CASE WHEN yes THEN len * 5 ELSE 0 END')} AS bimodal_gap_ppm,
 {sr('CASE WHEN yes THEN sl / nl END')} AS bimodal_lower_mean, {sr('CASE WHEN yes THEN sh / nh END')} AS bimodal_upper_mean FROM f""",
)
def bimodal_cycles(spark, sf):
    d = cycles.bimodality(cycle_rows(spark, sf), BY, "value")
    num = ("bimodal_gap_ppm", "bimodal_lower_mean", "bimodal_upper_mean")
    return d.select(*BY, "n_values", "bimodal_flag", *[r(c).alias(c) for c in num])


WINDOW_SQL = f"""fi AS (SELECT chamber, cycle_id, min(i) AS f, any_value(n) AS n FROM cyc WHERE t >= {CUT} GROUP BY 1, 2 HAVING min(i) < any_value(n) - {MIN_POINTS}),
 pts AS (SELECT cyc.chamber, cyc.cycle_id, i, t, y, f FROM cyc JOIN fi USING (chamber, cycle_id) WHERE i >= f),
 ends AS (SELECT p.chamber, p.cycle_id, p.i AS e, p.t - q.t AS dur FROM pts p JOIN pts q ON p.chamber = q.chamber AND p.cycle_id = q.cycle_id AND q.i = q.f
   WHERE p.i >= p.f + {MIN_POINTS} - 1 AND p.t - q.t >= {MIN_DUR}),
 cp AS (SELECT e.*, p.i, p.t, p.y FROM ends e JOIN pts p ON e.chamber = p.chamber AND e.cycle_id = p.cycle_id AND p.i <= e.e),
 f1 AS (SELECT chamber, cycle_id, e, regr_slope(y, t) AS s, regr_intercept(y, t) AS a FROM cp GROUP BY 1, 2, 3),
 r1 AS (SELECT cp.*, y - a - s * t AS res FROM cp JOIN f1 USING (chamber, cycle_id, e)),
 md AS (SELECT chamber, cycle_id, e, median(res) AS m FROM r1 GROUP BY 1, 2, 3),
 ma AS (SELECT r1.chamber, r1.cycle_id, r1.e, any_value(m) AS m, median(abs(res - m)) AS mad FROM r1 JOIN md USING (chamber, cycle_id, e) GROUP BY 1, 2, 3),
 od AS (SELECT r1.*, coalesce(mad > 0 AND 0.6745 * abs(res - m) / nullif(mad, 0) > {ZLIM}, false) AS odd FROM r1 JOIN ma USING (chamber, cycle_id, e)),
 fr AS (SELECT chamber, cycle_id, e, avg(CAST(odd AS INT)) AS frac, count(*) FILTER (NOT odd) AS nleft FROM od GROUP BY 1, 2, 3),
 kp AS (SELECT od.*, frac FROM od JOIN fr USING (chamber, cycle_id, e) WHERE NOT (odd AND frac > 0 AND frac <= 0.2 AND nleft >= {MIN_POINTS})),
 f2 AS (SELECT chamber, cycle_id, e, count(*)::DOUBLE AS n, regr_slope(y, t) AS s, regr_intercept(y, t) AS a FROM kp GROUP BY 1, 2, 3),
 st AS (SELECT kp.*, y - lag(y) OVER (PARTITION BY chamber, cycle_id, e ORDER BY i) AS d FROM kp),
 cand AS (SELECT st.chamber, st.cycle_id, st.e, any_value(st.dur) AS dur, any_value(frac) AS frac, any_value(f2.n) AS n, any_value(s) AS s,
   sum((y - a - s * t) * (y - a - s * t)) AS rss, count(*) FILTER (abs(d) > 0.5) AS nd, count(*) FILTER (abs(d) > 0.5 AND sign(d) = sign(s)) AS ns
  FROM st JOIN f2 USING (chamber, cycle_id, e) GROUP BY 1, 2, 3),
 sc AS (SELECT *, n * ln(greatest(rss, 1e-12) / n) + 4 + 12 / (n - 3) AS aicc, coalesce(CASE WHEN s <> 0 THEN ns * 1.0 / nullif(nd, 0) END, -1) AS mono FROM cand WHERE n > 3),
 rk AS (SELECT *, row_number() OVER (PARTITION BY chamber, cycle_id ORDER BY mono DESC, frac, dur DESC, e) AS k
  FROM (SELECT *, min(aicc) OVER (PARTITION BY chamber, cycle_id) AS best FROM sc) WHERE aicc <= best + 2),
 win AS (SELECT chamber, cycle_id, e, frac FROM rk WHERE k = 1),
 used AS (SELECT kp.chamber, kp.cycle_id, i, t, y, win.frac, kp.e, false AS fb FROM kp JOIN win ON kp.chamber = win.chamber AND kp.cycle_id = win.cycle_id AND kp.e = win.e
  UNION ALL SELECT chamber, cycle_id, i, t, y, 0.0, max(i) OVER (PARTITION BY chamber, cycle_id), true FROM pts WHERE (chamber, cycle_id) NOT IN (SELECT (chamber, cycle_id) FROM win))"""


def evaluated(spark, sf):
    return cycles.evaluate_cycles(
        readings(spark, sf),
        ["chamber"],
        "ts",
        "value",
        temp="aux",
        tie="event_id",
        gap_sec=GAP,
        start_cutoff_sec=CUT,
        min_points=MIN_POINTS,
        min_duration_sec=MIN_DUR,
        outlier_z=ZLIM,
    )


@query(
    "best_regression_window",
    f"""WITH {READINGS}, {KNOWN}, {WINDOW_SQL}
SELECT u.chamber, u.cycle_id, {sr('any_value(s0.t)')} AS window_start_sec, {sr('any_value(s1.t)')} AS window_end_sec, count(*) AS n_points_used,
 {sr('any_value(u.frac)')} AS outlier_frac, {sr('regr_slope(u.y, u.t)', 10)} AS flux_slope
FROM used u JOIN fi ON u.chamber = fi.chamber AND u.cycle_id = fi.cycle_id
 JOIN cyc s0 ON s0.chamber = u.chamber AND s0.cycle_id = u.cycle_id AND s0.i = fi.f
 JOIN cyc s1 ON s1.chamber = u.chamber AND s1.cycle_id = u.cycle_id AND s1.i = u.e GROUP BY 1, 2""",
)
def best_regression_window(spark, sf):
    d = evaluated(spark, sf)
    return d.select(
        *BY, r("window_start_sec").alias("window_start_sec"), r("window_end_sec").alias("window_end_sec"), "n_points_used",
        r("outlier_frac").alias("outlier_frac"), r("flux_slope", 10).alias("flux_slope"),
    )


@query(
    "full_cycle_evaluation",
    f"""WITH {READINGS}, {KNOWN}, {WINDOW_SQL},
 g AS (SELECT chamber, cycle_id, count(*)::DOUBLE AS n, regr_slope(y, t) AS s, regr_intercept(y, t) AS a, max(t) - min(t) AS dur, max(y) - min(y) AS rng,
   var_pop(y) * count(*) AS syy, var_pop(t) * count(*) AS sxx, avg(t) AS mt, stddev_pop(t) AS sdt, avg(y) AS my, any_value(frac) AS frac, bool_or(fb) AS fb FROM used GROUP BY 1, 2),
 w AS (SELECT used.*, y - lag(y) OVER (PARTITION BY chamber, cycle_id ORDER BY i) AS d FROM used),
 h AS (SELECT w.chamber, w.cycle_id, sum((y - a - s * t) * (y - a - s * t)) AS rss, count(*) FILTER (abs(d) > 0.5) AS nd, count(*) FILTER (abs(d) > 0.5 AND sign(d) = sign(s)) AS ns,
   sum(pow((t - mt) / sdt, 2)) AS s2, sum(pow((t - mt) / sdt, 3)) AS s3, sum(pow((t - mt) / sdt, 4)) AS s4, sum((y - my) * (y - my)) AS yy,
   sum((t - mt) / sdt * (y - my)) AS xy, sum(pow((t - mt) / sdt, 2) * (y - my)) AS xxy FROM w JOIN g USING (chamber, cycle_id) GROUP BY 1, 2),
 q AS (SELECT *, yy - (xy*xy*a22 - 2*xy*xxy*a12 + xxy*xxy*a11) / (a11*a22 - a12*a12) AS rq FROM (SELECT *, s2 AS a11, s3 AS a12, s4 - s2 * s2 / n AS a22 FROM h JOIN g USING (chamber, cycle_id))),
 p AS (SELECT a.chamber, a.cycle_id, median((b.y - a.y) / (b.t - a.t)) AS ts FROM used a JOIN used b ON a.chamber = b.chamber AND a.cycle_id = b.cycle_id AND b.t > a.t GROUP BY 1, 2),
 m AS (SELECT chamber, cycle_id, min(ts) AS flux_date, max(ts) AS cycle_end, count(*) AS n_points_total, avg(aux) AS mean_temp FROM cyc GROUP BY 1, 2),
 z AS (SELECT *, s AS flux_slope, sqrt(rss / n) AS rmse FROM q JOIN p USING (chamber, cycle_id) JOIN m USING (chamber, cycle_id))
SELECT chamber, cycle_id, flux_date, cycle_end, n_points_total, CAST(n AS BIGINT) AS n_points_used, {sr('dur')} AS duration_sec, {sr('s', 10)} AS flux_slope,
 {sr('a', 5)} AS flux_intercept, {sr('1 - rss / syy')} AS r2, {sr('CASE WHEN NOT fb THEN sqrt(rss / (n - 2) / sxx) END', 10)} AS std_err, {sr('rmse', 5)} AS rmse, {sr('rmse / rng')} AS nrmse,
 {sr('abs(s) * dur / rmse', 5)} AS snr, {sr('ns * 1.0 / nullif(nd, 0)')} AS monotonicity, {sr('frac')} AS outlier_frac,
 {sr('n * ln(rq / n) + 6 + 24 / (n - 4) - (n * ln(rss / n) + 4 + 12 / (n - 3))', 4)} AS delta_aicc, {sr('ts', 10)} AS slope_ts,
 {sr('abs(s - ts) / greatest(abs(s), 1e-9)', 4)} AS slope_diff_pct, {sr('rng')} AS co2_range, {sr('mean_temp')} AS mean_temp, {sr(FLUX_SQL, 8)} AS flux_absolute FROM z""",
)
def full_cycle_evaluation(spark, sf):
    d = evaluated(spark, sf)
    digits = {
        "duration_sec": 6, "flux_slope": 10, "flux_intercept": 5, "r2": 6, "std_err": 10, "rmse": 5, "nrmse": 6, "snr": 5,
        "monotonicity": 6, "outlier_frac": 6, "delta_aicc": 4, "slope_ts": 10, "slope_diff_pct": 4, "co2_range": 6,
        "mean_temp": 6, "flux_absolute": 8,
    }
    return d.select(
        *BY, "flux_date", "cycle_end", "n_points_total", "n_points_used", *[r(c, k).alias(c) for c, k in digits.items()]
    )


H2O_SQL = f"""hall AS (SELECT *, epoch_us(ts) AS us FROM readings),
 hl AS (SELECT *, CASE WHEN (us - lag(us) OVER w) / 1e6 > {GAP} OR lag(us) OVER w IS NULL THEN 1 ELSE 0 END AS nw FROM hall WINDOW w AS (PARTITION BY chamber ORDER BY us, event_id)),
 hn AS (SELECT *, CAST(sum(nw) OVER (PARTITION BY chamber ORDER BY us, event_id) AS BIGINT) AS cycle_id FROM hl),
 hs AS (SELECT chamber, cycle_id, min(ts) AS flux_date FROM hn GROUP BY 1, 2),
 hv AS (SELECT chamber, cycle_id, us, event_id, value AS y, (us - min(us) OVER (PARTITION BY chamber, cycle_id)) / 1e6 AS t FROM hn WHERE value IS NOT NULL),
 hd AS (SELECT *, y - lag(y) OVER (PARTITION BY chamber, cycle_id ORDER BY us, event_id) AS d FROM hv),
 hg AS (SELECT chamber, cycle_id, count(*) AS n, regr_slope(y, t) AS s, regr_intercept(y, t) AS a, max(t) AS dur, max(y) - min(y) AS rng, avg(y) AS my, var_pop(y) * count(*) AS syy,
   median(y) AS med_y, median(t) AS med_t, count(*) FILTER (abs(d) > 0.05) AS nd, count(*) FILTER (d > 0.05) AS up, count(*) FILTER (d < -0.05) AS dn
  FROM hd GROUP BY 1, 2 HAVING count(*) >= {MIN_POINTS} AND max(t) >= {MIN_DUR}),
 hp AS (SELECT a.chamber, a.cycle_id, median((b.y - a.y) / (b.t - a.t)) AS ts FROM hv a JOIN hv b ON a.chamber = b.chamber AND a.cycle_id = b.cycle_id AND b.t > a.t GROUP BY 1, 2),
 hr AS (SELECT hv.chamber, hv.cycle_id, y - a - s * t AS res FROM hv JOIN hg USING (chamber, cycle_id)),
 hm AS (SELECT chamber, cycle_id, median(res) AS m, sum(res * res) AS rss, stddev_pop(res) AS sd FROM hr GROUP BY 1, 2),
 hx AS (SELECT hr.chamber, hr.cycle_id, any_value(rss) AS rss, any_value(sd) AS sd, median(abs(res - m)) AS mad FROM hr JOIN hm USING (chamber, cycle_id) GROUP BY 1, 2),
 ho AS (SELECT hr.chamber, hr.cycle_id, avg(CAST(abs(res) > CASE WHEN mad > 0 THEN 2.5 * mad ELSE 1e-9 END AS INT)) AS frac FROM hr JOIN hx USING (chamber, cycle_id) GROUP BY 1, 2),
 h2o AS (SELECT chamber, cycle_id, hour(flux_date) < 6 OR hour(flux_date) >= 18 AS is_nighttime, ts AS h2o_slope, med_y - ts * med_t AS h2o_intercept, 1 - rss / syy AS h2o_r2,
   sqrt(rss / n) / rng AS h2o_nrmse, abs(ts) * dur / sd AS h2o_snr, frac AS h2o_outlier_frac, CASE WHEN ts > 0 THEN up ELSE dn END * 1.0 / nullif(nd, 0) AS h2o_monotonic_frac,
   n AS h2o_n_points, dur AS h2o_duration, my AS h2o_conc_mean, rng AS h2o_conc_range
  FROM hg JOIN hp USING (chamber, cycle_id) JOIN hx USING (chamber, cycle_id) JOIN ho USING (chamber, cycle_id) JOIN hs USING (chamber, cycle_id))"""
H2O_DIGITS = {
    "h2o_slope": 10, "h2o_intercept": 5, "h2o_r2": 6, "h2o_nrmse": 6, "h2o_snr": 5, "h2o_outlier_frac": 6,
    "h2o_monotonic_frac": 6, "h2o_duration": 6, "h2o_conc_mean": 6, "h2o_conc_range": 6,
}


def h2o(spark, sf):
    return cycles.evaluate_h2o_cycles(
        readings(spark, sf), ["chamber"], "ts", "value", gap_sec=GAP, min_points=MIN_POINTS, min_duration_sec=MIN_DUR, tie="event_id"
    )


@query(
    "h2o_cycle_metrics",
    f"""WITH {READINGS}, {H2O_SQL} SELECT chamber, cycle_id, is_nighttime, h2o_n_points, {', '.join(f"{sr(c, k)} AS {c}" for c, k in H2O_DIGITS.items())} FROM h2o""",
)
def h2o_cycle_metrics(spark, sf):
    return h2o(spark, sf).select(*BY, "is_nighttime", "h2o_n_points", *[r(c, k).alias(c) for c, k in H2O_DIGITS.items()])


