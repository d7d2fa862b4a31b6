"""Drift scores, offset correction, baselines, trends and change points."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import functions as F

from respira.catalog.base import READINGS, r, readings, registry, sr, table
from respira.operators import changepoints as cp
from respira.operators import drift
from respira.plans.series import micros

QUERIES, query = registry()


@query(
    "rolling_drift_score",
    f"""WITH {READINGS}, v AS (SELECT *, CASE WHEN aux >= 10 THEN value END AS x FROM readings),
 g AS (SELECT sensor, avg(x) AS m, stddev_samp(x) AS s FROM v GROUP BY 1),
 f AS (SELECT event_id, sensor, CASE WHEN count(x) OVER w >= 24 THEN avg(x) OVER w END AS rm FROM v
  WINDOW w AS (PARTITION BY sensor ORDER BY ts, event_id ROWS BETWEEN 47 PRECEDING AND CURRENT ROW))
SELECT event_id, {sr('rm')} AS rolling_mean, {sr('(rm - m) / s')} AS drift_score FROM f JOIN g USING (sensor)""",
)
def rolling_drift_score(spark, sf):
    d = readings(spark, sf).withColumn("flag", F.when(F.col("aux") >= 10, 0).otherwise(1))
    d = drift.drift_scores(d, ["sensor"], "ts", "value", "flag", 48, "event_id")
    return d.select("event_id", r("rolling_mean").alias("rolling_mean"), r("drift_score").alias("drift_score"))


BPS = """bps AS (SELECT sensor, ts AS bp FROM readings WHERE value > 250 AND sensor <> 'signup')"""


@query(
    "segment_offset_correction",
    f"""WITH {READINGS}, {BPS}, s AS (SELECT e.event_id, e.sensor, e.value, (SELECT count(*) FROM (SELECT DISTINCT sensor, bp FROM bps) b WHERE b.sensor = e.sensor AND b.bp <= e.ts) AS seg FROM readings e),
 m AS (SELECT sensor, seg, avg(value) AS m FROM s GROUP BY 1, 2), h AS (SELECT DISTINCT sensor, 1 AS has FROM bps),
 o AS (SELECT m.sensor, m.seg, CASE WHEN has = 1 THEN m.m - z.m ELSE 0 END AS off FROM m JOIN m z ON m.sensor = z.sensor AND z.seg = 0 LEFT JOIN h ON h.sensor = m.sensor)
SELECT event_id, CAST(seg AS INT) AS segment, {sr('value - off')} AS corrected, {sr('off')} AS offset_value FROM s JOIN o USING (sensor, seg)""",
)
def segment_offset_correction(spark, sf):
    d = readings(spark, sf)
    bps = d.filter("value > 250 AND sensor <> 'signup'").select("sensor", F.col("ts").alias("bp"))
    d = drift.correct_offsets(d, ["sensor"], "ts", "value", bps, "bp")
    return d.select("event_id", "segment", r("corrected").alias("corrected"), r("offset").alias("offset_value"))


@query(
    "daily_baseline_drift",
    f"""WITH o AS (SELECT o_orderpriority AS k, CAST(o_orderdate AS DATE) AS d, min(o_totalprice) / 1000 AS mn, max(o_totalprice) / 1000 AS mx, avg(o_totalprice) / 1000 AS av
  FROM orders WHERE o_totalprice > 20000 GROUP BY 1, 2),
 b AS (SELECT k, min(d) AS a, max(d) AS z FROM o GROUP BY 1),
 g AS (SELECT k, CAST(x AS DATE) AS d FROM b, LATERAL (SELECT unnest(generate_series(CAST(a AS TIMESTAMP), CAST(z AS TIMESTAMP), INTERVAL 1 DAY)) AS x)),
 j AS (SELECT g.k, g.d, mn, mx, av FROM g LEFT JOIN o USING (k, d)),
 w AS (SELECT *, CASE WHEN count(av) OVER x >= 7 THEN avg(av) OVER x END AS rm FROM j WINDOW x AS (PARTITION BY k ORDER BY d ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT k AS priority, d AS date, {sr('mn')} AS daily_min, {sr('mx')} AS daily_max, {sr('av')} AS daily_mean, {sr('mx - mn')} AS daily_range,
 {sr('rm - lag(rm) OVER (PARTITION BY k ORDER BY d)')} AS trend, coalesce(abs(mn - 60) > 50, false) AS baseline_drift FROM w""",
)
def daily_baseline_drift(spark, sf):
    o = table(spark, sf, "orders").filter("o_totalprice > 20000").select(
        F.col("o_orderpriority").alias("priority"), "o_orderdate", (F.col("o_totalprice") / 1000).alias("v")
    )
    d = drift.daily_baseline(o, ["priority"], "o_orderdate", "v", 60.0)
    num = ("daily_min", "daily_max", "daily_mean", "daily_range", "trend")
    return d.select("priority", "date", *[r(c).alias(c) for c in num], "baseline_drift")


@query(
    "centred_trend_line",
    f"""WITH {READINGS} SELECT event_id, {sr('CASE WHEN count(value) OVER w >= 50 THEN avg(value) OVER w END')} AS trend FROM readings WHERE value IS NOT NULL
 WINDOW w AS (PARTITION BY sensor ORDER BY ts, event_id ROWS BETWEEN 25 PRECEDING AND 24 FOLLOWING)""",
)
def centred_trend_line(spark, sf):
    d = readings(spark, sf).filter("value IS NOT NULL").withColumn("us", micros("ts"))
    return drift.trend_line(d, ["sensor"], ["us", "event_id"], "value", 50).select("event_id", r("trend").alias("trend"))


@query(
    "cumulative_flux",
    f"""WITH {READINGS} SELECT event_id, {sr('sum(value) OVER (PARTITION BY sensor ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)', 4)} AS cumulative FROM readings""",
)
def cumulative_flux(spark, sf):
    d = readings(spark, sf).withColumn("us", micros("ts"))
    d = drift.cumulative(d, ["sensor"], ["us", "event_id"], "value")
    return d.select("event_id", r("cumulative", 4).alias("cumulative"))


def signal(spark, sf):
    d = readings(spark, sf).withColumn("us", micros("ts"))
    return cp.prepare_signal(d, ["sensor"], ["us", "event_id"], "value")


def daily_signal(spark, sf):
    """Daily means of all readings."""
    d = readings(spark, sf).withColumn("us", micros("ts")).withColumn("day", F.date_trunc("day", "ts"))
    return cp.prepare_signal(d, ["sensor"], ["us"], "value", group="day")


SIGNAL = f"""sig AS (SELECT sensor, row_number() OVER (PARTITION BY sensor ORDER BY ts, event_id) - 1 AS i, epoch_us(ts) AS us, value AS x,
   count(*) OVER (PARTITION BY sensor) AS n FROM readings WHERE value IS NOT NULL),
 pre AS (SELECT *, sum(x) OVER w - x AS s1, sum(x * x) OVER w - x * x AS s2 FROM sig WINDOW w AS (PARTITION BY sensor ORDER BY i ROWS UNBOUNDED PRECEDING))"""
_SPLIT = """tot{t} AS (SELECT p.*, c.lo, c.hi, a.s1 AS a1, a.s2 AS a2, coalesce(b.s1, z.s1 + z.x) AS b1, coalesce(b.s2, z.s2 + z.x * z.x) AS b2
  FROM pre p JOIN seg{s} c ON p.sensor = c.sensor AND p.i >= c.lo AND p.i < c.hi JOIN pre a ON a.sensor = p.sensor AND a.i = c.lo
  LEFT JOIN pre b ON b.sensor = p.sensor AND b.i = c.hi JOIN pre z ON z.sensor = p.sensor AND z.i = c.hi - 1),
 gain{t} AS (SELECT sensor, lo, hi, i AS k, (b2 - a2 - (b1 - a1) * (b1 - a1) / (hi - lo)) - (s2 - a2 - (s1 - a1) * (s1 - a1) / (i - lo)) - (b2 - s2 - (b1 - s1) * (b1 - s1) / (hi - i)) AS gain
  FROM tot{t} WHERE i - lo >= 20 AND hi - i >= 20),
 best{t} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sensor ORDER BY gain DESC, k DESC) AS rn FROM gain{t}) WHERE rn = 1)"""
BINSEG = f"""{SIGNAL}, seg0 AS (SELECT sensor, 0 AS lo, count(*) AS hi FROM sig GROUP BY 1), {_SPLIT.format(t=1, s=0)},
 seg1 AS (SELECT sensor, lo, k AS hi FROM best1 UNION ALL SELECT sensor, k, hi FROM best1), {_SPLIT.format(t=2, s=1)}"""


@query(
    "binary_segmentation",
    f"""WITH {READINGS}, {BINSEG} SELECT sensor, CAST(k AS BIGINT) AS k, {sr('gain', 3)} AS gain, 1 AS "round" FROM best1
UNION ALL SELECT sensor, CAST(k AS BIGINT), {sr('gain', 3)}, 2 FROM best2""",
)
def binary_segmentation(spark, sf):
    d = cp.binary_segmentation(signal(spark, sf), ["sensor"], n_breaks=2, min_size=20)
    return d.select("sensor", "k", r("gain", 3).alias("gain"), "round")


SEGS = """br AS (SELECT sensor, k FROM best1 UNION ALL SELECT sensor, k FROM best2),
 sg AS (SELECT sig.*, (SELECT count(*) FROM br WHERE br.sensor = sig.sensor AND br.k <= sig.i) AS segment FROM sig),
 st AS (SELECT sensor, segment, min(i) AS k, min(us) AS a, max(us) AS z, count(*) AS n, avg(x) AS m, stddev_pop(x) AS s FROM sg GROUP BY 1, 2),
 lg AS (SELECT *, lag(m) OVER w AS pm, lag(s) OVER w AS ps, lag(z) OVER w AS pz FROM st WINDOW w AS (PARTITION BY sensor ORDER BY segment))"""


def _breaks(spark, sf):
    s = signal(spark, sf)
    return s, cp.binary_segmentation(s, ["sensor"], n_breaks=2, min_size=20)


@query(
    "segment_info",
    f"""WITH {READINGS}, {BINSEG}, {SEGS} SELECT sensor, CAST(segment AS INT) AS segment, a AS start_us, z AS end_us, n, {sr('m')} AS mean, {sr('s')} AS std FROM st""",
)
def segment_info(spark, sf):
    s, b = _breaks(spark, sf)
    d = cp.segment_table(s, ["sensor"], b)
    return d.select(
        "sensor", "segment", F.col("start").alias("start_us"), F.col("end").alias("end_us"), "n", r("mean").alias("mean"), r("std").alias("std")
    )


CONF = "least(1.0, abs(m - pm) / (3 * ((ps + s) / 2)))"


@query(
    "breakpoint_confidence",
    f"""WITH {READINGS}, {BINSEG}, {SEGS} SELECT sensor, k, pz AS last_before, a AS first_after, {sr('pm')} AS prev_mean, {sr('m')} AS new_mean, {sr('m - pm')} AS shift,
 round({CONF}, 2) AS confidence FROM lg WHERE pm IS NOT NULL""",
)
def breakpoint_confidence(spark, sf):
    s, b = _breaks(spark, sf)
    d = cp.breakpoint_table(cp.segment_table(s, ["sensor"], b), ["sensor"])
    return d.withColumns({c: r(c) for c in ("prev_mean", "new_mean", "shift")})


@query(
    "major_breakpoints",
    f"""WITH {READINGS}, {BINSEG}, {SEGS} SELECT sensor, k FROM lg WHERE round({CONF}, 2) >= 0.03 AND abs(m - pm) >= 5""",
)
def major_breakpoints(spark, sf):
    s, b = _breaks(spark, sf)
    d = cp.breakpoint_table(cp.segment_table(s, ["sensor"], b), ["sensor"])
    return cp.major_breaks(d, 0.03, 5.0).select("sensor", "k")


@query("breakpoint_pruning")
def breakpoint_pruning(spark, sf):
    s = signal(spark, sf)
    b = cp.binary_segmentation(s, ["sensor"], n_breaks=6, min_size=20)
    return cp.prune_breaks(cp.segment_table(s, ["sensor"], b), ["sensor"], 0.08)


# The kernel's features as columns, their prefix sums with one row after the last reading, and the best splits of both rounds.
GAMMA = 0.0002
_WAVES = range(2 * cp.FREQUENCIES)
_TURN = [(2 * GAMMA) ** 0.5 * NormalDist().inv_cdf(0.5 + (j + 0.5) / (2 * cp.FREQUENCIES)) for j in range(cp.FREQUENCIES)]
_FEATURES = ", ".join(f"{cp.FREQUENCIES ** -0.5!r}::DOUBLE * {'sin' if j % 2 else 'cos'}({_TURN[j // 2]!r}::DOUBLE * x) AS f{j}" for j in _WAVES)


def _square(a: str, b: str) -> str:
    return "(" + " + ".join(f"({a}.s{j} - {b}.s{j}) * ({a}.s{j} - {b}.s{j})" for j in _WAVES) + ")"


_KERNEL_SPLIT = f"""kg{{t}} AS (SELECT p.sensor, c.lo, c.hi, p.i AS k,
   {_square('p', 'a')} / (p.i - c.lo) + {_square('b', 'p')} / (c.hi - p.i) - {_square('b', 'a')} / (c.hi - c.lo) AS gain
  FROM kpre p JOIN kseg{{s}} c ON p.sensor = c.sensor AND p.i - c.lo >= 20 AND c.hi - p.i >= 20
  JOIN kpre a ON a.sensor = p.sensor AND a.i = c.lo JOIN kpre b ON b.sensor = p.sensor AND b.i = c.hi),
 kb{{t}} AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sensor ORDER BY gain DESC, k DESC) AS rn FROM kg{{t}}) WHERE rn = 1 AND gain > 0)"""
KERNEL = f"""WITH {READINGS}, {SIGNAL}, kf AS (SELECT sensor, i, {_FEATURES} FROM sig),
 kpre AS (SELECT sensor, i, {', '.join(f'sum(f{j}) OVER w - f{j} AS s{j}' for j in _WAVES)} FROM kf WINDOW w AS (PARTITION BY sensor ORDER BY i ROWS UNBOUNDED PRECEDING)
  UNION ALL SELECT sensor, count(*), {', '.join(f'sum(f{j})' for j in _WAVES)} FROM kf GROUP BY 1),
 kseg0 AS (SELECT sensor, 0 AS lo, count(*) AS hi FROM sig GROUP BY 1), {_KERNEL_SPLIT.format(t=1, s=0)},
 kseg1 AS (SELECT sensor, lo, k AS hi FROM kb1 UNION ALL SELECT sensor, k, hi FROM kb1), {_KERNEL_SPLIT.format(t=2, s=1)}
SELECT sensor, CAST(k AS BIGINT) AS k, {sr('gain', 3)} AS gain, 1 AS "round" FROM kb1 UNION ALL SELECT sensor, CAST(k AS BIGINT), {sr('gain', 3)}, 2 FROM kb2"""


@query("kernel_segmentation", KERNEL)
def kernel_segmentation(spark, sf):
    d = cp.binary_segmentation(signal(spark, sf), ["sensor"], n_breaks=2, min_size=20, model="rbf", gamma=GAMMA)
    return d.select("sensor", "k", r("gain", 3).alias("gain"), "round")


@query("penalised_segmentation")
def penalised_segmentation(spark, sf):
    return cp.binary_segmentation(signal(spark, sf), ["sensor"], penalty=12_000.0, min_size=10, jump=5)


# The optimum position by position: cost of the best partition of everything before, and where its last segment starts.
_ALL_STARTS = """list_transform(range(0, e + 2 - 10), lambda j: f[j + 1] + p2[e + 2] - p2[j + 1] - (p1[e + 2] - p1[j + 1]) * (p1[e + 2] - p1[j + 1]) / (e + 1 - j) + 12000)"""
OPTIMAL = f"""WITH RECURSIVE {READINGS}, {SIGNAL}, mid AS (SELECT sensor, avg(x) AS m FROM sig GROUP BY 1),
 cum AS (SELECT sensor, i, sum(x - m) OVER w AS t1, sum((x - m) * (x - m)) OVER w AS t2 FROM sig JOIN mid USING (sensor) WINDOW w AS (PARTITION BY sensor ORDER BY i ROWS UNBOUNDED PRECEDING)),
 s AS (SELECT sensor, list_prepend(0.0, list(t1 ORDER BY i)) AS p1, list_prepend(0.0, list(t2 ORDER BY i)) AS p2, count(*) AS n FROM cum GROUP BY 1),
 dp(sensor, e, f, prev) AS (SELECT sensor, 0, [-12000.0::DOUBLE], [0::BIGINT] FROM s
  UNION ALL SELECT sensor, e + 1, list_append(f, coalesce(list_min(t), 1e300)), list_append(prev, coalesce(list_position(t, list_min(t)) - 1, 0))
  FROM (SELECT dp.*, CASE WHEN e + 1 >= 10 THEN {_ALL_STARTS} END AS t FROM dp JOIN s USING (sensor) WHERE e < n)),
 cut(sensor, k, prev) AS (SELECT sensor, prev[e + 1], prev FROM dp JOIN s USING (sensor) WHERE e = n
  UNION ALL SELECT sensor, prev[k + 1], prev FROM cut WHERE k > 0)
SELECT sensor, CAST(k AS BIGINT) AS k FROM cut WHERE k > 0"""


@query("optimal_partition", OPTIMAL)
def optimal_partition(spark, sf):
    return cp.optimal_partition(signal(spark, sf), ["sensor"], penalty=12_000.0, min_size=10)


@query(
    "sliding_window_breaks",
    f"""WITH {READINGS}, {SIGNAL}, h AS (SELECT *, CAST(floor(CASE WHEN n < 200 THEN floor(n / 2) ELSE 100 END / 2) AS BIGINT) AS h FROM pre),
 j AS (SELECT p.sensor, p.i AS k, (b.s2 - a.s2 - (b.s1 - a.s1) * (b.s1 - a.s1) / (2 * p.h)) - (p.s2 - a.s2 - (p.s1 - a.s1) * (p.s1 - a.s1) / p.h)
   - (b.s2 - p.s2 - (b.s1 - p.s1) * (b.s1 - p.s1) / p.h) AS gain
  FROM h p JOIN pre a ON a.sensor = p.sensor AND a.i = p.i - p.h JOIN pre b ON b.sensor = p.sensor AND b.i = p.i + p.h),
 t AS (SELECT *, max(gain) OVER (PARTITION BY sensor ORDER BY k ROWS BETWEEN 50 PRECEDING AND 50 FOLLOWING) AS top FROM j)
SELECT sensor, CAST(k AS BIGINT) AS k, {sr('gain', 3)} AS gain FROM t WHERE gain = top AND gain > 10""",
)
def sliding_window_breaks(spark, sf):
    d = cp.window_discrepancy(signal(spark, sf), ["sensor"], 100, 10.0)
    return d.select("sensor", "k", r("gain", 3).alias("gain"))


@query(
    "grouped_signal",
    f"""WITH {READINGS}, g AS (SELECT sensor, date_trunc('day', ts) AS g, min(epoch_us(ts)) AS at_us, avg(value) AS x FROM readings WHERE value IS NOT NULL GROUP BY 1, 2)
SELECT sensor, row_number() OVER (PARTITION BY sensor ORDER BY at_us, g) - 1 AS i, at_us, {sr('x')} AS x FROM g""",
)
def grouped_signal(spark, sf):
    s = daily_signal(spark, sf)
    return s.select("sensor", "i", F.col("at").alias("at_us"), r("x").alias("x"))
