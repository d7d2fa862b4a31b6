"""Grids, filling, merges and joins on time."""

from __future__ import annotations

from pyspark.sql import functions as F

from respira.catalog.base import READINGS, r, readings, registry, sr, table
from respira.operators import dimensions, integrate
from respira.plans.series import Series, micros
from respira.plans.timejoin import asof_join, interval_join

QUERIES, query = registry()
SEC = "CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) * 1000000"


@query(
    "regular_timeline",
    f"""WITH {READINGS}, s AS (SELECT sensor, min({SEC}) AS a, max({SEC}) AS b FROM readings GROUP BY sensor)
SELECT sensor, make_timestamp(t) AS ts FROM s, LATERAL (SELECT unnest(generate_series(a, b, 60000000)) AS t)""",
)
def regular_timeline(spark, sf):
    d = readings(spark, sf).select("sensor", (F.floor(micros("ts") / 1_000_000) * 1_000_000).alias("us"))
    g = integrate.time_grid(d, ["sensor"], "us", 60_000_000)
    return g.select("sensor", F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"))


@query(
    "grid_linear_interpolation",
    f"""WITH {READINGS}, h AS (SELECT sensor, CAST(floor(epoch_us(ts) / 9e8) AS BIGINT) * 900000000 AS us, avg(value) AS v
  FROM readings GROUP BY 1, 2),
 s AS (SELECT sensor, min(us) AS a, max(us) AS b FROM h GROUP BY sensor),
 g AS (SELECT sensor, us FROM s, LATERAL (SELECT unnest(generate_series(a, b, 900000000)) AS us)),
 j AS (SELECT g.sensor, g.us, v, CASE WHEN v IS NOT NULL THEN g.us END AS k FROM g LEFT JOIN h USING (sensor, us)),
 f AS (SELECT *, last_value(v IGNORE NULLS) OVER p AS pv, last_value(k IGNORE NULLS) OVER p AS pk,
   first_value(v IGNORE NULLS) OVER n AS nv, first_value(k IGNORE NULLS) OVER n AS nk FROM j
  WINDOW p AS (PARTITION BY sensor ORDER BY us ROWS UNBOUNDED PRECEDING),
         n AS (PARTITION BY sensor ORDER BY us ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT sensor, us, {sr('coalesce(v, CASE WHEN pk IS NOT NULL AND nk IS NOT NULL THEN pv + (nv - pv) * (us - pk) / (nk - pk) ELSE coalesce(nv, pv) END)')} AS value
FROM f""",
)
def grid_linear_interpolation(spark, sf):
    q = 900_000_000
    h = readings(spark, sf).groupBy("sensor", (F.floor(micros("ts") / q) * q).alias("us")).agg(
        F.avg("value").alias("value")
    )
    g = integrate.time_grid(h, ["sensor"], "us", q).join(h, ["sensor", "us"], "left")
    s = integrate.interpolate(Series.of(g, ["sensor"], ["us"]), ["value"])
    return s.df.select("sensor", "us", r("value").alias("value"))


TWIN = """p AS (SELECT 'site' AS site, date_trunc('minute', ts) AS ts, avg(value) AS v FROM readings
   WHERE sensor IN ('click', 'view') GROUP BY 2),
 q AS (SELECT 'site' AS site, date_trunc('minute', ts) AS ts, avg(aux) AS w FROM readings
   WHERE sensor = 'error' GROUP BY 2)"""


@query(
    "source_priority_fill",
    f"""WITH {READINGS}, {TWIN}, b AS (SELECT min(ts) AS a, max(ts) AS z FROM (SELECT ts FROM p UNION ALL SELECT ts FROM q)),
 line AS (SELECT unnest(generate_series(a, z, INTERVAL 1 MINUTE)) AS ts FROM b),
 g AS (SELECT unnest(generate_series(min(ts), max(ts), INTERVAL 1 MINUTE)) AS ts FROM q),
 j AS (SELECT g.ts, w, CASE WHEN w IS NOT NULL THEN epoch_us(g.ts) END AS k FROM g LEFT JOIN q USING (ts)),
 f AS (SELECT ts, w, last_value(w IGNORE NULLS) OVER x AS pv, last_value(k IGNORE NULLS) OVER x AS pk,
   first_value(w IGNORE NULLS) OVER y AS nv, first_value(k IGNORE NULLS) OVER y AS nk FROM j
  WINDOW x AS (ORDER BY ts ROWS UNBOUNDED PRECEDING), y AS (ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
 s AS (SELECT ts, coalesce(w, pv + (nv - pv) * (epoch_us(ts) - pk) / (nk - pk)) AS w FROM f)
SELECT line.ts, {sr('coalesce(v, w)')} AS temp,
 CASE WHEN v IS NOT NULL THEN 'climate' WHEN w IS NOT NULL THEN 'soil_interpolated' ELSE 'missing' END AS temp_source
FROM line LEFT JOIN p USING (ts) LEFT JOIN s USING (ts)""",
)
def source_priority_fill(spark, sf):
    d = readings(spark, sf).withColumn("ts", F.date_trunc("minute", "ts").cast("timestamp_ntz"))
    d = d.withColumn("site", F.lit("site"))
    p = d.filter(F.col("sensor").isin("click", "view")).groupBy("site", "ts").agg(F.avg("value").alias("v"))
    q = d.filter(F.col("sensor") == "error").groupBy("site", "ts").agg(F.avg("aux").alias("w"))
    out = integrate.fill_from_secondary(p, q, ["site"], "ts", {"temp": ("v", "w")}, step_sec=60)
    return out.select("ts", r("temp").alias("temp"), "temp_source")


@query(
    "outer_merge_sensors",
    f"""WITH {READINGS}, a AS (SELECT chamber, date_trunc('hour', ts) AS h, avg(value) AS click FROM readings WHERE sensor = 'click' GROUP BY 1, 2),
 b AS (SELECT chamber, date_trunc('hour', ts) AS h, avg(value) AS v FROM readings WHERE sensor = 'view' GROUP BY 1, 2),
 c AS (SELECT chamber, date_trunc('hour', ts) AS h, max(aux) AS aux FROM readings WHERE sensor = 'error' GROUP BY 1, 2)
SELECT chamber, h, {sr('click')} AS click, {sr('v')} AS view_value, CAST(aux AS DOUBLE) AS aux
FROM a FULL JOIN b USING (chamber, h) FULL JOIN c USING (chamber, h)""",
)
def outer_merge_sensors(spark, sf):
    d = readings(spark, sf).withColumn("h", F.date_trunc("hour", "ts").cast("timestamp_ntz"))
    at = ["chamber", "h"]
    frames = [
        d.filter("sensor = 'click'").groupBy(*at).agg(F.avg("value").alias("click")),
        d.filter("sensor = 'view'").groupBy(*at).agg(F.avg("value").alias("view_value")),
        d.filter("sensor = 'error'").groupBy(*at).agg(F.max("aux").alias("aux")),
    ]
    out = integrate.outer_merge(frames, at)
    return out.select(*at, r("click").alias("click"), r("view_value").alias("view_value"), F.col("aux").cast("double"))


@query(
    "weather_comparison",
    f"""WITH {READINGS}, a AS (SELECT chamber, floor(epoch_us(ts) / 14400e6) AS b, avg(value) AS v FROM readings GROUP BY 1, 2),
 w AS (SELECT chamber, floor(epoch_us(ts) / 14400e6) AS b, avg(aux) AS v FROM readings WHERE sensor <> 'click' GROUP BY 1, 2),
 j AS (SELECT a.chamber, a.v AS l, w.v AS q, a.v - w.v AS d FROM a JOIN w USING (chamber, b) WHERE a.v IS NOT NULL)
SELECT chamber, count(*) AS n_bins, {sr('avg(d)')} AS mean_diff, {sr('stddev_samp(d)')} AS sd_diff,
 {sr('max(abs(d))')} AS max_abs_diff, {sr('corr(l, q)')} AS correlation FROM j GROUP BY chamber""",
)
def weather_comparison(spark, sf):
    d = readings(spark, sf)
    out = integrate.compare_at_bins(d, d.filter("sensor <> 'click'"), ["chamber"], "ts", ("value", "aux"), 240)
    num = ("mean_diff", "sd_diff", "max_abs_diff", "correlation")
    return out.select("chamber", "n_bins", *[r(c).alias(c) for c in num])


SPANS = """cyc AS (SELECT chamber, event_id AS cycle_id, ts AS a, ts + INTERVAL 2 HOUR AS b FROM readings WHERE sensor = 'purchase')"""


def spans(spark, sf):
    return readings(spark, sf).filter("sensor = 'purchase'").select(
        "chamber", F.col("event_id").alias("cycle_id"), F.col("ts").alias("a"), F.expr("ts + INTERVAL 2 HOURS").alias("b")
    )


@query(
    "sensor_flags_onto_cycles",
    f"""WITH {READINGS}, {SPANS},
 s AS (SELECT chamber, ts, CASE WHEN value < 10 THEN 2 WHEN value < 20 THEN 1 WHEN value IS NOT NULL THEN 0 END AS flag FROM readings),
 h AS (SELECT s.*, cyc.cycle_id, cyc.b FROM s ASOF JOIN cyc ON s.chamber = cyc.chamber AND s.ts >= cyc.a),
 m AS (SELECT cycle_id, avg(flag) AS f FROM h WHERE ts <= b GROUP BY cycle_id)
SELECT cycle_id, {sr('f')} AS co2_flag_mean FROM cyc LEFT JOIN m USING (cycle_id)""",
)
def sensor_flags_onto_cycles(spark, sf):
    v = F.col("value")
    d = readings(spark, sf).withColumn(
        "flag", F.when(v < 10, 2).when(v < 20, 1).when(v.isNotNull(), 0)
    )
    out = integrate.flags_onto_cycles(d, spans(spark, sf), ["chamber"], "ts", {"m": "flag"}, "a", "b")
    return out.select("cycle_id", r("m").alias("co2_flag_mean"))


@query(
    "interval_membership",
    f"""WITH {READINGS}, {SPANS} SELECT e.event_id, c.cycle_id FROM readings e JOIN cyc c
 ON e.chamber = c.chamber AND e.ts >= c.a AND e.ts <= c.b""",
)
def interval_membership(spark, sf):
    p = readings(spark, sf).select("event_id", "chamber", micros("ts").alias("us"))
    s = spans(spark, sf).select("cycle_id", "chamber", micros("a").alias("s_us"), micros("b").alias("e_us"))
    return interval_join(p, s, ["chamber"], "us", "s_us", "e_us", 7_200_000_000).select("event_id", "cycle_id")


@query(
    "asof_previous_reading",
    f"""WITH {READINGS}, l AS (SELECT * FROM readings WHERE sensor = 'click'), v AS (SELECT * FROM readings WHERE sensor = 'view')
SELECT l.event_id, CAST(v.event_id AS DOUBLE) AS view_id, {sr('v.value')} AS view_value FROM l ASOF LEFT JOIN v ON l.chamber = v.chamber AND l.ts >= v.ts""",
)
def asof_previous_reading(spark, sf):
    d = readings(spark, sf).withColumn("us", micros("ts"))
    v = d.filter("sensor = 'view'")
    out = asof_join(
        d.filter("sensor = 'click'"), v, ["chamber"], "us", "us", {"view_id": "event_id", "view_value": "value"}
    )
    return out.select("event_id", F.col("view_id").cast("double"), r("view_value").alias("view_value"))


@query(
    "nearest_hour_residual",
    f"""WITH {READINGS}, h AS (SELECT sensor, date_trunc('hour', ts) AS h, max(value) AS v FROM readings GROUP BY 1, 2 HAVING max(value) > 60),
 j AS (SELECT e.event_id, h.v, row_number() OVER (PARTITION BY e.event_id
    ORDER BY abs(epoch_us(h.h) - epoch_us(date_trunc('hour', e.ts))), h.h) AS rn
  FROM readings e JOIN h ON e.sensor = h.sensor AND h.h BETWEEN date_trunc('hour', e.ts) - INTERVAL 90 MINUTE AND date_trunc('hour', e.ts) + INTERVAL 90 MINUTE)
SELECT e.event_id, {sr('j.v')} AS v FROM readings e LEFT JOIN j ON e.event_id = j.event_id AND j.rn = 1""",
)
def nearest_hour_residual(spark, sf):
    d = readings(spark, sf)
    h = d.groupBy("sensor", F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("h")).agg(F.max("value").alias("v"))
    out = integrate.attach_nearest_hour(d, h.filter("v > 60"), ["sensor"], "ts", "h", ["v"])
    return out.select("event_id", r("v").alias("v"))


DIM = """dim AS (SELECT o_custkey AS tree, o_orderdate AS d, min(o_totalprice) / 1000 AS vol, min(o_orderkey) % 40 AS leaves
  FROM orders GROUP BY 1, 2),
 ship AS (SELECT l_orderkey, l_linenumber, o_custkey AS chamber, l_shipdate AS flux_date, l_discount AS flux_slope, l_quantity AS mean_temp
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def dim(spark, sf):
    return table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("tree"), F.col("o_orderdate").alias("d")).agg(
        (F.min("o_totalprice") / 1000).alias("vol"), (F.min("o_orderkey") % 40).alias("leaves")
    )


def ship(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").alias("chamber"))
    li = table(spark, sf, "lineitem")
    return li.join(o, li["l_orderkey"] == o["o_orderkey"]).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_extendedprice",
        "chamber",
        F.col("l_shipdate").alias("flux_date"),
        F.col("l_discount").alias("flux_slope"),
        F.col("l_quantity").alias("mean_temp"),
    )


NEAREST = """n AS (SELECT s.*, dim.leaves, row_number() OVER (PARTITION BY s.rid ORDER BY abs(date_diff('day', dim.d, s.flux_date)), dim.d) AS rn
  FROM (SELECT *, row_number() OVER () AS rid FROM ship) s LEFT JOIN dim ON s.chamber = dim.tree
   AND abs(date_diff('day', dim.d, s.flux_date)) <= 30)"""


@query(
    "nearest_date_leaf_area_index",
    f"""WITH {DIM}, {NEAREST}, x AS (SELECT *, CASE WHEN leaves IS NOT NULL THEN CASE WHEN flux_date < TIMESTAMP '2025-07-01' THEN 4.0 ELSE 16.0 END END AS fa FROM n WHERE rn = 1)
SELECT l_orderkey, l_linenumber, flux_date, CAST(leaves AS DOUBLE) AS n_leaves, {sr('leaves * 4.0')} AS leaf_area_m2, fa AS chamber_floor_area_m2,
 {sr('leaves * 4.0 / fa')} AS lai_effective, {sr('CASE WHEN leaves > 0 THEN flux_slope / (leaves * 4.0 / fa) END')} AS leaf_flux FROM x""",
)
def nearest_date_leaf_area_index(spark, sf):
    from respira.functions.units import leaf_basis_flux

    d = dimensions.effective_leaf_area_index(
        ship(spark, sf), dim(spark, sf).withColumnRenamed("leaves", "n_leaves"), "chamber", "flux_date", "tree", "d"
    )
    return d.select(
        "l_orderkey",
        "l_linenumber",
        "flux_date",
        F.col("n_leaves").cast("double"),
        r("leaf_area_m2").alias("leaf_area_m2"),
        "chamber_floor_area_m2",
        r("lai_effective").alias("lai_effective"),
        r(leaf_basis_flux(F.col("flux_slope"), F.col("lai_effective"))).alias("leaf_flux"),
    )


INTERP = """k AS (SELECT tree, d, vol, lead(d) OVER w AS nd, lead(vol) OVER w AS nv FROM dim WINDOW w AS (PARTITION BY tree ORDER BY d)),
 tv AS (SELECT ship.*, CASE WHEN nd IS NULL THEN vol ELSE vol + (nv - vol) * (epoch_us(flux_date) - epoch_us(d)) / (epoch_us(nd) - epoch_us(d)) END AS tree_volume
  FROM ship ASOF LEFT JOIN k ON ship.chamber = k.tree AND ship.flux_date >= k.d)"""


@query(
    "interpolated_tree_volume",
    f"""WITH {DIM}, {INTERP} SELECT l_orderkey, l_linenumber, flux_date, flux_slope, mean_temp, {sr('tree_volume', 5)} AS tree_volume FROM tv""",
)
def interpolated_tree_volume(spark, sf):
    d = dimensions.interpolated_measurement(
        ship(spark, sf), dim(spark, sf), "chamber", "flux_date", "tree", "d", "vol", "tree_volume"
    )
    cols = ("l_orderkey", "l_linenumber", "flux_date", "flux_slope", "mean_temp")
    return d.select(*cols, r("tree_volume", 5).alias("tree_volume"))


FLUX = "flux_slope * (101325.0 / (8.314 * (coalesce(mean_temp, 25.0) + 273.15)))"


@query(
    "tree_volume_corrected_flux",
    f"""WITH {DIM}, {INTERP} SELECT l_orderkey, l_linenumber, flux_date, flux_slope, mean_temp,
 {sr(f"{FLUX} * greatest(CASE WHEN flux_date < TIMESTAMP '2025-07-01' THEN 8.0 ELSE 96.0 END - coalesce(tree_volume, 0), 0.1) / CASE WHEN flux_date < TIMESTAMP '2025-07-01' THEN 4.0 ELSE 16.0 END")} AS flux_absolute FROM tv""",
)
def tree_volume_corrected_flux(spark, sf):
    from respira.functions.units import absolute_flux

    s = ship(spark, sf).withColumn(
        "flux_absolute", absolute_flux(F.col("flux_slope"), F.col("mean_temp"), F.col("flux_date"))
    )
    d = dimensions.correct_for_tree_volume(s, dim(spark, sf), "chamber", "flux_date", "tree", "d", "vol")
    cols = ("l_orderkey", "l_linenumber", "flux_date", "flux_slope", "mean_temp")
    return d.select(*cols, r("flux_absolute").alias("flux_absolute"))


REGIMES = """reg AS (SELECT date_trunc('month', o_orderdate) AS m, CAST(min(o_orderdate) AS DATE) AS s, CAST(max(o_orderdate) AS DATE) + CAST(3 AS INT) AS e,
   corr(o_totalprice, o_custkey) AS r2, 1 + corr(o_totalprice, o_orderkey) AS slope,
   CASE WHEN count(*) % 5 = 0 THEN 'poor' ELSE 'good' END AS quality, count(*) % 7 = 0 AS warn,
   CASE WHEN count(*) % 3 > 0 THEN count(*) % 100 / 100.0 END AS agreement FROM orders GROUP BY 1),
 dd AS (SELECT m, unnest(generate_series(CAST(s AS TIMESTAMP), CAST(e AS TIMESTAMP), INTERVAL 1 DAY)) AS day,
   CASE WHEN quality <> 'good' OR warn THEN 0.0 ELSE coalesce(agreement, 0.5 * greatest(0, r2) + 0.5 * greatest(0, 1 - 2 * abs(slope - 1))) END AS sc FROM reg),
 ds AS (SELECT day, max_by(sc, m) AS sc FROM dd GROUP BY day)"""


@query(
    "regime_date_lookup",
    f"""WITH {REGIMES} SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_extendedprice, {sr('coalesce(sc, 0.5)')} AS regime_score
FROM lineitem LEFT JOIN ds ON l_shipdate = day""",
)
def regime_date_lookup(spark, sf):
    n = F.count(F.lit(1))
    reg = table(spark, sf, "orders").groupBy(F.date_trunc("month", "o_orderdate").alias("position")).agg(
        F.min("o_orderdate").cast("date").alias("start"),
        F.date_add(F.max("o_orderdate").cast("date"), 3).alias("end"),
        F.corr("o_totalprice", "o_custkey").alias("r2"),
        (1 + F.corr("o_totalprice", "o_orderkey")).alias("slope"),
        F.when(n % 5 == 0, "poor").otherwise("good").alias("quality"),
        (n % 7 == 0).alias("slope_warning"),
        F.when(n % 3 > 0, n % 100 / 100.0).alias("agreement_score"),
    )
    d = dimensions.attach_regime_score(table(spark, sf, "lineitem"), dimensions.regime_scores(reg), "l_shipdate")
    return d.select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_extendedprice", r("regime_score").alias("regime_score")
    )


