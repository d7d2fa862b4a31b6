"""Tables behind the usual plots and reports."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respira.functions.labels import age_bin, age_years, months_after, pretty_formula, season
from respira.operators.drift import trend_line
from respira.operators.sessions import thin
from respira.plans.quantiles import exact_quantiles
from respira.plans.series import Series, micros, null_safe_join
from respira.plans.timejoin import interval_join

DAY_US = 86_400_000_000


def qc_tiers(df: DataFrame, keys: list[str], value: str, flag: str) -> DataFrame:
    """Count, minimum and maximum of all rows, of flags up to 1 and of flag 0."""
    g = df.groupBy(*keys, flag).agg(
        F.count(F.lit(1)).alias("_n"), F.min(value).alias("_lo"), F.max(value).alias("_hi")
    )
    tiers = F.array_compact(
        F.array(F.lit("all"), F.when(F.col(flag) <= 1, "high_and_medium"), F.when(F.col(flag) == 0, "high"))
    )
    t = g.withColumn("tier", F.explode(tiers))
    return t.groupBy(*keys, "tier").agg(
        F.sum("_n").alias("n"), F.min("_lo").alias("min_value"), F.max("_hi").alias("max_value")
    )


def seasonal_diurnal(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    """Mean and spread per hour of day and season."""
    return df.groupBy(*keys, season(ts).alias("season"), F.hour(ts).alias("hour")).agg(
        F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd"), F.count(value).alias("n")
    )


def hour_month_means(df: DataFrame, chamber: str, ts: str, value: str) -> DataFrame:
    """Mean per hour and month, per chamber and overall (chamber null), in one aggregation."""
    d = df.select(F.col(chamber), F.hour(ts).alias("hour"), F.month(ts).alias("month"), F.col(value))
    sets = [["hour", "month"], ["hour", "month", chamber]]
    g = d.groupingSets([[F.col(c) for c in s] for s in sets], "hour", "month", chamber)
    return g.agg(F.avg(value).alias("mean"), F.count(value).alias("n"), F.grouping(chamber).alias("overall"))


def value_by_age(
    df: DataFrame, keys: list[str], ts: str, value: str, origin: Column, width: int = 200, tie: str | None = None
) -> DataFrame:
    """Age in years of every value and its centred trend over ``width`` rows."""
    d = df.withColumn("_us", micros(ts)).withColumn("age_years", age_years(ts, origin))
    return trend_line(d, keys, ["_us", tie] if tie else ["_us"], value, width).drop("_us")


def cumulative_by_month(
    df: DataFrame, keys: list[str], ts: str, value: str, origin: Column, tie: str | None = None
) -> DataFrame:
    """Running sum per series against the months since ``origin``.

    Values below a million are summed as whole 1024ths in 64 bits and a small rest, so a sum over millions of rows loses no
    digits on the way.
    """
    v = F.col(value).cast("double")
    whole = F.when(v.isNull(), None).when(F.abs(v) < 1e6, F.rint(v * 1024).cast("bigint")).otherwise(F.lit(0).cast("bigint"))
    d = df.withColumn("_us", micros(ts)).withColumn("_whole", whole).withColumn("_rest", v - F.col("_whole") / 1024)
    s = Series.of(d, keys, ["_us", tie] if tie else ["_us"]).running_sum({"_w": F.col("_whole"), "_r": F.col("_rest")})
    d = s.df.withColumn("cumulative", F.col("_w") / 1024 + F.col("_r")).withColumn("months", months_after(ts, origin))
    return d.drop("_us", "_whole", "_rest", "_w", "_r")


def box_statistics(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """Quartiles and whiskers (furthest values within 1.5 IQR of the box) per group."""
    q = exact_quantiles(df, by, value, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    d = null_safe_join(df.select(*by, value), q, by, "inner")
    reach = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col(value).between(F.col("q1") - reach, F.col("q3") + reach)
    w = d.groupBy(*by).agg(
        F.min(F.when(inside, F.col(value))).alias("whisker_low"),
        F.max(F.when(inside, F.col(value))).alias("whisker_high"),
    )
    return null_safe_join(q, w, by)


def box_by_age(df: DataFrame, keys: list[str], ts: str, value: str, origin: Column, bin_days: int = 30) -> DataFrame:
    return box_statistics(df.withColumn("age_bin", age_bin(ts, origin, bin_days)), [*keys, "age_bin"], value)


def box_by_month(df: DataFrame, keys: list[str], ts: str, value: str) -> DataFrame:
    return box_statistics(df.withColumn("month", F.date_format(ts, "yyyy-MM")), [*keys, "month"], value)


def around_date(
    df: DataFrame, keys: list[str], ts: str, value: str, date: Column, days: int = 60, width: int = 50, tie: str | None = None
) -> DataFrame:
    """Rows within ``days`` of a date with side (before/after) and trend."""
    mid = date.cast("timestamp_ntz")
    lo, hi = mid - F.make_dt_interval(F.lit(days)), mid + F.make_dt_interval(F.lit(days))
    d = df.filter((F.col(ts) >= lo) & (F.col(ts) <= hi)).withColumn("_us", micros(ts))
    d = d.withColumn("side", F.when(F.col(ts) < mid, "before").otherwise("after"))
    return trend_line(d, keys, ["_us", tie] if tie else ["_us"], value, width).drop("_us")


def before_after(rows: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Group statistics of :func:`around_date` rows."""
    return rows.groupBy(*keys, "side").agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("sd")
    )


def cycle_drilldown(
    raw: DataFrame, cycles: DataFrame, chamber: str, ts: str, value: str, bucket_sec: float = 600.0, pad_sec: float = 5.0
) -> DataFrame:
    """Raw rows of every cycle with seconds since its first row, window membership, fit and residual.

    ``cycles`` carries ``flux_date, cycle_duration_sec, window_start_sec, window_end_sec, flux_slope, flux_intercept``.
    """
    c = cycles.withColumn("_a", micros("flux_date")).withColumn(
        "_b", F.col("_a") + ((F.col("cycle_duration_sec") + pad_sec) * 1_000_000).cast("bigint")
    )
    c = c.select(
        chamber, "cycle_id", "_a", "_b", "window_start_sec", "window_end_sec", "flux_slope", "flux_intercept"
    )
    d = interval_join(raw.withColumn("_us", micros(ts)), c, [chamber], "_us", "_a", "_b", int(bucket_sec * 1_000_000))
    first = d.groupBy(chamber, "cycle_id").agg(F.min("_us").alias("_t0"))
    d = null_safe_join(d, first, [chamber, "cycle_id"])
    d = d.withColumn("t", (F.col("_us") - F.col("_t0")) / 1e6)
    inside = F.col("t").between(F.col("window_start_sec"), F.col("window_end_sec"))
    fit = F.when(inside, F.col("flux_slope") * F.col("t") + F.col("flux_intercept"))
    d = d.withColumns({"in_window": inside, "fitted": fit}).withColumn("residual", F.col(value) - F.col("fitted"))
    return d.drop("_us", "_a", "_b", "_t0")


def sample_per_tier(df: DataFrame, tier: str, row_id: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows per tier in a fixed pseudo-random order of their ids."""
    order = F.md5(F.concat_ws(":", F.col(row_id).cast("string"), F.lit(str(seed))))
    w = Window.partitionBy(tier).orderBy(order, row_id)
    return df.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n).drop("_r")


def method_counts(df: DataFrame, variable: str, flags: list[str]) -> DataFrame:
    """How many rows each rule flagged, per variable."""
    return df.groupBy(variable).agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.when(F.col(c) > 0, 1)).alias(c.replace("_flag", "_hits")) for c in flags]
    )


def flag_timeline(df: DataFrame, keys: list[str], ts: str, flag: str) -> DataFrame:
    """Flagged rows per day and level."""
    return df.filter(F.col(flag) > 0).groupBy(*keys, F.col(ts).cast("date").alias("date"), flag).agg(
        F.count(F.lit(1)).alias("n")
    )


def flag_matrix(df: DataFrame, variable: str, flag: str) -> DataFrame:
    """Share of each flag per variable, one column per flag."""
    g = df.groupBy(variable).pivot(flag, [0, 1, 2]).agg(F.count(F.lit(1)))
    counts = [F.coalesce(F.col(str(i)), F.lit(0)) for i in range(3)]
    total = reduce(lambda a, b: a + b, counts)
    return g.select(variable, *[(c / total * 100).alias(f"flag_{i}_pct") for i, c in enumerate(counts)])


def within_limits(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """Values outside their physical limits become null, whichever columns they are in."""
    return df.withColumns({c: F.when(F.col(c).between(*lim), F.col(c)) for c, lim in limits.items()})


def hourly_means(df: DataFrame, keys: list[str], ts: str, value: str, flag: str | None = None) -> DataFrame:
    """Hourly mean series, of flag-0 rows where a flag is named."""
    d = df.filter(F.col(flag) == 0) if flag else df
    hour = F.date_trunc("hour", ts).cast("timestamp_ntz").alias("hour")
    return d.groupBy(*keys, hour).agg(F.avg(value).alias("mean"), F.count(value).alias("n"))


def dashboard_series(
    df: DataFrame,
    keys: list[str],
    ts: str,
    order: list[str],
    max_flag: int | None = None,
    flag: str | None = None,
    start: Column | None = None,
    end: Column | None = None,
    max_points: int = 5000,
) -> DataFrame:
    """Rows of a time range up to a flag level, thinned evenly per series."""
    cond = F.lit(True)
    if flag is not None and max_flag is not None:
        cond = cond & (F.col(flag) <= max_flag)
    if start is not None:
        cond = cond & (F.col(ts) >= start)
    if end is not None:
        cond = cond & (F.col(ts) <= end)
    return thin(df.filter(cond), keys, order, max_points)


def chamber_bias(df: DataFrame, a: str, b: str, by: list[str]) -> DataFrame:
    """Difference, median ratio, slope and RMSE between two columns of paired readings."""
    d = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).withColumn("_d", F.col(b) - F.col(a))
    d = d.withColumn("_q", F.try_divide(F.col(b), F.col(a)))
    g = d.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_pairs"),
        F.avg("_d").alias("mean_diff"),
        F.regr_slope(b, a).alias("slope"),
        F.sqrt(F.avg(F.col("_d") * F.col("_d"))).alias("rmse"),
    )
    return null_safe_join(g, exact_quantiles(d, by, "_q", {"median_ratio": 0.5}).drop("n"), by)


def flag_totals(df: DataFrame, flags: list[str]) -> DataFrame:
    """Sum of every flag column over the table."""
    return df.agg(*[F.sum(c).alias(c) for c in flags])


def describe(df: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """Count, mean, standard deviation, minimum, quartiles and maximum per group and metric."""
    long = df.select(*keys, *metrics).unpivot(keys, metrics, "metric", "value")
    by = [*keys, "metric"]
    g = long.groupBy(*by).agg(
        F.count("value").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    q = exact_quantiles(long, by, "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75}).drop("n")
    return null_safe_join(g, q, by)


def baseline_band(baseline: DataFrame, expected: float, tolerance: float = 50.0) -> DataFrame:
    """Daily baseline table with the accepted band."""
    return baseline.withColumns({"band_low": F.lit(expected - tolerance), "band_high": F.lit(expected + tolerance)})


def sensor_health(df: DataFrame, variable: str, flag: str, healthy: float = 80.0, warning: float = 50.0) -> DataFrame:
    """Flag shares and health per variable, worst first; the score is the share of good rows."""
    known = df.filter(F.col(flag).isNotNull())
    n = F.count(F.lit(1))
    g = known.groupBy(variable).agg(
        n.alias("total_points"), *[(F.count(F.when(F.col(flag) == i, 1)) / n * 100).alias(f"flag_{i}_percent") for i in range(3)]
    )
    g = g.withColumn("score", F.col("flag_0_percent"))
    status = F.when(F.col("score") >= healthy, "Healthy").when(F.col("score") >= warning, "Warning").otherwise("Critical")
    g = g.withColumn("status", status).withColumn("label", pretty_formula(F.col(variable)))
    return g.orderBy("score", variable)


def health_recommendations(health: DataFrame, variable: str, bad: float = 10.0, suspect: float = 15.0) -> DataFrame:
    """Critical where more than ``bad`` percent is bad, warning where more than ``suspect`` percent is suspect."""
    recs = F.array_compact(
        F.array(
            F.when(
                F.col("flag_2_percent") > bad,
                F.struct(F.lit("critical").alias("severity"), F.format_string("%.1f%% bad readings", "flag_2_percent").alias("message")),
            ),
            F.when(
                F.col("flag_1_percent") > suspect,
                F.struct(F.lit("warning").alias("severity"), F.format_string("%.1f%% suspect readings", "flag_1_percent").alias("message")),
            ),
        )
    )
    return health.select(variable, F.explode(recs).alias("_r")).select(variable, "_r.*")


def consistency_issues(df: DataFrame, checks: list[str]) -> DataFrame:
    """Share of rows each cross-variable check flagged, for checks that flagged any."""
    flags = [F.struct(F.lit(c).alias("name"), (F.col(c).cast("int") > 0).alias("hit")) for c in checks]
    long = df.select(F.explode(F.array(*flags)).alias("_c")).select("_c.*")
    g = long.groupBy("name").agg((F.avg(F.col("hit").cast("double")) * 100).alias("pct")).filter("pct > 0")
    tidy = F.initcap(F.replace(F.regexp_replace("name", "^cv_", ""), F.lit("_"), F.lit(" ")))
    return g.select(tidy.alias("name"), "pct")


def system_status(
    health: DataFrame, readings: DataFrame, ts: str, healthy: float = 80.0, warning: float = 50.0
) -> DataFrame:
    """One row: time span, mean score, status and sensor counts."""
    h = health.agg(
        F.avg("score").alias("avg_score"),
        F.count(F.lit(1)).alias("total_sensors"),
        F.count(F.when(F.col("status") == "Healthy", 1)).alias("healthy_count"),
    )
    span = readings.agg(F.min(ts).alias("window_start"), F.max(ts).alias("window_end"))
    one = h.withColumn("_k", F.lit(1)).join(span.withColumn("_k", F.lit(1)), "_k").drop("_k")
    status = F.when(F.col("avg_score") >= healthy, "HEALTHY").when(F.col("avg_score") >= warning, "WARNING").otherwise("CRITICAL")
    return one.withColumn("system_status", status)
