"""Chamber preparation and one regression per measurement cycle."""

from __future__ import annotations

import re
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from respira.functions import thresholds as TH
from respira.functions.numeric import numeric, true
from respira.functions.units import absolute_flux, dilution_columns, valid_h2o
from respira.operators import kernels
from respira.operators.long_slopes import long_theil_sen
from respira.operators.sessions import add_cycles
from respira.plans.quantiles import exact_medians, exact_quantiles
from respira.plans.series import Series, join_few, micros, null_safe_join
from respira.plans.sizing import cut_lineage, is_small, store_if_costly, target_rows

SECOND = 1_000_000.0
_CHAMBER = re.compile(r"^CO2_(C\d+)$")


def chamber_suffixes(columns: list[str]) -> list[str]:
    """Chambers of a wide table, from its ``CO2_C<k>`` columns."""
    return sorted(m.group(1) for c in columns if (m := _CHAMBER.match(c)))


def stack_chambers(wide: DataFrame, ts: str = "TIMESTAMP", prefer_corrected: bool = True) -> DataFrame:
    """Wide sensor table to one row per chamber and time, in a single pass over the wide rows."""
    rows = []
    for ch in chamber_suffixes(wide.columns):
        h2o = f"H2O_{ch}"
        if prefer_corrected and f"{h2o}_corrected" in wide.columns:
            h2o = f"{h2o}_corrected"
        names = {
            "CO2_raw": f"CO2_{ch}",
            "H2O": h2o,
            "Temp": f"Temp_1_{ch}",
            "CO2_Flag": f"CO2_{ch}_qc_flag",
            "H2O_Flag": f"H2O_{ch}_qc_flag",
        }
        cols = [numeric(src).alias(o) if src in wide.columns else F.lit(None).cast("double").alias(o)
                for o, src in names.items()]
        rows.append(F.struct(F.lit(ch).alias("chamber"), *cols))
    return wide.select(F.col(ts), F.explode(F.array(*rows)).alias("_r")).select(ts, "_r.*")


def prepare_chambers(
    df: DataFrame,
    ts: str = "TIMESTAMP",
    co2_flags: list[int] | None = (0,),
    h2o_flags: list[int] | None = (0, 1),
    dilution: bool = True,
    require_h2o: bool = True,
    max_rel_change: float = 0.12,
) -> DataFrame:
    """Keep accepted rows, correct CO2 for water vapour and settle the working ``CO2`` and ``Flag`` columns.

    Rows whose correction is implausibly large get flag 2. Rows without time or CO2 are dropped.
    """
    if co2_flags is not None and "CO2_Flag" in df.columns:
        df = df.filter(F.col("CO2_Flag").isin(*co2_flags))
    if h2o_flags is not None and "H2O_Flag" in df.columns:
        df = df.filter(F.col("H2O_Flag").isin(*h2o_flags))
    flags = [F.coalesce(F.col(c), F.lit(0)) for c in ("CO2_Flag", "H2O_Flag") if c in df.columns]
    df = df.withColumn("Flag", F.greatest(F.lit(0), F.lit(0), *flags).cast("int"))
    if dilution and "H2O" in df.columns:
        df = df.withColumns(dilution_columns("CO2_raw", "H2O")).withColumn("H2O", valid_h2o(F.col("H2O")))
        df = df.withColumnRenamed("co2_corrected", "CO2_corrected")
        big = true(F.abs("wpl_rel_change") > max_rel_change)
        df = df.withColumn("Flag", F.when(big, F.greatest("Flag", F.lit(2))).otherwise(F.col("Flag")))
        dry = F.col("CO2_corrected")
        co2 = dry if require_h2o else F.coalesce(dry, F.col("CO2_raw"))
    else:
        empty = ("CO2_corrected", "wpl_factor", "wpl_delta_ppm", "wpl_rel_change")
        df = df.withColumns({c: F.lit(None).cast("double") for c in empty}).withColumn("wpl_valid_input", F.lit(0))
        co2 = F.col("CO2_raw")
    return df.withColumn("CO2", co2).filter(F.col(ts).isNotNull() & F.col("CO2").isNotNull())


def dilution_by_cycle(cycles: DataFrame, keys: list[str]) -> DataFrame:
    """Per-cycle dilution metrics for a table that carries ``cycle_id``."""
    by = [*keys, "cycle_id"]
    out = cycles.groupBy(*by).agg(
        F.avg("wpl_factor").alias("wpl_factor_mean"),
        F.max("wpl_factor").alias("wpl_factor_max"),
        F.avg("wpl_delta_ppm").alias("wpl_delta_ppm_mean"),
        F.max("wpl_delta_ppm").alias("wpl_delta_ppm_max"),
        F.avg(F.col("CO2_corrected").isNotNull().cast("double")).alias("wpl_valid_fraction"),
        F.avg("H2O").alias("h2o_mean"),
        F.max("H2O").alias("h2o_max"),
    )
    rel = cycles.select(*by, F.abs("wpl_rel_change").alias("_rel"))
    p95 = exact_quantiles(rel, by, "_rel", {"wpl_abs_rel_change_p95": 0.95}).drop("n")
    return null_safe_join(out, p95, by)


def dilution_summary(df: DataFrame, keys: list[str]) -> DataFrame:
    """Point counts, median factor and change, and the 95th percentile of the relative change."""
    d = df.withColumn("_rel", F.abs("wpl_rel_change"))
    out = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_points"), F.count("CO2_corrected").alias("valid_points"))
    for col, o, q in (
        ("wpl_factor", "median_factor", 0.5),
        ("wpl_delta_ppm", "median_delta_ppm", 0.5),
        ("_rel", "p95_abs_rel_change", 0.95),
    ):
        out = null_safe_join(out, exact_quantiles(d, keys, col, {o: q}).drop("n"), keys)
    return out


def simple_cycle_fit(
    df: DataFrame,
    keys: list[str],
    ts: str,
    value: str,
    temp: str | None = None,
    flag: str | None = None,
    gap_sec: float = 300.0,
    start_cutoff: float = 50.0,
    min_points: int = 5,
    min_r2: float = 0.0,
    tie: str | None = None,
) -> DataFrame:
    """One ordinary regression per cycle after the first ``start_cutoff`` seconds, all in one aggregation.

    Temperature and flag are taken over the whole cycle.
    """
    d = add_cycles(df.filter(F.col(value).isNotNull()), keys, ts, gap_sec, tie, start_columns=True)
    t = (F.col("_us") - F.col("_start_us")) / SECOND
    d = d.withColumn("_t", F.when(t >= start_cutoff, t)).withColumn("_y", F.when(F.col("_t").isNotNull(), F.col(value)))
    out = d.groupBy(*keys, "cycle_id").agg(
        F.min(ts).alias("flux_date"),
        F.regr_slope("_y", "_t").alias("flux_slope"),
        F.regr_r2("_y", "_t").alias("r_squared"),
        (F.avg(temp) if temp else F.lit(None).cast("double")).alias("mean_temp"),
        (F.max(flag) if flag else F.lit(0)).alias("qc_flag"),
        F.count("_t").alias("n_points"),
        F.max("_t").alias("duration_sec"),
        F.min("_t").alias("_t0"),
    )
    out = out.filter((F.col("n_points") >= min_points) & (F.col("duration_sec") > F.col("_t0"))).drop("_t0")
    # A flat cycle has no r2 in SQL; it counts as 0.
    out = out.withColumn("r_squared", F.coalesce("r_squared", F.lit(0.0))).filter(F.col("r_squared") >= min_r2)
    return out.withColumn("flux_absolute", absolute_flux(F.col("flux_slope"), F.col("mean_temp"), F.col("flux_date")))


_DOUBLES = (
    "window_start_sec window_end_sec duration_sec flux_slope flux_intercept r2 p_value std_err rmse nrmse snr "
    "snr_noise noise_sigma monotonicity outlier_frac aicc_linear aicc_quadratic delta_aicc slope_ts slope_ts_low "
    "slope_ts_high slope_diff_pct co2_range bimodal_gap_ppm bimodal_lower_mean bimodal_upper_mean"
).split()
METRIC_SCHEMA = T.StructType(
    [T.StructField(c, T.DoubleType()) for c in _DOUBLES]
    + [T.StructField("n_points_used", T.LongType()), T.StructField("bimodal_flag", T.BooleanType())]
)
H2O_SCHEMA = T.StructType(
    [
        T.StructField(f"h2o_{c}", T.DoubleType())
        for c in "slope intercept r2 nrmse snr outlier_frac monotonic_frac duration conc_mean conc_range".split()
    ]
    + [T.StructField("h2o_n_points", T.LongType())]
)


def _points(value: str, tie: str | None) -> list[Column]:
    """Time and value arrays of a cycle in time order."""
    fields = ["_us", *([tie] if tie else []), value]
    pts = F.array_sort(F.collect_list(F.struct(*fields)))
    return [F.transform(pts, lambda p: p["_us"]).alias("_ts"), F.transform(pts, lambda p: p[value]).alias("_ys")]


def _spread(df: DataFrame, by: list[str]) -> DataFrame:
    """Fix the partition count of the coming grouping: kernels cost far more than their bytes suggest, and adaptive
    coalescing would put small data into one task. The grouping reuses this shuffle."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def _map_cycles(grouped: DataFrame, schema: T.StructType, fn: Callable) -> DataFrame:
    """Apply ``fn(t, y) -> dict | None`` to the arrays of every cycle, whole Arrow batches at a time."""
    names = schema.names

    def run(ts: pd.Series, ys: pd.Series) -> pd.DataFrame:
        rows = []
        for us, y in zip(ts, ys, strict=True):
            us = np.asarray(us, dtype=np.int64)
            m = fn((us - us[0]) / SECOND, np.asarray(y, dtype=float)) if len(us) else None
            rows.append((m is not None, *(m[c] if m is not None else None for c in names)))
        out = pd.DataFrame(rows, columns=["_known", *names])
        return out.astype({f.name: "Int64" if f.dataType in (T.LongType(), T.IntegerType()) else object for f in schema.fields})

    # Only the points go to Python: keys and all other columns stay as they are. Not to be run twice by the optimizer.
    kernel = F.pandas_udf(run, T.StructType([T.StructField("_known", T.BooleanType()), *schema.fields])).asNondeterministic()
    raw = grouped.withColumn("_m", kernel("_ts", "_ys")).filter("_m._known").drop("_ts", "_ys")
    raw = raw.select(*[c for c in raw.columns if c != "_m"], *[F.col("_m")[c].alias(c) for c in names])
    return raw.withColumns({f.name: numeric(f.name) for f in schema.fields if f.dataType == T.DoubleType()})


def evaluate_cycles(
    df: DataFrame,
    keys: list[str],
    ts: str,
    value: str,
    temp: str | None = None,
    flag: str | None = None,
    tie: str | None = None,
    **settings,
) -> DataFrame:
    """Full regression metrics per CO2 cycle, with the best window of each.

    A cycle is one closing of the chamber, minutes long; its points travel as two arrays in one row, so cycles of all
    chambers spread over all tasks. Cycles without a usable window give no row.
    """
    cfg = {**TH.CYCLE_SETTINGS, "bimodal": TH.BIMODAL, **settings}
    known = df.filter(F.col(value).isNotNull() & F.col(ts).isNotNull())
    d = add_cycles(known, keys, ts, cfg["gap_sec"], tie)
    d = d.withColumn("_us", micros(ts)).withColumn(value, F.col(value).cast("double"))
    g = _spread(d, [*keys, "cycle_id"]).groupBy(*keys, "cycle_id").agg(
        F.min(ts).alias("flux_date"),
        F.max(ts).alias("cycle_end"),
        ((F.max("_us") - F.min("_us")) / SECOND).alias("cycle_duration_sec"),
        F.count(F.lit(1)).alias("n_points_total"),
        (F.avg(temp) if temp else F.lit(None).cast("double")).alias("mean_temp"),
        F.coalesce((F.max(flag) if flag else F.lit(0)), F.lit(0)).cast("int").alias("qc_flag"),
        *_points(value, tie),
    )
    out = _map_cycles(g.filter(F.col("n_points_total") >= cfg["min_points"]), METRIC_SCHEMA,
                      lambda t, y: kernels.cycle_metrics(t, y, cfg))
    return out.withColumn("flux_absolute", absolute_flux(F.col("flux_slope"), F.col("mean_temp"), F.col("flux_date")))


def evaluate_h2o_cycles(
    df: DataFrame,
    keys: list[str],
    ts: str,
    value: str,
    radiation: str | None = None,
    gap_sec: float = 300.0,
    min_points: int = 20,
    min_duration_sec: float = 180.0,
    tie: str | None = None,
) -> DataFrame:
    """Water-vapour metrics per cycle, with ``is_nighttime`` for grading.

    Night is a median radiation below 10 where radiation is given, else a start before 6 or from 18 o'clock.
    """
    d = add_cycles(df, keys, ts, gap_sec, tie)
    d = d.withColumn("_us", micros(ts)).withColumn(value, F.col(value).cast("double"))
    if radiation:
        night = F.coalesce(F.percentile(radiation, F.lit(0.5)) < 10, F.lit(False))
    else:
        h = F.hour(F.min(ts))
        night = (h < 6) | (h >= 18)
    known = F.when(F.col(value).isNotNull(), F.struct("_us", *([tie] if tie else []), value))
    pts = F.array_sort(F.collect_list(known))
    g = _spread(d, [*keys, "cycle_id"]).groupBy(*keys, "cycle_id").agg(
        F.min(ts).alias("flux_date"),
        night.alias("is_nighttime"),
        F.transform(pts, lambda p: p["_us"]).alias("_ts"),
        F.transform(pts, lambda p: p[value]).alias("_ys"),
    )
    return _map_cycles(
        g.filter(F.size("_ts") >= min_points),
        H2O_SCHEMA,
        lambda t, y: kernels.h2o_metrics(t, y, min_points, min_duration_sec),
    )


def theil_sen_by_group(df: DataFrame, by: list[str], t: str, y: str) -> DataFrame:
    """Median pairwise slope with intercept and 95 % interval per group; ``t`` in microseconds gives per-second slopes.

    A group of up to ``respira.series.rows`` points is one task's work, n log n in its points; longer ones are counted in
    blocks by all tasks, where NaN values count as missing.
    """
    d = df.filter(F.col(t).isNotNull() & F.col(y).isNotNull()).select(*by, F.col(t).alias("_us"), F.col(y).cast("double").alias("_y"))
    if is_small(d):
        return _theil_sen_in_tasks(d, by)
    d, rows = store_if_costly(d), target_rows(d)
    size = d.groupBy(*by).agg(F.count(F.lit(1)).alias("_n"), F.min("_us").alias("_us0")).filter(F.col("_n") > rows)
    long = cut_lineage(size.withColumn("_g", F.monotonically_increasing_id()))
    if long.isEmpty():
        return _theil_sen_in_tasks(d, by)
    d = cut_lineage(join_few(d, long, by))
    points = d.filter("_g is not null and not isnan(_y)").select("_g", ((F.col("_us") - F.col("_us0")) / SECOND).alias("_x"), "_y")
    s = long_theil_sen(points, rows).toDF("_s", "slope_ts", "slope_ts_low", "slope_ts_high")
    mid = exact_medians(points, ["_g"], {"_mx": F.col("_x"), "_my": F.col("_y")}, small=False).toDF("_m", "_mx", "_my")
    out = long.join(s, F.col("_g") == F.col("_s"), "left").join(mid, F.col("_g") == F.col("_m"), "left")
    icpt = (F.col("_my") - F.col("slope_ts") * F.col("_mx")).alias("intercept_ts")
    out = out.select(*by, F.col("_n").alias("n_points"), "slope_ts", icpt, "slope_ts_low", "slope_ts_high")
    return _theil_sen_in_tasks(d.filter("_g is null").select(*by, "_us", "_y"), by).unionByName(out)


def _theil_sen_in_tasks(d: DataFrame, by: list[str]) -> DataFrame:
    """Groups as arrays of times and values, a task's batch at a time."""
    schema = T.StructType(
        [T.StructField(c, T.DoubleType()) for c in ("slope_ts", "intercept_ts", "slope_ts_low", "slope_ts_high")]
    )
    pts = F.array_sort(F.collect_list(F.struct("_us", "_y")))
    g = _spread(d, by).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_points"),
        F.transform(pts, lambda p: p["_us"]).alias("_ts"),
        F.transform(pts, lambda p: p["_y"]).alias("_ys"),
    )
    return _map_cycles(g, schema, lambda a, b: dict(zip(schema.names, kernels.theil_sen(a, b), strict=True)))


def linear_fit(df: DataFrame, by: list[str], t: str, y: str) -> DataFrame:
    """Straight-line fit per group: slope, intercept, r2 (0 for flat values), rmse, rss and corrected criterion.

    The residual sum is taken in a second pass over the residuals, which keeps its digits for near-perfect fits.
    """
    g = df.filter(F.col(t).isNotNull() & F.col(y).isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.regr_slope(y, t).alias("slope"),
        F.regr_intercept(y, t).alias("intercept"),
        (F.var_pop(y) * F.count(F.lit(1))).alias("_ss"),
    )
    d = null_safe_join(df, g, by)
    res = F.col(y) - (F.col("slope") * F.col(t) + F.col("intercept"))
    rss = d.groupBy(*by).agg(F.sum(res * res).alias("rss"))
    out = null_safe_join(g.filter("slope IS NOT NULL"), rss, by)
    n = F.col("n").cast("double")
    crit = n * F.ln(F.greatest(F.col("rss"), F.lit(1e-12)) / n) + 4 + F.try_divide(F.lit(12.0), n - 3)
    return out.select(
        *by,
        "n",
        "slope",
        "intercept",
        F.when(F.col("_ss") > 0, 1 - F.col("rss") / F.col("_ss")).otherwise(0.0).alias("r2"),
        F.sqrt(F.col("rss") / n).alias("rmse"),
        "rss",
        F.when(n > 3, crit).alias("aicc"),
    )


def quadratic_gain(df: DataFrame, by: list[str], t: str, y: str) -> DataFrame:
    """Criterion of line and parabola per group and their difference, from power sums of centred time.

    Fully decomposable: one aggregation for the centres, one for the sums, whatever the group size.
    """
    c = df.groupBy(*by).agg(F.avg(t).alias("_mt"), F.avg(y).alias("_my"), F.stddev_pop(t).alias("_st"))
    d = null_safe_join(df, c, by)
    d = d.withColumn("_x", F.try_divide(F.col(t) - F.col("_mt"), F.col("_st"))).withColumn(
        "_v", F.col(y) - F.col("_my")
    )
    x, v = F.col("_x"), F.col("_v")
    s = d.filter(x.isNotNull() & v.isNotNull()).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(x * x).alias("s2"),
        F.sum(x * x * x).alias("s3"),
        F.sum(x * x * x * x).alias("s4"),
        F.sum(v * v).alias("yy"),
        F.sum(x * v).alias("xy"),
        F.sum(x * x * v).alias("xxy"),
        F.sum(x).alias("s1"),
        F.sum(v).alias("y1"),
    )
    n, s1, s2, s3, s4 = (F.col(k).cast("double") for k in ("n", "s1", "s2", "s3", "s4"))
    yy, xy, xxy, y1 = (F.col(k) for k in ("yy", "xy", "xxy", "y1"))
    lin_rss = yy - y1 * y1 / n - (xy - s1 * y1 / n) * F.try_divide(xy - s1 * y1 / n, s2 - s1 * s1 / n)

    # Normal equations of the parabola after removing means (x is centred, so s1 is rounding only).
    a11, a12, a22 = s2 - s1 * s1 / n, s3 - s1 * s2 / n, s4 - s2 * s2 / n
    b1, b2 = xy - s1 * y1 / n, xxy - s2 * y1 / n
    det = a11 * a22 - a12 * a12
    gain = F.try_divide(b1 * b1 * a22 - 2 * b1 * b2 * a12 + b2 * b2 * a11, det)
    quad_rss = yy - y1 * y1 / n - gain

    def crit(rss: Column, k: int) -> Column:
        r = F.greatest(rss, F.lit(1e-12))
        return F.when(n > k + 1, n * F.ln(r / n) + 2 * k + F.try_divide(F.lit(2.0 * k * (k + 1)), n - k - 1))

    out = s.select(*by, "n", crit(lin_rss, 2).alias("aicc_linear"), crit(quad_rss, 3).alias("aicc_quadratic"))
    return out.withColumn("delta_aicc", F.col("aicc_quadratic") - F.col("aicc_linear"))


def mad_outliers(df: DataFrame, by: list[str], value: str, z: float = 3.5, out: str = "is_outlier") -> DataFrame:
    """True where the deviation from the group median exceeds ``z`` robust standard deviations."""
    med = exact_quantiles(df, by, value, {"_med": 0.5}).drop("n")
    d = join_few(df, med, by).withColumn("_dev", F.abs(F.col(value) - F.col("_med")))
    mad = exact_quantiles(d, by, "_dev", {"_mad": 0.5}).drop("n")
    d = join_few(d, mad, by)
    hit = (F.col("_mad") > 0) & (0.6745 * F.try_divide(F.col("_dev"), F.col("_mad")) > z)
    return d.withColumn(out, true(hit)).drop("_med", "_dev", "_mad")


def monotonic_share(df: DataFrame, by: list[str], order: list[str], value: str, eps: float = 0.5) -> DataFrame:
    """Share of steps above ``eps`` that go the way of the group's regression slope on ``order[0]``."""
    d = Series.of(df, by, order).previous({"_before": value}).df.withColumn("_step", F.col(value) - F.col("_before"))
    moved = F.abs("_step") > eps
    g = d.groupBy(*by).agg(
        F.count(value).alias("n_points"),
        F.regr_slope(value, order[0]).alias("slope"),
        F.count(F.when(moved & (F.col("_step") > 0), 1)).alias("_up"),
        F.count(F.when(moved & (F.col("_step") < 0), 1)).alias("_down"),
    )
    way = F.when(F.col("slope") > 0, F.col("_up")).when(F.col("slope") < 0, F.col("_down"))
    share = F.when(F.col("n_points") >= 3, F.try_divide(way, F.col("_up") + F.col("_down")))
    return g.select(*by, "n_points", "slope", share.alias("monotonicity"))


def bimodality(df: DataFrame, by: list[str], value: str, **settings) -> DataFrame:
    """Two-cluster test per group on occupied histogram bins; only bins, not values, are ordered."""
    cfg = {**TH.BIMODAL, **settings}
    width, gap = cfg["bin_width"], cfg["min_gap_bins"]
    bins = (
        df.filter(F.col(value).isNotNull())
        .withColumn("_bin", F.floor(F.col(value) / width))
        .groupBy(*by, "_bin")
        .agg(
            F.count(F.lit(1)).alias("_c"),
            F.sum(value).alias("_s"),
            F.min(value).alias("_lo"),
            F.max(value).alias("_hi"),
        )
    )
    w = Window.partitionBy(*by).orderBy("_bin")
    bins = bins.withColumn("_empty", F.lead("_bin").over(w) - F.col("_bin") - 1)
    best = bins.groupBy(*by).agg(
        F.sum("_c").alias("n_values"),
        (F.max("_hi") - F.min("_lo")).alias("_range"),
        F.max(F.struct("_empty", (-F.col("_bin")).alias("_nb"))).alias("_run"),
    )
    best = best.withColumn("_at", -F.col("_run._nb")).withColumn("_len", F.col("_run._empty")).drop("_run")
    j = null_safe_join(bins.drop("_empty"), best, by)
    low = F.col("_bin") <= F.col("_at")
    out = j.groupBy(*by).agg(
        F.first("n_values").alias("n_values"),
        F.first("_range").alias("_range"),
        F.first("_len").alias("_len"),
        F.sum(F.when(low, F.col("_c"))).alias("_nl"),
        F.sum(F.when(~low, F.col("_c"))).alias("_nh"),
        F.sum(F.when(low, F.col("_s"))).alias("_sl"),
        F.sum(F.when(~low, F.col("_s"))).alias("_sh"),
    )
    side = cfg["min_side_points"]
    yes = true(
        (F.col("n_values") >= cfg["min_values"])
        & (F.col("_range") >= width * (gap + 2))
        & (F.col("_len") >= gap)
        & (F.col("_nl") >= side)
        & (F.col("_nh") >= side)
    )
    return out.select(
        *by,
        "n_values",
        yes.alias("bimodal_flag"),
        F.when(yes, F.col("_len") * width).otherwise(0.0).alias("bimodal_gap_ppm"),
        F.when(yes, F.col("_sl") / F.col("_nl")).alias("bimodal_lower_mean"),
        F.when(yes, F.col("_sh") / F.col("_nh")).alias("bimodal_upper_mean"),
    )
