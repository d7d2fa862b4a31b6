"""Rule-based quality flags on long readings ``(keys..., ts, value)``: 0 good, 1 suspect, 2 bad."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respira.functions.numeric import any_of, numeric, true
from respira.plans.quantiles import exact_quantiles
from respira.plans.series import Series, join_few, micros, trailing_range

HOUR_US = 3_600_000_000


def bounds_flag(value: Column, hard_lo: Column, hard_hi: Column, soft_lo: Column, soft_hi: Column) -> Column:
    """2 outside the hard limits, 1 outside the soft ones; missing values and missing limits never flag."""
    hard = true(value < hard_lo) | true(value > hard_hi)
    soft = true(value < soft_lo) | true(value > soft_hi)
    return F.when(hard, 2).when(soft, 1).otherwise(0)


def iqr_flags(
    df: DataFrame, keys: list[str], value: str, factor: str | float = 1.5, out: str = "iqr_flag"
) -> DataFrame:
    """1 beyond quartile ± factor x IQR of the whole series; none below 4 values or with IQR 0.

    ``factor`` is a number or the name of a column with one value per series.
    """
    k = F.col(factor) if isinstance(factor, str) else F.lit(factor)
    q = exact_quantiles(df, keys, value, {"_q1": 0.25, "_q3": 0.75}).filter("n >= 4 AND _q3 > _q1")
    d = join_few(df, q.drop("n"), keys)
    width = k * (F.col("_q3") - F.col("_q1"))
    hit = (F.col(value) < F.col("_q1") - width) | (F.col(value) > F.col("_q3") + width)
    return d.withColumn(out, true(hit).cast("int")).drop("_q1", "_q3")


def rate_of_change_flags(
    df: DataFrame, keys: list[str], ts: str, value: str, limit: str | float, out: str = "roc_flag", tie: str | None = None
) -> DataFrame:
    """1 where the step from the row before exceeds ``limit``, unless the step spans more than 3 usual intervals.

    The usual interval is the median over the whole series. A null on either side never flags.
    """
    lim = F.col(limit) if isinstance(limit, str) else F.lit(limit)
    order = ["_us", tie] if tie else ["_us"]
    s = Series.of(df.withColumn("_us", micros(ts)), keys, order).previous({"_pv": value, "_pt": "_us"})
    d = s.df.withColumn("_dt", F.col("_us") - F.col("_pt"))
    usual = exact_quantiles(d, keys, "_dt", {"_med": 0.5}).drop("n")
    d = join_few(d, usual, keys)
    near = F.coalesce(F.col("_dt") <= 3 * F.col("_med"), F.lit(True))
    jump = true(F.abs(F.col(value) - F.col("_pv")) > lim)
    return d.withColumn(out, (jump & near).cast("int")).drop("_us", "_pv", "_pt", "_dt", "_med")


def persistence_flags(
    df: DataFrame,
    keys: list[str],
    ts: str,
    value: str,
    hours: float,
    epsilon: float,
    out: str = "persistence_flag",
) -> DataFrame:
    """1 where all values of the last ``hours`` (open start, null-skipping) lie within ``epsilon``.

    The first reading after a pause is alone in its frame and is flagged too.
    """
    back = int(hours * HOUR_US) - 1
    d = trailing_range(df.withColumn("_us", micros(ts)), keys, "_us", back, {"_hi": ("max", value), "_lo": ("min", value)})
    flat = F.col(value).isNotNull() & true(F.col("_hi") - F.col("_lo") <= epsilon)
    return d.withColumn(out, flat.cast("int")).drop("_us", "_hi", "_lo")


def combine_flags(bounds: Column, others: list[Column]) -> Column:
    """The bounds flag, raised to 1 where it is below 2 and any other rule fired."""
    return F.when((bounds < 2) & any_of([o == 1 for o in others]), 1).otherwise(bounds)


def exclusion_days(windows: DataFrame, sensor: str = "sensor") -> DataFrame:
    """Exclusion windows ``(sensor, start, end, flag)`` as one row per sensor and day they touch.

    A window lasts to the last whole second of its end day.
    """
    w = windows.select(
        F.col(sensor).alias("_sensor"),
        micros(F.col("start")).alias("s"),
        (micros(F.col("end")) + 86_399_000_000).alias("e"),
        F.coalesce(F.col("flag").cast("int"), F.lit(2)).alias("f"),
    )
    day = F.sequence(F.timestamp_micros("s").cast("date"), F.timestamp_micros("e").cast("date"))
    return (
        w.withColumn("_day", F.explode(day))
        .groupBy("_sensor", "_day")
        .agg(F.collect_set(F.struct("s", "e", "f")).alias("_ws"))
    )


def exclusion_flags(
    df: DataFrame, windows: DataFrame, sensor: str, ts: str, out: str = "exclusion_flag"
) -> DataFrame:
    """Highest flag of the exclusion windows a reading falls into, else 0. Never changes the number of rows."""
    days = exclusion_days(windows)
    at = micros(ts)
    d = df.withColumn("_d", F.col(ts).cast("date"))
    d = d.join(days, (d[sensor] == days["_sensor"]) & (d["_d"] == days["_day"]), "left")
    inside = F.filter("_ws", lambda w: (at >= w["s"]) & (at <= w["e"]))
    flag = F.coalesce(F.array_max(F.transform(inside, lambda w: w["f"])), F.lit(0))
    return d.withColumn(out, flag).drop("_d", "_sensor", "_day", "_ws")


def resolve_config(names: DataFrame, config: DataFrame, name: str = "variable") -> DataFrame:
    """Give every variable its configuration row: listed columns first, then name prefix, then config order.

    ``config`` has ``position, columns ARRAY<STRING>, pattern`` and any settings. Variables without one get nulls.
    """
    names = names.select(name).distinct()
    listed = config.select(F.explode("columns").alias("_c"), "position")
    exact = names.join(listed, names[name] == listed["_c"]).select(name, F.lit(0).alias("_rank"), "position")
    # A name of m tokens has m - 1 candidate prefixes, so the prefix match is an equi-join as well.
    parts = F.split(name, "_")
    prefixes = F.transform(
        F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "_")
    )
    pat = config.filter("pattern IS NOT NULL").select("pattern", "position")
    spread = names.filter(F.size(parts) > 1).select(name, F.explode(prefixes).alias("_p"))
    prefix = spread.join(pat, spread["_p"] == pat["pattern"]).select(name, F.lit(1).alias("_rank"), "position")
    best = exact.unionByName(prefix).groupBy(name).agg(F.min(F.struct("_rank", "position")).alias("_b"))
    picked = names.join(best, name, "left").select(name, F.col("_b.position").alias("position"))
    return picked.join(config.drop("columns", "pattern"), "position", "left")


def flag_readings(
    df: DataFrame,
    keys: list[str],
    variable: str,
    ts: str,
    value: str,
    config: DataFrame,
    windows: DataFrame | None = None,
    skip_roc: bool = False,
    skip_persistence: bool = False,
) -> DataFrame:
    """All rules for all variables in one job.

    ``config`` has one row per variable with ``hard_lo, hard_hi, soft_lo, soft_hi, iqr_factor, roc_limit, window_hours,
    epsilon``; nulls switch a rule off. ``window_hours`` and ``epsilon`` may differ between variables: readings are
    framed once per distinct ``window_hours``. Variables without configuration get 0 everywhere.
    """
    d = df.withColumn(value, numeric(value)).join(config, variable, "left")
    d = d.withColumn(
        "bounds_flag", bounds_flag(F.col(value), *[F.col(c) for c in ("hard_lo", "hard_hi", "soft_lo", "soft_hi")])
    )
    d = iqr_flags(d, keys, value, "iqr_factor")
    d = d.withColumn("roc_flag", F.lit(0)) if skip_roc else rate_of_change_flags(d, keys, ts, value, "roc_limit")
    if skip_persistence:
        d = d.withColumn("persistence_flag", F.lit(0))
    else:
        d = d.withColumn("_us", micros(ts))
        hours = [r[0] for r in config.select("window_hours").distinct().collect() if r[0] is not None]
        flat = F.lit(0)
        for h in hours:
            back = int(h * HOUR_US) - 1
            d = trailing_range(d, keys, "_us", back, {"_hi": ("max", value), "_lo": ("min", value)})
            hit = (F.col("window_hours") == h) & F.col(value).isNotNull()
            hit = hit & true(F.col("_hi") - F.col("_lo") <= F.col("epsilon"))
            d = d.withColumn("persistence_flag", F.when(true(hit), 1).otherwise(flat)).drop("_hi", "_lo")
            flat = F.col("persistence_flag")
        d = d.withColumn("persistence_flag", flat).drop("_us")
    if windows is not None:
        d = exclusion_flags(d, windows, variable, ts)
    else:
        d = d.withColumn("exclusion_flag", F.lit(0))
    rule = combine_flags(F.col("bounds_flag"), [F.col(c) for c in ("iqr_flag", "roc_flag", "persistence_flag")])
    d = d.withColumn("rule_flag", F.greatest(rule, F.col("exclusion_flag")))
    return d.drop(*[c for c in config.columns if c != variable])


def merge_rule_flag(qc_flag: Column, rule_flag: Column) -> Column:
    """Quality flag after the rules: the higher of the two."""
    return F.greatest(F.coalesce(qc_flag, F.lit(0)), F.coalesce(rule_flag, F.lit(0)))


def battery_escalation(
    df: DataFrame, battery: str, warn_below: float, bad_below: float, targets: list[tuple[str, str]]
) -> DataFrame:
    """Raise ``(rule flag, quality flag)`` pairs where the supply voltage is low: 1 below warn, 2 below bad."""
    level = F.when(true(F.col(battery) < bad_below), 2).when(true(F.col(battery) < warn_below), 1).otherwise(0)
    for rule, qc in targets:
        df = df.withColumn(rule, F.greatest(F.col(rule), level))
        df = df.withColumn(qc, F.greatest(F.col(rule), F.col(qc)))
    return df


def battery_summary(df: DataFrame, battery: str, warn_below: float, bad_below: float) -> DataFrame:
    b = F.col(battery)
    return df.agg(
        F.count(F.when(b < warn_below, 1)).alias("warn_count"), F.count(F.when(b < bad_below, 1)).alias("bad_count")
    )


def qc_summary(df: DataFrame, variable: str, flag: str = "rule_flag") -> DataFrame:
    """Counts and shares of each flag per variable, best first; method counts where those columns exist."""
    n = F.count(F.lit(1))

    def cnt(c: Column) -> Column:
        return F.count(F.when(c, 1))

    f = F.col(flag)
    aggs = [n.alias("total_points")]
    for i in (0, 1, 2):
        aggs += [cnt(f == i).alias(f"flag_{i}_count"), (cnt(f == i) / n * 100).alias(f"flag_{i}_percent")]
    for c, o in {"bounds_flag": "bounds_failures", "iqr_flag": "iqr_outliers"}.items():
        if c in df.columns:
            aggs.append(cnt(F.col(c) > 0).alias(o))
    return df.groupBy(variable).agg(*aggs).orderBy(F.desc("flag_0_percent"), variable)


def consistency_flags(
    df: DataFrame,
    humidity: list[str] = (),
    temperatures: tuple[str, str] | None = None,
    gases: tuple[str, str] | None = None,
    max_temp_gap: float = 10.0,
    max_gas_gap: float = 200.0,
) -> DataFrame:
    """Cross-variable checks: humidity outside 0-100 and twin sensors too far apart."""
    cols = {f"{c}_invalid": true((F.col(c) > 100) | (F.col(c) < 0)) for c in humidity}
    if temperatures:
        a, b = map(F.col, temperatures)
        cols["temp_chamber_mismatch"] = true(F.abs(a - b) > max_temp_gap)
    if gases:
        a, b = map(F.col, gases)
        cols["co2_chamber_mismatch"] = true(F.abs(a - b) > max_gas_gap)
    return df.withColumns(cols)


def gradient_anomaly(
    df: DataFrame, keys: list[str], ts: str, shallow: str, deep: str, factor: float = 1.5
) -> DataFrame:
    """True where the deep sensor varied more than ``factor`` x the shallow one over the last day (open start)."""
    d = df.withColumn("_us", micros(ts))
    d = trailing_range(d, keys, "_us", 24 * HOUR_US - 1, {"_sh": ("stddev_samp", shallow), "_de": ("stddev_samp", deep)})
    hit = true(F.col("_de") > F.col("_sh") * factor)
    return d.withColumn("soil_gradient_anomaly", hit).drop("_us", "_sh", "_de")


def exclusion_recommendations(audit: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Windows to exclude from an audit of regimes ``variable, regime, start, end, slope, agreement_score,
    slope_warning, reference``.

    Bad regimes (low agreement or a slope warning) of the chamber that is not the reference are merged when they touch
    or are at most a day apart.
    """
    bad = audit.filter(true(F.col("agreement_score") < threshold) | true(F.col("slope_warning")))
    other = F.when(F.coalesce(F.col("reference"), F.lit("C1")) == "C1", "C2").otherwise("C1")
    bad = bad.withColumn("sensor", F.concat_ws("_", F.col("variable"), other))
    w = Window.partitionBy("sensor").orderBy("start", "end", "regime")
    reach = F.max("end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col("start") <= F.date_add(reach, 1), 0).otherwise(1)
    isl = bad.withColumn("_new", fresh).withColumn(
        "_isl", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    ids = F.transform(
        F.array_sort(F.collect_list(F.struct("start", "end", "regime"))), lambda r: r["regime"].cast("string")
    )
    out = isl.groupBy("sensor", "_isl").agg(
        F.min("start").alias("start"),
        F.max("end").alias("end"),
        ids.alias("_ids"),
        F.avg("agreement_score").alias("avg_agreement"),
        F.max(F.coalesce("slope_warning", F.lit(False)).cast("int")).alias("_warn"),
        F.count(F.lit(1)).alias("n_regimes"),
    )
    score = F.concat(F.lit("avg agreement="), F.format_string("%.2f", F.bround("avg_agreement", 2)))
    parts = F.array(
        F.concat(F.lit("regimes "), F.array_join("_ids", ",")), score, F.when(F.col("_warn") == 1, "slope_warning=True")
    )
    return out.select(
        "sensor",
        "start",
        "end",
        F.lit(2).alias("flag"),
        F.array_join(F.array_compact(parts), "; ").alias("reason"),
        "n_regimes",
        "avg_agreement",
    )


