"""Bringing sources onto one time line: grids, gap filling, merges and time joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respira.plans.series import Series, micros, null_safe_join
from respira.plans.timejoin import asof_join

TICKS_PER_TASK = 21_600
HOUR_US = 3_600_000_000


def time_grid(df: DataFrame, keys: list[str], us: str, step_us: int) -> DataFrame:
    """All ticks ``first + i * step`` up to the last time of each key, in column ``us``.

    Ticks are made in runs of a day at 4 s, spread over tasks by key and run, so a long span never becomes one array.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    span = df.groupBy(*keys).agg(F.min(us).alias("_a"), F.max(us).alias("_b"))
    run = TICKS_PER_TASK * step_us
    runs = span.withColumn("_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("_b") - F.col("_a")) / run))))
    runs = runs.repartition(parts, *keys, "_run")
    lo = F.col("_a") + F.col("_run") * run
    hi = F.least(F.col("_b"), lo + (run - step_us))
    return runs.select(*keys, F.explode(F.sequence(lo, hi, F.lit(step_us))).alias(us))


def interpolate(s: Series, cols: list[str], limit_us: int | None = None, extend: bool = True) -> Series:
    """Fill nulls linearly in the order column; outer nulls take the nearest value when ``extend``.

    With ``limit_us`` only rows at most that far from a known value on either side are filled.
    """
    x = s.order[0]
    for c in cols:
        s = s.with_columns({"_known": F.when(F.col(c).isNotNull(), F.col(x))})
        s = s.nearest_known({"_pv": c, "_px": "_known"})
        s = s.nearest_known({"_nv": c, "_nx": "_known"}, forward=False)
        pv, px, nv, nx = (F.col(k) for k in ("_pv", "_px", "_nv", "_nx"))
        inner = pv + (nv - pv) * F.try_divide(F.col(x) - px, nx - px)
        outer = F.coalesce(nv, pv) if extend else F.lit(None)
        v = F.when(px.isNotNull() & nx.isNotNull(), inner).otherwise(outer)
        if limit_us is not None:
            near = F.least(F.col(x) - px, nx - F.col(x)) <= limit_us
            v = F.when(near, v)
        s = s.with_columns({c: F.coalesce(F.col(c), v)})
        s = s.map(lambda d: d.drop("_known", "_pv", "_px", "_nv", "_nx"))
    return s


def fill_from_secondary(
    primary: DataFrame,
    secondary: DataFrame,
    keys: list[str],
    ts: str,
    columns: dict[str, tuple[str, str]],
    step_sec: int = 4,
    labels: tuple[str, str] = ("climate", "soil_interpolated"),
) -> DataFrame:
    """Regular time line over both sources; the primary wins, the interpolated secondary fills, and
    ``<out>_source`` says which.

    ``columns`` maps output to (primary column, secondary column). Secondary readings count only on the exact grid.
    """
    step = step_sec * 1_000_000
    p = primary.select(*keys, micros(ts).alias("_us"), *[F.col(a).alias(f"_p_{o}") for o, (a, _) in columns.items()])
    q = secondary.select(*keys, micros(ts).alias("_us"), *[F.col(b).alias(f"_s_{o}") for o, (_, b) in columns.items()])
    line = time_grid(p.select(*keys, "_us").unionByName(q.select(*keys, "_us")), keys, "_us", step)
    at = [*keys, "_us"]
    aligned = q.select(*keys, (F.floor(F.col("_us") / step) * step).alias("_us"))
    grid = time_grid(aligned, keys, "_us", step)
    s = Series.of(grid.join(q, at, "left"), keys, ["_us"])
    soil = interpolate(s, [f"_s_{o}" for o in columns]).df
    d = line.join(p, at, "left").join(soil, at, "left")
    out: list[Column] = []
    for o in columns:
        a, b = F.col(f"_p_{o}"), F.col(f"_s_{o}")
        src = F.when(a.isNotNull(), labels[0]).when(b.isNotNull(), labels[1]).otherwise("missing")
        out += [F.coalesce(a, b).alias(o), src.alias(f"{o}_source")]
    return d.select(*keys, F.timestamp_micros("_us").cast("timestamp_ntz").alias(ts), *out)


def outer_merge(frames: list[DataFrame], at: list[str]) -> DataFrame:
    """Full outer merge of tables with disjoint value columns and unique ``at`` rows, in one shuffle for all of them."""
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    rest = [c for c in union.columns if c not in at]
    return union.groupBy(*at).agg(*[F.first(c, ignorenulls=True).alias(c) for c in rest])


def compare_at_bins(
    left: DataFrame, right: DataFrame, keys: list[str], ts: str, value: tuple[str, str], minutes: int = 30
) -> DataFrame:
    """Difference of two sources averaged over common time bins: count, mean, spread, largest, correlation."""
    width = minutes * 60_000_000

    def binned(df: DataFrame, col: str, out: str) -> DataFrame:
        b = F.floor(micros(ts) / width).alias("_bin")
        return df.groupBy(*keys, b).agg(F.avg(col).alias(out)).filter(F.col(out).isNotNull())

    d = binned(left, value[0], "_l").join(binned(right, value[1], "_r"), [*keys, "_bin"])
    diff = F.col("_l") - F.col("_r")
    return d.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_bins"),
        F.avg(diff).alias("mean_diff"),
        F.stddev_samp(diff).alias("sd_diff"),
        F.max(F.abs(diff)).alias("max_abs_diff"),
        F.corr("_l", "_r").alias("correlation"),
    )


def flags_onto_cycles(
    sensor: DataFrame, cycles: DataFrame, keys: list[str], ts: str, flags: dict[str, str], start: str, end: str
) -> DataFrame:
    """Mean sensor flag per cycle: a reading belongs to the latest cycle start at or before it, if not past its end.

    ``flags`` maps output to flag column; unknown flags are skipped in the mean.
    """
    span = cycles.select(*keys, micros(start).alias("_a"), micros(end).alias("_b")).dropDuplicates([*keys, "_a"])
    rows = sensor.select(*keys, micros(ts).alias("_us"), *set(flags.values()))
    hit = asof_join(rows, span, keys, "_us", "_a", {"_cs": "_a", "_ce": "_b"}).filter(F.col("_us") <= F.col("_ce"))
    means = hit.groupBy(*keys, "_cs").agg(*[F.avg(c).alias(o) for o, c in flags.items()])
    return null_safe_join(cycles.withColumn("_cs", micros(start)), means, [*keys, "_cs"]).drop("_cs")


def attach_nearest_hour(
    rows: DataFrame, hourly: DataFrame, keys: list[str], ts: str, hour: str, cols: list[str]
) -> DataFrame:
    """Values of the nearest hour within 90 minutes of the row's floored hour (earlier one on ties).

    Hours are whole, so only the same, previous and next hour qualify: each hourly row is offered to three hours and the
    best offer per hour is joined by equality.
    """
    offers = hourly.select(
        *keys,
        F.explode(F.array(F.lit(0), F.lit(-HOUR_US), F.lit(HOUR_US))).alias("_off"),
        micros(hour).alias("_h"),
        F.struct(*cols).alias("_v"),
    )
    best = (
        offers.withColumn("_target", F.col("_h") + F.col("_off"))
        .groupBy(*keys, "_target")
        .agg(F.min_by("_v", F.struct(F.abs("_off"), "_h")).alias("_v"))
    )
    d = rows.withColumn("_target", F.floor(micros(ts) / HOUR_US) * HOUR_US)
    d = null_safe_join(d, best, [*keys, "_target"])
    return d.withColumns({c: F.col("_v")[c] for c in cols}).drop("_target", "_v")
