"""Exact, linearly interpolated quantiles per group for groups of any size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respira.plans.series import join_few, null_safe_join
from respira.plans.sizing import is_small, store_if_costly

def _known(c: Column) -> Column:
    """Doubles, with NaN counted as missing on every path."""
    d = c.cast("double")
    return F.when(~F.isnan(d), d)


def exact_quantiles(
    df: DataFrame,
    keys: list[str],
    value: str,
    probs: dict[str, float],
    small: bool | None = None,
    accuracy: int = 100_000,
) -> DataFrame:
    """One row per group with ``n`` (non-null count) and one column per entry of ``probs``.

    Small inputs use Spark's ``percentile``, which keeps a count per distinct value in memory. Otherwise a sketch
    brackets each wanted rank, one pass counts what lies below the bracket and only the values inside it (about
    8/accuracy of the rows; all of a group with fewer than ``accuracy`` rows) are ordered, so no task holds a whole
    large group.
    """
    names, qs = list(probs), list(probs.values())
    df = df.withColumn(value, _known(F.col(value)))
    if small if small is not None else is_small(df):
        arr = F.percentile(value, F.array(*map(F.lit, qs)))
        out = df.groupBy(*keys).agg(F.count(value).alias("n"), arr.alias("_q"))
        return out.select(*keys, "n", *[F.col("_q")[i].alias(o) for i, o in enumerate(names)])
    d = 4.0 / accuracy
    marks = [b for q in qs for b in (max(q - d, 0.0), min(q + d, 1.0))]
    v = df.select(*keys, F.col(value).cast("double").alias("_v"))
    v = store_if_costly(v)
    sketch = v.groupBy(*keys).agg(
        F.count("_v").alias("n"),
        F.percentile_approx("_v", F.array(*map(F.lit, marks)), F.lit(accuracy)).alias("_m"),
    )
    few = F.col("n") < accuracy
    limits = {f"_lo{i}": F.when(few, -float("inf")).otherwise(F.col("_m")[2 * i]) for i in range(len(qs))}
    limits |= {f"_hi{i}": F.when(few, float("inf")).otherwise(F.col("_m")[2 * i + 1]) for i in range(len(qs))}
    sketch = sketch.withColumns(limits).drop("_m")
    j = join_few(v, sketch, keys, "inner")
    brackets = F.array(
        *[
            F.struct(F.lit(i).alias("i"), F.col(f"_lo{i}").alias("lo"), F.col(f"_hi{i}").alias("hi"))
            for i in range(len(qs))
        ]
    )
    below = j.groupBy(*keys).agg(
        *[F.sum((F.col("_v") < F.col(f"_lo{i}")).cast("bigint")).alias(f"_b{i}") for i in range(len(qs))]
    )
    hits = F.filter(brackets, lambda b: F.coalesce((F.col("_v") >= b["lo"]) & (F.col("_v") <= b["hi"]), F.lit(False)))
    inside = (
        j.select(*keys, "_v", F.explode(F.transform(hits, lambda b: b["i"])).alias("_i"))
        .groupBy(*keys, "_i", "_v")
        .agg(F.count(F.lit(1)).alias("_c"))
    )
    base = null_safe_join(sketch.select(*keys, "n"), below, keys, "inner")
    w = Window.partitionBy(*keys, "_i").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    ranked = null_safe_join(inside.withColumn("_cum", F.sum("_c").over(w)), base, keys, "inner")
    picks = []
    for i, (o, q) in enumerate(zip(names, qs, strict=True)):
        pos = F.lit(q) * (F.col("n") - 1)
        for off, side in ((F.floor(pos), "l"), (F.ceil(pos), "h")):
            r = off - F.col(f"_b{i}")
            hit = (F.col("_i") == i) & (F.col("_cum") > r) & (F.col("_cum") - F.col("_c") <= r)
            picks.append(F.max(F.when(hit, F.col("_v"))).alias(f"_{side}{i}"))
    # From all groups, so that one without any value still gives a row, with nulls.
    found = null_safe_join(base, ranked.groupBy(*keys).agg(*picks), keys)
    cols = []
    for i, (o, q) in enumerate(zip(names, qs, strict=True)):
        pos = F.lit(q) * (F.col("n") - 1)
        lo, hi = F.col(f"_l{i}"), F.col(f"_h{i}")
        cols.append(F.when(lo == hi, lo).otherwise(lo + (hi - lo) * (pos - F.floor(pos))).alias(o))  # equal infinities have no difference
    return found.select(*keys, "n", *cols)


def exact_medians(df: DataFrame, keys: list[str], cols: dict[str, Column], small: bool | None = None) -> DataFrame:
    """Medians of several expressions per group; groups where all values of one are null still appear."""
    small = is_small(df) if small is None else small
    if small:
        return df.groupBy(*keys).agg(*[F.percentile(_known(c), F.lit(0.5)).alias(o) for o, c in cols.items()])
    df = store_if_costly(df.select(*keys, *[c.alias(f"_in_{o}") for o, c in cols.items()]))
    out = df.select(*keys).distinct()
    for o in cols:
        med = exact_quantiles(df, keys, f"_in_{o}", {o: 0.5}, small=False).drop("n")
        out = null_safe_join(out, med, keys)
    return out
