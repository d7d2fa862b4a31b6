"""Joins on time written as equi-joins, so Spark can shuffle, broadcast or split them as usual."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respira.plans.series import Series, null_safe_join

DAY_US = 86_400_000_000


def interval_join(
    points: DataFrame,
    spans: DataFrame,
    keys: list[str],
    at: str,
    start: str,
    end: str,
    bucket: int,
    how: str = "inner",
) -> DataFrame:
    """Join points to closed spans containing them: ``start <= at <= end`` on microsecond columns.

    A span is repeated once per time bucket it touches; pick ``bucket`` near a typical span length.
    """
    k = {c: f"_s_{c}" for c in keys}
    s = spans.withColumnsRenamed(k).withColumn(
        "_bkt", F.explode(F.sequence(F.floor(F.col(start) / bucket), F.floor(F.col(end) / bucket)))
    )
    p = points.withColumn("_pbkt", F.floor(F.col(at) / bucket))
    cond = [p["_pbkt"] == s["_bkt"], p[at] >= s[start], p[at] <= s[end]]
    cond += [p[c] == s[r] for c, r in k.items()]
    return p.join(s, reduce(lambda a, b: a & b, cond), how).drop("_bkt", "_pbkt", *k.values())


def asof_join(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    at: str,
    right_at: str,
    cols: dict[str, str],
    direction: str = "backward",
    small: bool | None = None,
) -> DataFrame:
    """Attach the latest right row at or before each left row (``backward``) or the first at or after it.

    ``cols`` maps output to right column; they arrive together, also where some are null. Both sides are put on one
    time line and the value is carried along it, so cost is linear and long keys are split like any series.
    """
    pack = F.struct(*[F.col(c).alias(o) for o, c in cols.items()])
    r = right.select(*keys, F.col(right_at).alias("_at"), pack.alias("_pack"))
    if left.schema[at].dataType != right.schema[right_at].dataType:
        raise TypeError("both time columns must have the same type")
    l_cols = [c for c in left.columns if c not in keys]
    lrow = left.select(*keys, F.col(at).alias("_at"), F.struct(*l_cols).alias("_row"))
    first = 0 if direction == "backward" else 1
    both = r.withColumn("_side", F.lit(first)).unionByName(
        lrow.withColumn("_side", F.lit(1 - first)), allowMissingColumns=True
    )
    s = Series.of(both, keys, ["_at", "_side"], small=small)
    s = s.nearest_known({"_hit": "_pack"}, forward=direction == "backward")
    out = s.df.filter(F.col("_side") == 1 - first)
    return out.select(*keys, "_row.*", *[F.col("_hit")[o].alias(o) for o in cols])


def neighbours(
    left: DataFrame, right: DataFrame, keys: list[str], at: str, right_at: str, cols: list[str], small: bool | None = None
) -> DataFrame:
    """Both neighbours in time: ``_prev`` is the latest right row at or before the left row, ``_next`` the first after it.

    Each is a struct of ``right_at`` and ``cols``. One shuffle serves both directions.
    """
    pack = F.struct(right_at, *cols)
    r = right.select(*keys, F.col(right_at).alias("_at"), F.lit(0).alias("_side"), pack.alias("_pack"))
    l_cols = [c for c in left.columns if c not in keys]
    lrow = left.select(*keys, F.col(at).alias("_at"), F.lit(1).alias("_side"), F.struct(*l_cols).alias("_row"))
    s = Series.of(r.unionByName(lrow, allowMissingColumns=True), keys, ["_at", "_side"], small=small)
    s = s.nearest_known({"_prev": "_pack"}).nearest_known({"_next": "_pack"}, forward=False)
    return s.df.filter("_side = 1").select(*keys, "_row.*", "_prev", "_next")


__all__ = ["asof_join", "interval_join", "neighbours", "null_safe_join", "DAY_US"]
