"""Theil-Sen slopes of groups too long for one task: inversions counted over blocks of time and buckets of the rests.

:mod:`respira.operators.slopes` says how slopes are counted. Here a group's points lie in blocks of consecutive times. For a slope to try,
each block sorts its rests and cuts them at sampled bounds into buckets. A pair of points is then in one block
(counted there), in one bucket of two blocks (counted by bucket), or apart in both, for which the points of each block
and bucket suffice. Tried slopes narrow the bracket of every wanted rank, all groups and ranks in the same jobs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from respira.operators.kernels import Z95
from respira.operators.slopes import inversions
from respira.plans.series import SEG, _cut_table, _position, join_few
from respira.plans.sizing import cut_lineage

#: Sampled points for each bucket, from whose rests its bounds are taken.
SAMPLED_EACH = 64
#: A bracket ends when it is this narrow against its slopes or the median size of sampled slopes.
NARROW = 1e-12
#: Tries lie this far to either side of the place that a straight line through the bracket's counts gives, and evenly.
ASIDE = 0.02
EVENLY = 8
MAX_ROUNDS = 200

_COUNTED = "_g long, _s double, _seg int, _bucket int, _n long, _within long, _data binary"


def _ranks(v: np.ndarray) -> np.ndarray:
    rank = np.empty(len(v), np.int64)
    rank[np.argsort(v, kind="stable")] = np.arange(len(v))
    return rank


def _block(points: pd.DataFrame, tries: pd.DataFrame) -> pd.DataFrame:
    """One block under every tried slope: falling pairs inside it, and its sorted rests by bucket."""
    out = []
    order = np.lexsort((points["_y"], points["_x"]))
    x, y = points["_x"].to_numpy()[order], points["_y"].to_numpy()[order]
    for g, seg, s, rests in tries.itertuples(index=False):
        bounds = np.frombuffer(rests).reshape(-1, 2)
        r = y - s * x
        within = inversions(_ranks(r)) if len(r) else 0
        to = np.argsort(r, kind="stable")
        r, at = r[to], x[to]
        # Equal rests are told apart by time, so that no bucket has to hold all of them.
        cut = []
        for b, t in bounds:
            lo, hi = np.searchsorted(r, b, "left"), np.searchsorted(r, b, "right")
            cut.append(int(lo + np.searchsorted(at[lo:hi], t, "right")))
        edges = [0, *cut, len(r)]
        for k in range(len(edges) - 1):
            part = r[edges[k] : edges[k + 1]]
            if len(part):
                out.append((g, s, seg, k, len(part), within, part.tobytes()))
                within = 0
    return pd.DataFrame(out, columns=["_g", "_s", "_seg", "_bucket", "_n", "_within", "_data"])


def _bucket(f: pd.DataFrame) -> pd.DataFrame:
    """Falling pairs of a bucket between blocks: each block's rests are in order already."""
    f = f.sort_values("_seg")
    r = np.concatenate([np.frombuffer(b) for b in f["_data"]])
    return pd.DataFrame({"_g": f["_g"].iloc[:1], "_s": f["_s"].iloc[:1], "_less": [inversions(_ranks(r))]})


def _less(points: DataFrame, segs: DataFrame, sample: DataFrame, tries: DataFrame) -> DataFrame:
    """``_g, _s, _less``: how many slopes of each group are below each tried one."""

    def bounds(f: pd.DataFrame) -> pd.DataFrame:
        r, x = f["_y"].to_numpy() - f["_s"].iloc[0] * f["_x"].to_numpy(), f["_x"].to_numpy()
        order = np.lexsort((x, r))[SAMPLED_EACH // 2 :: SAMPLED_EACH]
        rests = np.unique(np.stack([r[order], x[order]], 1), axis=0).tobytes()
        return pd.DataFrame({"_g": f["_g"].iloc[:1], "_s": f["_s"].iloc[:1], "_rests": [rests]})

    limits = sample.join(tries, "_g").groupBy("_g", "_s").applyInPandas(bounds, "_g long, _s double, _rests binary")
    asked = segs.join(limits, "_g").select("_g", SEG, "_s", "_rests").toDF("_group", "_block", "_s", "_rests")
    parts = points.groupBy("_g", SEG).cogroup(asked.groupBy("_group", "_block")).applyInPandas(_block, _COUNTED)
    parts = cut_lineage(parts)
    inside = parts.groupBy("_g", "_s").agg(F.sum("_within").alias("_less"))
    shared = parts.select("_g", "_s", "_seg", "_bucket", "_data").groupBy("_g", "_s", "_bucket")
    shared = shared.applyInPandas(_bucket, "_g long, _s double, _less long")
    # Points of earlier blocks in higher buckets: sums over blocks inside a bucket first, then over the buckets above.
    earlier = Window.partitionBy("_g", "_s", "_bucket").orderBy("_seg").rowsBetween(Window.unboundedPreceding, -1)
    grid = segs.join(parts.select("_g", "_s", "_bucket").distinct(), "_g")
    full = grid.join(parts.select("_g", "_s", "_bucket", "_seg", "_n"), ["_g", "_s", "_bucket", SEG], "left").fillna(0, ["_n"])
    above = Window.partitionBy("_g", "_s", "_seg").orderBy(F.col("_bucket").desc()).rowsBetween(Window.unboundedPreceding, -1)
    full = full.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    full = full.withColumn("_over", F.coalesce(F.sum("_before").over(above), F.lit(0)))
    apart = full.groupBy("_g", "_s").agg(F.sum(F.col("_n") * F.col("_over")).alias("_less"))
    return inside.unionByName(shared).unionByName(apart).groupBy("_g", "_s").agg(F.sum("_less").alias("_less"))


def _wanted(points: DataFrame) -> DataFrame:
    """Per group its number of slopes, medians, and the wanted ranks: both middle ones and the ends of the interval."""

    def ties(col):
        c = points.groupBy("_g", col).agg(F.count(F.lit(1)).alias("c"))
        k = F.col("c").cast("double")
        same = F.sum(F.expr("c * (c - 1) div 2"))
        return c.groupBy("_g").agg(same.alias(f"_same{col}"), F.sum(k * (k - 1) * (2 * k + 5)).alias(f"_ties{col}"))

    of = points.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")).join(ties("_x"), "_g").join(ties("_y"), "_g")
    n = F.col("_n").cast("double")
    var = (n * (n - 1) * (2 * n + 5) - F.col("_ties_x") - F.col("_ties_y")) / 18
    of = of.withColumn("_pairs", F.expr("_n * (_n - 1) div 2") - F.col("_same_x")).filter("_pairs > 0")
    half = Z95 * F.sqrt(F.greatest(var, F.lit(0.0))) / 2
    last, mid = F.col("_pairs") - 1, F.col("_pairs") / 2
    ranks = {
        "low": F.greatest(F.rint(mid - half).cast("long") - 1, F.lit(0)),
        "mid1": F.expr("(_pairs - 1) div 2"),
        "mid2": F.expr("_pairs div 2"),
        "high": F.least(F.rint(mid + half).cast("long"), last),
    }
    rows = F.array(*[F.struct(F.lit(k).alias("_what"), v.alias("_k")) for k, v in ranks.items()])
    return of.select("_g", "_pairs", F.explode(rows).alias("_r")).select("_g", "_pairs", "_r.*")


def _tries(state: DataFrame) -> DataFrame:
    """Slopes to try inside the open brackets: around the straight line's place, evenly, or beyond a known end."""
    lo, hi, w = F.col("_lo"), F.col("_hi"), F.col("_width")
    share = (F.col("_k") - F.col("_below_lo") + 0.5) / (F.col("_below_hi") - F.col("_below_lo"))
    inner = [lo + (hi - lo) * F.greatest(F.least(share + d, F.lit(1 - 1e-3)), F.lit(1e-3)) for d in (-ASIDE, 0.0, ASIDE)]
    tries = (
        F.when(lo.isNull() & hi.isNull(), F.array(F.lit(0.0), -w, w))
        .when(lo.isNull(), F.array(hi - w, hi - 8 * w))
        .when(hi.isNull(), F.array(lo + w, lo + 8 * w))
        .otherwise(F.array(*inner, *[lo + (hi - lo) * (i / EVENLY) for i in range(1, EVENLY)]))
    )
    return state.filter("not _done").select("_g", F.explode(tries).alias("_s")).distinct()


def long_theil_sen(points: DataFrame, rows: int) -> DataFrame:
    """``_g, slope, slope_low, slope_high`` for points ``_g`` (a number of the group), ``_x``, ``_y`` (doubles).

    ``rows`` is about the number of points of a block and of a bucket. Points of one time share a block. A slope is right
    to the rounding of the rests or a part in 1e12 of the median size of slopes. Groups without two different times have no row.
    """
    cuts = _cut_table(points, ["_g"], "_x", rows)
    if cuts is None:
        cuts = points.select("_g", F.array().cast("array<double>").alias("_cuts")).limit(0)
    points = join_few(points, cuts, ["_g"]).withColumn(SEG, _position(F.col("_cuts"), F.col("_x"))).select("_g", SEG, "_x", "_y")
    points = cut_lineage(points)
    segs = cut_lineage(points.select("_g", SEG).distinct())
    sample = cut_lineage(points.filter(F.rand(7) < min(1.0, SAMPLED_EACH / rows)).select("_g", "_x", "_y"))
    by_chance = Window.partitionBy("_g").orderBy(F.xxhash64("_x", "_y"))
    drawn = sample.withColumn("_px", F.lag("_x").over(by_chance)).withColumn("_py", F.lag("_y").over(by_chance))
    drawn = F.abs((F.col("_y") - F.col("_py")) / F.nullif(F.col("_x") - F.col("_px"), F.lit(0.0))), drawn
    width = drawn[1].groupBy("_g").agg(F.percentile_approx(drawn[0], 0.5).alias("_width"))
    state = _wanted(points).join(width, "_g", "left").select(
        "_g", "_what", "_k", F.when(F.col("_width") > 0, F.col("_width")).otherwise(1.0).alias("_width"),
        F.coalesce("_width", F.lit(0.0)).alias("_spread"),
        F.lit(None).cast("double").alias("_lo"), F.lit(None).cast("double").alias("_hi"),
        F.lit(0).cast("long").alias("_below_lo"), F.col("_pairs").alias("_below_hi"), F.lit(False).alias("_done"),
    )
    state = cut_lineage(state)
    for _ in range(MAX_ROUNDS):
        tries = cut_lineage(_tries(state))
        if tries.isEmpty():
            break
        told = _less(points, segs, sample, tries).join(tries, ["_g", "_s"])
        seen = state.join(told, "_g", "left")
        low, high = F.col("_less") <= F.col("_k"), F.col("_less") > F.col("_k")
        here = (F.col("_lo").isNull() | (F.col("_s") > F.col("_lo"))) & (F.col("_hi").isNull() | (F.col("_s") < F.col("_hi")))
        key = ["_g", "_what", "_k", "_width", "_spread", "_done"]
        new = seen.groupBy(*key).agg(
            F.max(F.struct("_lo", "_below_lo")).alias("_a"),
            F.min(F.struct("_hi", "_below_hi")).alias("_b"),
            F.max(F.when(low & here, F.struct("_s", "_less"))).alias("_up"),
            F.min(F.when(high & here, F.struct("_s", "_less"))).alias("_down"),
        )
        lo, hi = F.coalesce("_up._s", "_a._lo"), F.coalesce("_down._s", "_b._hi")
        stuck = F.col("_up").isNull() & F.col("_down").isNull()
        near = (hi - lo) <= NARROW * F.greatest(F.abs(lo), F.abs(hi), F.col("_spread"))
        state = cut_lineage(new.select(
            "_g", "_what", "_k",
            F.when(lo.isNull() | hi.isNull(), 8 * F.col("_width")).otherwise(F.col("_width")).alias("_width"), "_spread",
            lo.alias("_lo"), hi.alias("_hi"),
            F.coalesce("_up._less", "_a._below_lo").alias("_below_lo"), F.coalesce("_down._less", "_b._below_hi").alias("_below_hi"),
            (F.col("_done") | stuck | F.coalesce(near, F.lit(False))).alias("_done"),
        ))
    else:
        raise RuntimeError("slopes did not settle")
    found = state.groupBy("_g").agg(*[F.max(F.when(F.col("_what") == k, F.col("_lo"))).alias(k) for k in ("low", "mid1", "mid2", "high")])
    return found.select("_g", ((F.col("mid1") + F.col("mid2")) / 2).alias("slope"), F.col("low").alias("slope_low"), F.col("high").alias("slope_high"))
