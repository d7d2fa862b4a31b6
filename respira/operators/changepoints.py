"""Change points of many series at once, in the mean or (``model="rbf"``) in the whole distribution.

A series is taken whole (or averaged per group, or thinned where ``max_samples`` asks for it). Segment costs come from prefix sums, so
binary segmentation evaluates every split of every segment of every series in one aggregation per round; only the small
table of cuts passes between rounds.
"""

from __future__ import annotations

import pickle
from statistics import NormalDist

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from respira.plans.series import Series, _position, join_few, null_safe_join
from respira.plans.sizing import cut_lineage, store_if_costly


#: Frequencies that stand for the Gaussian kernel, and quantiles that its width is taken from.
FREQUENCIES = 16
GRID = 64
#: Positions whose kernel features are summed by one window, and such blocks that a task takes.
BLOCK = 100_000
TASK_BLOCKS = 4


def prepare_signal(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    flag: str | None = None,
    group: str | None = None,
    max_samples: int | None = None,
) -> DataFrame:
    """Signal rows ``keys, i, at, x, step`` with 0-based position ``i``: good rows only, averaged per ``group`` or thinned."""
    d = df.filter(F.col(value).isNotNull())
    if flag:
        d = d.filter(F.col(flag) == 0)
    if group:
        d = d.groupBy(*keys, group).agg(F.min(order[0]).alias("at"), F.avg(value).alias("x"))
        s = Series.of(d, keys, ["at", group]).row_number("_rn")
        return s.df.select(*keys, (F.col("_rn") - 1).alias("i"), "at", "x", F.lit(1).cast("bigint").alias("step"))
    s = Series.of(d, keys, order).row_number("_rn")
    if max_samples is None:
        return s.df.select(
            *keys, (F.col("_rn") - 1).alias("i"), F.col(order[0]).alias("at"), F.col(value).cast("double").alias("x"),
            F.lit(1).cast("bigint").alias("step"),
        )
    n = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    d = join_few(s.df, n, keys).withColumn("step", F.greatest(F.lit(1), F.ceil(F.col("_n") / max_samples)))
    d = d.withColumn("_i", F.col("_rn") - 1).filter(F.col("_i") % F.col("step") == 0)
    return d.select(
        *keys, (F.col("_i") / F.col("step")).cast("bigint").alias("i"), F.col(order[0]).alias("at"),
        F.col(value).cast("double").alias("x"), "step",
    )


def _min_size(signal_min: int) -> Column:
    return F.greatest(F.lit(2), F.floor(F.lit(signal_min) / F.col("step")))


def _with_sums(signal: DataFrame, keys: list[str]) -> DataFrame:
    """Prefix sums of the centred signal: ``s1`` and ``s2`` are sums over positions below ``i``."""
    mean = signal.groupBy(*keys).agg(F.avg("x").alias("_m"), F.count(F.lit(1)).alias("n"))
    c = join_few(signal, mean, keys).withColumn("_c", F.col("x") - F.col("_m"))
    s = Series.of(c, keys, ["i"]).running_sum({"_s1": F.col("_c"), "_s2": F.col("_c") * F.col("_c")})
    return s.df.select(
        *keys, "i", "at", "x", "step", "n", (F.col("_s1") - F.col("_c")).alias("s1"),
        (F.col("_s2") - F.col("_c") * F.col("_c")).alias("s2"), F.col("_c").alias("c"),
    )


def _cost(s1: Column, s2: Column, n: Column) -> Column:
    return s2 - F.try_divide(s1 * s1, n.cast("double"))


def _kernel_sums(signal: DataFrame, keys: list[str], gamma: float | None) -> tuple[DataFrame, DataFrame]:
    """Prefix sums ``s1`` of the kernel's features of each reading (an array) and ``s2``, their squared length; the sums
    ``n, s1`` of whole series.

    The Gaussian kernel of one variable is a mean of cosines over normally spread frequencies; ``FREQUENCIES`` of them, at
    even steps of probability, give a cosine and a sine each. Squares of these features are what the kernel cost counts,
    so sums replace the table of all pairs. Without ``gamma`` it is one over the median squared distance of two readings,
    taken over a grid of quantiles (1 where that is 0).

    Positions are dense, so blocks of ``BLOCK`` of them are cut without a look at the data. Readings are dealt to tasks by
    block and get their many features only there; between blocks go their sums, a row each.
    """
    d = signal.withColumn("_g", F.lit(gamma))
    if gamma is None:
        share = [(q + 0.5) / GRID for q in range(GRID)]
        grid = signal.groupBy(*keys).agg(F.percentile_approx("x", F.array(*map(F.lit, share)), F.lit(10_000)).alias("_q"))
        gaps = F.transform("_q", lambda a: F.transform("_q", lambda b: (a - b) * (a - b)))
        middle = F.try_element_at(F.array_sort(F.flatten(gaps)), F.lit(GRID * GRID // 2))
        grid = grid.select(*keys, F.when(middle > 0, F.try_divide(F.lit(1.0), middle)).otherwise(1.0).alias("_g"))
        d = join_few(signal, grid, keys)
    unit, size = NormalDist(), (1 / FREQUENCIES) ** 0.5
    turns = [F.sqrt(2 * F.col("_g")) * unit.inv_cdf(0.5 + (j + 0.5) / (2 * FREQUENCIES)) * F.col("x") for j in range(FREQUENCIES)]
    names = [f"_f{j}" for j in range(2 * FREQUENCIES)]
    parts = [size * wave(t) for t in turns for wave in (F.cos, F.sin)]
    d = d.withColumn("_blk", F.floor(F.col("i") / BLOCK))
    features = dict(zip(names, parts, strict=True))
    sums = d.withColumns(features).groupBy(*keys, "_blk").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(n).alias(n) for n in names])
    sums = cut_lineage(sums)
    whole = sums.groupBy(*keys).agg(F.sum("_n").alias("n"), F.array(*[F.sum(n) for n in names]).alias("s1"))
    before = Window.partitionBy(*keys).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(*keys, "_blk", F.array(*[F.coalesce(F.sum(n).over(before), F.lit(0.0)) for n in names]).alias("_carry"))
    tasks = max(int(signal.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-sums.count() // TASK_BLOCKS))
    # Dealt and sorted before the features are there, so neither carries them.
    d = d.repartition(tasks, *keys, "_blk").sortWithinPartitions(*keys, "_blk", "i").withColumns(features)
    w = Window.partitionBy(*keys, "_blk").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_own", F.array(*[F.sum(n).over(w) - F.col(n) for n in names])).drop(*names)
    d = join_few(d, carry, [*keys, "_blk"])
    below = F.array(*[F.col("_carry")[j] + F.col("_own")[j] for j in range(2 * FREQUENCIES)])
    return d.select(*keys, "i", "at", "x", "step", below.alias("s1"), F.col("i").cast("double").alias("s2")), whole


def _kernel_cost(s1: list[Column], s2: Column, n: Column) -> Column:
    square = F.lit(0.0)
    for s in s1:
        square = square + s * s
    return s2 - F.try_divide(square, n.cast("double"))


def _split_gains(
    rows: DataFrame, ends: DataFrame, keys: list[str], min_size: int, jump: int, kernel: bool = False
) -> DataFrame:
    """Best split ``(gain, k)`` of every segment, with the prefix sums at ``k``.

    ``ends`` holds per series the sorted cuts ``(k, s1, s2)``, 0 and n included, so one aggregation scores all splits.
    """
    d = join_few(rows, ends.withColumn("_ks", F.transform("_cuts", lambda c: c["k"])), keys, "inner")
    pos = _position(F.col("_ks"), F.col("i"))
    d = d.withColumn("_p", pos).withColumn("_a", F.try_element_at("_cuts", F.col("_p")))
    d = d.withColumn("_b", F.try_element_at("_cuts", F.col("_p") + 1))
    lo, a1, a2 = (F.col("_a")[c] for c in ("k", "s1", "s2"))
    hi, b1, b2 = (F.col("_b")[c] for c in ("k", "s1", "s2"))
    i, s1, s2 = F.col("i"), F.col("s1"), F.col("s2")
    if kernel:
        minus = lambda p, q: [p[j] - q[j] for j in range(2 * FREQUENCIES)]
        parts = (minus(b1, a1), b2 - a2, hi - lo), (minus(s1, a1), s2 - a2, i - lo), (minus(b1, s1), b2 - s2, hi - i)
        whole, left, right = (_kernel_cost(*p) for p in parts)
        gain = whole - left - right
    else:
        gain = _cost(b1 - a1, b2 - a2, hi - lo) - _cost(s1 - a1, s2 - a2, i - lo) - _cost(b1 - s1, b2 - s2, hi - i)
    size = _min_size(min_size)
    ok = (i - lo >= size) & (hi - i >= size) & ((i - lo) % jump == 0)
    hit = F.struct(gain.alias("gain"), i.alias("k"), "s1", "s2")
    best = d.filter(ok).groupBy(*keys, lo.alias("lo")).agg(F.max(hit).alias("_g"))
    return best.select(*keys, "lo", "_g.*")


def binary_segmentation(
    signal: DataFrame,
    keys: list[str],
    penalty: float | None = 10.0,
    n_breaks: int | None = None,
    min_size: int = 2,
    jump: int = 1,
    model: str = "l2",
    gamma: float | None = None,
) -> DataFrame:
    """Break positions ``keys, k, gain, round``; a break at ``k`` starts a new segment at position ``k``.

    With ``n_breaks`` each round splits the most profitable segment of a series; otherwise all segments whose gain
    exceeds ``penalty`` are split at once, which gives the same breaks as one at a time. ``model`` is ``l2`` (squares,
    shifts of the mean) or ``rbf`` (Gaussian kernel ``exp(-gamma * d * d)``, any change of distribution).
    """
    if model not in ("l2", "rbf"):
        raise ValueError(f"model must be l2 or rbf, not {model}")
    kernel = model == "rbf"
    rows, whole = _kernel_sums(signal, keys, gamma) if kernel else (_with_sums(signal, keys).drop("n"), None)
    rows = cut_lineage(rows)
    zero = F.struct(F.lit(0).cast("bigint").alias("k"), F.lit(0.0).alias("s1"), F.lit(0.0).alias("s2"))
    total = F.struct(F.count(F.lit(1)).alias("k"), F.sum("c").alias("s1"), F.sum(F.col("c") * F.col("c")).alias("s2"))
    if kernel:
        none = F.array(*[F.lit(0.0)] * 2 * FREQUENCIES)
        zero = F.struct(F.lit(0).cast("bigint").alias("k"), none.alias("s1"), F.lit(0.0).alias("s2"))
        total = F.struct(F.col("n").alias("k"), "s1", F.col("n").cast("double").alias("s2"))
        base = whole.select(*keys, F.array(zero, total).alias("_cuts"))
    else:
        base = rows.groupBy(*keys).agg(F.array(zero, total).alias("_cuts"))
    ends, found, rnd = base, None, 0
    while n_breaks is None or rnd < n_breaks:
        rnd += 1
        best = _split_gains(rows, ends, keys, min_size, jump, kernel)
        if n_breaks is not None:
            w = Window.partitionBy(*keys).orderBy(F.desc("gain"), F.desc("k"))
            best = best.withColumn("_r", F.row_number().over(w)).filter("_r = 1 AND gain > 0").drop("_r")
        else:
            best = best.filter(F.col("gain") > penalty)
        best = best.withColumn("round", F.lit(rnd)).drop("lo")
        # The few new cuts are stored, so a round reads the stored signal and stored cuts only.
        if rnd != n_breaks:
            best = cut_lineage(best)
        if n_breaks is None and best.isEmpty():
            break
        found = best if found is None else found.unionByName(best)
        new = found.groupBy(*keys).agg(F.collect_list(F.struct("k", "s1", "s2")).alias("_new"))
        none = F.array().cast(base.schema["_cuts"].dataType)
        ends = null_safe_join(base, new, keys).withColumn(
            "_cuts", F.array_sort(F.concat("_cuts", F.coalesce("_new", none)))
        )
        ends = ends.drop("_new")
    found = found.drop("s1", "s2") if found is not None else None
    if found is None:
        fields = [signal.schema[k] for k in keys]
        schema = T.StructType(
            [*fields, T.StructField("k", T.LongType()), T.StructField("gain", T.DoubleType()), T.StructField("round", T.IntegerType())]
        )
        return signal.sparkSession.createDataFrame([], schema)
    return found


def window_discrepancy(
    signal: DataFrame,
    keys: list[str],
    width: int = 100,
    penalty: float = 10.0,
    n_breaks: int | None = None,
    model: str = "l2",
    gamma: float | None = None,
) -> DataFrame:
    """Breaks where the two half windows around a position differ most: local maxima of the discrepancy.

    ``width`` is halved for series shorter than two widths. Maxima above ``penalty`` (or the ``n_breaks`` highest) count.
    ``model`` and ``gamma`` as for :func:`binary_segmentation`.
    """
    if model not in ("l2", "rbf"):
        raise ValueError(f"model must be l2 or rbf, not {model}")
    if model == "rbf":
        rows = join_few(_kernel_sums(signal, keys, gamma)[0], signal.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")), keys)
    else:
        rows = _with_sums(signal, keys)
    small = F.when(F.col("n") < 2 * width, F.floor(F.col("n") / 2)).otherwise(width)
    rows = rows.withColumn("_h", F.floor(small / 2))
    back, here = rows.select(*keys, "i", "s1", "s2", "_h", "n"), rows.select(*keys, "i", "s1", "s2")
    j = back
    for tag, shift in (("a", -1), ("b", 1)):
        other = here.select(*keys, F.col("i").alias("_o"), F.col("s1").alias(f"{tag}1"), F.col("s2").alias(f"{tag}2"))
        j = null_safe_join(j.withColumn("_o", F.col("i") + shift * F.col("_h")), other, [*keys, "_o"], "inner").drop("_o")
    s1, s2, h = F.col("s1"), F.col("s2"), F.col("_h")
    a1, a2, b1, b2 = (F.col(c) for c in ("a1", "a2", "b1", "b2"))
    if model == "rbf":
        minus = lambda p, q: [p[c] - q[c] for c in range(2 * FREQUENCIES)]
        parts = (minus(b1, a1), b2 - a2, 2 * h), (minus(s1, a1), s2 - a2, h), (minus(b1, s1), b2 - s2, h)
        whole, left, right = (_kernel_cost(*p) for p in parts)
        score = whole - left - right
    else:
        score = _cost(b1 - a1, b2 - a2, 2 * h) - _cost(s1 - a1, s2 - a2, h) - _cost(b1 - s1, b2 - s2, h)
    j = j.withColumn("gain", score)
    half = width // 2
    s = Series.of(j, keys, ["i"]).rows_frame(half, half, {"_top": lambda w: F.max("gain").over(w)})
    peaks = s.df.filter((F.col("gain") == F.col("_top")) & (F.col("gain") > (penalty if n_breaks is None else 0)))
    peaks = peaks.select(*keys, F.col("i").alias("k"), "gain")
    if n_breaks is not None:
        w = Window.partitionBy(*keys).orderBy(F.desc("gain"), "k")
        peaks = peaks.withColumn("_r", F.row_number().over(w)).filter(F.col("_r") <= n_breaks).drop("_r")
    return peaks


#: Positions of a series that one task searches before it passes on what is still open.
RANGE_ROWS = 200_000


class _Search:
    """Optimal mean-shift partition, position by position; only starts that can still win are held.

    A start that loses to position ``e`` can win until a segment from ``e`` is long enough.
    """

    def __init__(self, penalty: float, size: int):
        self.penalty, self.size, self.e = penalty, size, 0
        self.open = np.array([[0.0], [-penalty], [0.0], [0.0], [np.inf]])  # start, cost, sums below it, end of its life
        self.wait: list[tuple] = []  # starts too near for a segment

    def advance(self, t1: np.ndarray, t2: np.ndarray) -> np.ndarray:
        """Best last start of each further position, given the sums of the series up to it."""
        prev = np.zeros(len(t1), np.int64)
        for j, (a, b) in enumerate(zip(t1.tolist(), t2.tolist(), strict=True)):
            self.e = e = self.e + 1
            if e < self.size:
                continue
            ready = [w for w in self.wait if w[0] <= e - self.size]
            if ready:
                self.open = np.concatenate([self.open, np.array(ready).T], axis=1)
                self.wait = self.wait[len(ready) :]
            if (self.open[4] <= e).any():
                self.open = self.open[:, self.open[4] > e]
            at, cost, s1, s2, life = self.open
            total = cost + (b - s2) - (a - s1) ** 2 / (e - at) + self.penalty
            k = int(np.argmin(total))
            prev[j] = at[k]
            lost = total > total[k] + self.penalty
            life[lost] = np.minimum(life[lost], e + self.size)
            self.wait.append((float(e), float(total[k]), a, b, np.inf))
        return prev


def _pelt(x: np.ndarray, penalty: float, min_size: int) -> list[int]:
    """Optimal mean-shift partition of a short series."""
    c = x - x.mean()
    prev = _Search(penalty, min_size).advance(np.cumsum(c), np.cumsum(c * c))
    cuts, e = [], len(x)
    while e > 0 and prev[e - 1] > 0:
        e = int(prev[e - 1])
        cuts.append(e)
    return cuts[::-1]


def optimal_partition(signal: DataFrame, keys: list[str], penalty: float = 10.0, min_size: int = 2) -> DataFrame:
    """Penalised optimum over all partitions of each whole series.

    Prefix sums are a table. A task searches ``RANGE_ROWS`` positions of a series and passes its open starts with their
    costs to the next range; then the best starts are followed back, range by range. Series run in parallel, the ranges
    of one series in turn.
    """
    fields = [signal.schema[k] for k in keys]
    rows = _with_sums(signal, keys).withColumn("_r", F.floor(F.col("i") / RANGE_ROWS).cast("bigint"))
    rows = cut_lineage(rows.select(*keys, "i", "step", "n", "_r", (F.col("s1") + F.col("c")).alias("t1"), (F.col("s2") + F.col("c") * F.col("c")).alias("t2")))
    last = rows.agg(F.max("_r")).first()[0]
    kind = T.StructType([*fields, *[T.StructField(c, T.LongType()) for c in ("e", "prev")], T.StructField("state", T.BinaryType())])
    empty = signal.sparkSession.createDataFrame([], kind)

    def forth(pdf: pd.DataFrame, state: pd.DataFrame) -> pd.DataFrame:
        if not len(pdf):
            return state.iloc[:0]
        pdf = pdf.sort_values("i")
        search = pickle.loads(state["state"].iloc[0]) if len(state) else _Search(penalty, max(2, int(min_size // pdf["step"].iloc[0])))
        prev = search.advance(pdf["t1"].to_numpy(), pdf["t2"].to_numpy())
        out = pdf[keys].assign(e=pdf["i"].to_numpy() + 1, prev=prev, state=None)
        more = pdf.iloc[[0]][keys].assign(e=-1, prev=-1, state=pickle.dumps(search)) if pdf["i"].iloc[-1] + 1 < pdf["n"].iloc[0] else out.iloc[:0]
        return pd.concat([out, more]) if len(more) else out

    def back(pdf: pd.DataFrame, at: pd.DataFrame) -> pd.DataFrame:
        # prev is 0 for a place to go on from, 1 for a cut.
        one = pdf if len(pdf) else at
        e = int(at["e"].iloc[0]) if len(at) else int(pdf["e"].max())
        prev, cuts = dict(zip(pdf["e"], pdf["prev"], strict=True)), []
        while e in prev:
            e = int(prev[e])
            cuts += [e] if e > 0 else []
        ks = [*cuts, e]
        return one.iloc[[0] * len(ks)][keys].assign(e=ks, prev=[1] * len(cuts) + [0], state=None)

    pointers, state = [], empty
    for r in range(-1 if last is None else last + 1):
        part = rows.filter(F.col("_r") == r).groupBy(*keys).cogroup(state.groupBy(*keys)).applyInPandas(forth, kind)
        part = cut_lineage(part)
        pointers.append(part.filter("e > 0"))
        state = part.filter("e < 0")
    found, at = empty, empty
    for part in reversed(pointers):
        step = cut_lineage(part.groupBy(*keys).cogroup(at.groupBy(*keys)).applyInPandas(back, kind))
        found, at = found.unionByName(step.filter("prev = 1")), step.filter("prev = 0")
    return found.select(*keys, F.col("e").alias("k"))


def segment_table(signal: DataFrame, keys: list[str], breaks: DataFrame) -> DataFrame:
    """One row per segment: ``segment, start, end, n, mean, std`` (population) with the sums they came from."""
    cuts = breaks.groupBy(*keys).agg(F.array_sort(F.collect_set("k")).alias("_cuts"))
    d = join_few(signal, cuts, keys).withColumn("segment", _position(F.col("_cuts"), F.col("i")))
    return d.groupBy(*keys, "segment").agg(
        F.min("i").alias("k"),
        F.min("at").alias("start"),
        F.max("at").alias("end"),
        F.count(F.lit(1)).alias("n"),
        F.avg("x").alias("mean"),
        F.stddev_pop("x").alias("std"),
    )


def confidence(prev_mean: Column, prev_std: Column, mean: Column, std: Column) -> Column:
    """Mean shift in units of three average standard deviations, at most 1."""
    diff, pooled = F.abs(mean - prev_mean), (prev_std + std) / 2
    flat = F.when(diff > 0, 1.0).otherwise(0.0)
    return F.when(pooled > 0, F.least(F.lit(1.0), F.try_divide(diff, 3 * pooled))).otherwise(flat)


def breakpoint_table(segments: DataFrame, keys: list[str]) -> DataFrame:
    """One row per break with the means before and after, the shift and the confidence (2 decimals)."""
    w = Window.partitionBy(*keys).orderBy("segment")
    d = segments.withColumns({f"prev_{c}": F.lag(c).over(w) for c in ("mean", "std", "end")})
    d = d.filter(F.col("prev_mean").isNotNull())
    conf = confidence(F.col("prev_mean"), F.col("prev_std"), F.col("mean"), F.col("std"))
    return d.select(
        *keys,
        "k",
        F.col("prev_end").alias("last_before"),
        F.col("start").alias("first_after"),
        "prev_mean",
        F.col("mean").alias("new_mean"),
        (F.col("mean") - F.col("prev_mean")).alias("shift"),
        F.bround(conf, 2).alias("confidence"),
    )


def prune_breaks(segments: DataFrame, keys: list[str], min_confidence: float) -> DataFrame:
    """Drop the least certain break of a series, merge its segments and repeat until all reach ``min_confidence``.

    Works on the segment table, a few rows per series. Returns the kept breaks ``keys, k``.
    """
    fields = [segments.schema[k] for k in keys]

    def score(a: tuple, b: tuple) -> float:
        (n1, m1, s1), (n2, m2, s2) = a, b
        pooled = (s1 + s2) / 2
        return min(1.0, abs(m2 - m1) / (3 * pooled)) if pooled > 0 else float(m1 != m2)

    def merge(a: tuple, b: tuple) -> tuple:
        (n1, m1, s1), (n2, m2, s2) = a, b
        n = n1 + n2
        m = (n1 * m1 + n2 * m2) / n
        var = (n1 * (s1 * s1 + (m1 - m) ** 2) + n2 * (s2 * s2 + (m2 - m) ** 2)) / n
        return n, m, var**0.5

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("segment")
        segs = list(zip(pdf["n"], pdf["mean"], pdf["std"], strict=True))
        ks = list(pdf["k"])[1:]
        while ks:
            scores = [score(segs[j], segs[j + 1]) for j in range(len(ks))]
            j = int(np.argmin(scores))
            if scores[j] >= min_confidence:
                break
            segs[j : j + 2] = [merge(segs[j], segs[j + 1])]
            ks.pop(j)
        return pdf.iloc[[0] * len(ks)][keys].assign(k=np.array(ks, dtype="int64"))

    return segments.groupBy(*keys).applyInPandas(run, T.StructType([*fields, T.StructField("k", T.LongType())]))


def major_breaks(breaks: DataFrame, min_confidence: float = 0.3, min_shift: float = 15.0) -> DataFrame:
    """Breaks that are certain and large enough."""
    return breaks.filter((F.col("confidence") >= min_confidence) & (F.abs("shift") >= min_shift))
