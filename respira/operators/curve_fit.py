"""Least squares of a curve within bounds, for all groups at once: damped Gauss-Newton rounds over one aggregation each."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respira.plans.series import join_few, null_safe_join
from respira.plans.sizing import write_once

#: Relative step below which a group is done.
STEP = 1e-10
#: Damping at the start, and where no smaller step is tried.
DAMPING, MOST_DAMPING = 1e-3, 1e14
#: Trials of one round: these times the damping that did best last.
TRIALS = (0.1, 1.0, 10.0)


class Parameter(NamedTuple):
    name: str
    start: float
    low: float
    high: float


def _step(x: np.ndarray, jj: np.ndarray, jr: np.ndarray, damping: float, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Next trial: a damped step of the parameters that no bound holds back.

    Parameters that would leave their range are put on its end, and the step of the others is found again.
    """
    a = jj + damping * np.diag(np.maximum(np.diag(jj), 1e-300))
    fixed = (x <= low) & (jr <= 0) | (x >= high) & (jr >= 0)
    step = np.zeros(len(x))
    while not fixed.all():
        free = ~fixed
        step[free] = np.linalg.lstsq(a[np.ix_(free, free)], jr[free] - a[np.ix_(free, fixed)] @ step[fixed], rcond=None)[0]
        out = free & ((x + step < low) | (x + step > high))
        if not out.any():
            break
        step[out] = np.clip(x + step, low, high)[out] - x[out]
        fixed |= out
    return np.clip(x + step, low, high)


_STATE = "x array<double>, sums array<double>, rss double, damping double, trial array<double>, done boolean"


def _advance(parameters: Sequence[Parameter]):
    """Scalar pandas UDF on one row a group: takes or refuses the trial and sets the next one."""
    low, high = (np.array([p[i] for p in parameters], float) for i in (2, 3))
    p = len(parameters)
    upper = np.triu_indices(p)

    def one(x, sums, rss, damping, trial, done, new_sums, new_rss):
        if done:
            return x, sums, rss, damping, trial, True
        trial, new_sums = (np.array(v, float).reshape(len(TRIALS), -1) for v in (trial, new_sums))
        best = int(np.nanargmin(new_rss)) if np.isfinite(new_rss).any() else 0
        if x is None:
            x, sums, rss, damping = trial[0], new_sums[0], new_rss[0], DAMPING
        elif new_rss[best] < rss:
            x, sums, rss, damping = trial[best], new_sums[best], new_rss[best], max(damping * TRIALS[best], 1e-12)
        else:
            damping = damping * TRIALS[-1] ** 3
        jj = np.zeros((p, p))
        jj[upper] = sums[: len(upper[0])]
        jj = jj + np.triu(jj, 1).T
        x, jr = np.array(x, float), np.array(sums[len(upper[0]) :], float)
        if not np.isfinite([rss, *jr]).all():
            return x, sums, rss, damping, trial.ravel(), True
        nxt = np.stack([_step(x, jj, jr, damping * t, low, high) for t in TRIALS])
        small = np.abs(nxt - x).max() <= STEP * (np.abs(x).max() + STEP)
        return x, sums, rss, damping, nxt.ravel(), bool(small or damping > MOST_DAMPING)

    def run(x: pd.Series, sums: pd.Series, rss: pd.Series, damping: pd.Series, trial: pd.Series, done: pd.Series,
            new_sums: pd.Series, new_rss: pd.Series) -> pd.DataFrame:
        out = [one(*row) for row in zip(x, sums, rss, damping, trial, done, new_sums, new_rss, strict=True)]
        return pd.DataFrame(out, columns=[c.split()[0] for c in _STATE.split(", ")])

    return F.pandas_udf(run, _STATE)


def _errors(p: int):
    """Scalar pandas UDF: standard errors from the sums of the Jacobian's products, residual sum and count."""
    upper = np.triu_indices(p)

    def run(sums: pd.Series, rss: pd.Series, n: pd.Series) -> pd.Series:
        out = []
        for s, r, k in zip(sums, rss, n, strict=True):
            jj = np.zeros((p, p))
            jj[upper] = s[: len(upper[0])]
            v = np.diag(np.linalg.pinv(jj + np.triu(jj, 1).T)) * (r / (k - p) if k > p else np.nan)
            out.append([float(x) ** 0.5 if x >= 0 else None for x in v])
        return pd.Series(out)

    return F.pandas_udf(run, "array<double>")


def fit_curve(
    points: DataFrame,
    by: list[str],
    y: str,
    value: Callable[..., Column],
    slopes: Callable[..., Sequence[Column]],
    parameters: Sequence[Parameter],
    rounds: int = 20,
) -> DataFrame:
    """One row a group: ``by``, ``n``, each parameter and its standard error (``<name>_se``), ``rss``, ``r2``, ``converged``.

    ``value`` and ``slopes`` give the curve and its partial derivatives as columns of the points, from the parameters'
    columns in order. Each round is one aggregation over the points of all groups that are not done: the products of the
    Jacobian, its product with the residuals and the residual sum, at three trials of different damping; the state is a
    stored table with a row a group. The best trial is taken if its residual sum is smaller, else the damping grows. A
    parameter at a bound stays there while the residuals push it outwards. Rows with a null ``y`` are left out; null keys form a group;
    a group that is not done after ``rounds`` keeps its best parameters and ``converged`` false.
    """
    names = [p.name for p in parameters]
    d = points.filter(F.col(y).isNotNull())
    whole = d.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), (F.var_pop(y) * F.count(F.lit(1))).alias("_syy"))
    start = F.array(*[F.lit(float(p.start)) for _ in TRIALS for p in parameters])
    nothing = {"x": "array<double>", "sums": "array<double>", "rss": "double", "damping": "double"}
    state = whole.select(*by, *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()], start.alias("trial"), F.lit(False).alias("done"))
    state = write_once(state)
    p, sums, residuals = len(names), [], []
    for t in range(len(TRIALS)):
        at = [F.col(f"_t{t * p + i}") for i in range(p)]
        j, left = list(slopes(*at)), F.col(y) - value(*at)
        sums += [j[a] * j[b] for a in range(p) for b in range(a, p)] + [x * left for x in j]
        residuals.append(left * left)
    advance = _advance(parameters)
    for _ in range(rounds):
        open_ = state.filter("not done")
        if open_.isEmpty():
            break
        trial = open_.select(*by, *[F.col("trial")[i].alias(f"_t{i}") for i in range(len(TRIALS) * p)])
        g = join_few(d, trial, by, "inner").groupBy(*by).agg(
            F.array(*[F.sum(x) for x in sums]).alias("new_sums"), F.array(*[F.sum(x) for x in residuals]).alias("new_rss")
        )
        g = null_safe_join(state, g, by)
        cols = ["x", "sums", "rss", "damping", "trial", "done", "new_sums", "new_rss"]
        state = write_once(g.coalesce(1).select(*by, advance(*cols).alias("_s")).select(*by, "_s.*"))
    out = null_safe_join(whole, state.select(*by, "x", "sums", "rss", F.col("done").alias("converged")), by)
    out = out.withColumn("_se", _errors(len(names))("sums", "rss", "n"))
    return out.select(
        *by, "n", *[F.col("x")[i].alias(c) for i, c in enumerate(names)], *[F.col("_se")[i].alias(f"{c}_se") for i, c in enumerate(names)],
        "rss", (1 - F.try_divide(F.col("rss"), F.col("_syy"))).alias("r2"), "converged",
    )
