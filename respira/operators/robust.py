"""Minimum covariance determinant: concentration steps of many starts at once, from sums that tasks make of their rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from respira.plans.sizing import cut_lineage

#: Share of a column's squared scale added to each variance, so that repeated or collinear rows keep an inverse.
RIDGE = 1e-9
#: Leading bits of a distance's fraction that the first and the second count of distances tell apart.
FIRST_BITS = 6
SECOND_BITS = 20
_LOW, _HIGH = 2.0**-64, 2.0**64
#: Rows that one block holds, and the schema of a table of blocks.
BLOCK_ROWS = 10_000
_BLOCKS = T.StructType([T.StructField("block", T.BinaryType())])
_PART = T.StructType(
    [T.StructField("s", T.IntegerType()), T.StructField("j", T.LongType()), T.StructField("v", T.DoubleType())]
)


def chi2_quantile(k: int, z: float) -> float:
    """Chi-square quantile with ``k`` degrees of freedom at the normal quantile ``z`` (Wilson and Hilferty)."""
    return k * (1 - 2 / (9 * k) + z * (2 / (9 * k)) ** 0.5) ** 3


def _precision(cov: np.ndarray) -> np.ndarray:
    return np.linalg.inv(cov + RIDGE * np.eye(len(cov)))


def _blocks(rows: DataFrame, cols: list[str]) -> DataFrame:
    """Rows as blocks of doubles, stored: a step then moves one value for many rows, which costs more than its sums."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = batch.to_numpy(dtype=float)
            parts = [x[at : at + BLOCK_ROWS].tobytes() for at in range(0, len(x), BLOCK_ROWS)]
            yield pd.DataFrame({"block": parts})

    return cut_lineage(rows.select(*cols).mapInPandas(run, _BLOCKS))


def _sum_parts(rows: DataFrame, cols: list[str], fits: dict[int, tuple], part: Callable) -> dict[int, dict[int, float]]:
    """Sums over all rows, by fit and number, of what ``part(fit, differences, squared distances)`` adds up for a batch.

    ``rows`` has the columns or blocks of them. Differences from a fit's mean are made in place, a batch and a fit at a
    time; only a task's sums are shuffled.
    """
    known = {s: (np.array(mean, dtype=float), _precision(cov)) for s, (mean, cov) in fits.items()}
    packed, k = rows.schema == _BLOCKS, len(cols)

    def arrays(batches: Iterator[pd.DataFrame]) -> Iterator[np.ndarray]:
        for batch in batches:
            if packed:
                yield from (np.frombuffer(b).reshape(-1, k) for b in batch["block"])
            else:
                yield batch.to_numpy(dtype=float)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple[int, int], float] = {}
        for x in arrays(batches):
            for s, (mean, precision) in known.items():
                diff = x - mean
                d = np.maximum(np.einsum("ij,ij->i", diff @ precision, diff), 0.0)
                for j, v in zip(*part(s, diff, d), strict=True):
                    held[s, int(j)] = held.get((s, int(j)), 0.0) + float(v)
        yield pd.DataFrame([(s, j, v) for (s, j), v in held.items()], columns=["s", "j", "v"])

    out: dict[int, dict[int, float]] = {s: {} for s in fits}
    sums = (rows if packed else rows.select(*cols)).mapInPandas(run, _PART)
    for s, j, v in sums.groupBy("s", "j").agg(F.sum("v")).collect():
        out[s][j] = v
    return out


def _bits(d: np.ndarray, keep: int) -> np.ndarray:
    """Distances as whole numbers in the same order: exponent and the first ``keep`` bits of the fraction."""
    return np.clip(d, _LOW, _HIGH).view(np.int64) >> (52 - keep)


def _cuts(rows: DataFrame, cols: list[str], fits: dict[int, tuple], share: float, keep: int = SECOND_BITS) -> dict[int, float]:
    """Distance of every fit that at least ``share`` of the rows do not pass, rounded up to ``keep`` bits of its fraction.

    One count of all distances by their leading bits finds where the rank lies, a second tells apart what lies there.
    """
    first = _sum_parts(rows, cols, fits, lambda s, diff, d: np.unique(_bits(d, FIRST_BITS), return_counts=True))
    place, rest = {}, {}
    for s, counts in first.items():
        want, below = share * sum(counts.values()), 0.0
        for j in sorted(counts):
            if below + counts[j] >= want * (1 - 1e-12):
                break
            below += counts[j]
        place[s], rest[s] = j, want - below

    def inside(s: int, diff: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        fine = _bits(d, keep)
        return np.unique(fine[fine >> (keep - FIRST_BITS) == place[s]], return_counts=True)

    out = {}
    for s, counts in _sum_parts(rows, cols, fits, inside).items():
        below = 0.0
        for j in sorted(counts):
            below += counts[j]
            if below >= rest[s] * (1 - 1e-12):
                break
        out[s] = float(np.array([(j + 1 << (52 - keep)) - 1], dtype=np.int64).view(float)[0])
    return out


def _near(
    rows: DataFrame, cols: list[str], fits: dict[int, tuple], cuts: dict[int, float] | None = None
) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Mean and covariance of each fit's rows, those within its cut where given, from one pass over the rows."""
    k = len(cols)

    def part(s: int, diff: np.ndarray, d: np.ndarray) -> tuple[range, np.ndarray]:
        y = diff[d <= cuts[s]] if cuts else diff
        return range(1 + k + k * k), np.concatenate([[len(y)], y.sum(axis=0), (y.T @ y).ravel()])

    out = {}
    for s, v in _sum_parts(rows, cols, fits, part).items():
        if v.get(0):
            sums = np.array([v[j] for j in range(1 + k + k * k)])
            off, square = sums[1 : k + 1] / sums[0], sums[k + 1 :].reshape(k, k) / sums[0]
            out[s] = (np.asarray(fits[s][0], dtype=float) + off, square - np.outer(off, off))
    return out


def _spread(cov: np.ndarray) -> float:
    """Logarithm of the determinant, the measure that concentration steps never raise."""
    return float(np.linalg.slogdet(cov + RIDGE * np.eye(len(cov)))[1])


def _scales(rows: DataFrame, cols: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Centre and spread of each column by its quartiles; deviation, else 1, where half of a column is one value."""
    quart = [F.percentile_approx(c, F.array(*map(F.lit, (0.25, 0.5, 0.75))), F.lit(1000)) for c in cols]
    row = rows.agg(*quart, *[F.stddev_pop(c) for c in cols]).first()
    if row[0] is None:
        raise ValueError("no complete row to learn from")
    centre = np.array([q[1] for q in row[: len(cols)]])
    width = [(q[2] - q[0]) / 1.349 or s or 1.0 for q, s in zip(row[: len(cols)], row[len(cols) :], strict=True)]
    return centre, np.array(width, dtype=float)


def robust_covariance(
    rows: DataFrame, cols: list[str], support: float = 0.75, starts: int = 50, keep: int = 5, max_steps: int = 15, seed: int = 42
) -> tuple[np.ndarray, np.ndarray]:
    """Location and precision of the share ``support`` of rows whose covariance has the smallest determinant.

    Starts are the moments of all rows and of ``starts`` draws of (columns + 1) different rows, chosen by hash. All take
    two steps on all rows with coarse cuts; the ``keep`` smallest go on with finer ones until they settle. The best is
    made consistent by its median distance, and rows within the 97.5 % point of chi-square give the final moments.
    Every step reads the whole stored table; rows with a null, NaN or infinite column are left out. Repeated rows count
    each. Raises ``ValueError`` where no row is left.
    """
    k = len(cols)
    known = rows.select(*[F.col(c).cast("double").alias(c) for c in cols])
    for c in cols:
        known = known.filter(F.abs(F.col(c)) < float("inf"))
    centre, width = _scales(known, cols)
    z = [((F.col(c) - float(m)) / float(w)).alias(c) for c, m, w in zip(cols, centre, width, strict=True)]
    rows = cut_lineage(known.select(*z))
    blocks = _blocks(rows, cols)
    fits = _near(blocks, cols, {0: (np.zeros(k), np.eye(k))})
    # A few hundred rows by the parameters alone.
    drawn = rows.select(*cols).distinct().orderBy(F.xxhash64(F.lit(seed), *cols), *cols).limit(starts * (k + 1)).collect()
    x = np.array([list(r) for r in drawn], dtype=float)
    for s in range(len(x) // (k + 1)):
        part = x[s * (k + 1) : (s + 1) * (k + 1)]
        fits[s + 1] = (part.mean(axis=0), np.cov(part.T, bias=True).reshape(k, k))

    for _ in range(2):
        fits = _near(blocks, cols, fits, _cuts(blocks, cols, fits, support, 14))
    best = sorted(fits, key=lambda s: (round(_spread(fits[s][1]), 9), s))[:keep]
    fits, done = {s: fits[s] for s in best}, {}
    for _ in range(max_steps):
        new = _near(blocks, cols, fits, _cuts(blocks, cols, fits, support))
        settled = {s for s in new if abs(_spread(new[s][1]) - _spread(fits[s][1])) < 1e-6}
        done |= {s: new[s] for s in settled}
        fits = {s: f for s, f in new.items() if s not in settled}
        if not fits:
            break
    done |= fits
    mean, cov = done[min(done, key=lambda s: (round(_spread(done[s][1]), 9), s))]

    med = _cuts(blocks, cols, {0: (mean, cov)}, 0.5)[0]
    cov = cov * max(med / chi2_quantile(k, 0.0), 1e-12)
    mean, cov = _near(blocks, cols, {0: (mean, cov)}, {0: chi2_quantile(k, 1.959964)}).get(0, (mean, cov))
    return mean * width + centre, _precision(cov) / np.outer(width, width)
