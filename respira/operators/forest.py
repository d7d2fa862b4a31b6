"""Isolation forest: trees grown in parallel on seeded samples, scored in slices of bounded size.

Each tree sees at most ``max_samples`` rows, chosen by a hash of row and tree, so no tree depends on how rows are
partitioned; a row finds its trees by skip lengths, so the work is that of the drawn rows. Scoring compares places among
a slice's splits, which are whole numbers, and moves all rows of a batch down a tree by two look-ups a level.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from respira.plans.quantiles import exact_quantiles
from respira.plans.sizing import cut_lineage

_NODES = T.StructType(
    [
        T.StructField("tree", T.IntegerType()),
        T.StructField("node", T.IntegerType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("split", T.DoubleType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("length", T.DoubleType()),
    ]
)


def average_path(n):
    """Mean depth of an unsuccessful search in a random tree over ``n`` points."""
    n = np.asarray(n, dtype=float)
    with np.errstate(divide="ignore", invalid="ignore"):
        big = 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n
    return np.where(n > 2, big, np.where(n == 2, 1.0, 0.0))


def _grow(x: np.ndarray, rng: np.random.Generator, limit: int) -> pd.DataFrame:
    """``node, feature, split, left, right, length`` of one tree, all nodes of a level at once; leaves have feature -1."""
    levels, node, first, depth = [], np.zeros(len(x), int), 0, 0
    while len(x):
        order = np.argsort(node, kind="stable")
        x, node = x[order], node[order]
        at = np.flatnonzero(np.diff(node, prepend=-1))
        lo, hi = np.minimum.reduceat(x, at), np.maximum.reduceat(x, at)
        count = np.diff(np.append(at, len(x)))
        open_ = hi > lo
        inner = open_.any(axis=1) & (depth < limit)
        feature = np.where(open_, rng.random(open_.shape), -1.0).argmax(axis=1)
        every = np.arange(len(at))
        low, high = lo[every, feature], hi[every, feature]
        with np.errstate(invalid="ignore"):
            split = np.minimum(low + rng.random(len(at)) * (high - low), np.nextafter(high, low))
        split = np.fmax(split, low)  # no number lies between minus infinity and another value
        left = np.where(inner, first + len(at) + 2 * (np.cumsum(inner) - 1), -1)
        levels.append(pd.DataFrame({
            "node": first + every, "feature": np.where(inner, feature, -1), "split": np.where(inner, split, 0.0), "left": left,
            "right": np.where(inner, left + 1, -1), "length": np.where(inner, 0.0, depth + average_path(count)),
        }))
        mine = np.repeat(every, count)
        goes = inner[mine]
        x, mine = x[goes], mine[goes]
        first, depth = first + len(at), depth + 1
        node = left[mine] + (x[np.arange(len(x)), feature[mine]] > split[mine]) if len(x) else mine
    return pd.concat(levels)


def _uniform(ids: np.ndarray, k: int) -> np.ndarray:
    """The ``k``-th number in (0, 1) that belongs to each 64-bit id."""
    with np.errstate(over="ignore"):
        h = ids.view(np.uint64) + np.uint64(k + 1) * np.uint64(0x9E3779B97F4A7C15)
        for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(times)
        h ^= h >> np.uint64(31)
    return ((h >> np.uint64(11)).astype(float) + 0.5) / 2**53


def draws(ids: np.ndarray, trees: int, p: float) -> list[np.ndarray]:
    """Which trees draw each id, every tree with chance ``p``: from one drawn tree to the next by a skip length."""
    at, live, row, tree, k = np.full(len(ids), -1.0), np.arange(len(ids)), [], [], 0
    while len(live):
        skip = np.floor(np.log(_uniform(ids[live], k)) / np.log1p(-p)) if p < 1 else 0.0
        at[live] += 1 + skip
        live = live[at[live] < trees]
        row.append(live)
        tree.append(at[live].astype(int))
        k += 1
    row, tree = np.concatenate(row or [live]), np.concatenate(tree or [live])
    tree = tree[np.argsort(row, kind="stable")]
    return np.split(tree, np.cumsum(np.bincount(row, minlength=len(ids)))[:-1]) if len(ids) else []


def fit_forest(
    rows: DataFrame, cols: list[str], id_cols: list[str], trees: int = 200, max_samples: int = 10_000, seed: int = 42
) -> tuple[DataFrame, int]:
    """Node table of the forest and the sample size per tree."""
    n = rows.count()
    size = min(max_samples, n)
    # Slightly more than needed, then the lowest hashes: exact size without sorting the data or pairing rows and trees.
    p = min(1.0, (size + 6 * size**0.5 + 10) / max(n, 1))

    def which(ids: pd.Series) -> pd.Series:
        return pd.Series(draws(ids.to_numpy(np.int64), trees, p))

    draw = rows.select(*cols, F.xxhash64(*id_cols, F.lit(seed)).alias("_id"))
    draw = draw.withColumn("tree", F.explode(F.pandas_udf(which, "array<int>")("_id")))
    draw = draw.withColumn("_r", F.xxhash64("_id", "tree"))
    limit = max(1, int(np.ceil(np.log2(max(size, 2)))))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = int(pdf["tree"].iloc[0])
        pdf = pdf.sort_values(["_r", "_id"]).head(size)
        nodes = _grow(pdf[cols].to_numpy(dtype=float), np.random.default_rng([seed, tree]), limit)
        return nodes.assign(tree=tree)[_NODES.names]

    return cut_lineage(draw.groupBy("tree").applyInPandas(build, _NODES)), size


#: Nodes that are sent to every executor at once (40 bytes each).
MOST_NODES = 1_000_000


def _tree_slices(nodes: DataFrame) -> list[list[int]]:
    """Trees in groups of at most ``MOST_NODES`` nodes, from one count a tree."""
    out, held = [[]], 0
    for tree, n in sorted(tuple(r) for r in nodes.groupBy("tree").count().collect()):
        if out[-1] and held + n > MOST_NODES:
            out.append([])
            held = 0
        out[-1].append(tree)
        held += n
    return out


def score_forest(df: DataFrame, cols: list[str], nodes: DataFrame, size: int) -> DataFrame:
    """Add ``ml_if_score`` in [-1, 0]; lower is odder.

    Trees are sent in slices of bounded size; each slice adds its path lengths in one pass over the rows.
    """
    slices = _tree_slices(nodes)
    n_trees = sum(map(len, slices))
    norm = float(average_path(size)) or 1.0
    d = df.withColumn("_paths", F.lit(0.0))
    for trees in slices:
        d = _add_paths(d, cols, nodes.filter(F.col("tree").between(min(trees), max(trees))))
    score = -F.pow(F.lit(2.0), -(F.col("_paths") / max(n_trees, 1)) / norm)
    return d.withColumn("ml_if_score", score).drop("_paths")


#: Bits of a packed node that hold its feature, and its feature and its split's place; the rest hold its left child.
_FEATURE_BITS = 12
_LOW_BITS = 38
#: Rows that go down a tree together: their numbers stay in a core's cache, and calls of numpy cost little each.
_TOGETHER = 16_384

Packed = tuple[list[np.ndarray], list[tuple[np.ndarray, np.ndarray, int]]]


def pack_trees(table: pd.DataFrame, n_features: int) -> Packed:
    """Sorted splits of each feature over all trees, and ``nodes, length, depth`` of each tree.

    A node is its left child (the right one follows it) above a remainder that is as large as its split's place is small:
    adding a row's place in the node's feature carries into the child's number where the row lies beyond the split. A
    leaf is its own left child and nothing makes it carry.
    """
    feature, split = table["feature"].to_numpy(), table["split"].to_numpy()
    place, cuts = np.zeros(len(table), dtype=np.int64), []
    for f in range(n_features):
        mine = feature == f
        found, place[mine] = np.unique(split[mine], return_inverse=True)
        cuts.append(found)
    most, last = (1 << _LOW_BITS) - 1, (1 << _FEATURE_BITS) - 1
    if n_features > last or max(map(len, cuts)) >= most >> _FEATURE_BITS or table["node"].max() >= 1 << 63 - _LOW_BITS:
        raise ValueError("too many features, or too many nodes in one tree")
    trees = []
    for rows in table.groupby("tree").indices.values():
        f, left = feature[rows], table["left"].to_numpy()[rows].astype(np.int64)
        leaf = f < 0
        inner = left << _LOW_BITS | most - (place[rows] << _FEATURE_BITS | np.maximum(f, 0))
        depth, level = 0, left[:1][~leaf[:1]]
        while len(level):
            depth, level = depth + 1, np.concatenate([level, level + 1])
            level = left[level[~leaf[level]]]
        nodes = np.where(leaf, np.arange(len(f)) << _LOW_BITS | last, inner)
        trees.append((nodes, table["length"].to_numpy()[rows], depth))
    return cuts, trees


def path_lengths(x: np.ndarray, packed: Packed) -> np.ndarray:
    """Sum of each row's path lengths over all trees; an unknown value lies beyond every split."""
    cuts, trees = packed
    total = np.zeros(len(x))
    for start in range(0, len(x), _TOGETHER):
        part, out = x[start : start + _TOGETHER], total[start : start + _TOGETHER]
        m, k = part.shape
        # Features from last to first, as a node holds its feature counted from the highest number.
        codes = np.stack([np.searchsorted(cuts[f], part[:, f]) for f in reversed(range(k))], axis=1)
        codes = (codes.astype(np.int64) << _FEATURE_BITS).ravel()
        base = np.arange(m) * k - ((1 << _FEATURE_BITS) - k)
        node, at, code, length = np.empty(m, np.int64), np.empty(m, np.int64), np.empty(m, np.int64), np.empty(m)
        for nodes, lengths, depth in trees:
            node.fill(nodes[0])
            for _ in range(depth):
                np.bitwise_and(node, (1 << _FEATURE_BITS) - 1, out=at)
                np.add(at, base, out=at)
                # All places exist; any mode but "raise" writes straight into ``out``.
                np.take(codes, at, out=code, mode="clip")
                np.add(code, node, out=at)
                np.right_shift(at, _LOW_BITS, out=at)
                np.take(nodes, at, out=node, mode="clip")
            np.right_shift(node, _LOW_BITS, out=at)
            out += np.take(lengths, at, out=length, mode="clip")
    return total


def _add_paths(df: DataFrame, cols: list[str], nodes: DataFrame) -> DataFrame:
    """Add to ``_paths`` each row's path length in every tree of a bounded node table."""
    table = nodes.orderBy("tree", "node").toArrow().to_pandas()
    shared = df.sparkSession.sparkContext.broadcast(pack_trees(table, len(cols)))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        packed = shared.value
        for b in batches:
            yield pd.Series(path_lengths(b.to_numpy(dtype=float), packed))

    run.__annotations__ = {"batches": Iterator[pd.DataFrame], "return": Iterator[pd.Series]}
    # The features alone go to Python: ids and all other columns stay as they are.
    return df.withColumn("_paths", F.col("_paths") + F.pandas_udf(run, "double")(F.struct(*cols)))


def flag_lowest(df: DataFrame, score: str, train: str, contamination: float = 0.05) -> DataFrame:
    """1 below the ``contamination`` quantile of the training scores."""
    base = df.filter(train).withColumn("_all", F.lit(1))
    cut = cut_lineage(exact_quantiles(base, ["_all"], score, {"_cut": contamination}).drop("n"))
    d = df.withColumn("_all", F.lit(1)).join(F.broadcast(cut), "_all", "left")
    return d.withColumn("if_flag", (F.col(score) < F.col("_cut")).cast("int")).drop("_all", "_cut")
