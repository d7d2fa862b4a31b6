"""Nearest neighbours by learned partitions: a balanced partition of a sample's neighbour graph, and a small classifier
that sends every vector to its partition and every query to several."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respira.llm.common import row_key, store

#: Vectors that the partition and the classifier are fitted on, at most about; drawn by a hash of their contents.
SAMPLE = 6000
#: Partitions double until one holds at most about this many of all vectors, up to ``MAX_DEPTH`` doublings.
PART_ROWS = 2000
MAX_DEPTH = 6
NEIGHBOURS = 12
HIDDEN = 128
#: A query goes to its most probable partitions until their probabilities sum to a reach: the least of these that finds
#: ``RECALL`` of the neighbours of sample vectors which the classifier was not trained on.
REACHES = (0.8, 0.9, 0.95, 0.97, 0.98, 0.985, 0.99, 0.995, 0.999, 1.0)
RECALL = 0.945
HELD_OUT = 0.15
#: Vectors and queries that meet in one task at most, about.
BLOCK = 4000
K = 20
SEED = 7


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """Numbers of the ``k`` vectors of largest inner product with each vector, in blocks."""
    out = np.empty((len(x), k), np.int64)
    for a in range(0, len(x), 512):
        s = x[a : a + 512] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 512] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def bisect(graph: np.ndarray, depth: int) -> np.ndarray:
    """Balanced parts of the graph: halve at the median of a vector smoothed over edges within the part."""
    n = len(graph)
    part, rng = np.zeros(n, np.int64), np.random.default_rng(SEED)
    heads = np.repeat(np.arange(n), graph.shape[1])
    u, v = np.concatenate([heads, graph.ravel()]), np.concatenate([graph.ravel(), heads])
    for _ in range(depth):
        inside = part[u] == part[v]
        a, b = u[inside], v[inside]
        degree = np.maximum(np.bincount(a, minlength=n), 1)
        y, size = rng.standard_normal(n), np.bincount(part)
        for _ in range(60):
            y = 0.5 * y + 0.5 * np.bincount(a, y[b], n) / degree
            y -= (np.bincount(part, y) / size)[part]
            y /= np.sqrt(np.bincount(part, y * y) / size + 1e-300)[part]
        order = np.lexsort((y, part))
        start = np.concatenate([[0], np.cumsum(size)])[:-1]
        rank = np.empty(n, np.int64)
        rank[order] = np.arange(n) - start[part[order]]
        part = 2 * part + (rank >= (size[part] + 1) // 2)
    return part


class Router:
    """One hidden layer and a softmax over partitions, on vectors divided by the sample's mean norm."""

    def __init__(self, x: np.ndarray, part: np.ndarray, parts: int):
        rng = np.random.default_rng(SEED)
        self.scale = 1 / max(np.linalg.norm(x, axis=1).mean(), 1e-30)
        d = x.shape[1]
        w = [rng.standard_normal((d, HIDDEN)) / math.sqrt(d) * 2, np.zeros(HIDDEN), rng.standard_normal((HIDDEN, parts)) * 0.1, np.zeros(parts)]
        m, v = [np.zeros_like(p) for p in w], [np.zeros_like(p) for p in w]
        x, step = x * self.scale, 0
        for _ in range(max(8, min(60, 240_000 // max(1, len(x))))):
            order = rng.permutation(len(x))
            for a in range(0, len(x), 256):
                i, step = order[a : a + 256], step + 1
                h = np.maximum(x[i] @ w[0] + w[1], 0)
                p = self._softmax(h @ w[2] + w[3])
                p[np.arange(len(i)), part[i]] -= 1
                p /= len(i)
                back = (p @ w[2].T) * (h > 0)
                for k, g in enumerate((x[i].T @ back + 1e-4 * w[0], back.sum(0), h.T @ p + 1e-4 * w[2], p.sum(0))):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    w[k] -= 0.003 * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        self.w = w

    @staticmethod
    def _softmax(z: np.ndarray) -> np.ndarray:
        e = np.exp(z - z.max(1, keepdims=True))
        return e / e.sum(1, keepdims=True)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        w = self.w
        return self._softmax(np.maximum((x * self.scale) @ w[0] + w[1], 0) @ w[2] + w[3])


def ordered(p: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Partitions of each row by probability, and how many of them to search."""
    order = np.argsort(-p, axis=1, kind="stable")
    total = np.cumsum(np.take_along_axis(p, order, 1), 1)
    return order, np.minimum((total < reach).sum(1) + 1, p.shape[1]) if reach < 1 else np.full(len(p), p.shape[1])


def calibrate(router: Router, x: np.ndarray, asked: np.ndarray) -> float:
    """The least reach that finds ``RECALL`` of the asked vectors' neighbours among ``x``."""
    p = router.probabilities(x)
    home, k = p.argmax(1), min(K, len(x) - 1)
    s = x[asked] @ x.T
    s[np.arange(len(asked)), asked] = -np.inf
    want = home[np.argpartition(-s, k - 1, axis=1)[:, :k]]
    for reach in REACHES:
        order, need = ordered(p[asked], reach)
        place = np.argsort(order, axis=1)
        if (np.take_along_axis(place, want, 1) < need[:, None]).mean() >= RECALL:
            return reach
    return 1.0


def fit(x: np.ndarray, rows: int) -> tuple[Router, int, float]:
    """Router over balanced parts of the sample ``x`` for a table of ``rows`` vectors, their number, and the reach."""
    depth = max(0, min(MAX_DEPTH, math.ceil(math.log2(max(rows, 1) / PART_ROWS)), int(math.log2(max(len(x), 1) / 64 + 1))))
    part = bisect(neighbour_graph(x, min(NEIGHBOURS, len(x) - 1)), depth) if depth else np.zeros(len(x), np.int64)
    if not depth:
        return Router(x, part, 1), 1, 1.0
    asked = np.random.default_rng(SEED).permutation(len(x))[: int(HELD_OUT * len(x))]
    train = np.setdiff1d(np.arange(len(x)), asked)
    router = Router(x[train], part[train], 1 << depth)
    return router, 1 << depth, calibrate(router, x, asked)


def best(queries: pd.DataFrame, rows: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's ``k`` rows of largest inner product, not its own: ``query_id``, ``below`` (scores negated), ``ids``."""
    out = []
    x, ids = np.stack(rows["v"].to_numpy()).astype(float), rows["id"].to_numpy()
    for a in range(0, len(queries), 256):
        q = np.stack(queries["v"].iloc[a : a + 256].to_numpy()).astype(float)
        s = q @ x.T
        own = queries["id"].iloc[a : a + 256].to_numpy()
        s[own[:, None] == ids[None, :]] = -np.inf
        least = np.partition(s, -k, axis=1)[:, -k] if s.shape[1] > k else np.full(len(s), -np.inf)
        near = 1e-9 * (1 + np.abs(np.where(np.isfinite(least), least, 0)))
        i, j = np.nonzero((s >= (least - near)[:, None]) & (s > -np.inf))
        # The sum of exact products in one fixed order, so that equal vectors score the same wherever they lie.
        f = pd.DataFrame({"i": i, "below": -(q[i] * x[j]).sum(1), "id": ids[j]})
        f = f.sort_values(["i", "below", "id"], kind="stable").groupby("i").head(k)
        cut = np.searchsorted(f["i"].to_numpy(), np.arange(1, len(s)))
        parts = [np.split(f[c].to_numpy(), cut) for c in ("below", "id")]
        out.append(pd.DataFrame({"query_id": own, "below": parts[0], "ids": parts[1]}))
    return pd.concat(out) if out else pd.DataFrame({"query_id": [], "below": [], "ids": []})


def _blocks(n: str) -> Column:
    return F.ceil(F.col(n) / BLOCK).cast("long")


def nearest(vectors: DataFrame, queries, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each query, by inner product in double precision.

    ``queries`` is a condition on the rows (column ``id``). Every vector is indexed under its most probable partition;
    a query searches partitions, each exactly, until their probabilities sum to the reach that the sample calls for.
    Queries that found fewer than ``k`` search all partitions. Vectors and queries of a partition meet in blocks of
    about ``BLOCK``. Ties go to the smaller id. Rows without an id, and vectors that are null, zero, of another length than
    most, or hold null or non-finite components take no part; repeated rows are candidates each; an empty table
    gives no rows; other columns are ignored.
    """
    spark = vectors.sparkSession
    v = F.transform(F.col(vector_col), lambda x: x.cast("float"))
    d = vectors.select(F.col(id_col).alias("id"), v.alias("v")).filter("id is not null and v is not null and size(v) > 0")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    d = d.filter(~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda x: x != 0))
    sizes = d.groupBy(F.size("v").alias("s")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "s").first()
    kind = dict(d.dtypes)["id"]
    if sizes is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score double")
    n = sizes["n"]
    d = d.filter(F.size("v") == sizes["s"])
    draw = F.pmod(row_key("id", "v"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / n) * (1 << 30))
    drawn = d.filter(draw | F.lit(n <= SAMPLE)).select("id", "v").toArrow().to_pandas().sort_values("id", kind="stable")
    if len(drawn) < 2:
        drawn = d.limit(2).toArrow().to_pandas()
    router, parts, reach = fit(np.stack(drawn["v"].to_numpy()).astype(float), n)
    shared = spark.sparkContext.broadcast(router)

    def route(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for s in it:
            order, need = ordered(shared.value.probabilities(np.stack(s.to_numpy()).astype(float)), reach)
            yield pd.Series([o[:m].tolist() for o, m in zip(order, need, strict=True)])

    route.__annotations__ = {"it": Iterator[pd.Series], "return": Iterator[pd.Series]}
    ask = queries
    d = store(d.withColumn("route", F.pandas_udf(route, "array<long>")("v")).withColumn("ask", F.coalesce(ask, F.lit(False))))
    every = F.array(*[F.lit(i).cast("long") for i in range(parts)])
    held = d.groupBy(F.col("route")[0].alias("part")).agg(F.count(F.lit(1)).alias("n")).select("part", _blocks("n").alias("blocks"))
    held = store(held)  # one row a partition
    rows = d.select("id", "v", F.col("route")[0].alias("part"))

    def search(asked: DataFrame) -> DataFrame:
        """``asked``: id, v, part rows of the queries."""
        per = store(asked.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select("part", _blocks("n").alias("qblocks")))
        plan = F.broadcast(held.join(per, "part"))
        r = rows.join(plan, "part").withColumn("block", F.pmod(F.xxhash64("id", "v"), "blocks"))
        r = r.withColumn("qblock", F.explode(F.sequence(F.lit(0).cast("long"), F.col("qblocks") - 1)))
        q = asked.join(plan, "part").withColumn("qblock", F.pmod(F.xxhash64("id"), "qblocks"))
        q = q.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))

        def both(key, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
            if not len(a) or not len(b):
                return pd.DataFrame({"query_id": [], "below": [], "ids": []})
            return best(a, b, k)

        def side(f: DataFrame):
            keys = [F.col(c).alias(f"k_{c}") for c in ("part", "block", "qblock")]
            return f.select(F.col("id").alias("id_"), F.col("v").alias("v_"), *keys).toDF("id", "v", *names).groupBy(*names)

        names = ["k_part", "k_block", "k_qblock"]
        return side(q).cogroup(side(r)).applyInPandas(both, f"query_id {kind}, below array<double>, ids array<{kind}>")

    ask_rows = d.filter("ask").dropDuplicates(["id"])
    first = store(search(ask_rows.select("id", "v", F.explode("route").alias("part"))))
    few = ask_rows.join(first.groupBy(F.col("query_id").alias("id")).agg(F.sum(F.size("ids")).alias("n")), "id", "left")
    few = store(few.filter(F.coalesce("n", F.lit(0)) < min(k, n - 1)).select("id", "v"))
    if not few.isEmpty():
        again = search(few.select("id", "v", F.explode(every).alias("part")))
        first = first.join(few.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(again)
    # A block answers with one row a query, so what is merged is a list for each block that the query searched.
    near = F.flatten(F.collect_list(F.arrays_zip("below", "ids")))
    out = first.groupBy("query_id").agg(F.slice(F.array_sort(near), 1, k).alias("near"))
    out = out.select("query_id", F.posexplode("near").alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("x.ids").alias("vec_id"), (-F.col("x.below")).alias("score"))


def op7_vector_search(spark, sf: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf}/embeddings.parquet"), F.col("id") % 20 == 0)
