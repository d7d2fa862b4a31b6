"""Near duplicates: MinHash bands for candidates, sequential Bayesian pruning of signatures, exact confirmation.

Only connected components are asked for, so a large group of similar texts never needs all its pairs:

1. Documents with equal shingle sets become one node.
2. Each node of a band's bucket is compared with the bucket's hub alone, a linear number of pairs; the hub is the member
   that shares its bands with most.
3. What may still be missing are links between two non-hub nodes of one bucket that lie in different components. These
   nodes, and only these, go through a prefix filter, which is exact: two sets that are similar enough share one of
   their rarest shingles.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respira.llm.common import Words, chunks, grams, lookup, mix, released, store
from respira.llm.components import components

#: Chance that banding misses a pair exactly at the threshold; higher similarities are missed far less.
BAND_MISS = 1e-6
#: Posterior probability of reaching the threshold below which a candidate is dropped before exact confirmation.
POSTERIOR_MISS = 1e-9
#: Hashes compared before each look at the posterior.
BATCH = 20
#: Slots of the shingle frequency sketch that orders prefixes; any order is right, a rare-first one is fast.
SLOTS = 1 << 20

_U = np.uint64


def plan(t: float) -> tuple[int, int]:
    """Rows of a band, and bands: enough to miss a pair at similarity ``t`` with ``BAND_MISS`` at most."""
    rows = 5 if t >= 0.85 else 4
    return rows, math.ceil(math.log(BAND_MISS) / math.log1p(-(t**rows)))


def family(n: int) -> tuple[np.ndarray, np.ndarray]:
    r = np.random.Generator(np.random.PCG64(2)).integers(0, 2**63, (2, n), dtype=np.int64).astype(_U)
    return r[0] * _U(2) + _U(1), r[1]


def shingle_sets(texts, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's ``k``-word shingles (fewer words: the sequence; none: empty)."""
    for _, part in chunks(texts, lower=True):
        w = Words(part)
        g = grams(w.hash, k)
        for a, n in zip(w.first[:-1].tolist(), w.count.tolist(), strict=True):
            if n >= k:
                yield np.unique(g[a : a + n - k + 1])
            else:
                yield grams(w.hash[a : a + n], n) if n else np.empty(0, _U)


def signature(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest 32-bit hash of the set under each function of the family."""
    out = np.full(len(a), 2**32 - 1, _U)
    for i in range(0, len(x), 2048):
        part = x[i : i + 2048]
        out = np.minimum(out, ((part[None, :] * a[:, None] + b[:, None]) >> _U(32)).min(1))
    return out.astype("<u4")


def fewest_matches(n: int, t: float, eps: float = POSTERIOR_MISS) -> int:
    """Fewest matches among ``n`` hashes that keep P(similarity >= t) at ``eps`` or more, from a uniform prior.

    The posterior is Beta(m + 1, n - m + 1); its upper tail at ``t`` is a binomial sum.
    """
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
        if total >= eps:
            return m
    return n + 1


def bayes_filter(left: np.ndarray, right: np.ndarray, t: float) -> np.ndarray:
    """Matches of each pair of signatures, -1 where a batch's posterior ruled the pair out."""
    alive, match = np.arange(len(left)), np.zeros(len(left), np.int64)
    for a in range(0, left.shape[1], BATCH):
        b = min(a + BATCH, left.shape[1])
        match[alive] += (left[alive, a:b] == right[alive, a:b]).sum(1)
        ok = match[alive] >= fewest_matches(b, t)
        match[alive[~ok]] = -1
        alive = alive[ok]
    return match


def _udf(fn, kind: str, *args: str):
    """Iterator pandas UDF of a closure, whose types are given as names."""
    one = Iterator[pd.Series] if len(args) == 1 else Iterator[tuple[(pd.Series,) * len(args)]]

    def run(it):
        return released(fn(it))

    run.__annotations__ = {"it": one, "return": Iterator[pd.DataFrame] if " " in kind else Iterator[pd.Series]}
    return F.pandas_udf(run, kind)(*[F.col(a) for a in args])


class Dedup:
    """One run over ``docs``: shingles of ``k`` words, links at ``100 * intersection >= percent * union``."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int):
        self.k, self.percent, self.t = k, percent, percent / 100
        self.rows, self.bands = plan(self.t)
        text = F.col(text_col)
        # A row to fetch a node's text by: its id, or its text where the id is null.
        fetch = F.when(F.col(id_col).isNotNull(), F.xxhash64(id_col, F.lit(1))).otherwise(F.xxhash64(text, F.lit(2)))
        self.docs = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), fetch.alias("fetch"))

    def sketch(self) -> DataFrame:
        k, (a, b) = self.k, family(self.rows * self.bands)

        def run(it):
            for s in it:
                n, node, sig = [], [], []
                for x in shingle_sets(s, k):
                    n.append(len(x))
                    node.append(int(mix(x).sum(dtype=_U).view(np.int64)) if len(x) else 0)
                    sig.append(signature(x, a, b).tobytes() if len(x) else None)
                yield pd.DataFrame({"n": n, "node": node, "sig": sig})

        d = self.docs.select("doc_id", "fetch", _udf(run, "n long, node long, sig binary", "text").alias("s"))
        return store(d.select("doc_id", "fetch", "s.*"))

    def texts(self, nodes: DataFrame) -> DataFrame:
        """``node, n, text`` of the given nodes (``node, fetch``), each text once."""
        k = self.k

        def run(it):
            for s in it:
                yield pd.Series([int(mix(x).sum(dtype=_U).view(np.int64)) if len(x) else 0 for x in shingle_sets(s, k)])

        need = store(nodes.select("fetch").distinct())
        d = lookup(self.docs, need, "fetch", "left_semi").withColumn("node", _udf(run, "long", "text"))
        return store(d.join(nodes.select("node"), "node", "left_semi").groupBy("node").agg(F.first("text").alias("text")))

    def prune(self, pairs: DataFrame) -> DataFrame:
        """Candidates ``a, b`` whose signatures leave the threshold possible, with their matches ``m``."""
        t, size = self.t, self.rows * self.bands
        sig = self.nodes.select("node", "sig")

        def run(it):
            for x, y in it:
                left, right = (np.frombuffer(b"".join(s), "<u4").reshape(-1, size) for s in (x, y))
                yield pd.Series(bayes_filter(left, right, t))

        d = pairs.join(sig.toDF("a", "sa"), "a").join(sig.toDF("b", "sb"), "b")
        return store(d.select("a", "b", _udf(run, "long", "sa", "sb").alias("m")).filter("m >= 0"))

    def confirm(self, pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """Pairs whose full shingle sets are similar enough."""
        k, percent = self.k, self.percent

        def run(it):
            memo: OrderedDict[int, np.ndarray] = OrderedDict()

            def sets(nodes, texts):
                new = [(n, t) for n, t in zip(nodes, texts, strict=True) if n not in memo]
                memo.update(zip([n for n, _ in new], shingle_sets([t for _, t in new], k), strict=True))

            for a, ta, b, tb in it:
                ok = []
                for i in range(0, len(a), 64):
                    j = slice(i, i + 64)
                    sets(a.iloc[j], ta.iloc[j])
                    sets(b.iloc[j], tb.iloc[j])
                    for x, y in zip(a.iloc[j], b.iloc[j], strict=True):
                        u, v = memo[x], memo[y]
                        both = len(np.intersect1d(u, v, assume_unique=True))
                        ok.append(100 * both >= percent * (len(u) + len(v) - both))
                    while len(memo) > 256:
                        memo.popitem(last=False)
                yield pd.Series(ok, dtype=bool)

        d = pairs.select("a", "b").join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
        return store(d.select("a", "b", _udf(run, "boolean", "a", "ta", "b", "tb").alias("ok")).filter("ok").select("a", "b"))

    def fits(self, n: Column, m: Column) -> Column:
        """Sizes that can reach the threshold at all."""
        return (100 * F.least(n, m) >= self.percent * F.greatest(n, m))

    def prefixes(self, nodes: DataFrame, texts: DataFrame) -> DataFrame:
        """``h, node, comp, n, at``: the rarest shingles of each node, enough that similar sets share one."""
        k, percent = self.k, self.percent

        def count(frames):
            total = np.zeros(SLOTS, np.int64)
            for f in frames:
                for x in shingle_sets(f["text"], k):
                    total += np.bincount((x & _U(SLOTS - 1)).astype(np.int64), minlength=SLOTS) if len(x) > SLOTS else 0
                    if len(x) <= SLOTS:
                        np.add.at(total, (x & _U(SLOTS - 1)).astype(np.int64), 1)
            slot = np.flatnonzero(total)
            yield pd.DataFrame({"slot": slot, "c": total[slot]})

        c = texts.select("text").mapInPandas(lambda it: released(count(it)), "slot long, c long").groupBy("slot").agg(F.sum("c").alias("c")).toArrow().to_pandas()
        freq = np.zeros(SLOTS, np.int32)
        freq[c["slot"]] = np.minimum(c["c"], 2**31 - 1)
        shared = texts.sparkSession.sparkContext.broadcast(freq)  # SLOTS * 4 bytes whatever the data

        def run(frames):
            for f in frames:
                out = []
                for node, comp, x in zip(f["node"], f["comp"], shingle_sets(f["text"], k), strict=True):
                    n = len(x)
                    keep = n - -(-percent * n // 100) + 1
                    rare = np.lexsort((x, shared.value[(x & _U(SLOTS - 1)).astype(np.int64)]))[:keep]
                    h = x[rare].view(np.int64)
                    out.append(pd.DataFrame({"h": h, "node": node, "comp": comp, "n": n, "at": np.arange(len(h))}))
                if out:
                    yield pd.concat(out)

        d = texts.join(nodes, "node").select("node", "comp", "text")
        return d.mapInPandas(lambda it: released(run(it)), "h long, node long, comp long, n long, at long")

    def far_pairs(self, nodes: DataFrame, texts: DataFrame) -> DataFrame:
        """Candidate pairs of different components by the prefix filter, with its bound on what can still match."""
        p = store(self.prefixes(nodes, texts))
        mixed = p.groupBy("h").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("h")
        p = store(p.join(mixed, "h", "left_semi"))
        x, y = (p.select("h", *[F.col(c).alias(f"{c}{s}") for c in ("node", "comp", "n", "at")]) for s in "xy")
        least = F.ceil(self.percent * (F.col("nx") + F.col("ny")) / (100 + self.percent) - 1e-6)
        most = 1 + F.least(F.col("nx") - F.col("atx"), F.col("ny") - F.col("aty")) - 1
        j = x.join(y, "h").filter("nodex < nodey and compx <> compy").filter(self.fits(F.col("nx"), F.col("ny")) & (most >= least))
        return store(j.select(F.col("nodex").alias("a"), F.col("nodey").alias("b")).distinct())

    def run(self) -> DataFrame:
        d = self.sketch()
        nodes = d.filter("n > 0").groupBy("node").agg(
            F.min("doc_id").alias("id"), F.min("fetch").alias("fetch"), F.first("n").alias("n"), F.first("sig").alias("sig")
        )
        self.nodes = nodes = store(nodes)
        width = 4 * self.rows
        keys = F.array(*[F.xxhash64(F.expr(f"substring(sig, {1 + i * width}, {width})"), F.lit(i)) for i in range(self.bands)])
        bands = nodes.select("node", "n", F.explode(keys).alias("key"))
        sizes = bands.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
        shared = store(bands.join(sizes, "key"))
        # The hub is the member whose bands most nodes share: of edited copies that is the original, which they resemble
        # more than each other.
        degree = shared.groupBy("node").agg(F.sum("size").alias("degree"))
        hubs = shared.join(degree, "node").groupBy("key").agg(
            F.max_by(F.struct("node", "n"), F.struct("degree", F.xxhash64("node").alias("tie"))).alias("hub")
        )
        members = shared.join(hubs, "key").filter("node <> hub.node")
        members = store(members.select("key", "node", "n", "size", F.col("hub.node").alias("hub"), F.col("hub.n").alias("hub_n")))
        pairs = members.filter(self.fits(F.col("n"), F.col("hub_n"))).select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        likely = self.prune(pairs.distinct())
        ends = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
        texts = self.texts(nodes.select("node", "fetch").join(ends, "node"))
        # Each node's likeliest partner first; most other pairs then lie inside one component and need no look.
        best = likely.groupBy(F.col("b").alias("node")).agg(F.max_by("a", F.struct("m", "a")).alias("a"))
        first = self.confirm(best.select("a", F.col("node").alias("b")), texts)
        comp = store(components(first))
        apart = self.apart(likely.select("a", "b"), comp).join(best.select("a", F.col("node").alias("b")), ["a", "b"], "left_anti")
        links = store(first.union(self.confirm(store(apart), texts)))
        comp = store(components(links))
        # Buckets whose members besides the hub lie in more than one component.
        m = self.label(members.filter("size > 2").select("key", "node"), comp)
        open_ = m.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("key")
        left = store(m.join(open_, "key", "left_semi").select("node", "comp").distinct())
        if not left.isEmpty():
            more = self.texts(nodes.select("node", "fetch").join(left.select("node"), "node"))
            far = self.prune(self.far_pairs(left, more))
            links = store(links.union(self.confirm(far, more)))
            comp = store(components(links))
        labelled = self.label(nodes.select("node", "id"), comp)
        lowest = labelled.groupBy("comp").agg(F.min("id").alias("component_id"))
        found = labelled.join(lowest, "comp").select("node", "component_id")
        out = d.filter("n > 0").select("doc_id", "n", "node").join(found, "node").select("doc_id", "n", "component_id")
        out = out.unionByName(d.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
        return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))

    @staticmethod
    def label(rows: DataFrame, comp: DataFrame) -> DataFrame:
        return rows.join(comp, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")

    def apart(self, pairs: DataFrame, comp: DataFrame) -> DataFrame:
        """Pairs between different components."""
        c = comp.select("node", "component")
        d = pairs.join(c.toDF("a", "ca"), "a", "left").join(c.toDF("b", "cb"), "b", "left")
        return d.filter(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are runs without ASCII white space, lower-cased in ASCII; links need ``100 * intersection >= percent * union``
    of the full shingle sets (64-bit hashes). ``component_id`` is the smallest id reachable over links (null if all ids
    of a component are null), ``kept`` marks the document that bears it. Null and blank texts are linked with nothing;
    texts with fewer words than a shingle have their whole sequence as one. Repeated rows each get their row and are
    linked through their equal sets; other columns are ignored.
    """
    return Dedup(docs, id_col, text_col, words, percent).run()


def op2_minhash_dedup(spark, sf: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf}/documents.parquet"), words=3, percent=85)
