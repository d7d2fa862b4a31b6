"""Similarity join of word n-gram sets: prefixes extended by one token, single tokens of rare classes, pairs of frequent ones.

Texts with equal sets become one node. A node's tokens (n-grams) stand in one order for all, rare ones first. Sets that
are similar enough share two tokens inside their extended prefixes. A token that few prefixes hold is a key by itself;
tokens that many hold are keys in pairs. Should one of the two shared tokens be rare the first kind of key meets, else the
second, so no link is lost. Only components are asked for: a key's members first meet its hub, a linear number of pairs;
afterwards only members of keys that still hold several components meet each other, across components alone, under a
bound on the symmetric difference that 1024 parity bits give (a key of two members has only one pair to look at). Whatever is left is verified on full sets.
"""

from __future__ import annotations

import functools
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from respira.llm.common import drop, lookup, mix, released, store
from respira.llm.components import components
from respira.llm.minhash_dedup import shingle_sets

#: Prefixes that hold a token of the rare class, at most.
RARE = 64
#: Tokens that similar sets share in their extended prefixes.
SHARED = 2
#: Slots of the frequency sketch that orders tokens; any order is right, a rare-first one is fast.
SLOTS = 1 << 20
#: Pieces in which a worker sends its sketch.
PIECES = 64
#: 64-bit words of a node's parity bits.
PARITY = 16
#: Tokens from which on a node's parity bits are not folded: on fewer places too many of them cancel out.
LONG = 512
#: Members of a key that one task row meets at most; larger keys are dealt over several.
MEET = 1000

_U = np.uint64


def _apply(fn, kind: str, *cols: str) -> Column:
    """Iterator pandas UDF of a closure, whose types are given as names."""
    one = Iterator[pd.Series] if len(cols) == 1 else Iterator[tuple[(pd.Series,) * len(cols)]]

    def run(it):
        return released(fn(it))

    run.__annotations__ = {"it": one, "return": Iterator[pd.DataFrame] if " " in kind else Iterator[pd.Series]}
    return F.pandas_udf(run, kind)(*[F.col(c) for c in cols])


def slot(x: np.ndarray) -> np.ndarray:
    return (x & _U(SLOTS - 1)).astype(np.int64)


def parity(x: np.ndarray) -> np.ndarray:
    """Whether an odd number of tokens falls on each of ``64 * PARITY`` places: sets whose bits differ in ``d`` places
    have a symmetric difference of at least ``d``."""
    odd = np.bincount((x >> _U(40)).astype(np.int64) % (64 * PARITY), minlength=64 * PARITY) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def prefix(x: np.ndarray, freq: np.ndarray, percent: int) -> np.ndarray:
    """First tokens in the common order: any set that is similar enough shares ``SHARED`` of them, within its own."""
    size = len(x) + percent * len(x) // -100 + SHARED
    order = np.lexsort((x, freq[slot(x)]))[:size]
    return x[order]


def frequencies(texts: DataFrame, k: int) -> np.ndarray:
    """Count of each slot over the n-grams of all texts (column ``text``), of fixed size whatever the data."""

    def count(frames):
        total = np.zeros(SLOTS, np.int64)
        for f in frames:
            for x in shingle_sets(f["text"], k):
                at = slot(x)
                if len(x) > SLOTS >> 4:
                    total += np.bincount(at, minlength=SLOTS)
                else:
                    np.add.at(total, at, 1)
        part = [zlib.compress(p.tobytes(), 1) for p in np.split(total, PIECES)]
        yield pd.DataFrame({"piece": range(PIECES), "data": part})

    def add(f):
        total = sum(np.frombuffer(zlib.decompress(b), np.int64) for b in f["data"])
        return pd.DataFrame({"piece": f["piece"].iloc[:1], "data": [zlib.compress(total.tobytes(), 1)]})

    d = texts.mapInPandas(lambda it: released(count(it)), "piece long, data binary").groupBy("piece").applyInPandas(add, "piece long, data binary")
    out = np.zeros(SLOTS, np.int64)
    for piece, data in zip(*(d.toArrow().to_pandas()[c] for c in ("piece", "data")), strict=True):
        n = SLOTS // PIECES
        out[piece * n : (piece + 1) * n] = np.frombuffer(zlib.decompress(data), np.int64)
    return np.minimum(out, 2**31 - 1).astype(np.int32)


class Join:
    """One run over ``docs``: n-grams of ``k`` words, links at ``100 * intersection >= percent * union``."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int):
        if not 50 < percent <= 100:
            raise ValueError("percent must lie above 50 and not above 100")
        self.k, self.percent = k, percent
        text = F.col(text_col)
        # A row to fetch a node's text by: its id, or its text where the id is null.
        fetch = F.when(F.col(id_col).isNotNull(), F.xxhash64(id_col, F.lit(1))).otherwise(F.xxhash64(text, F.lit(2)))
        self.docs = docs.select(F.col(id_col).alias("doc_id"), text.alias("text"), fetch.alias("fetch"))

    def sketch(self) -> DataFrame:
        """``doc_id, fetch, n, node, bits, tokens`` of every document; ``tokens`` is the extended prefix."""
        k, percent = self.k, self.percent
        freq = self.docs.sparkSession.sparkContext.broadcast(frequencies(self.docs.select("text"), k))  # 4 * SLOTS bytes

        def run(it):
            for s in it:
                out = []
                for x in shingle_sets(s, k):
                    node = int(mix(x).sum(dtype=_U).view(np.int64)) if len(x) else 0
                    out.append((len(x), node, parity(x), prefix(x, freq.value, percent).view(np.int64)))
                yield pd.DataFrame(out, columns=["n", "node", "bits", "tokens"])

        d = self.docs.select("doc_id", "fetch", _apply(run, "n long, node long, bits array<long>, tokens array<long>", "text").alias("s"))
        d = store(d.select("doc_id", "fetch", "s.*"))
        freq.destroy()
        return d

    def keys(self, nodes: DataFrame) -> DataFrame:
        """``key, node, size`` for keys with two members or more: rare tokens, and pairs of frequent ones."""
        tokens = nodes.select("node", F.explode("tokens").alias("h"))
        held = store(tokens.groupBy("h").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))
        tokens = store(lookup(tokens, held, "h", "inner"))
        rare = tokens.filter(F.col("size") <= RARE).select(F.col("h").alias("key"), "node", "size")
        frequent = tokens.filter(F.col("size") > RARE).groupBy("node").agg(F.sort_array(F.collect_list("h")).alias("f"))
        first = frequent.select("node", "f", F.posexplode("f").alias("i", "x"))
        both = first.select("node", "x", F.explode(F.slice("f", F.col("i") + 2, F.size("f"))).alias("y"))
        both = both.select(F.xxhash64("x", "y").alias("key"), "node")
        several = store(both.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1"))
        out = store(rare.unionByName(lookup(both, several, "key", "inner")))
        drop(held, tokens, several)
        return out

    def possible(self, a: str, b: str, words: int, bits: str = "bits") -> Column:
        """Whether sizes and parity bits (so many words of them) leave the threshold possible for two structs ``n, bits``."""
        n, m = F.col(f"{a}.n"), F.col(f"{b}.n")
        differ = sum(F.bit_count(F.col(f"{a}.{bits}")[i].bitwiseXOR(F.col(f"{b}.{bits}")[i])) for i in range(words))
        sizes = 100 * F.least(n, m) >= self.percent * F.greatest(n, m)
        return sizes & (differ * (100 + self.percent) <= (n + m) * (100 - self.percent))

    def filtered(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """Distinct pairs ``a, b`` that are still possible."""
        info = nodes.select("node", F.struct("n", "bits").alias("i"))
        d = pairs.distinct().join(info.toDF("a", "ia"), "a").join(info.toDF("b", "ib"), "b")
        return store(d.filter(self.possible("ia", "ib", PARITY)).select("a", "b"))

    def verified(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """Pairs whose full sets are similar enough."""
        k, percent = self.k, self.percent
        ends = store(pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct())
        need = store(nodes.select("node", "fetch").join(ends, "node", "left_semi").select("fetch").distinct())

        def name(it):
            for s in it:
                yield pd.Series([int(mix(x).sum(dtype=_U).view(np.int64)) if len(x) else 0 for x in shingle_sets(s, k)])

        texts = lookup(self.docs, need, "fetch", "left_semi").withColumn("node", _apply(name, "long", "text"))
        # A fetch key may name other rows too: the node tells which text is its own.
        texts = store(texts.groupBy("node").agg(F.first("text").alias("text")))

        def check(it):
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

        d = pairs.join(texts.toDF("a", "ta"), "a").join(texts.toDF("b", "tb"), "b")
        out = store(d.select("a", "b", _apply(check, "boolean", "a", "ta", "b", "tb").alias("ok")).filter("ok").select("a", "b"))
        drop(ends, need, texts)
        return out

    @staticmethod
    def members(keys: DataFrame) -> DataFrame:
        """``key, node, size, hub``: members of each key but its hub, the one that shares its keys with most."""
        degree = keys.groupBy("node").agg(F.sum("size").alias("degree"))
        hubs = keys.join(degree, "node").groupBy("key").agg(F.max_by("node", F.struct("degree", "node")).alias("hub"))
        return store(keys.join(hubs, "key").filter("node <> hub"))

    def candidates(self, members: DataFrame, comp: DataFrame, nodes: DataFrame) -> DataFrame:
        """Possible pairs of different components under one key, hubs aside; a key of many members is dealt over rows.

        Of keys with the same members one is enough. The parity bits of short nodes travel folded to a quarter of their
        places, which bound the difference as well; long nodes are held against each other's full bits.
        """
        m = self.label(members.select("key", "node", "size"), comp)
        who = F.bit_xor(F.xxhash64("node")).alias("who")
        open_ = m.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), who, F.count(F.lit(1)).alias("many"))
        open_ = open_.filter("lo < hi").groupBy("who", "many").agg(F.min("key").alias("key")).select("key")
        quarter = PARITY // 4
        folded = F.array(*[functools.reduce(Column.bitwiseXOR, [F.col("bits")[i + j] for j in range(0, PARITY, quarter)]) for i in range(quarter)])
        m = m.join(open_, "key", "left_semi").join(nodes.select("node", "n", folded.alias("bits"), F.when(F.col("n") >= LONG, F.col("bits")).alias("full")), "node")
        m = store(m.withColumn("ways", F.ceil(F.col("size") / MEET).cast("int")))
        left = m.withColumn("way", F.pmod(F.xxhash64("node"), F.col("ways")).cast("int"))
        right = m.withColumn("way", F.explode(F.sequence(F.lit(0), F.col("ways") - 1)))
        x, y = (
            d.select("key", "way", F.col("node").alias(f"node{s}"), F.col("comp").alias(f"comp{s}"), F.struct("n", "bits", "full").alias(f"i{s}"))
            for d, s in ((left, "x"), (right, "y"))
        )
        long = F.coalesce(self.possible("ix", "iy", PARITY, "full"), F.lit(True))  # null where either node is short
        d = x.join(y, ["key", "way"]).filter("nodex < nodey and compx <> compy").filter(self.possible("ix", "iy", quarter) & long)
        return d.select(F.col("nodex").alias("a"), F.col("nodey").alias("b"))

    @staticmethod
    def label(rows: DataFrame, comp: DataFrame) -> DataFrame:
        return rows.join(comp, "node", "left").withColumn("comp", F.coalesce("component", "node")).drop("component")

    def run(self) -> DataFrame:
        d = self.sketch()
        one = [F.first(c).alias(c) for c in ("n", "bits", "tokens")]
        nodes = store(d.filter("n > 0").groupBy("node").agg(F.min("doc_id").alias("id"), F.min("fetch").alias("fetch"), *one))
        keys = self.keys(nodes)
        twos = keys.filter("size = 2").groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b")).select("a", "b")
        members = self.members(keys.filter("size > 2"))
        hub_pairs = members.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
        links = self.verified(self.filtered(hub_pairs.union(twos), nodes), nodes)
        comp = store(components(links))
        far = self.filtered(self.candidates(members, comp, nodes), nodes)
        if not far.isEmpty():
            links = store(links.union(self.verified(far, nodes)))
            comp = store(components(links))
        labelled = self.label(nodes.select("node", "id"), comp)
        lowest = labelled.groupBy("comp").agg(F.min("id").alias("component_id"))
        found = labelled.join(lowest, "comp").select("node", "component_id")
        out = d.filter("n > 0").select("doc_id", "n", "node").join(found, "node").select("doc_id", "n", "component_id")
        out = out.unionByName(d.filter("n = 0").select("doc_id", "n", F.col("doc_id").alias("component_id")))
        return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def ngram_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for every row of ``docs``.

    Words are runs without ASCII white space, lower-cased in ASCII. Rows link where ``100 * intersection >= percent *
    union`` of their full n-gram sets (64-bit hashes); ``percent`` lies above 50. ``component_id`` is the smallest id
    reachable over links (null if all ids of a component are null). Null and blank texts are linked with nothing; texts
    with fewer words than an n-gram have their whole sequence as one. Repeated rows each get their row and are linked
    through their equal sets; other columns are ignored.
    """
    return Join(docs, id_col, text_col, words, percent).run()


def op12_ngram_join(spark, sf: str) -> DataFrame:
    return ngram_join(spark.read.parquet(f"{sf}/documents.parquet"), words=3, percent=90)
