"""Mixing sources to target weights by balanced sampling (cube method).

Each document is taken a whole number of times plus once more with a fractional probability. The fractional parts move
through the null space of the constraint matrix (tokens and documents of a block), so both totals stay put while
probabilities reach 0 or 1; what is left of the blocks meets in fewer blocks, until a source's last two documents land.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respira.llm.common import lookup, store
from respira.plans.series import number_rows

MAX_TIMES = 3
BLOCK_ROWS = 2000
#: Documents of a source's last block that are rounded together, besides the two that the flight leaves.
LANDING = 14
SEED = 5
_EPS = 1e-9


def _flight(size: np.ndarray, p: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Move probabilities until at most two lie strictly between 0 and 1; keeps sum(p) and sum(size * p)."""
    x, s, out = p.tolist(), size.tolist(), p.copy()
    draw = iter(rng.random(len(x) + 3).tolist())
    live: list[int] = []
    for k in range(len(x)):
        live.append(k)
        if len(live) < 3:
            continue
        a, b, c = live
        u = (s[b] - s[c], s[c] - s[a], s[a] - s[b])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = min((1 - x[i]) / v if v > 0 else -x[i] / v for i, v in zip(live, u, strict=True) if v)
        down = min(x[i] / v if v > 0 else (x[i] - 1) / v for i, v in zip(live, u, strict=True) if v)
        step = up if next(draw) * (up + down) < down else -down
        for i, v in zip(live, u, strict=True):
            y = x[i] + step * v
            x[i] = 0.0 if y < _EPS else 1.0 if y > 1 - _EPS else y
        live = [i for i in live if 0 < x[i] < 1]
    out[:] = x
    return out


def _land(size: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Round the last few probabilities so that the token total changes least, then the number of documents."""
    out, open_ = p.copy(), np.flatnonzero((p > 0) & (p < 1))
    pick = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    off = np.abs(pick @ size[open_] - size[open_] @ p[open_])
    best = np.lexsort((np.abs(pick.sum(1) - p[open_].sum()), np.round(off, 6)))[0]
    out[open_] = pick[best]
    return out


def _block(key: tuple, f: pd.DataFrame) -> pd.DataFrame:
    src, block, level, last = (int(k) for k in key)
    # The smallest of a source's last block stay out of the flight, so that landing has small steps to choose from.
    f = f.sort_values(["size", "order", "copy"], kind="stable")
    f = f.assign(small=np.arange(len(f)) < (LANDING if last else 0))
    f = f.sort_values(["small", "order", "size", "copy"], kind="stable")
    n = int((~f["small"]).sum())
    rng = np.random.Generator(np.random.PCG64([SEED, src, block, level]))
    size, p = f["size"].to_numpy(float), f["p"].to_numpy(float)
    p[:n] = _flight(size[:n], p[:n], rng)
    return f.assign(p=_land(size, p) if last else p)[["src", "id", "size", "copy", "order", "p"]]


def targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3), most: int = MAX_TIMES) -> DataFrame:
    """``source, source_size, rank, target`` for every source of ``source, size`` rows.

    Weights repeat over the sources by code point, null last. A target stops at ``most`` times its source's size and the
    excess is shared again by weight: all others lie at one level times their weight, which is found with two sums a
    round.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = [F.col("source").isNull(), F.col("source").cast("binary")]
    ranked = number_rows(per, order, "_n").withColumn("rank", F.col("_n").cast("long") - 1).drop("_n")
    w = F.element_at(F.array(*[F.lit(x) for x in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    t = store(ranked.withColumn("w", w).withColumn("cap", most * F.col("source_size")))
    total = t.agg(F.sum("source_size")).first()[0] or 0
    level, before = None, -1
    while True:
        full = F.lit(False) if level is None else F.col("cap") < level * F.col("w")
        r = t.agg(
            F.sum(F.when(full, F.col("cap")).otherwise(0)), F.sum(F.when(~full, F.col("w")).otherwise(0)),
            F.sum(full.cast("long")),
        ).first()
        capped, free, n = (x or 0 for x in r)
        if n == before or not free:
            break
        level, before = (total - capped) / free, n
    share = F.least(F.col("cap").cast("double"), F.lit(float(level or 0)) * F.col("w"))
    return t.select("source", "source_size", "rank", share.alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        weights: tuple[int, ...] = (1, 2, 3), most: int = MAX_TIMES) -> DataFrame:
    """How many times each document is taken: ``doc_id, source, size, source_size, target, times, taken``.

    Only ids, sources and word counts are kept and shuffled. Equal rows are numbered copies and may be taken differently,
    but as a set they are the same in every run: all draws depend on contents. Null text has size 0 and is never taken;
    null sources form one source. No document is taken more than ``most`` times.
    """
    d = docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
    )
    d = store(d.groupBy("id", "source", "size").agg(F.count(F.lit(1)).alias("n")))
    goal = targets(d.select("source", (F.col("size") * F.col("n")).alias("size")), weights, most)
    goal = store(goal.withColumn("skey", F.xxhash64("source", F.col("source").isNull())))
    q = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    per = goal.select("skey", F.col("rank").alias("src"), q.alias("q"))
    rows = d.withColumn("skey", F.xxhash64("source", F.col("source").isNull()))
    rows = lookup(rows, per, "skey").select("src", "q", "id", "size", F.explode(F.sequence(F.lit(1), "n")).alias("copy"))
    whole = F.floor("q")
    rows = rows.select("src", "id", "size", F.col("copy").cast("long"), F.lit(0.0).alias("whole") + whole, (F.col("q") - whole).alias("p"))
    rows = rows.withColumn("order", F.xxhash64("id", "size", "copy", F.lit(SEED)))
    rows = rows.withColumn("p", F.when(F.col("size") == 0, 0.0).when(F.col("p") < _EPS, 0.0).otherwise(F.col("p")))
    # Ids travel as text: next to a null pandas would keep large integers as rounded floats.
    kind = rows.schema["id"].dataType
    base = store(rows.withColumn("id", F.col("id").cast("string")))
    schema = "src long, id string, size long, copy long, order long, p double"
    done: list[DataFrame] = [base.filter("p = 0").select("src", "id", "size", "copy", "p")]
    open_, level = base.filter("p > 0").select("src", "id", "size", "copy", "order", "p"), 0
    while True:
        counts = store(open_.groupBy("src").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("long").alias("blocks")))
        if counts.isEmpty():
            break
        r = lookup(open_, counts, "src")
        r = r.withColumn("block", F.pmod(F.xxhash64("order", F.lit(level)), "blocks")).withColumn("level", F.lit(level))
        r = r.withColumn("last", (F.col("blocks") == 1).cast("int")).drop("blocks")
        moved = store(r.groupBy("src", "block", "level", "last").applyInPandas(_block, schema))
        done.append(moved.filter("p = 0 or p = 1").select("src", "id", "size", "copy", "p"))
        open_, level = moved.filter("p > 0 and p < 1"), level + 1
    out = done[0]
    for x in done[1:]:
        out = out.union(x)
    info = goal.select(F.col("rank").alias("src"), "source", "source_size", "target", q.alias("q"))
    out = lookup(out, store(info), "src")
    times = F.when(F.col("size") == 0, 0).otherwise(F.floor("q") + F.col("p")).cast("long")
    return out.withColumn("times", times).select(
        F.col("id").cast(kind).alias("doc_id"), "source", "size", "source_size", "target", "times",
        (F.col("times") * F.col("size")).alias("taken"),
    )


def op5_source_mixing(spark, sf: str) -> DataFrame:
    return mix(spark.read.parquet(f"{sf}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")
