"""Merkle manifest of a dataset: one hash tree a group of rows, with a proof for every row.

Rows are ranked in their group by one range-partitioned sort, so no group meets in one task. The digits of the rank (base
8) are grouped away one by one inside blocks of 8^4 consecutive rows, each step nesting the children's structs in their
parent's. Block roots are rows of the next tier, treated alike, until every group has one node; group roots form the last
tree. On the way down a ``transform`` of each node's children hands them their siblings, ``posexplode`` unfolds them, and
each row folds its own proof.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respira.llm.common import fresh, lookup, store

#: Children of a node: one digit of the rank in base 8.
BITS = 3
#: Digits grouped away inside one block, whose rows end up nested in one row.
DIGITS = 4
#: Rows of a range partition while ranks are found.
RANGE_ROWS = 250_000
#: What a leaf is made of.
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def sha256(*parts: Column) -> Column:
    """Lower-case hex digest of the parts, one after the other."""
    return F.sha2(F.concat(*parts), 256)


def field(c: Column) -> Column:
    """``-`` for null, else UTF-8 byte count, ``:`` and the value."""
    s = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))


def ranked(rows: DataFrame, group: str, order: list[str]) -> tuple[DataFrame, int]:
    """Stored ``rows`` with ``rank`` in the group (from 0) and ``height``, its tree's levels; and the largest height.

    One shuffle by ranges of group and order; a partition's place in a group comes from a table with a row for each
    partition and group. ``order`` must tell all rows of a group apart, so that a hot value is cut too.
    """
    parts = max(1, -(-rows.count() // RANGE_ROWS))
    keys = [F.col(group).asc_nulls_first(), *[F.col(c).asc_nulls_first() for c in order]]
    d = rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    d = store(d).withColumn("_part", F.shiftright("_at", 33)).withColumn("_g", F.struct(group))
    runs = d.groupBy("_g", "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy("_g")
    before = F.sum("_n").over(w.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("_g", "_part", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"), F.sum("_n").over(w).alias("_size"))
    # Levels until one node is left: the octal digits of the largest rank (none for a lone leaf).
    height = F.when(F.col("_size") > 1, F.length(F.conv((F.col("_size") - 1).cast("string"), 10, 8))).otherwise(0)
    runs = store(runs.withColumn("height", height.cast("int")))
    out = lookup(d, runs, ["_g", "_part"], "inner").withColumn("rank", F.col("_at") + F.col("_shift"))
    return out.drop("_at", "_shift", "_size", "_part", "_g"), runs.agg(F.coalesce(F.max("height"), F.lit(0))).first()[0]


def _nest(rows: DataFrame, group: str, payload: list[str], level: int) -> DataFrame:
    """One row a block: ``group, height, rank`` (the block's), ``node`` with the block's hash and nested children.

    ``rows`` hold ``rank, height, hash`` and the payload that goes into the leaf structs; ``level`` is their level.
    """
    block = F.shiftright("rank", BITS * DIGITS).alias("_block")
    d = rows.select(F.struct(group).alias("_g"), "height", block, "rank", F.struct("hash", *payload).alias("node")).repartition("_g", "_block")
    for k in range(DIGITS):
        child = F.struct(F.col("rank").alias("place"), "node")
        d = d.groupBy("_g", "height", "_block", F.shiftright("rank", BITS).alias("rank")).agg(F.sort_array(F.collect_list(child)).alias("_c"))
        children = F.transform("_c", lambda c: c["node"])
        digests = F.array_join(F.transform("_c", lambda c: c["node"]["hash"]), "")
        own = F.when(F.lit(level + k) < F.col("height"), F.sha2(digests, 256)).otherwise(digests)
        d = d.select("_g", "height", "_block", "rank", F.struct(own.alias("hash"), children.alias("children")).alias("node"))
    return d.select(F.col(f"_g.{group}").alias(group), "height", F.col("_block").alias("rank"), "node")


def _unfold(blocks: DataFrame, keep: list[str], level: int) -> DataFrame:
    """Leaves of nested blocks with their ``path``: the parent's, after the siblings at each level from the leaf up."""
    d = blocks
    for k in reversed(range(DIGITS)):
        sibling = F.transform("node.children", lambda c: c["hash"])
        d = d.select(*keep, "path", sibling.alias("_h"), F.posexplode("node.children").alias("_i", "node"))
        before = F.array_join(F.slice("_h", F.lit(1), F.col("_i")), "")
        after = F.array_join(F.slice("_h", F.col("_i") + 2, F.lit(1 << BITS)), "")
        step = F.array(F.struct(before.alias("before"), after.alias("after")))
        path = F.when(F.lit(level + k) < F.col("height"), F.concat(step, F.col("path"))).otherwise(F.col("path"))
        d = d.select(*keep, path.alias("path"), "node")
    return d


_PATH = "array<struct<before string, after string>>"


def _tree(rows: DataFrame, group: str, order: list[str], payload: list[str], finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Each of ``rows`` (``group, hash``, the order and payload columns) with its payload and ``finish``'s columns.

    ``finish`` gets one row a group (``group``, ``hash`` of its root) and returns it with more columns, among them
    ``path`` from the group's root up.
    """
    rows, top = ranked(rows, group, order)
    tiers, level = [], 0
    while True:
        blocks = store(_nest(rows, group, ["place"] if tiers else payload, level))
        tiers.append((blocks, level))
        level += DIGITS
        if top <= level:
            break
        rows = blocks.select(group, "height", "rank", F.col("rank").alias("place"), F.col("node.hash").alias("hash"))
    roots = finish(blocks.select(group, F.col("node.hash").alias("hash")))
    told = [c for c in roots.columns if c not in (group, "path", "hash")]
    above = roots.withColumn("rank", F.lit(0).cast("long")).select(group, "rank", "path", *told)
    for blocks, level in reversed(tiers):
        # A block and what its parent says of it come together by grouping: one row of each, so no key is hot.
        both = blocks.unionByName(above, allowMissingColumns=True)
        one = [F.first(c, ignorenulls=True).alias(c) for c in ("height", "node", "path", *told)]
        met = both.groupBy(F.struct(group).alias("_g"), "rank").agg(*one)
        keep = [group, "height", *told]
        leaves = _unfold(met.select(F.col(f"_g.{group}").alias(group), "height", *told, "path", "node"), keep, level)
        if level:
            above = store(leaves.select(group, F.col("node.place").alias("rank"), "path", *told))
    return leaves.select(group, *[F.col(f"node.{c}").alias(c) for c in ("hash", *payload)], "path", *told)


def _with_empty_path(roots: DataFrame) -> DataFrame:
    return roots.withColumn("path", F.array().cast(_PATH))


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = FIELDS,
             found: dict[str, Column] | None = None) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof, folded_root, verified`` for every row of ``docs``.

    A leaf is the digest of the row's ``fields`` (``-`` for null, else UTF-8 byte count, ``:`` and value). In each group
    leaves ascend by id and runs of 8 nodes become their parent until one is left, the ``subroot``; subroots by group (null
    first, UTF-8 byte order) likewise give ``root``. ``proof`` lists for each level, from the leaf up, the digests of the
    siblings ``before`` and ``after``. ``found`` gives fields as they are met on verification; ``folded_root`` is what the
    proof makes of the leaf of these values, ``verified`` whether that is the root.

    A null id comes first, equal ids by leaf; equal rows are leaves each. A null group is one of its own. An empty table
    gives no rows; other columns are ignored.
    """
    found = found or {}
    leaf = sha256(*[field(F.col(c)) for c in fields])
    met = sha256(*[field(found.get(c, F.col(c))) for c in fields])
    changed = F.lit(False)
    for c, x in found.items():
        changed = changed | ~x.eqNullSafe(F.col(c))
    rows = docs.select(F.col(group_col).alias("group"), F.col(id_col).alias("doc_id"), leaf.alias("hash"), F.when(changed, met).alias("met"))
    rows = store(rows.withColumn("tie", F.monotonically_increasing_id()))

    def within(roots: DataFrame) -> DataFrame:
        names = roots.select(F.lit(0).alias("all"), "group", "hash")
        top = _tree(names, "all", ["group"], ["group"], lambda r: _with_empty_path(r).withColumn("root", F.col("hash")))
        return top.select("group", "path", F.col("hash").alias("subroot"), "root")

    d = _tree(rows, "group", ["doc_id", "hash", "tie"], ["doc_id", "met"], within)
    folded = F.aggregate("path", F.coalesce("met", "hash"), lambda own, p: sha256(p["before"], own, p["after"]))
    d = d.withColumn("folded_root", folded)
    return d.select("doc_id", F.col("hash").alias("leaf"), "subroot", "root", F.col("path").alias("proof"), "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified"))


def op11_merkle_manifest(spark, sf: str) -> DataFrame:
    """The manifest of ``documents``, verified against texts of which a third were lower-cased."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    text = F.when(hit, F.translate("text", UPPER, LOWER)).otherwise(F.col("text"))
    d = manifest(spark.read.parquet(f"{sf}/documents.parquet"), found={"text": text})
    siblings = F.array_join(F.transform("proof", lambda p: F.concat(p["before"], p["after"])), "")
    return d.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), "folded_root", "verified")


_LEAF = "sha256(concat(" + ", ".join(
    f"coalesce(strlen(cast({c} as varchar)) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars", "{text}")
) + "))"
_CRC_STEP = "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
_CRC = f"""xor(list_reduce(list_prepend(4294967295, list_transform(string_split(cast(doc_id as varchar), ''),
    lambda d: cast(ascii(d) as bigint))), lambda c, b: {_CRC_STEP}), 4294967295)"""
_TAMPERED = f"case when {_CRC} % 3 = 0 then translate(text, '{UPPER}', '{LOWER}') else text end"
_LEVELS = """
    union all
    select level + 1, {key} k, i // 8, sha256(string_agg(h, '' order by i))
    from (select *, count(*) over (partition by k) n from {name}) where n > 1 group by level, k, i // 8"""

SQL = f"""
with recursive leaves as (
    select *, row_number() over (partition by lang order by doc_id nulls first, leaf) - 1 as rank from (
        select doc_id, lang, {_LEAF.replace("{text}", "text")} as leaf, {_LEAF.replace("{text}", f"({_TAMPERED})")} as met from documents)
), langs as (
    select lang, row_number() over (order by lang nulls first) - 1 as k from (select distinct lang from documents)
), placed as materialized (
    select g.k, l.rank as i, l.* from leaves l join langs g on l.lang is not distinct from g.lang order by k, i
), nodes(level, k, i, h) as (
    select 0, k, i, leaf from placed
    {_LEVELS.format(key="k", name="nodes")}
), subroots as (
    select k, level as height, h from nodes n where level = (select max(level) from nodes m where m.k = n.k)
), tops(level, k, i, h) as (
    select 0, 0, k, h from subroots
    {_LEVELS.format(key="k", name="tops")}
), tree as (
    select level, k, i, h from nodes where level < (select height from subroots s where s.k = nodes.k)
    union all
    select s.height + t.level, s.k, t.i, t.h from tops t, subroots s where t.level < (select max(level) from tops)
), named as materialized (
    select row_number() over (order by k, i) as r, * from placed
), fold(level, r, k, i, met, proof) as (
    select 0, l.r, l.k, case when s.height = 0 then l.k else l.i end, l.met, ''
    from named l join subroots s on s.k = l.k
    union all
    select f.level + 1, f.r, f.k, case when f.level + 1 = s.height then f.k else f.i // 8 end,
        sha256(string_agg(case when t.i = f.i then f.met else t.h end, '' order by t.i)),
        f.proof || coalesce(string_agg(t.h, '' order by t.i) filter (t.i <> f.i), '')
    from fold f join tree t on t.level = f.level and t.k = f.k and t.i // 8 = f.i // 8 join subroots s on s.k = f.k
    group by f.level, f.r, f.k, f.i, f.met, f.proof, s.height
), ends as (
    select k, r, arg_max(met, level) as folded_root, arg_max(proof, level) as proof from fold group by k, r
)
select l.doc_id, l.leaf, s.h as subroot, t.h as root, sha256(e.proof) as proof_sha256, e.folded_root, e.folded_root = t.h as verified
from named l join ends e using (r) join subroots s on s.k = l.k, (select h from tops order by level desc limit 1) t
"""
