"""Ordered operators over keyed series that stay parallel when a few keys hold most rows.

Sensor data has few keys and very long histories, so ``partitionBy(key)`` alone leaves most of a cluster idle.
A :class:`Series` cuts every long key into consecutive segments of about ``target_rows`` rows at approximate
quantiles of its time column. Work inside a segment is an ordinary Spark window; what must cross a cut travels
through a carry table with one row per segment, or through halo copies of the rows near a cut. All results equal
those of the uncut window, whatever the cuts are. Inputs that are small by Catalyst's statistics are not cut.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from respira.plans.sizing import cut_lineage, is_small, store_if_costly, target_rows

SEG = "_seg"
_GRID_BITS = 12
#: Rows of a table with one row per key up to which it is sent to every executor, and places of a key beyond that.
FEW_ROWS = 100_000
SALTS = 32


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp, with or without zone (session zone is pinned to UTC)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join on ``keys`` where null keys match each other; key columns are kept once."""
    tmp = {k: f"_r_{k}" for k in keys}
    r = right.withColumnsRenamed(tmp)
    cond = reduce(lambda a, b: a & b, [left[k].eqNullSafe(r[v]) for k, v in tmp.items()])
    return left.join(r, cond, how).drop(*tmp.values())


def join_few(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "left") -> DataFrame:
    """Equi-join of many rows to a table with one row per key, where keys may be few and hot.

    The table is stored and its rows are counted: up to ``FEW_ROWS`` it goes to every executor, so the rows stay where
    they are; beyond that each table row is copied to ``SALTS`` places and a key's rows spread over them.
    """
    if is_small(rows):
        return null_safe_join(rows, table, keys, how)
    table = cut_lineage(table)
    if table.limit(FEW_ROWS + 1).count() <= FEW_ROWS:
        return null_safe_join(rows, F.broadcast(table), keys, how)
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*rows.columns), F.lit(SALTS)))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(SALTS - 1).cast("bigint"))))
    return null_safe_join(salted, copies, [*keys, "_salt"], how).drop("_salt")


def _grid_cuts(df: DataFrame, hot: DataFrame, keys: list[str], order: str, rows: int) -> DataFrame:
    """Cut points of the groups in ``hot`` (with their counts ``_n``), at most the grid's size for each."""
    n_grid = 1 << _GRID_BITS
    grid = ",".join(f"{i / n_grid}D" for i in range(1, n_grid))
    # Multiplied in Python: the product of the usual two million rows and the grid passes 32 bits.
    step = F.greatest(F.lit(1), F.floor(F.lit(rows * n_grid) / F.col("_n")).cast("int"))
    return (
        null_safe_join(df, F.broadcast(hot), keys, "inner")
        .groupBy(*keys)
        .agg(F.max("_n").alias("_n"), F.expr(f"percentile_approx({order}, array({grid}), {10 * n_grid})").alias("_grid"))
        .withColumn("_cuts", F.array_distinct(F.filter("_grid", lambda _, i: (i + 1) % step == 0)))
        .select(*keys, "_cuts")
    )


def _cut_table(df: DataFrame, keys: list[str], order: str, rows: int) -> DataFrame | None:
    """One row per long key with its cut points; ``None`` when no key is long.

    Holds at most (all rows / rows) cuts in total, since only keys above ``rows`` get any. A key of more than
    ``rows`` times the grid's size is cut again inside its segments.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > rows)
    hot = cut_lineage(counts)
    if hot.isEmpty():
        return None
    slim = df.select(*keys, order)
    cuts = cut_lineage(_grid_cuts(slim, hot, keys, order, rows))
    again = hot.filter(F.col("_n") > 2 * rows * (1 << _GRID_BITS)).select(*keys)
    while not again.isEmpty():
        parts = null_safe_join(null_safe_join(slim, F.broadcast(again), keys, "inner"), F.broadcast(cuts), keys)
        parts = parts.withColumn(SEG, _position(F.col("_cuts"), F.col(order))).select(*keys, SEG, order)
        long = cut_lineage(parts.groupBy(*keys, SEG).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 2 * rows))
        more = _grid_cuts(parts, long, [*keys, SEG], order, rows).groupBy(*keys).agg(F.flatten(F.collect_list("_cuts")).alias("_more"))
        both = null_safe_join(cuts, more, keys)
        merged = F.array_sort(F.array_union("_cuts", F.coalesce("_more", F.array().cast(cuts.schema["_cuts"].dataType))))
        # A segment of one repeated time gains no cut; without a new cut nothing more can be split.
        new = cut_lineage(both.select(*keys, merged.alias("_cuts"), (F.size(merged) > F.size("_cuts")).alias("_grew")))
        cuts = new.drop("_grew")
        again = long.filter(F.col("_n") > 2 * rows * (1 << _GRID_BITS)).select(*keys).distinct()
        again = null_safe_join(again, new.filter("_grew").select(*keys), keys, "inner")
    return cuts


def _position(cuts: Column, x: Column) -> Column:
    """Number of cuts <= x, by binary search; 0 where there are no cuts."""
    bits = F.floor(F.log2(F.greatest(F.array_size(cuts), F.lit(1)))).cast("int")
    steps = F.transform(F.sequence(bits, F.lit(0), F.lit(-1)), lambda k: F.call_function("shiftleft", F.lit(1), k))
    return F.when(cuts.isNull(), F.lit(0)).otherwise(
        F.aggregate(
            steps, F.lit(0), lambda lo, st: F.when(F.try_element_at(cuts, lo + st) <= x, lo + st).otherwise(lo)
        )
    )


def number_rows(df: DataFrame, order: list[Column], out: str) -> DataFrame:
    """1-based position of every row in the order given.

    Beyond small inputs the sorted rows are stored, so that partition numbers stay put, and only one count per partition
    is summed up.
    """
    if is_small(df):
        return df.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    d = cut_lineage(df.orderBy(*order)).withColumn("_id", F.monotonically_increasing_id())
    d = d.withColumn("_pid", F.shiftright("_id", 33)).withColumn("_pos", F.col("_id").bitwiseAND((1 << 33) - 1))
    counts = d.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    return d.join(counts, "_pid").withColumn(out, F.col("_off") + F.col("_pos") + 1).drop("_id", "_pid", "_pos", "_off")


class Series:
    """Rows of ``df`` grouped by ``keys`` and ordered by ``order`` (first entry numeric, rest break ties)."""

    def __init__(self, df: DataFrame, keys: list[str], order: list[str], cuts: DataFrame | None, split: bool):
        self._df, self.keys, self.order, self._cuts, self.split = df, list(keys), list(order), cuts, split

    @classmethod
    def of(cls, df: DataFrame, keys: list[str], order: list[str], small: bool | None = None) -> Series:
        """Prepare a series; ``small=True`` skips the size probe when the caller knows the answer."""
        if small is None:
            small = is_small(df)
        if small:
            return cls(df, keys, order, None, False)
        df = store_if_costly(df)
        cuts = _cut_table(df, keys, order[0], target_rows(df))
        if cuts is None:
            return cls(df, keys, order, None, False)
        seg = _position(F.col("_cuts"), F.col(order[0]))
        cut = join_few(df, cuts, keys).withColumn(SEG, seg).drop("_cuts")
        return cls(cut, keys, order, cuts, True)

    @property
    def df(self) -> DataFrame:
        """The rows with all columns added so far."""
        return self._df.drop(SEG) if self.split else self._df

    def _with(self, df: DataFrame) -> Series:
        return Series(df, self.keys, self.order, self._cuts, self.split)

    @property
    def _group(self) -> list[str]:
        return [*self.keys, SEG] if self.split else self.keys

    def _window(self, desc: bool = False):
        cols = [F.col(c).desc() if desc else F.col(c) for c in self.order]
        return Window.partitionBy(*self._group).orderBy(*cols)

    def map(self, fn: Callable[[DataFrame], DataFrame]) -> Series:
        """Apply a row-wise change that keeps keys and order columns."""
        return self._with(fn(self._df))

    def with_columns(self, cols: dict[str, Column]) -> Series:
        return self._with(self._df.withColumns(cols))

    def previous(self, cols: dict[str, str]) -> Series:
        """``out -> source``: value of the preceding row of the same key (nulls are not skipped)."""
        w = self._window()
        if not self.split:
            return self.with_columns({o: F.lag(c).over(w) for o, c in cols.items()})
        pack = F.struct(*[F.col(c).alias(o) for o, c in cols.items()])
        tails = self._df.groupBy(*self._group).agg(F.max_by(pack, F.struct(*self.order)).alias("_tail"))
        over_segs = Window.partitionBy(*self.keys).orderBy(SEG)
        carry = tails.withColumn("_carry", F.lag("_tail").over(over_segs)).drop("_tail")
        d = self._df.withColumn("_first", F.row_number().over(w) == 1)
        d = d.withColumns({o: F.lag(c).over(w) for o, c in cols.items()})
        d = null_safe_join(d, carry, self._group)
        pick = {o: F.when(F.col("_first"), F.col("_carry")[o]).otherwise(F.col(o)) for o in cols}
        return self._with(d.withColumns(pick).drop("_first", "_carry"))

    def running_sum(self, cols: dict[str, Column]) -> Series:
        """Inclusive running sums per key."""
        w = self._window().rowsBetween(Window.unboundedPreceding, 0)
        if not self.split:
            return self.with_columns({o: F.sum(c).over(w) for o, c in cols.items()})
        tot = self._df.groupBy(*self._group).agg(*[F.sum(c).alias(o) for o, c in cols.items()])
        before = Window.partitionBy(*self.keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
        carry = tot.select(*self._group, *[F.sum(o).over(before).alias(f"_c_{o}") for o in cols])
        d = self._df.withColumns({o: F.sum(c).over(w) for o, c in cols.items()})
        d = null_safe_join(d, carry, self._group)
        add = {
            o: F.when(F.col(o).isNull() & F.col(f"_c_{o}").isNull(), None).otherwise(
                F.coalesce(F.col(o), F.lit(0)) + F.coalesce(F.col(f"_c_{o}"), F.lit(0))
            )
            for o in cols
        }
        return self._with(d.withColumns(add).drop(*[f"_c_{o}" for o in cols]))

    def row_number(self, out: str) -> Series:
        """1-based position within the key."""
        if not self.split:
            return self.with_columns({out: F.row_number().over(self._window()).cast("bigint")})
        return self.running_sum({out: F.lit(1).cast("bigint")})

    def nearest_known(self, cols: dict[str, str], forward: bool = True, strict: bool = False) -> Series:
        """``out -> source``: last non-null value at or before the row (``forward``) or next at or after it."""
        w = self._window(desc=not forward).rowsBetween(Window.unboundedPreceding, -1 if strict else 0)
        local = {o: F.last(c, ignorenulls=True).over(w) for o, c in cols.items()}
        if not self.split:
            return self.with_columns(local)
        pos = F.struct(*self.order)
        pick = F.max_by if forward else F.min_by
        ends = self._df.groupBy(*self._group).agg(
            *[pick(F.col(c), F.when(F.col(c).isNotNull(), pos)).alias(o) for o, c in cols.items()]
        )
        seg = F.col(SEG) if forward else F.col(SEG).desc()
        before = Window.partitionBy(*self.keys).orderBy(seg).rowsBetween(Window.unboundedPreceding, -1)
        carry = ends.select(
            *self._group, *[F.last(o, ignorenulls=True).over(before).alias(f"_c_{o}") for o in cols]
        )
        d = null_safe_join(self._df.withColumns(local), carry, self._group)
        d = d.withColumns({o: F.coalesce(F.col(o), F.col(f"_c_{o}")) for o in cols})
        return self._with(d.drop(*[f"_c_{o}" for o in cols]))

    def rows_frame(self, before: int, after: int, cols: dict[str, Callable]) -> Series:
        """``out -> fn(window)`` over the frame from ``before`` rows back to ``after`` rows on."""
        if not self.split:
            w = self._window().rowsBetween(-before, after)
            return self.with_columns({o: fn(w) for o, fn in cols.items()})
        block = max(target_rows(self._df), before + after + 1)
        d = self.row_number("_rn")._df
        lo = F.greatest(F.lit(0), F.floor((F.col("_rn") - after) / block)).cast("int")
        hi = F.floor((F.col("_rn") + before) / block).cast("int")
        d = d.withColumn("_own", F.floor(F.col("_rn") / block).cast("int"))
        d = d.withColumn("_blk", F.explode(F.sequence(lo, hi)))
        w = Window.partitionBy(*self.keys, "_blk").orderBy("_rn").rowsBetween(-before, after)
        d = d.withColumns({o: fn(w) for o, fn in cols.items()}).filter("_blk = _own")
        return self._with(d.drop("_rn", "_own", "_blk"))

    def range_frame(self, before: int, after: int, cols: dict[str, Callable]) -> Series:
        """``out -> fn(window)`` over rows whose order value lies in [x - before, x + after].

        Costs the rows of a frame for every row; ``trailing_range`` does not.
        """
        x = self.order[0]
        if not self.split:
            w = Window.partitionBy(*self.keys).orderBy(x).rangeBetween(-before, after)
            return self.with_columns({o: fn(w) for o, fn in cols.items()})
        d = join_few(self._df, self._cuts, self.keys)
        lo, hi = _position(F.col("_cuts"), F.col(x) - after), _position(F.col("_cuts"), F.col(x) + before)
        d = d.withColumn("_blk", F.explode(F.sequence(lo, hi))).drop("_cuts")
        w = Window.partitionBy(*self.keys, "_blk").orderBy(x).rangeBetween(-before, after)
        d = d.withColumns({o: fn(w) for o, fn in cols.items()}).filter(F.col("_blk") == F.col(SEG))
        return self._with(d.drop("_blk"))


def _running(pairs: list[tuple[str, Column]], w) -> Column:
    """What the values of a running frame come to, one entry for each (kind, value); deviations as count, mean and square."""
    parts = []
    for kind, v in pairs:
        if kind == "stddev_samp":
            v = v.cast("double")
            parts.append(F.struct(F.count(v).over(w).alias("n"), F.avg(v).over(w).alias("m"), F.var_pop(v).over(w).alias("q")))
        else:
            parts.append({"min": F.min, "max": F.max}[kind](v).over(w))
    return F.struct(*[p.alias(f"p{i}") for i, p in enumerate(parts)])


def _merged(kind: str, a: Column, b: Column) -> Column:
    """One value from those of two frames without a common row (a common row does no harm to ``min`` and ``max``)."""
    if kind != "stddev_samp":
        return {"min": F.least, "max": F.greatest}[kind](a, b)
    na, nb = F.coalesce(a["n"], F.lit(0)), F.coalesce(b["n"], F.lit(0))
    n, gap = na + nb, F.coalesce(b["m"] - a["m"], F.lit(0.0))
    square = F.coalesce(a["q"] * na, F.lit(0.0)) + F.coalesce(b["q"] * nb, F.lit(0.0)) + gap * gap * F.try_divide(na * nb, n)
    return F.when(n > 1, F.sqrt(square / (n - 1)))


def trailing_range(df: DataFrame, keys: list[str], x: str, span: int, cols: dict[str, tuple[str, str]]) -> DataFrame:
    """``out -> (kind, column)``: ``min``, ``max`` or ``stddev_samp`` of the rows of the key with ``x`` in [x - span, x].

    A sliding frame costs its own length for every row, which grows with the density of readings. Here time is cut into
    blocks of ``span + 1``: a frame is the end of one block and the beginning of the next, both running aggregates, so the
    work is three rows sorted for every row. Blocks spread over tasks by themselves; a task holds whole blocks.
    """
    block, back, columns = span + 1, F.col(x) - span, df.columns
    used = list(dict.fromkeys(c for _, c in cols.values()))
    row = F.struct(*[F.col(c) for c in columns])
    none = F.lit(None)
    reading = F.struct(
        F.floor(F.col(x) / block).alias("blk"), F.col(x).alias("u"), F.struct(*[F.col(c) for c in used]).alias("v"),
        none.cast(df.select(row.alias("r")).schema["r"].dataType).alias("row"),
    )
    asked = F.struct(
        F.floor(back / block).alias("blk"), back.alias("u"),
        F.struct(*[none.cast(df.schema[c].dataType).alias(c) for c in used]).alias("v"), row.alias("row"),
    )
    at = Window.partitionBy(*keys, "_at.blk").orderBy(F.desc("_at.u")).rangeBetween(Window.unboundedPreceding, 0)
    d = df.select(*keys, F.explode(F.array(reading, asked)).alias("_at"))
    d = d.withColumn("_end", _running([(kind, F.col("_at")["v"][c]) for kind, c in cols.values()], at))
    d = d.filter("_at.row IS NOT NULL").select("_at.row.*", F.col("_at.blk").alias("_from"), "_end")
    d = d.withColumn("_blk", F.floor(F.col(x) / block))
    w = Window.partitionBy(*keys, "_blk").orderBy(x).rangeBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_begin", _running([(kind, F.col(c)) for kind, c in cols.values()], w))
    # At the last instant of a block the frame is that block, which its beginning alone covers; so is that of unknown times.
    end = F.when(F.col("_from") < F.col("_blk"), F.col("_end"))
    out = {o: _merged(kind, end[f"p{i}"], F.col("_begin")[f"p{i}"]) for i, (o, (kind, _)) in enumerate(cols.items())}
    return d.select(*columns, *[c.alias(o) for o, c in out.items()])
