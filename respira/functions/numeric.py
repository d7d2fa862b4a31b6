"""Numeric cleaning and null-preserving arithmetic."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def numeric(c: str | Column) -> Column:
    """Double value of any column; text that is no number and NaN become null."""
    col = F.col(c) if isinstance(c, str) else c
    d = col.try_cast("double")
    return F.when(~F.isnan(d), d)


def clean_numeric(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: numeric(c) for c in cols})


def clip(c: Column, lo: float, hi: float) -> Column:
    """Limit to [lo, hi]; null stays null (``greatest`` alone would skip it)."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(lo)), F.lit(hi)))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is 0."""
    return F.try_divide(a, b)


def rounded(c: Column, digits: int) -> Column:
    """Half-even rounding without negative zero."""
    return F.bround(c, digits) + F.lit(0.0)


def true(c: Column) -> Column:
    """Condition with unknown taken as false."""
    return F.coalesce(c, F.lit(False))


def any_of(conds: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [true(c) for c in conds], F.lit(False))


def row_mean(cols: list[Column]) -> Column:
    """Mean of the non-null entries; null if there are none."""
    total = reduce(lambda a, b: a + b, [F.coalesce(c, F.lit(0.0)) for c in cols])
    n = reduce(lambda a, b: a + b, [c.isNotNull().cast("int") for c in cols])
    return F.try_divide(total, n)
