"""How the shared tables stand in for sensor tables.

``events`` is the sensor stream. A *sensor* is an event type (few series, many rows) and a *chamber* is a user (many
series); ``value`` is the reading, null below the detection limit of 1.0, and the number in ``props`` is a second
channel (temperature or humidity). Orders give a calendar of several years.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from respira.session import prepare

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


def readings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(
        "event_id",
        "ts",
        F.col("event_type").alias("sensor"),
        F.col("user_id").alias("chamber"),
        F.when(F.col("value") >= 1, F.col("value")).alias("value"),
        F.regexp_extract("props", r"(\d+)", 1).cast("int").alias("aux"),
    )


READINGS = """readings AS (
  SELECT event_id, ts, event_type AS sensor, user_id AS chamber,
         CASE WHEN value >= 1 THEN value END AS value,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) AS aux
  FROM events)"""


def r(c: str | Column, digits: int = 6) -> Column:
    """Comparable number: rounded, without negative zero.

    The nudge moves exact rounding ties, common for means of decimals, off the boundary, so that two engines summing in
    different orders round alike.
    """
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col + F.lit(_nudge(digits)), digits) + F.lit(0.0)


def sr(expr: str, digits: int = 6) -> str:
    return f"round(({expr}) + {_nudge(digits):.12g}, {digits}) + 0.0"


def _nudge(digits: int) -> float:
    return float(f"1.23e-{digits + 2}")


def registry():
    """A fresh registry and the decorator that fills it."""
    queries: dict[str, tuple[Query, str | None]] = {}

    def query(name: str, sql: str | None = None):
        def add(fn: Query) -> Query:
            queries[name] = (fn, sql)
            return fn

        return add

    return queries, query
