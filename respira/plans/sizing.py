"""Size probes that decide between a one-shuffle plan and a split plan."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from respira.session import checkpoint_dir

SMALL_BYTES = 64 << 20
SMALL_CONF = "respira.small.bytes"
TARGET_CONF = "respira.series.rows"
TARGET_ROWS = 2_000_000


# Input bytes behind stored results, by id of the stored RDD: a stored result keeps only a join-inflated estimate.
_STORED: dict[int, int] = {}


def _leaves(df: DataFrame) -> list:
    found = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return [found.apply(i) for i in range(found.size())]


def source_bytes(df: DataFrame) -> int:
    """Bytes of the tables a plan reads, from Catalyst's leaf statistics (no job is run)."""
    total = 0
    for leaf in _leaves(df):
        stored = _STORED.get(leaf.rdd().id()) if leaf.getClass().getSimpleName() == "LogicalRDD" else None
        total += stored if stored is not None else int(str(leaf.stats().sizeInBytes()))
    return total


def is_small(df: DataFrame) -> bool:
    """True when all inputs together fit one task comfortably, so no key can be too large for one."""
    limit = int(df.sparkSession.conf.get(SMALL_CONF, str(SMALL_BYTES)))
    return source_bytes(df) <= limit


def target_rows(df: DataFrame) -> int:
    """Rows one window task should see at most."""
    return int(df.sparkSession.conf.get(TARGET_CONF, str(TARGET_ROWS)))


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of executors, unlike cached or local copies."""
    checkpoint_dir(df.sparkSession)
    size = source_bytes(df)
    out = df.checkpoint(eager=True)
    for leaf in _leaves(out):
        if leaf.getClass().getSimpleName() == "LogicalRDD":
            _STORED[leaf.rdd().id()] = size
    return out


def write_once(df: DataFrame) -> DataFrame:
    """Store ``df`` as a table in the shared folder and read it back: unlike a checkpoint it is computed only once."""
    folder = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


_COSTLY = ("Join ", "Aggregate ", "Window ", "Sort ", "Generate ", "Repartition", "MapInPandas", "FlatMapGroups")


def store_if_costly(df: DataFrame) -> DataFrame:
    """Store a table that is about to be read several times, unless it is a plain scan that is cheaper to repeat.

    Without this, operators that each read their input a few times would multiply each other's work when chained.
    """
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return cut_lineage(df) if any(word in plan for word in _COSTLY) else df
