"""Cycles of an unbounded reading stream.

Row-wise operators (bounds, grading, conversion) run on streaming tables as they are. Sessions need state, which Spark's
own session windows keep: a cycle is emitted once the watermark has passed its end by the gap.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cycle_fits(
    stream: DataFrame, keys: list[str], ts: str, value: str, gap_sec: int = 300, late: str = "10 minutes"
) -> DataFrame:
    """One regression per finished cycle: start, points, slope per second and r2. Readings later than ``late`` drop out.

    Session windows join readings up to ``gap_sec`` apart, as the batch sessions do for whole seconds.
    """
    t = F.unix_micros(F.col(ts).cast("timestamp")) / 1e6
    known = stream.filter(F.col(value).isNotNull()).withColumn("_t", t).withWatermark(ts, late)
    return (
        known.groupBy(*keys, F.session_window(ts, f"{gap_sec} seconds").alias("_s"))
        .agg(
            F.min(ts).alias("flux_date"),
            F.count(F.lit(1)).alias("n_points"),
            F.regr_slope(value, "_t").alias("flux_slope"),
            F.regr_r2(value, "_t").alias("r_squared"),
        )
        .drop("_s")
    )
