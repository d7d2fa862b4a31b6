"""Writers. All write in parallel, one directory per result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_quality_data(df: DataFrame, path: str, csv_path: str | None = None, mode: str = "overwrite") -> None:
    """Flagged data as zstd parquet, with a CSV copy where asked for."""
    df.write.mode(mode).option("compression", "zstd").parquet(path)
    if csv_path:
        df.write.mode(mode).option("header", "true").csv(csv_path)


def write_monthly(df: DataFrame, path: str, ts: str = "TIMESTAMP", fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One partition per calendar month, clustered so that a month is not scattered over small files.

    Rows are ranged by time, not hashed by month: a month with most of the rows still gets many writers.
    """
    d = df.drop("Date").withColumn("year_month", F.date_format(ts, "yyyy-MM"))
    writer = d.repartitionByRange("year_month", ts).write.mode(mode).partitionBy("year_month")
    writer.option("header", "true").csv(path) if fmt == "csv" else writer.parquet(path)


def monthly_summary(df: DataFrame, ts: str = "TIMESTAMP") -> DataFrame:
    """Records per month, newest first."""
    month = F.date_format(ts, "yyyy-MM").alias("month")
    return df.groupBy(month).agg(F.count(F.lit(1)).alias("records")).orderBy(F.desc("month"))


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite") -> None:
    """Result table (cycles, scored cycles, windows, scorecards) as CSV, JSON or parquet."""
    w = df.write.mode(mode)
    (w.option("header", "true").csv if fmt == "csv" else w.json if fmt == "json" else w.parquet)(path)
