"""Logger text files: four preamble lines (station, names, units, type), then one reading per line."""

from __future__ import annotations

import csv
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from respira.functions.numeric import numeric
from respira.plans.series import join_few
from respira.plans.sizing import cut_lineage

# How sensor folders are recognised, first match wins.
SENSOR_PATTERNS = {
    "chamber_1": ["chamber1", "chamber_1"],
    "chamber_2": ["chamber2", "chamber_2"],
    "climate": ["climate"],
    "soil_sensor": ["soil"],
}
_NAMES_LINE = r'(^|,)"?TIMESTAMP"?(,|$)'


def _parse_names(line: str) -> list[str]:
    return [n.strip() for n in next(csv.reader([line]))]


def _fields(line: Column, width: int) -> Column:
    """The comma-separated fields of a line, missing ones null."""
    parsed = F.from_csv(line, F.lit(", ".join(f"c{i} STRING" for i in range(width))))
    return F.array(*[F.trim(parsed[f"c{i}"]) for i in range(width)])


def read_logger(
    spark: SparkSession,
    path: str | list[str],
    pattern: str | None = None,
    flat: bool = False,
    start: str | None = None,
    end: str | None = None,
    names_line: str | None = None,
) -> DataFrame:
    """All logger files under ``path`` as one table: ``TIMESTAMP``, every column any file has (null elsewhere), ``_file``.

    Files may have any number of layouts: a line's fields are found through its own file's names line, which travels
    with it. Only the distinct column names reach the driver; give ``names_line`` where all files share one layout and
    the extra pass over the text is not needed. Preamble lines and lines without a valid time drop out by content, so
    files can be split anywhere. Both ends of the time range count, and it applies only if both are given. Files without
    a TIMESTAMP column are skipped.
    """
    reader = spark.read.option("recursiveFileLookup", str(not flat).lower())
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    lines = reader.text(path).select("value", F.col("_metadata.file_path").alias("_file"))
    if names_line is None:
        found = lines.filter(F.col("value").rlike(_NAMES_LINE))
        heads = found.groupBy("_file").agg(F.min("value").alias("_head"))
        width = heads.agg(F.max(F.size(F.split("_head", ",")))).first()[0]
        if width is None:
            return spark.createDataFrame([], "TIMESTAMP timestamp_ntz, _file string")
        heads = cut_lineage(heads.select("_file", _fields(F.col("_head"), width).alias("_names")))
        spots = heads.select(F.posexplode("_names").alias("i", "name")).filter("name <> ''")
        columns = [r[0] for r in spots.groupBy("name").agg(F.min("i").alias("i")).orderBy("i", "name").collect()]
        lines = join_few(lines, heads, ["_file"], "inner")
    else:
        names = _parse_names(names_line)
        width, columns = len(names), list(dict.fromkeys(n for n in names if n))
        lines = lines.withColumn("_names", F.array(*[F.lit(n) for n in names]))
    d = lines.withColumn("_v", _fields(F.col("value"), width))

    def value(name: str) -> Column:
        """The field under this name in the line's own layout."""
        spot = F.array_position("_names", name)
        return F.when(spot > 0, F.try_element_at("_v", spot.cast("int")))

    columns = [c for c in columns if c != "TIMESTAMP"]
    out = d.select(
        F.try_to_timestamp(value("TIMESTAMP")).cast("timestamp_ntz").alias("TIMESTAMP"),
        *[numeric(value(c)).alias(c) for c in columns],
        "_file",
    ).filter(F.col("TIMESTAMP").isNotNull())
    if start is not None and end is not None:
        span = [F.lit(x).cast("timestamp_ntz") for x in (start, end)]
        out = out.filter(F.col("TIMESTAMP").between(*span))
    return out


def first_per_time(df: DataFrame, keys: list[str], ts: str = "TIMESTAMP", file: str = "_file") -> DataFrame:
    """One row per key and time, from the first file in name order."""
    w = Window.partitionBy(*keys, ts).orderBy(file)
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r")


def merge_sources(frames: list[DataFrame], keys: list[str], ts: str = "TIMESTAMP") -> DataFrame:
    """Union of sources in order; where they share a time the later source wins."""
    ranked = [f.withColumn("_rank", F.lit(i)) for i, f in enumerate(frames)]
    return latest_source(reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), ranked), keys, ts)


def latest_source(df: DataFrame, keys: list[str], ts: str = "TIMESTAMP", rank: str = "_rank") -> DataFrame:
    """One row per key and time, from the highest ``rank``; rows of one source go by their other columns, largest first."""
    rest = [c for c in df.columns if c not in (*keys, ts, rank)]
    w = Window.partitionBy(*keys, ts).orderBy(F.desc(rank), *[F.desc(c) for c in rest])
    return df.withColumn("_r", F.row_number().over(w)).filter("_r = 1").drop("_r", rank)


def sensor_of(file: Column) -> Column:
    """Sensor type from a file path: its folder below ``main`` or ``update_*``; null for other folders."""
    folder = F.lower(F.regexp_extract(file, r"/(?:main|update_[0-9][^/]*)/([^/]+)/", 1))
    out = F.lit(None).cast("string")
    for sensor, marks in reversed(SENSOR_PATTERNS.items()):
        hit = reduce(lambda a, b: a | b, [folder.contains(m) for m in marks])
        out = F.when(hit, sensor).otherwise(out)
    return out


def source_rank(file: Column) -> Column:
    """Order of sources: the main folder first, then update folders by name."""
    return F.regexp_extract(file, r"/(?:main|(update_[0-9][^/]*))/", 1)


def read_sensor_tree(spark: SparkSession, base: str, **kwargs) -> DataFrame:
    """One reading per sensor and time of everything under ``main`` and ``update_*``; later updates override earlier ones.

    Where one file repeats a time, the row with the largest columns in file order counts, so the highest record number.
    """
    d = read_logger(spark, base, **kwargs)
    d = d.withColumn("sensor", sensor_of(F.col("_file"))).filter(F.col("sensor").isNotNull())
    d = d.withColumn("_rank", F.struct(source_rank(F.col("_file")), "_file"))
    return latest_source(d, ["sensor"])
