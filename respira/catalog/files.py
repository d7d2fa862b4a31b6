"""File sources and sinks: tables are written as files by Spark and read back through the package."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from respira.catalog.base import READINGS, r, readings, registry, sr, table
from respira.plans.sizing import source_bytes
from respira.session import checkpoint_dir
from respira.sources import logger, sinks, tables

QUERIES, query = registry()


def fresh_folder(spark) -> str:
    """A new folder in the session's shared folder."""
    return f"{checkpoint_dir(spark)}/files-{uuid.uuid4().hex}"


LAYOUTS = {
    "click": ("main", "chamber_1", '"TIMESTAMP","RECORD","CO2_C1","Temp_1_C1"'),
    "view": ("main", "Chamber2_logs", '"TIMESTAMP","RECORD","CO2_C2","RH_1_C2","Temp_1_C2"'),
    "error": ("main", "climate", '"TIMESTAMP","RECORD","AirTC_Avg"'),
    "signup": ("update_240101", "soil_x", '"TIMESTAMP","RECORD","AirTC_Avg_Soil"'),
    "purchase": ("update_240201", "notes", '"TIMESTAMP","RECORD","Junk"'),
}


def write_logger_files(spark, sf: str, folder: str, only: str | None = None) -> None:
    """Events as logger files of several layouts, one file per sensor and day; an update folder repeats some readings."""
    d = readings(spark, sf)
    v = F.coalesce(F.col("value").cast("string"), F.lit('"NAN"'))
    aux = F.col("aux").cast("string")
    stamp = F.concat(F.lit('"'), F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit('"'))
    fields = {
        "click": [v, aux],
        "view": [v, aux, aux],
        "error": [aux],
        "signup": [v],
        "purchase": [v],
    }
    parts = []
    layouts = {k: v for k, v in LAYOUTS.items() if only in (None, k)}
    for sensor, (top, sub, names) in layouts.items():
        s = d.filter(F.col("sensor") == sensor)
        line = F.concat_ws(",", stamp, F.col("event_id").cast("string"), *fields[sensor])
        day = F.col("ts").cast("date").alias("day")
        rows = s.select(day, F.lit(1).alias("o"), stamp.alias("k"), line.alias("value"))
        parts.append((rows, (top, sub, names)))
        if sensor == "click":
            again = s.filter("aux >= 50").select(
                day, F.lit(1).alias("o"), stamp.alias("k"),
                F.concat_ws(",", stamp, F.col("event_id").cast("string"), F.lit("777.5"), aux).alias("value"),
            )
            parts.append((again, ("update_240101", "chamber_1_new", names)))
    # A day becomes more files as the table grows, each with its own preamble.
    salts = 1 + source_bytes(d) // (128 << 20)
    for rows, (top, sub, names) in parts:
        rows = rows.withColumn("part", F.pmod(F.xxhash64("k"), F.lit(salts)))
        head = rows.select("day", "part").distinct()
        pre = F.array(
            *[
                F.struct(F.lit(0).alias("o"), F.lit(str(i)).alias("k"), F.lit(t).alias("value"))
                for i, t in enumerate(('"TOA5","STATION","CR1000X"', names, '"TS","RN","x"', '"","","Smp"'))
            ]
        )
        head = head.select("day", "part", F.explode(pre).alias("p")).select("day", "part", "p.*")
        # Directory names must be plain folder names, so every part goes under its own path.
        both = rows.unionByName(head).repartition("day", "part").sortWithinPartitions("day", "part", "o", "k")
        both.select("day", "part", "value").write.partitionBy("day", "part").text(f"{folder}/{top}/{sub}")


# Every line of the written files: all readings, and the repeated ones of the update folder.
LINES = f"""{READINGS}, lines AS (SELECT *, 0 AS again FROM readings UNION ALL
  SELECT event_id, ts, sensor, chamber, 777.5, aux, 1 FROM readings WHERE sensor = 'click' AND aux >= 50)"""


def _of(sensor: str, expr: str, name: str) -> str:
    return f"CASE WHEN sensor = '{sensor}' THEN {expr} END AS \"{name}\""


NAMED = ", ".join([
    _of("click", sr("value"), "CO2_C1"), _of("click", "CAST(aux AS DOUBLE)", "Temp_1_C1"), _of("view", sr("value"), "CO2_C2"),
    _of("view", "CAST(aux AS DOUBLE)", "RH_1_C2"), _of("error", "CAST(aux AS DOUBLE)", "AirTC_Avg"),
    _of("signup", sr("value"), "AirTC_Avg_Soil"),
])
STAMP = 'ts AS "TIMESTAMP", CAST(event_id AS DOUBLE) AS "RECORD"'


def _named(d):
    return d.select(
        "TIMESTAMP", "RECORD", r("CO2_C1").alias("CO2_C1"), "Temp_1_C1", r("CO2_C2").alias("CO2_C2"), "RH_1_C2", "AirTC_Avg",
        r("AirTC_Avg_Soil").alias("AirTC_Avg_Soil"),
    )


@query("logger_file_scan", f"WITH {LINES} SELECT {STAMP}, {NAMED} FROM lines")
def logger_file_scan(spark, sf):
    folder = fresh_folder(spark)
    write_logger_files(spark, sf, folder)
    return _named(logger.read_logger(spark, folder))


@query(
    "logger_range_scan",
    f"WITH {LINES} SELECT {STAMP}, {NAMED} FROM lines WHERE again = 0 AND ts BETWEEN TIMESTAMP '2024-01-04' AND TIMESTAMP '2024-01-20'",
)
def logger_range_scan(spark, sf):
    folder = fresh_folder(spark)
    write_logger_files(spark, sf, folder)
    d = logger.read_logger(spark, [f"{folder}/main", folder], start="2024-01-04 00:00:00", end="2024-01-20 00:00:00")
    return _named(logger.first_per_time(d, ["RECORD"]))


@query(
    "later_source_wins",
    f"""WITH {LINES} SELECT {STAMP}, {NAMED} FROM lines WHERE sensor <> 'purchase' AND (again = 1 OR NOT (sensor = 'click' AND aux >= 50))""",
)
def later_source_wins(spark, sf):
    folder = fresh_folder(spark)
    write_logger_files(spark, sf, folder)
    main, update = (logger.read_logger(spark, f"{folder}/{top}") for top in ("main", "update_240101"))
    return _named(logger.merge_sources([main, update], ["RECORD"]))


# One reading per sensor and time: the update folder's before the main one's, then the highest record number.
@query(
    "sensor_tree_scan",
    f"""WITH {LINES}, one AS (SELECT *, row_number() OVER (PARTITION BY sensor, ts ORDER BY again DESC, event_id DESC) AS rn FROM lines WHERE sensor <> 'purchase')
SELECT CASE sensor WHEN 'click' THEN 'chamber_1' WHEN 'view' THEN 'chamber_2' WHEN 'error' THEN 'climate' ELSE 'soil_sensor' END AS sensor, ts AS "TIMESTAMP",
 CAST(event_id AS DOUBLE) AS "RECORD", {_of("click", sr("value"), "CO2_C1")}, {_of("signup", sr("value"), "AirTC_Avg_Soil")} FROM one WHERE rn = 1""",
)
def sensor_tree_scan(spark, sf):
    folder = fresh_folder(spark)
    write_logger_files(spark, sf, folder)
    d = logger.read_sensor_tree(spark, folder)
    return d.select("sensor", "TIMESTAMP", "RECORD", r("CO2_C1").alias("CO2_C1"), r("AirTC_Avg_Soil").alias("AirTC_Avg_Soil"))


def hardware(spark, sf):
    o = table(spark, sf, "orders")
    return o.select(
        F.col("o_orderkey"),
        F.col("o_orderdate").alias("TIMESTAMP"),
        (F.col("o_totalprice") / 4000 - 5).cast("string").alias("Temp_1_C1"),
        (F.col("o_custkey") - 150).cast("string").alias("RH_1_C1"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 1000 + 40).cast("string").alias("AtmosphericPressure_1_C2"),
        (F.col("o_totalprice") / 480).alias("WP_1_Soil"),
    )


HW = """hw AS (SELECT o_orderkey, o_orderdate AS ts, o_totalprice / 4000 - 5 AS t, o_custkey - 150 AS rh, CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 1000 + 40 END AS ap, o_totalprice / 480 AS wp FROM orders),
 ok AS (SELECT * FROM hw WHERE NOT (t < -100 OR t > 100 OR rh < -100 OR coalesce(ap < 50, false) OR wp > 1000))"""


@query(
    "monthly_scan_hardware_filter",
    f"""WITH {HW} SELECT o_orderkey, ts AS "TIMESTAMP", {sr('t', 4)} AS "Temp_1_C1", strftime(ts, '%Y-%m') AS year_month FROM ok WHERE strftime(ts, '%Y-%m') IN ('1996-02', '1996-03', '1997-11')""",
)
def monthly_scan_hardware_filter(spark, sf):
    folder = fresh_folder(spark)
    sinks.write_monthly(hardware(spark, sf), folder)
    d = tables.read_monthly(spark, folder, ["1996-02", "1996-03", "1997-11"])
    return d.select("o_orderkey", "TIMESTAMP", r("Temp_1_C1", 4).alias("Temp_1_C1"), F.col("year_month").cast("string"))


@query("monthly_export_summary", "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS records FROM orders GROUP BY 1")
def monthly_export_summary(spark, sf):
    return sinks.monthly_summary(table(spark, sf, "orders"), "o_orderdate")


@query(
    "radiation_normalisation",
    """SELECT o_orderkey, o_orderdate + to_hours(CAST(o_custkey % 24 AS INT)) AS "TIMESTAMP", CASE WHEN o_orderstatus <> 'P' THEN o_custkey * 1.0 END AS "Global_Radiation" FROM orders WHERE o_orderpriority <> '5-LOW'""",
)
def radiation_normalisation(spark, sf):
    folder = fresh_folder(spark)
    o = table(spark, sf, "orders")
    low = F.col("o_orderpriority") == "5-LOW"
    o.select(
        "o_orderkey",
        F.when(low, "--").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("Date"),
        F.format_string("%02d:00:00", (F.col("o_custkey") % 24).cast("int")).alias("Time"),
        F.when(F.col("o_orderstatus") == "P", "--").otherwise(F.col("o_custkey").cast("string")).alias("Solar Rad W"),
    ).write.option("header", "true").csv(folder)
    d = tables.normalise_radiation(spark.read.option("header", "true").csv(folder))
    return d.select(F.col("o_orderkey").cast("bigint"), "TIMESTAMP", "Global_Radiation")


def sheet(spark, sf):
    c = table(spark, sf, "customer")
    code = F.when(F.col("c_custkey") % 7 == 0, "x").otherwise(F.concat(F.lit("2.2/EKA-"), F.col("c_nationkey") % 4, F.lit("/"), F.col("c_custkey")))
    return c.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") != "BUILDING", F.date_add(F.lit("2024-01-01").cast("date"), F.col("c_nationkey"))).alias("Tanggal"),
        code.alias("Kode pohon"),
        (F.col("c_custkey") % 40).alias("Total Pelepah"),
        (F.col("c_custkey") % 900).alias("Tinggi Pohon (cm)"),
        F.when(F.col("c_acctbal") > 0, F.col("c_acctbal") / 10).alias("R1 (cm)"),
        F.when(F.col("c_nationkey") > 5, F.col("c_nationkey") * 1.0).alias("R2 (cm)"),
        (F.col("c_acctbal") * 1000).alias("Vigor Index"),
    )


SHEET = """sh AS (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN DATE '2024-01-01' + c_nationkey END AS d,
  CASE WHEN c_custkey % 7 = 0 THEN 'x' ELSE '2.2/EKA-' || (c_nationkey % 4) || '/' || c_custkey END AS code, c_nationkey % 4 AS k, CASE WHEN c_acctbal > 0 THEN c_acctbal / 10 END AS r1, CASE WHEN c_nationkey > 5 THEN c_nationkey * 1.0 END AS r2, c_acctbal, c_custkey % 900 AS h FROM customer)"""


@query(
    "tree_size_table",
    f"""WITH {SHEET} SELECT code AS tree_id, d AS date, {sr('h / 100.0')} AS height_m, {sr('greatest(r1, r2) / 100')} AS max_radius_m, {sr('(CASE WHEN r1 IS NULL THEN r2 WHEN r2 IS NULL THEN r1 ELSE (r1 + r2) / 2 END) * 2 / 100')} AS est_width_m,
 {sr('c_acctbal * 1000 / 1e6')} AS vigor_m3, CASE WHEN c_custkey % 7 <> 0 THEN 'EKA ' || k END AS clone FROM sh WHERE d IS NOT NULL""",
)
def tree_size_table(spark, sf):
    d = tables.normalise_tree_sizes(sheet(spark, sf))
    names = {"Height_m": "height_m", "Max_Radius_m": "max_radius_m", "Est_Width_m": "est_width_m", "Vigor_Index_m3": "vigor_m3"}
    return d.select(
        F.col("Tree ID").alias("tree_id"), F.col("Date").alias("date"), *[r(a).alias(b) for a, b in names.items()], F.col("Clone").alias("clone")
    )


@query(
    "leaf_count_table",
    f"""WITH {SHEET} SELECT d AS date, code AS tree_code, c_custkey % 40 AS n_leaves, CAST(CASE WHEN code LIKE '%/1%' THEN 1 ELSE 2 END AS INT) AS chamber FROM sh WHERE d IS NOT NULL""",
)
def leaf_count_table(spark, sf):
    trees = sheet(spark, sf)
    code = F.col("Kode pohon")
    stands = trees.select(code.alias("tree_code"), F.when(code.like("%/1%"), 1).otherwise(2).alias("chamber")).distinct()
    return tables.normalise_leaf_counts(trees, stands).select("date", "tree_code", "n_leaves", "chamber")


@query("column_pruned_scan", f"WITH {READINGS} SELECT ts AS \"TIMESTAMP\", value AS \"CO2_C1\", aux AS \"Temp_1_C1\" FROM readings")
def column_pruned_scan(spark, sf):
    d = readings(spark, sf).select(
        F.col("ts").alias("TIMESTAMP"), F.col("value").alias("CO2_C1"), F.col("aux").alias("Temp_1_C1"), F.col("sensor").alias("note")
    )
    return tables.wanted_columns(d)


@query("quality_data_sink", f"WITH {READINGS} SELECT event_id, sensor, value FROM readings")
def quality_data_sink(spark, sf):
    folder = fresh_folder(spark)
    sinks.write_quality_data(readings(spark, sf).select("event_id", "sensor", "value"), f"{folder}/QC_Flagged_Data_latest.parquet", f"{folder}/copy")
    return spark.read.parquet(tables.stage_path(spark, folder, "020"))


@query(
    "latest_load_lookup",
    "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS load FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)",
)
def latest_load_lookup(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").alias("load"))
    return tables.latest_load(o, "load").select("o_orderkey", "load")


@query("result_table_sinks", "SELECT o_orderpriority AS priority, count(*) AS n FROM orders GROUP BY 1")
def result_table_sinks(spark, sf):
    folder = fresh_folder(spark)
    g = table(spark, sf, "orders").groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"))
    sinks.write_table(g, f"{folder}/csv", "csv")
    back = spark.read.option("header", "true").schema("priority STRING, n BIGINT").csv(f"{folder}/csv")
    sinks.write_table(back, f"{folder}/json", "json")
    return spark.read.schema("priority STRING, n BIGINT").json(f"{folder}/json")
