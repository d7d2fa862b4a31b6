"""Tabular inputs: monthly integrated tables, radiation, biophysics and quality-controlled stages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from respira.functions.numeric import numeric, row_mean, true

# Columns the analysis uses, hardware limits, tree codes of the two chambers.
WANTED = [
    "TIMESTAMP",
    "CO2_C1",
    "CO2_C2",
    "Temp_1_C1",
    "Temp_1_C2",
    "CO2_C1_qc_flag",
    "CO2_C2_qc_flag",
    "H2O_C1",
    "H2O_C2",
    "H2O_C1_qc_flag",
    "H2O_C2_qc_flag",
    "H2O_C1_corrected",
    "H2O_C2_corrected",
    "RH_1_C1",
    "RH_1_C2",
]
LOW_CHECKED = ["AtmosphericPressure_1_C1", "Temp_1_C1", "VaporPressure_1_C1", "RH_1_C1"]
TREE_CHAMBERS = {"2.2/EKA-1/2107": 1, "2.4/EKA-2/2858": 2}
STAGES = {
    "020": "020_rule_qc_output.parquet",
    "022": "022_ml_qc_output.parquet",
    "025": "025_cross_chamber_corrected.parquet",
    "026": "026_segmented_bias_corrected.parquet",
}


def wanted_columns(df: DataFrame) -> DataFrame:
    """Only the columns the analysis uses, in table order; the scan reads nothing else."""
    return df.select(*[c for c in df.columns if c in WANTED])


def drop_hardware_outliers(df: DataFrame) -> DataFrame:
    """Drop rows with impossible hardware values; unknown values never drop a row."""
    bad = [F.col(c) < -100 for c in LOW_CHECKED if c in df.columns]
    bad += [(F.col(c) < -100) | (F.col(c) > 100) for c in df.columns if "Temp" in c]
    bad += [F.col(c) > 1000 for c in df.columns if "WP" in c and "Soil" in c]
    bad += [F.col(c) < 50 for c in df.columns if "AtmosphericPressure" in c]
    return df.filter(~reduce(lambda a, b: a | b, [true(x) for x in bad], F.lit(False)))


def read_monthly(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """Monthly integrated table (partitioned by ``year_month``), pruned to ``months``, without hardware outliers."""
    d = spark.read.parquet(path)
    if months:
        d = d.filter(F.col("year_month").isin(*months))
    checked = {c for c in d.columns if "Temp" in c or "AtmosphericPressure" in c or ("WP" in c and "Soil" in c)}
    checked |= set(LOW_CHECKED) & set(d.columns)
    return drop_hardware_outliers(d.withColumns({c: numeric(c) for c in checked}))


def normalise_radiation(df: DataFrame) -> DataFrame:
    """Time and radiation columns of a weather export under their usual names; ``--`` and ``-`` are missing."""
    low = {c: c.lower() for c in df.columns}
    text = {c: F.when(~F.col(c).cast("string").isin("--", "-"), F.col(c).cast("string")) for c in df.columns}

    def when(c):
        return F.try_to_timestamp(F.trim(c)).cast("timestamp_ntz")

    if "TIMESTAMP" in df.columns:
        ts = when(text["TIMESTAMP"])
    elif {"Date", "Time"} <= set(df.columns):
        ts = when(F.concat(F.trim(text["Date"]), F.lit(" "), F.trim(text["Time"])))
    elif "Date" in df.columns:
        ts = when(text["Date"])
    else:
        named = next((c for c in df.columns if "time" in low[c] or "date" in low[c]), None)
        if named is None:
            raise ValueError("no time column")
        ts = when(text[named])
    out = {"TIMESTAMP": ts}
    rad = "Global_Radiation" if "Global_Radiation" in df.columns else next(
        (c for c in df.columns if "radiation" in low[c] or ("solar" in low[c] and "rad" in low[c])), None
    )
    if rad:
        out["Global_Radiation"] = numeric(text[rad])
    rest = {c: text[c] for c in df.columns if c not in out}
    return df.withColumns({**rest, **out}).filter(F.col("TIMESTAMP").isNotNull())


def normalise_tree_sizes(df: DataFrame) -> DataFrame:
    """Tree measurements in metres and cubic metres with the clone read from the tree id."""
    r1, r2 = numeric("R1 (cm)"), numeric("R2 (cm)")
    clone = F.upper(F.replace(F.regexp_extract("Kode pohon", r"(EKA[- ]?\d)", 1), F.lit("-"), F.lit(" ")))
    d = df.select(
        F.col("Kode pohon").alias("Tree ID"),
        F.col("Tanggal").cast("date").alias("Date"),
        (numeric("Tinggi Pohon (cm)") / 100).alias("Height_m"),
        (F.greatest(r1, r2) / 100).alias("Max_Radius_m"),
        (row_mean([r1, r2]) * 2 / 100).alias("Est_Width_m"),
        (numeric("Vigor Index") / 1_000_000).alias("Vigor_Index_m3"),
        F.when(clone != "", clone).alias("Clone"),
    )
    return d.filter(F.col("Tree ID").isNotNull() & F.col("Date").isNotNull())


def normalise_leaf_counts(df: DataFrame, chambers: DataFrame | dict[str, int] | None = None) -> DataFrame:
    """Leaf counts per chamber; trees that stand in no chamber drop out.

    ``chambers`` says where trees stand: a table ``tree_code, chamber`` of any size, or a few pairs.
    """
    code = F.col("Kode pohon")
    if not isinstance(chambers, DataFrame):
        pairs = list((chambers or TREE_CHAMBERS).items())
        chambers = df.sparkSession.createDataFrame(pairs, "tree_code string, chamber int")
    d = df.join(chambers.select(F.col("tree_code").alias("_tree"), F.col("chamber").alias("_chamber")), code == F.col("_tree"))
    chamber = F.col("_chamber").cast("int")
    d = d.select(
        F.col("Tanggal").cast("date").alias("date"),
        code.alias("tree_code"),
        F.col("Total Pelepah").alias("n_leaves"),
        F.col("Tinggi Pohon (cm)").alias("height_cm"),
        F.col("R1 (cm)").alias("r1_cm"),
        F.col("R2 (cm)").alias("r2_cm"),
        F.col("Vigor Index").alias("vigor_index"),
        chamber.alias("chamber"),
    )
    return d.filter(F.col("date").isNotNull() & F.col("chamber").isNotNull())


def stage_path(spark: SparkSession, folder: str, stage: str | None = None) -> str | None:
    """Path of a stage output: the named file, else the fixed latest one, else the newest by name; ``None`` if none."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(folder)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return None
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    fixed = [STAGES.get(stage), "QC_Flagged_Data_latest.parquet"]
    dated = sorted((n for n in names if n.startswith("QC_Flagged_Data_") and n.endswith(".parquet")), reverse=True)
    plain = sorted((n for n in names if n.startswith("QC_Flagged_Data_") and n.endswith(".csv")), reverse=True)
    pick = next((n for n in [*fixed, *dated, *plain] if n in names), None)
    return f"{folder}/{pick}" if pick else None


def latest_load(df: DataFrame, load: str) -> DataFrame:
    """Rows of the newest load of a table partitioned by ``load``."""
    newest = df.agg(F.max(load).alias(load))
    return df.join(newest, load, "left_semi")
