"""Joint machine-learned anomaly flag of cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from respira.operators.anomaly import impute_features, mahalanobis_scores
from respira.operators.forest import fit_forest, flag_lowest, score_forest
from respira.plans.sizing import write_once

# Measurement-quality features (never the flux itself) and their names in exported tables.
FEATURES = [
    "r2",
    "nrmse",
    "snr",
    "monotonicity",
    "outlier_frac",
    "slope_diff_pct",
    "delta_aicc",
    "co2_range",
    "h2o_r2",
    "h2o_snr",
    "h2o_outlier_frac",
]
ALIASES = {
    "r2": "co2_r2",
    "nrmse": "co2_nrmse",
    "snr": "co2_snr",
    "monotonicity": "co2_monotonic_frac",
    "outlier_frac": "co2_outlier_frac",
}


def anomaly_flags(
    cycles: DataFrame,
    id_cols: list[str],
    features: list[str] | None = None,
    qc: str | None = "flux_qc",
    max_qc: int = 1,
    contamination: float = 0.05,
    trees: int = 200,
    max_samples: int = 10_000,
    mode: str = "AND",
    seed: int = 42,
) -> DataFrame:
    """Add ``ml_if_score``, ``ml_mcd_dist`` and ``ml_anomaly_flag`` (both detectors agree, or either with ``OR``).

    Models learn from passing cycles only. Raises ``ValueError`` with fewer than 3 known features or too few rows.
    """
    if mode.upper() not in ("AND", "OR"):
        raise ValueError(f"mode must be AND or OR, not {mode}")
    have = []
    for f in features or FEATURES:
        have += [c for c in (f, ALIASES.get(f)) if c in cycles.columns][:1]
    if len(have) < 3:
        raise ValueError(f"fewer than 3 of the features are columns: {have}")
    d = cycles
    if {"n_points_used", "n_points_total"} <= set(d.columns):
        d = d.withColumn("_completeness", F.try_divide(F.col("n_points_used"), F.col("n_points_total")))
        have.append("_completeness")
    train = F.col(qc) <= max_qc if qc and qc in d.columns else F.lit(True)
    # Stored in columns: medians and models read a few of them many times.
    d, cols = impute_features(write_once(d), have, train)
    n_train = d.filter("_train").count()
    if n_train < max(50, len(cols) + 1):
        raise ValueError(f"too few rows to learn from: {n_train}")
    nodes, size = fit_forest(d.filter("_train"), cols, id_cols, trees, max_samples, seed)
    spark = d.sparkSession
    parts = min(int(spark.conf.get("spark.sql.shuffle.partitions")), 3 * spark.sparkContext.defaultParallelism)
    if d.rdd.getNumPartitions() < parts:
        # Scoring is heavy for its bytes; coalesced storage must not put it into a few tasks.
        d = d.repartition(parts)
    # Every row goes through the forest once; both cuts and the result read the stored scores.
    d = flag_lowest(write_once(score_forest(d, cols, nodes, size)), "ml_if_score", "_train", contamination)
    d = mahalanobis_scores(d, cols, "_train", id_cols=tuple(id_cols))
    a, b = F.col("if_flag"), F.col("mcd_flag")
    d = d.withColumn("ml_anomaly_flag", F.least(a, b) if mode.upper() == "AND" else F.greatest(a, b))
    return d.drop("_train", "_completeness", "if_flag", "mcd_flag", *cols)
