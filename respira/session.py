"""Session settings the operators assume."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def build_session(master: str | None = None, app: str = "respira", **conf: str) -> SparkSession:
    """Create a session with adaptive execution, UTC times and Arrow transfer switched on."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for k, v in settings.items():
        b = b.config(k, v)
    return prepare(b.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on, for a session somebody else built."""
    if spark.conf.get("spark.sql.session.timeZone", "") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``; a private one only on a local master without one (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not named and not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = named or tempfile.mkdtemp(prefix="spark-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder
