"""Registered queries against their SQL, plain and with every series forced into many segments."""

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

from check import compare, duck  # noqa: E402

from respira.catalog import load  # noqa: E402

SF = "/root/testdata/sf0.001"
ALL = load()
CHECKED = [n for n, (_, sql) in ALL.items() if sql]
SPLIT = [
    "rate_of_change_flags",
    "persistence_flags",
    "gap_sessions",
    "grid_linear_interpolation",
    "sensor_flags_onto_cycles",
    "rolling_drift_score",
    "cumulative_flux",
    "seasonal_residuals",
]


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", CHECKED)
def test_matches_sql(spark, con, name):
    fn, sql = ALL[name]
    assert compare(fn(spark, SF).toPandas(), con.execute(sql).df()) == ""


@pytest.mark.parametrize("name", SPLIT)
def test_split_plans_match_sql(spark, con, cut_series, name):
    fn, sql = ALL[name]
    assert compare(fn(spark, SF).toPandas(), con.execute(sql).df()) == ""


@pytest.mark.parametrize("name", ["full_cycle_evaluation", "box_by_month", "cycle_confidence"])
@pytest.mark.parametrize("parts", ["1", "64"])
def test_partition_count_does_not_matter(spark, con, name, parts):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        fn, sql = ALL[name]
        assert compare(fn(spark, SF).toPandas(), con.execute(sql).df()) == ""
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_sensor_tree_with_repeated_times(spark, tmp_path):
    e = spark.read.parquet(f"{SF}/events.parquet")
    more = [e.withColumn("event_id", e.event_id + i * 10_000).withColumn("value", e.value + i) for i in range(3)]
    more[0].unionByName(more[1]).unionByName(more[2]).write.parquet(str(tmp_path / "events.parquet"))
    fn, sql = ALL["sensor_tree_scan"]
    sql = sql.replace("FROM events", f"FROM '{tmp_path}/events.parquet/*.parquet'")
    got = fn(spark, str(tmp_path)).toPandas()
    assert not got.duplicated(["sensor", "TIMESTAMP"]).any()
    assert compare(got, duck(SF).execute(sql).df()) == ""


def test_entry_runs(spark):
    from __spark_entry__ import entry, oracle_sql, queries

    assert entry(spark).count() > 0
    assert set(oracle_sql()) <= set(queries())
