"""Limits that must not exist: many cut points, many segments, hot keys in shuffled joins, NaN on both quantile paths."""

import pytest
from pyspark.sql import functions as F

from respira.plans import series
from respira.plans.quantiles import exact_medians, exact_quantiles
from respira.plans.series import Series, _position, join_few


def test_position_has_no_limit(spark):
    cuts = F.sequence(F.lit(0), F.lit(29_998), F.lit(2))
    d = spark.range(-1, 30_010).select("id", _position(cuts, F.col("id")).alias("p"))
    assert d.filter(F.col("p") != F.least(F.lit(15_000), F.floor(F.col("id") / 2) + 1)).count() == 0
    assert spark.range(1).select(_position(F.array().cast("array<int>"), F.lit(1)).alias("p")).first()["p"] == 0


def test_segments_beyond_one_grid(spark, cut_series, monkeypatch):
    monkeypatch.setattr(series, "_GRID_BITS", 3)
    d = spark.range(5000).select(F.lit("a").alias("k"), F.col("id").alias("t"), (F.col("id") % 7).alias("v"))
    s = Series.of(d, ["k"], ["t"]).running_sum({"s": F.col("v")}).previous({"p": "v"})
    assert s._df.groupBy(series.SEG).count().agg(F.max("count"), F.count("*")).first()[0] <= 500
    assert s._df.select(series.SEG).distinct().count() > 20
    got = s.df.filter("t = 4999").first()
    assert got["s"] == sum(i % 7 for i in range(5000)) and got["p"] == 4998 % 7
    assert s.df.count() == 5000


@pytest.mark.parametrize("few", [100_000, 0])
def test_join_few_both_ways(spark, cut_series, monkeypatch, few):
    monkeypatch.setattr(series, "FEW_ROWS", few)
    rows = spark.range(400).select(F.when(F.col("id") % 3 > 0, "a").alias("k"), "id")
    table = spark.createDataFrame([("a", 1), (None, 2), ("z", 3)], "k string, v int")
    got = join_few(rows, table, ["k"]).groupBy("k").agg(F.count("*").alias("n"), F.sum("v").alias("v")).collect()
    assert {(r.k, r.n, r.v) for r in got} == {("a", 266, 266), (None, 134, 268)}
    plan = join_few(rows, table, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) == (few > 0)


def test_nan_is_missing_on_both_paths(spark, cut_series):
    d = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", float("nan")), ("a", float("inf")), ("b", float("nan"))], "k string, v double")
    for small in (True, False):
        q = {r.k: r for r in exact_quantiles(d, ["k"], "v", {"lo": 0.0, "hi": 1.0}, small=small).collect()}
        assert (q["a"].n, q["a"].lo, q["a"].hi) == (3, 1.0, float("inf")) and (q["b"].n, q["b"].lo) == (0, None)
        m = {r.k: r.m for r in exact_medians(d, ["k"], {"m": F.col("v")}, small=small).collect()}
        assert m == {"a": 2.0, "b": None}


def test_cuts_of_usual_rows(spark):
    # The product of two million rows and the grid passes 32 bits.
    d = spark.range(2000).select(F.lit("a").alias("k"), F.col("id").alias("t"))
    hot = d.groupBy("k").agg(F.lit(12_000_000).cast("bigint").alias("_n"))
    cuts = series._grid_cuts(d, hot, ["k"], "t", 2_000_000).first()["_cuts"]
    assert len(cuts) == 6 and 300 < cuts[0] < 360


def test_running_sum_keeps_its_digits(spark):
    from respira.operators.summaries import cumulative_by_month

    n = 300_000
    d = spark.range(n).select(
        F.lit("a").alias("k"), F.timestamp_seconds("id").alias("ts"), F.lit(99_999.99899).alias("v"), "id"
    )
    out = cumulative_by_month(d, ["k"], "ts", "v", F.lit("1970-01-01").cast("timestamp"), "id")
    got = out.filter(f"id = {n - 1}").first()["cumulative"]
    assert abs(got - n * 9_999_999_899 / 100_000) < 1e-5
    none = cumulative_by_month(d.withColumn("v", F.lit(None).cast("double")).limit(2), ["k"], "ts", "v", F.lit("1970-01-01").cast("timestamp"))
    assert [r["cumulative"] for r in none.collect()] == [None, None]
