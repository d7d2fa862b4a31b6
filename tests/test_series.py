"""Split plans must give what the plain single-partition window gives."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from respira.plans.quantiles import exact_quantiles
from respira.plans.series import Series, micros, trailing_range
from respira.plans.timejoin import asof_join, interval_join


def _base(events):
    v = F.when(F.col("value") > 5, F.col("value"))
    return events.select("event_id", "event_type", micros("ts").alias("us"), v.alias("value"))


def _run(df, small, step):
    s = Series.of(df, ["event_type"], ["us", "event_id"], small=small)
    if small is None:
        assert s.split
    return step(s).df.toPandas().sort_values("event_id").reset_index(drop=True)


STEPS = {
    "previous": lambda s: s.previous({"p": "value", "pu": "us"}),
    "running_sum": lambda s: s.running_sum({"c": F.col("value")}),
    "row_number": lambda s: s.row_number("rn"),
    "ffill": lambda s: s.nearest_known({"f": "value"}),
    "bfill": lambda s: s.nearest_known({"f": "value"}, forward=False),
    "ffill_strict": lambda s: s.nearest_known({"f": "value"}, strict=True),
    "rows_frame": lambda s: s.rows_frame(6, 5, {"m": lambda w: F.avg("value").over(w)}),
    "range_frame": lambda s: s.range_frame(
        6 * 3_600_000_000, 0, {"m": lambda w: F.max("value").over(w), "k": lambda w: F.count("value").over(w)}
    ),
}


@pytest.mark.parametrize("name", STEPS)
def test_split_equals_plain(events, cut_series, name):
    df = _base(events)
    a, b = _run(df, True, STEPS[name]), _run(df, None, STEPS[name])
    pd.testing.assert_frame_equal(a, b[a.columns], rtol=1e-12)


@pytest.mark.parametrize("accuracy", [100_000, 60])
def test_quantiles_match_percentile(events, cut_series, accuracy):
    df = _base(events).withColumn("event_type", F.when(F.col("value").isNull(), F.lit("none")).otherwise(F.col("event_type")))
    probs = {"q1": 0.25, "q2": 0.5, "q95": 0.95, "lo": 0.0, "hi": 1.0}
    a = exact_quantiles(df, ["event_type"], "value", probs, small=True).toPandas()
    b = exact_quantiles(df, ["event_type"], "value", probs, accuracy=accuracy).toPandas()
    a, b = (x.sort_values("event_type").reset_index(drop=True) for x in (a, b))
    pd.testing.assert_frame_equal(a, b[a.columns], rtol=1e-12)


def test_asof_matches_pandas(events, cut_series):
    df = _base(events)
    left = df.filter("event_type = 'click'").select("event_id", "us", F.lit("k").alias("key"))
    right = df.filter("event_type = 'view'").select(
        F.col("us").alias("rus"), F.col("event_id").alias("rid"), F.lit("k").alias("key")
    )
    for direction in ("backward", "forward"):
        got = asof_join(left, right, ["key"], "us", "rus", {"rid": "rid"}, direction).toPandas()
        got = got.sort_values("us").reset_index(drop=True)
        want = pd.merge_asof(
            left.toPandas().sort_values("us"),
            right.drop("key").toPandas().sort_values("rus"),
            left_on="us",
            right_on="rus",
            direction=direction,
        )
        np.testing.assert_array_equal(got["rid"].astype(float), want["rid"].astype(float))


def test_interval_join_matches_brute_force(events):
    p = _base(events).select("event_id", "event_type", "us")
    s = p.filter("event_id % 10 = 0").select(
        F.col("event_id").alias("sid"), "event_type", F.col("us").alias("a"), (F.col("us") + 9_000_000_000).alias("b")
    )
    got = interval_join(p, s, ["event_type"], "us", "a", "b", 3_600_000_000)
    pp, ss = p.toPandas(), s.toPandas()
    m = pp.merge(ss, on="event_type")
    want = m[(m.us >= m.a) & (m.us <= m.b)]
    assert set(map(tuple, got.select("event_id", "sid").toPandas().values)) == set(
        map(tuple, want[["event_id", "sid"]].values)
    )


def test_trailing_range_equals_a_sliding_frame(spark, events):
    hour = 3_600_000_000
    d = _base(events).unionByName(_base(events).withColumn("event_id", F.col("event_id") + 10_000))
    d = d.withColumn("us", F.when(F.col("event_id") % 3 == 0, F.floor(F.col("us") / hour) * hour - 1).otherwise(F.col("us")))
    d = d.withColumn("us", F.when(F.col("event_id") % 50 > 0, F.col("us")))
    w = Window.partitionBy("event_type").orderBy("us").rangeBetween(-(6 * hour - 1), 0)
    want = d.withColumns({"a": F.max("value").over(w), "b": F.min("value").over(w), "c": F.stddev_samp("value").over(w)})
    cols = {"a": ("max", "value"), "b": ("min", "value"), "c": ("stddev_samp", "value")}
    got = trailing_range(d, ["event_type"], "us", 6 * hour - 1, cols)
    a, b = (x.toPandas().sort_values("event_id").reset_index(drop=True) for x in (want, got))
    pd.testing.assert_frame_equal(a, b[a.columns], rtol=1e-9)


@pytest.mark.parametrize("name", ["persistence_flags", "qc_summary", "soil_gradient_anomaly"])
def test_no_query_slides_a_range(spark, name):
    from respira.catalog import load

    plan = load()[name][0](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "specifiedwindowframe(RangeFrame, -" not in plan
