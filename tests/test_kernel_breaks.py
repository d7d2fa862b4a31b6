"""Kernel cost of change points: a change in variance alone is found, gains agree with the table of all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from respira.operators import changepoints as cp


def signals(spark, series):
    rows = [(k, i, i, float(v), 1) for k, x in series.items() for i, v in enumerate(x)]
    return spark.createDataFrame(rows, "g long, i long, at long, x double, step long")


def pairwise_split(x, gamma, size):
    """Best first split by the kernel of all pairs."""
    k = np.exp(-gamma * (x[:, None] - x[None, :]) ** 2)
    cost = lambda a, b: (b - a) - k[a:b, a:b].sum() / (b - a)
    gains = {e: cost(0, len(x)) - cost(0, e) - cost(e, len(x)) for e in range(size, len(x) - size + 1)}
    best = max(gains, key=gains.get)
    return best, gains[best]


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(11)
    return {
        2**60 + 1: np.concatenate([rng.normal(0, 1, 150), rng.normal(0, 6, 130)]),
        2**60 + 3: np.concatenate([rng.normal(0, 1, 90), rng.normal(4, 1, 110)]),
        None: np.full(80, 3.0),
    }


def found(spark, series, **more):
    d = cp.binary_segmentation(signals(spark, series), ["g"], n_breaks=1, min_size=10, **more)
    return {r["g"]: (r["k"], r["gain"]) for r in d.collect()}


def test_gain_agrees_with_all_pairs(spark, series):
    got = found(spark, series, model="rbf", gamma=0.05)
    for g, x in series.items():
        if g is None:
            continue
        k, gain = pairwise_split(x, 0.05, 10)
        assert abs(got[g][0] - k) <= 2 and got[g][1] == pytest.approx(gain, rel=0.05)
    assert None not in got or got[None][1] == pytest.approx(0, abs=1e-6)


def test_variance_change_needs_the_kernel(spark, series):
    one = {2**60 + 1: series[2**60 + 1]}
    assert abs(found(spark, one, model="rbf")[2**60 + 1][0] - 150) <= 5
    plain = found(spark, one)
    noise = np.var(one[2**60 + 1])
    # Squares see no more there than chance gives, the best of about 260 places.
    assert plain[2**60 + 1][1] < 12 * noise


def test_split_series_give_the_same(spark, series, cut_series):
    cut = found(spark, series, model="rbf", gamma=0.05)
    spark.conf.unset("respira.small.bytes")
    whole = found(spark, series, model="rbf", gamma=0.05)
    for g in (2**60 + 1, 2**60 + 3):
        assert cut[g] == pytest.approx(whole[g])


def test_sliding_window_finds_variance(spark, series):
    one = {2**60 + 1: series[2**60 + 1]}
    x, h = one[2**60 + 1], 40
    d = cp.window_discrepancy(signals(spark, one), ["g"], 2 * h, n_breaks=1, model="rbf", gamma=0.05)
    (top,) = d.collect()
    k = np.exp(-0.05 * (x[:, None] - x[None, :]) ** 2)
    cost = lambda a, b: (b - a) - k[a:b, a:b].sum() / (b - a)
    gains = {i: cost(i - h, i + h) - cost(i - h, i) - cost(i, i + h) for i in range(h, len(x) - h)}
    assert abs(top["k"] - max(gains, key=gains.get)) <= 2 and abs(top["k"] - 150) <= 10
    assert top["gain"] == pytest.approx(max(gains.values()), rel=0.05)


def test_unknown_model(spark, series):
    with pytest.raises(ValueError, match="l2 or rbf"):
        cp.binary_segmentation(signals(spark, series), ["g"], model="l1")


def test_features_are_made_after_the_shuffle_and_blocks_add_up(spark, monkeypatch):
    d = spark.range(1000).selectExpr("IF(id % 2 = 0, 'a', 'b') AS k", "id DIV 2 AS i", "id AS at", "CAST(id % 7 AS DOUBLE) AS x", "1L AS step")
    whole = cp._kernel_sums(d, ["k"], 0.1)[0].orderBy("k", "i").collect()
    monkeypatch.setattr(cp, "BLOCK", 60)
    rows, total = cp._kernel_sums(d, ["k"], 0.1)
    got = rows.orderBy("k", "i").collect()
    assert len(got) == 1000 and got[0].s1 == [0.0] * 2 * cp.FREQUENCIES and got[999].i == 499
    assert all(abs(p - q) < 1e-9 for a, b in zip(whole, got, strict=True) for p, q in zip(a.s1, b.s1, strict=True))
    last = {r.k: r for r in got if r.i == 499}
    for r in total.collect():
        assert r.n == 500 and all(abs(p - q) <= 1 / 4 + 1e-9 for p, q in zip(r.s1, last[r.k].s1, strict=True))
    # The exchange of readings carries no features: they are projected above it.
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    deal = plan.index("RepartitionByExpression")
    assert "COS(" in plan[:deal] and "COS(" not in plan[deal:]
