"""Minimum covariance determinant: many starts find what one start misses, odd rows and tables are defined."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from respira.operators.anomaly import mahalanobis_scores
from respira.operators.robust import chi2_quantile, robust_covariance

COLS = ["a", "b", "c"]


def table(spark, x, **more):
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double")


@pytest.fixture(scope="module")
def clustered():
    """A third of the rows is a tight cluster, near enough to hide inside the covariance of all rows."""
    rng = np.random.default_rng(3)
    good = rng.normal(size=(1000, 3)) @ np.array([[2.0, 0.5, 0.0], [0.0, 1.0, 0.3], [0.0, 0.0, 0.5]]) + 10
    bad = rng.normal(size=(500, 3)) * 0.4 + good.mean(axis=0) + [9.0, -6.0, 5.0]
    return good, bad


def one_start(x, support):
    """Concentration steps from the moments of all rows."""
    mean, cov = x.mean(axis=0), np.cov(x.T, bias=True)
    for _ in range(60):
        d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        near = x[d <= np.quantile(d, support)]
        mean, cov = near.mean(axis=0), np.cov(near.T, bias=True)
    return np.linalg.slogdet(cov)[1], mean


def test_clustered_outliers_are_found(spark, clustered):
    good, bad = clustered
    x = np.concatenate([good, bad])
    mean, precision = robust_covariance(table(spark, x), COLS, support=0.6)
    assert np.abs(mean - good.mean(axis=0)).max() < 0.2
    d = np.einsum("ij,jk,ik->i", x - mean, precision, x - mean)
    assert d[1000:].min() > chi2_quantile(3, 3.09)
    assert np.mean(d[:1000] > chi2_quantile(3, 1.959964)) < 0.08
    # Truth up to sampling: the covariance of the good rows, trimmed at 97.5 %.
    assert np.linalg.inv(precision) == pytest.approx(np.cov(good.T), rel=0.25, abs=0.15)


def test_never_worse_than_one_start(spark, clustered):
    x = np.concatenate(clustered)
    spread, start_mean = one_start(x, 0.6)
    mean, precision = robust_covariance(table(spark, x), COLS, support=0.6)
    d = np.einsum("ij,jk,ik->i", x - mean, precision, x - mean)
    near = x[d <= np.quantile(d, 0.6)]
    assert np.linalg.slogdet(np.cov(near.T, bias=True))[1] <= spread + 0.02


def test_units_and_partitions_do_not_matter(spark, clustered):
    x = np.concatenate(clustered)
    mean, precision = robust_covariance(table(spark, x).repartition(7, "a"), COLS, support=0.6, starts=20)
    scale = np.array([1.0, 1e6, 1e-6])
    mean2, precision2 = robust_covariance(table(spark, x * scale), COLS, support=0.6, starts=20)
    assert mean2 / scale == pytest.approx(mean, abs=0.1)
    assert precision2 * np.outer(scale, scale) == pytest.approx(precision, rel=0.2, abs=0.2)


def test_repeats_unknown_and_constant_columns(spark):
    rng = np.random.default_rng(5)
    x = np.concatenate([np.tile([1.0, 2.0, 7.0], (300, 1)), np.c_[rng.normal(size=(300, 2)), np.full(300, 7.0)]])
    d = table(spark, x).unionByName(spark.createDataFrame([(-1, None, 1.0, 7.0), (-2, float("nan"), 1.0, 7.0)], "id long, a double, b double, c double"))
    mean, precision = robust_covariance(d, COLS)
    assert np.isfinite(mean).all() and np.isfinite(precision).all() and mean[2] == pytest.approx(7.0)
    out = mahalanobis_scores(d.withColumn("_train", F.lit(True)), COLS)
    got = {r["id"]: r for r in out.collect()}
    assert len(got) == 602 and got[-1]["ml_mcd_dist"] is None and got[-1]["mcd_flag"] == 0


def test_few_and_no_rows(spark):
    few = table(spark, [[1, 2, 3], [2, 3, 5]])
    mean, precision = robust_covariance(few, COLS)
    assert np.isfinite(precision).all()
    with pytest.raises(ValueError, match="no complete row"):
        robust_covariance(few.filter("id < 0"), COLS)


def test_cuts_and_moments_equal_numpy(spark):
    from respira.operators import robust

    rng = np.random.default_rng(8)
    x = rng.normal(size=(3001, 3))
    fits = {s: (rng.normal(size=3) * 0.1, np.eye(3) * (1 + s)) for s in range(51)}
    rows = table(spark, x).select(*COLS).repartition(5)
    cuts = robust._cuts(rows, COLS, fits, 0.75)
    near = robust._near(rows, COLS, fits, cuts)
    for s, (mean, cov) in fits.items():
        d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov + robust.RIDGE * np.eye(3)), x - mean)
        exact = np.sort(d)[int(np.ceil(0.75 * len(d))) - 1]
        assert exact <= cuts[s] <= exact * (1 + 2e-6)
        y = x[d <= cuts[s]]
        assert near[s][0] == pytest.approx(y.mean(axis=0), abs=1e-9) and near[s][1] == pytest.approx(np.cov(y.T, bias=True), abs=1e-9)
    # Distances of all starts are made in place: no row is copied once per start.
    plan = robust_plan(spark, rows)
    assert "Generate explode" not in plan


def robust_plan(spark, rows):
    """Plans of the jobs of one fit, as the functions that make them leave them."""
    seen, kind = [], type(rows)
    old = kind.collect
    kind.collect = lambda d: (seen.append(d._jdf.queryExecution().optimizedPlan().toString()), old(d))[1]
    try:
        robust_covariance(rows, COLS, starts=3, max_steps=1)
    finally:
        kind.collect = old
    return "\n".join(seen)
