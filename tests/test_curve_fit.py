"""Bounded curve fits: known parameters come back, at a bound too, in any number of groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from respira.operators.curve_fit import Parameter, fit_curve

WANT = [Parameter("a", 0.04, 0.0, 0.2), Parameter("m", 12.0, 0.0, 50.0), Parameter("r", 2.0, 0.0, 15.0)]


def curve(a, m, r, p):
    return a * p * m / (a * p + m) - r


def fit(points, by=("g",), rounds=20):
    p = F.col("p")
    value = lambda a, m, r: a * p * m / (a * p + m) - r
    slopes = lambda a, m, r: [p * m * m / (a * p + m) ** 2, (a * p / (a * p + m)) ** 2, F.lit(-1.0)]
    return fit_curve(points, list(by), "y", value, slopes, WANT, rounds)


@pytest.fixture(scope="module")
def points(spark):
    p = np.linspace(5, 1800, 120)
    known = {2**60 + 1: (0.03, 20.0, 1.0), None: (0.09, 8.0, 3.5), 2**60 + 3: (0.012, 45.0, 0.0)}
    rows = [(g, float(x), float(y)) for g, v in known.items() for x, y in zip(p, curve(*v, p), strict=True)]
    rows.append((2**60 + 1, 1.0, None))
    return known, spark.createDataFrame(rows, "g long, p double, y double")


def test_known_parameters_come_back(points):
    known, d = points
    got = {r.g: r for r in fit(d).collect()}
    assert set(got) == set(known)
    for g, v in known.items():
        assert [got[g].a, got[g].m, got[g].r] == pytest.approx(v, rel=1e-6, abs=1e-6)
        assert got[g].converged and got[g].n == 120 and got[g].r2 == pytest.approx(1) and got[g].a_se < 1e-6


def test_bounds_hold(spark):
    """The free optimum has r = -2 and m = 80: both end at their bounds, where the best a is found."""
    p = np.linspace(5, 1800, 150)
    y = curve(0.05, 80.0, -2.0, p)
    d = spark.createDataFrame([("x", float(u), float(v)) for u, v in zip(p, y, strict=True)], "g string, p double, y double")
    r = fit(d).first()
    assert (r.m, r.r) == (50.0, 0.0) and r.converged
    grid = np.linspace(0.0, 0.2, 200_001)[1:]
    rss = np.array([((y - curve(a, 50.0, 0.0, p)) ** 2).sum() for a in grid[::20]])
    assert r.a == pytest.approx(grid[::20][rss.argmin()], abs=3e-5) and r.rss <= rss.min() + 1e-9


def test_standard_errors(spark):
    rng = np.random.default_rng(3)
    p = rng.uniform(5, 1800, 400)
    y = curve(0.04, 15.0, 2.0, p) + rng.normal(0, 0.3, 400)
    d = spark.createDataFrame([(0, float(u), float(v)) for u, v in zip(p, y, strict=True)], "g int, p double, y double").repartition(7)
    r = fit(d).first()
    j = np.stack([p * r.m**2 / (r.a * p + r.m) ** 2, (r.a * p / (r.a * p + r.m)) ** 2, -np.ones(400)], 1)
    left = y - curve(r.a, r.m, r.r, p)
    se = np.sqrt(np.diag(np.linalg.inv(j.T @ j)) * (left @ left) / 397)
    assert [r.a_se, r.m_se, r.r_se] == pytest.approx(se.tolist(), rel=1e-6)
    assert np.abs(j.T @ left).max() < 1e-4 * np.abs(j).sum(0).max()


def test_empty_and_unfinished(points):
    _, d = points
    assert fit(d.limit(0)).count() == 0
    assert not any(r.converged for r in fit(d, rounds=2).collect())
