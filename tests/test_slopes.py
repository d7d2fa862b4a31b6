"""Order statistics of pairwise slopes by counting, against all pairs."""

import numpy as np
import pytest

from respira.operators import kernels, long_slopes, slopes
from respira.operators.cycles import theil_sen_by_group
from respira.operators.slopes import PairSlopes, inversions, inverted_pairs


@pytest.mark.parametrize("n", [0, 1, 2, 3, 7, 8, 9, 100, 257])
def test_inversions_match_all_pairs(n):
    p = np.random.default_rng(n).permutation(n).tolist()
    want = sorted((p[i], p[j]) for i in range(n) for j in range(i + 1, n) if p[i] > p[j])
    assert inversions(np.array(p, np.int64)) == len(want)
    assert sorted(zip(*(x.tolist() for x in inverted_pairs(np.array(p, np.int64))), strict=True)) == want


def _values(kind, t, rng):
    n = len(t)
    return {
        "noisy line": lambda: rng.normal(size=n) + 0.01 * t,
        "coarse": lambda: np.round(rng.normal(size=n), 1),
        "large": lambda: rng.normal(size=n) * 1e6,
        "one slope": lambda: np.round(0.3 * t, 1),
        "flat": lambda: np.zeros(n),
    }[kind]()


@pytest.mark.parametrize("kind", ["noisy line", "coarse", "large", "one slope", "flat"])
@pytest.mark.parametrize("spread", [3, 0.2])
def test_ranks_match_all_pairs(kind, spread, monkeypatch):
    monkeypatch.setattr(slopes, "LISTED", 50)
    monkeypatch.setattr(slopes, "LISTED_EACH", 0)
    rng = np.random.default_rng(5)
    for n in (2, 50, 700):
        t = np.sort(rng.integers(0, int(spread * n) + 2, n)).astype(float)
        y = _values(kind, t, rng)
        whole, counted = PairSlopes(t, y, 10**9), PairSlopes(t, y, 1)
        assert whole.count == counted.count
        for k in {0, whole.count // 4, (whole.count - 1) // 2, whole.count // 2, whole.count - 1} - {-1}:
            if whole.count:
                assert counted.at(k) == pytest.approx(whole.at(k), rel=1e-9, abs=1e-9)


def test_theil_sen_of_a_long_group():
    rng = np.random.default_rng(2)
    n = 60_000
    t = np.sort(rng.uniform(0, n, n))
    y = 5 + 0.25 * t + rng.normal(size=n)
    y[rng.random(n) < 0.2] += 1e4  # pairs inside and outside the shifted fifth balance out
    mid, icpt, lo, hi = kernels.theil_sen(t, y)
    assert lo < mid < hi and abs(mid - 0.25) < 1e-3
    assert np.isnan(kernels.theil_sen(np.zeros(3), np.arange(3.0))).all()


def test_groups_beyond_a_task(spark, cut_series, monkeypatch):
    """Blocks of 60 points: a noisy line, coarse values with repeated times and mass ties, a short group, a null key."""
    monkeypatch.setattr(long_slopes, "EVENLY", 48)
    monkeypatch.setattr(long_slopes, "NARROW", 1e-7)
    rng = np.random.default_rng(3)
    rows, want = [], {}
    for key, n in (("line", 300), (None, 240), ("short", 30)):
        t = np.sort(rng.integers(0, 2 * n, n)).astype(float)
        y = 0.02 * t + rng.normal(size=n) if key == "line" else np.round(rng.normal(size=n), 0)
        rows += [(key, int(a * 1_000_000), float(b)) for a, b in zip(t, y, strict=True)]
        want[key] = (n, *kernels.theil_sen(t - t.min(), y))
    d = spark.createDataFrame(rows, "k string, us long, y double")
    got = {r[0]: tuple(r)[1:] for r in theil_sen_by_group(d, ["k"], "us", "y").collect()}
    assert got.keys() == want.keys()
    for key, w in want.items():
        assert got[key] == pytest.approx(w, rel=1e-5, abs=1e-5)
