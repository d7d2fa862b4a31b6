"""Robust covariance: steps read blocks of rows and come to the same sums as rows one by one."""

import numpy as np
import pytest

from respira.operators import robust
from respira.operators.robust import robust_covariance

COLS = ["a", "b", "c"]


@pytest.fixture(scope="module")
def x():
    return np.random.default_rng(11).normal(size=(1003, 3)) * [1.0, 5.0, 0.2]


def table(spark, x):
    return spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double").repartition(3)


def test_blocks_hold_every_row_and_give_equal_sums(spark, monkeypatch, x):
    monkeypatch.setattr(robust, "BLOCK_ROWS", 100)
    rows = table(spark, x)
    blocks = robust._blocks(rows.select("c", "a", "b"), COLS)
    held = np.concatenate([np.frombuffer(r.block).reshape(-1, 3) for r in blocks.collect()])
    assert blocks.count() >= 11 and np.array_equal(held[np.lexsort(held.T)], x[np.lexsort(x.T)])
    fits = {s: (np.full(3, 0.1 * s), np.eye(3) * (1 + s)) for s in range(4)}
    cuts = robust._cuts(rows, COLS, fits, 0.75)
    assert robust._cuts(blocks, COLS, fits, 0.75) == cuts
    one, many = robust._near(rows, COLS, fits, cuts), robust._near(blocks, COLS, fits, cuts)
    for s in fits:
        assert many[s][0] == pytest.approx(one[s][0], abs=1e-12) and many[s][1] == pytest.approx(one[s][1], abs=1e-12)


def test_steps_read_blocks_not_rows(spark, monkeypatch, x):
    seen, real = [], robust._sum_parts
    monkeypatch.setattr(robust, "_sum_parts", lambda rows, *more: (seen.append(rows.columns), real(rows, *more))[1])
    mean, precision = robust_covariance(table(spark, x), COLS, starts=3, max_steps=2)
    assert len(seen) > 6 and all(c == ["block"] for c in seen)
    assert mean == pytest.approx([0, 0, 0], abs=0.5) and np.isfinite(precision).all()


def test_empty_partitions_make_no_sums(spark, x):
    rows = table(spark, x[:5]).repartition(8)
    fits = {0: (np.zeros(3), np.eye(3))}
    got = robust._near(robust._blocks(rows, COLS), COLS, fits)
    assert got[0][0] == pytest.approx(x[:5].mean(axis=0))
