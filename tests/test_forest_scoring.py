"""Forest scores: packed trees equal a plain walk, and every row goes through the forest once."""

import numpy as np
import pandas as pd
import pytest

from respira.operators import anomaly, forest
from respira.operators.forest import _grow, pack_trees, path_lengths
from respira.operators.ml_flags import anomaly_flags


def plain(x, table):
    """Path lengths by one comparison at a time."""
    out = np.zeros(len(x))
    for _, t in table.groupby("tree"):
        nodes = t.set_index("node").to_dict("index")
        for i, row in enumerate(x):
            at = nodes[0]
            while at["feature"] >= 0:
                at = nodes[at["left" if row[at["feature"]] <= at["split"] else "right"]]
            out[i] += at["length"]
    return out


def trees(x, n, limit):
    grown = [_grow(x, np.random.default_rng([7, t]), limit).assign(tree=t) for t in range(n)]
    return pd.concat(grown, ignore_index=True)


@pytest.mark.parametrize("limit", [1, 4, 30])
def test_packed_trees_equal_a_plain_walk(monkeypatch, limit):
    monkeypatch.setattr(forest, "_TOGETHER", 64)  # 300 rows: several parts and a shorter last one
    x = np.random.default_rng(1).normal(size=(300, 4))
    x[:, 3] = np.round(x[:, 3])  # values that are splits of other trees, too
    table = trees(x[:200], 6, limit)
    x[250], x[251, 2], x[252, 0], x[253, 1], x[254, 3] = np.nan, np.nan, np.inf, -np.inf, -0.0
    x[255:260, 0] = table["split"][table["feature"] == 0].iloc[:5] if limit > 1 else 0.0  # exactly on a split
    assert path_lengths(x, pack_trees(table, 4)) == pytest.approx(plain(x, table), abs=1e-12)


def test_tree_of_one_leaf_and_no_rows():
    packed = pack_trees(trees(np.ones((5, 3)), 2, 5), 3)
    assert path_lengths(np.zeros((2, 3)), packed).tolist() == pytest.approx([2 * float(forest.average_path(5))] * 2)
    assert path_lengths(np.zeros((0, 3)), packed).tolist() == []


def test_infinite_values_part_rows():
    x = np.random.default_rng(2).normal(size=(90, 3))
    x[::7, 0], x[::5, 1], x[::11, 2], x[3::11, 2] = -np.inf, np.inf, -np.inf, np.inf
    table = trees(x, 3, 40)
    assert not table["split"].isna().any()
    leaves = table[table["feature"] < 0]
    assert leaves.groupby("tree").size().tolist() == [90] * 3  # all rows differ, so each has a leaf of its own
    assert path_lengths(x, pack_trees(table, 3)) == pytest.approx(plain(x, table), abs=1e-12)


def test_too_large_trees_are_refused():
    table = trees(np.random.default_rng(3).normal(size=(9, 2)), 1, 5)
    with pytest.raises(ValueError, match="too many"):
        pack_trees(table, 1 << 12)
    table["node"] += 1 << 25
    with pytest.raises(ValueError, match="too many"):
        pack_trees(table, 2)


@pytest.mark.parametrize("small", ["0", str(64 << 20)])
def test_every_row_is_scored_once(spark, monkeypatch, small):
    rng = np.random.default_rng(4)
    rows = [(i, *map(float, r), int(i % 4)) for i, r in enumerate(rng.normal(size=(600, 3)))]
    rows += [(1000, 9.0, -9.0, 9.0, 0), (1001, None, 0.0, 0.0, 0)]
    d = spark.createDataFrame(rows, "id long, r2 double, nrmse double, snr double, flux_qc int")
    seen = []

    def watched(module):
        real = module.exact_quantiles

        def quantiles(df, *args, **more):
            seen.append(df._jdf.queryExecution().optimizedPlan().toString())
            return real(df, *args, **more)

        monkeypatch.setattr(module, "exact_quantiles", quantiles)

    watched(forest)
    watched(anomaly)
    spark.conf.set("respira.small.bytes", small)
    try:
        out = anomaly_flags(d, ["id"], trees=20, max_samples=64)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        got = {r["id"]: r for r in out.collect()}
    finally:
        spark.conf.unset("respira.small.bytes")
    # Both cuts and the result read stored scores; a plan with Python in it would run the forest again.
    assert len(seen) == 2 and not any("ArrowEvalPython" in p or "pythonUDF" in p or "run(" in p for p in [*seen, plan])
    assert len(got) == 602 and got[1000]["ml_anomaly_flag"] == 1
    assert min(got.values(), key=lambda r: r["ml_if_score"])["id"] == 1000
    assert got[1001]["r2"] is None and -1 <= got[1001]["ml_if_score"] <= 0 and got[1001]["ml_mcd_dist"] is not None
