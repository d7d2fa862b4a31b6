"""Forest growth and sampling; ids beyond doubles pass Python operators unchanged, beside nulls too."""

import numpy as np
import pandas as pd
import pytest

from respira.operators.cycles import theil_sen_by_group
from respira.operators.forest import _grow, draws, fit_forest, score_forest

BIG = [2**60 + 1, None, 2**60 + 3]


def test_skip_lengths_draw_every_tree_alike():
    ids = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 20_000)
    got = draws(ids, 50, 0.03)
    n = np.bincount(np.concatenate(got), minlength=50)
    assert len(got) == 20_000 and all((np.diff(g) > 0).all() for g in got)
    assert abs(n - 600).max() < 5 * (600 * 0.97) ** 0.5
    assert [g.tolist() for g in draws(ids[:3], 50, 0.03)] == [g.tolist() for g in got[:3]]
    assert all(g.tolist() == list(range(7)) for g in draws(ids[:5], 7, 1.0)) and draws(ids[:0], 7, 0.5) == []


def test_tree_parts_all_points():
    x = np.random.default_rng(2).normal(size=(500, 3))
    x[:40] = x[0]
    t = _grow(x, np.random.default_rng(3), 30)
    assert t["node"].tolist() == list(range(len(t)))
    at = np.zeros(500, int)
    for _ in range(30):
        f, here = t["feature"].to_numpy()[at], at
        go = x[np.arange(500), np.maximum(f, 0)] <= t["split"].to_numpy()[here]
        at = np.where(f < 0, at, np.where(go, t["left"].to_numpy()[here], t["right"].to_numpy()[here]))
    leaf, n = np.unique(at, return_counts=True)
    assert set(leaf) == set(t["node"][t["feature"] < 0])
    assert (n > 1).sum() == 1 and n.max() == 40  # equal points stay together, all others part
    capped = _grow(x, np.random.default_rng(3), 4)
    assert capped["length"].max() <= 4 + 2 * np.log(500) and isinstance(capped, pd.DataFrame)


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_ids_stay_intact(spark, kind):
    rows = [(i, float(t), 2.0 * t + k) for k, i in enumerate(BIG) for t in range(6)]
    d = spark.createDataFrame(rows, "id long, t double, y double").coalesce(1)
    d = d.withColumn("id", d["id"].cast(kind))
    want = {None if i is None else str(i) for i in BIG}
    slopes = theil_sen_by_group(d.withColumn("t", (d["t"] * 1_000_000).cast("long")), ["id"], "t", "y").collect()
    assert {None if r.id is None else str(r.id) for r in slopes} == want and all(r.slope_ts == pytest.approx(2) for r in slopes)
    nodes, size = fit_forest(d, ["t", "y"], ["id", "t"], trees=5)
    got = score_forest(d, ["t", "y"], nodes, size)
    assert got.columns == [*d.columns, "ml_if_score"] and dict(got.dtypes)["id"] == kind
    got = got.collect()
    assert len(got) == 18 and {None if r.id is None else str(r.id) for r in got} == want
    assert all(-1 <= r.ml_if_score <= 0 for r in got)
