"""Worked examples with known answers, and property checks of the numeric parts."""

import datetime as dt
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from respira.functions import grading, units
from respira.functions.special import t_two_sided
from respira.operators import anomaly, changepoints, coherence, cycles, day_windows, kernels, rules, sessions, validation
from respira.operators.ml_flags import anomaly_flags
from respira.plans.series import number_rows

T0 = dt.datetime(2024, 1, 1)


def series(spark, values, step_sec, name="x"):
    rows = [("a", i, T0 + dt.timedelta(seconds=step_sec * i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "k string, i int, ts timestamp_ntz, " + name + " double")


def column(df, col):
    return [r[0] for r in df.orderBy("i").select(col).collect()]


def test_bounds_flag(spark):
    d = series(spark, [25.0, 100.0, 38.0, -50.0, None, 35.0], 4)
    f = rules.bounds_flag(F.col("x"), *map(F.lit, (-40.0, 60.0, 10.0, 35.0)))
    assert column(d.withColumn("f", f), "f") == [0, 2, 1, 2, 0, 0]


def test_rate_of_change_example(spark):
    d = series(spark, [400.0, 401.0, 500.0, 402.0, 403.0], 4)
    assert column(rules.rate_of_change_flags(d, ["k"], "ts", "x", 20.0), "roc_flag") == [0, 0, 1, 1, 0]


def test_persistence_example(spark):
    d = series(spark, [400.0] * 5 + [500.0], 1800)
    assert column(rules.persistence_flags(d, ["k"], "ts", "x", 1.5, 0.01), "persistence_flag") == [1, 1, 1, 1, 1, 0]


def test_iqr_example(spark):
    d = series(spark, [400.0, 410.0, 405.0, 395.0, 9999.0], 4)
    assert column(rules.iqr_flags(d, ["k"], "x"), "iqr_flag") == [0, 0, 0, 0, 1]
    assert column(rules.iqr_flags(series(spark, [1.0, 1.0, 900.0], 4), ["k"], "x"), "iqr_flag") == [0, 0, 0]


def test_sessions_split_above_gap(spark):
    rows = [("a", i, T0 + dt.timedelta(seconds=s)) for i, s in enumerate([0, 300, 601, 602])]
    d = spark.createDataFrame(rows, "k string, i int, ts timestamp_ntz")
    assert column(sessions.add_cycles(d, ["k"], "ts", 300.0), "cycle_id") == [1, 1, 2, 2]


def test_absolute_flux_example(spark):
    d = spark.createDataFrame([(-0.5, 28.0, dt.date(2024, 6, 15)), (-0.5, 28.0, None)], "s double, t double, d date")
    out = d.select(units.absolute_flux(F.col("s"), F.col("t"), F.col("d")).alias("f")).collect()
    assert round(out[0][0], 2) == -40.47
    assert out[1][0] is None


def test_closure_confidence_examples(spark):
    rows = [(0.98, 0.03, 0.0, 1.0), (0.95, 0.05, 200.0, 0.988), (0.50, 0.25, 600.0, 0.021), (0.40, 0.30, 700.0, 0.0)]
    d = spark.createDataFrame(rows, "r double, n double, g double, want double")
    out = d.select(units.closure_confidence(F.col("r"), F.col("n"), F.col("g")).alias("c"), "want").collect()
    for r in out:
        assert round(r["c"], 3) == r["want"]


CYCLE = {
    "n_points_used": 12, "duration_sec": 180.0, "r2": 0.95, "nrmse": 0.05, "snr": 15.0, "monotonicity": 0.90,
    "outlier_frac": 0.02, "delta_aicc": 1.0, "slope_diff_pct": 0.10, "flux_slope": -0.05, "flux_absolute": -2.0,
    "co2_range": 10.0,
}


def grade(spark, night=False, raw=0, **over):
    row = {**CYCLE, **over}
    schema = ", ".join(f"{c} {'int' if c == 'n_points_used' else 'double'}" for c in row)
    d = spark.createDataFrame([tuple(row.values())], schema)
    r = grading.co2_grade(d, F.lit(night), F.lit(raw)).first()
    return r["model_qc"], r["flux_qc"], r["qc_reason"]


def test_co2_grades(spark):
    assert grade(spark) == (0, 0, "")
    assert grade(spark, raw=5) == (0, 2, "sensor_flag_2")
    assert grade(spark, r2=None) == (2, 2, "low_r2")
    assert grade(spark, r2=0.8, nrmse=0.15, snr=5.0) == (
        2, 2, "r2_moderate;nrmse_moderate;snr_moderate;many_moderate_issues:3"
    )
    assert grade(spark, r2=0.8, nrmse=0.15, snr=5.0, night=True) == (0, 0, "")
    assert grade(spark, delta_aicc=-13.0) == (2, 2, "curvature;strong_curvature")


def test_h2o_grade_reasons(spark):
    d = spark.createDataFrame(
        [(0.6, 0.1, 10.0, 0.05, 0.9, 2.0), (0.4, 0.1, 10.0, 0.05, None, 2.0), (0.9, 0.1, 10.0, 0.05, 0.9, 2.0)],
        "h2o_r2 double, h2o_nrmse double, h2o_snr double, h2o_outlier_frac double, h2o_monotonic_frac double, h2o_conc_range double",
    )
    out = grading.h2o_grade(d, F.lit(False)).select("h2o_qc", "h2o_qc_label", "h2o_qc_reason").collect()
    assert [tuple(r) for r in out] == [(1, "B", "R2=0.60<0.7"), (2, "C", "R2=0.40<0.7"), (0, "A", "")]


def test_day_score_components(spark):
    rows = [
        (T0 + dt.timedelta(hours=h, minutes=m), -0.05, 0.95, 0.05, 0) for h in range(7, 19) for m in (0, 30)
    ]
    d = spark.createDataFrame(rows, "flux_datetime timestamp_ntz, flux_slope double, r2 double, nrmse double, flux_qc int")
    r = coherence.day_quality(d.withColumn("ch", F.lit("a")), ["ch"]).first()
    assert (r["n_cycles_daytime"], r["n_hours_covered"]) == (24, 12)
    assert (r["coverage_score"], r["quality_score"], r["frac_negative"], r["shape_score"], r["nrmse_score"]) == (
        1.0, 0.95, 1.0, 0.5, 0.75
    )


def window_cycles(spark):
    rng = np.random.default_rng(0)
    rows = []
    for ch, day, h, m in itertools.product(("Chamber 1", "Chamber 2"), range(20), range(6, 19), (0, 30)):
        q = 1.0 if day < 10 else 0.5
        rows.append(
            (
                T0 + dt.timedelta(days=day, hours=h, minutes=m), ch, 0.95 * q, 0.05 + 0.1 * (1 - q), 10 * q,
                0.02 + 0.1 * (1 - q), 0.1 + 0.3 * (1 - q), -1 - 5 * (1 - q), float(rng.normal(400, 1)), 0, 1 - q, 0.5 * (1 - q),
                False,
            )
        )
    return spark.createDataFrame(
        rows,
        "ts timestamp_ntz, ch string, co2_r2 double, co2_nrmse double, co2_snr double, co2_outlier_frac double, "
        "slope_diff_pct double, delta_aicc double, flux_intercept double, co2_qc int, sensor_co2_qc_mean double, "
        "sensor_h2o_qc_mean double, is_instrumental_regime_change boolean",
    )


def test_window_selection_goldens(spark):
    d = day_windows.score_cycles(window_cycles(spark), "ch", "ts")
    assert d.agg(F.avg("cycle_confidence")).first()[0] == pytest.approx(0.91145, abs=1e-9)
    w = day_windows.select_windows(day_windows.daily_statistics(d, "ch", "ts"), "ch").toPandas()
    assert len(w) == 8
    assert w["window_score"].iloc[0] == 0.9893
    assert list(w["window_id"].sort_values()) == list(range(1, 9))
    ex = day_windows.export_cycles(d, day_windows.chosen_windows(day_windows.select_windows(
        day_windows.daily_statistics(d, "ch", "ts"), "ch")), "ch", "ts")
    assert ex.count() == d.count()


def loop_starts(flags, need=5, span=7):
    out, i = [], 0
    while i <= len(flags) - need:
        if sum(flags[i : i + span]) >= need:
            out.append(i)
            i += need
        else:
            i += 1
    return out


def test_greedy_fold_matches_loop(spark):
    rng = np.random.default_rng(3)
    cases = [[int(v) for v in rng.random(n) < 0.75] for n in (0, 3, 5, 6, 17, 60)]
    d = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, q array<int>")
    got = d.select("i", day_windows._greedy_starts(F.size("q"), F.col("q"), 5, 7).alias("s")).orderBy("i").collect()
    assert [r["s"] for r in got] == [loop_starts(c) for c in cases]


def test_theil_sen_matches_brute_force(spark):
    rng = np.random.default_rng(1)
    t = np.sort(rng.random(40)) * 100
    y = 3 * t + rng.normal(0, 5, 40)
    s = [(y[j] - y[i]) / (t[j] - t[i]) for i in range(40) for j in range(i + 1, 40)]
    mid, icpt, lo, hi = kernels.theil_sen(t, y)
    assert mid == pytest.approx(np.median(s))
    assert icpt == pytest.approx(np.median(y) - mid * np.median(t))
    assert lo < 3 < hi


def reference_window(t, y, cfg):
    """Straight restatement of the window rules, one candidate at a time."""
    first = int(np.searchsorted(t, cfg["start_cutoff_sec"]))
    best, rows = None, []
    for e in range(first + cfg["min_points"] - 1, len(t)):
        if t[e] - t[first] < cfg["min_duration_sec"]:
            continue
        tt, yy = t[first : e + 1], y[first : e + 1]
        res = yy - np.polyval(np.polyfit(tt, yy, 1), tt)
        dev = np.abs(res - np.median(res))
        odd = 0.6745 * dev / np.median(dev) > cfg["outlier_z"]
        keep = ~odd if 0 < odd.mean() <= 0.2 and (~odd).sum() >= cfg["min_points"] else np.ones(len(tt), bool)
        c = np.polyfit(tt[keep], yy[keep], 1)
        rss = np.sum((yy[keep] - np.polyval(c, tt[keep])) ** 2)
        steps = np.diff(yy[keep])
        steps = steps[np.abs(steps) > cfg["noise_eps"]]
        mono = np.mean(np.sign(steps) == np.sign(c[0])) if len(steps) else -1
        rows.append((float(kernels.aicc(rss, keep.sum(), 2)), mono, -odd.mean(), t[e] - t[first], -e, e))
    low = min(r[0] for r in rows)
    best = max((r for r in rows if r[0] <= low + 2), key=lambda r: r[1:5])
    return first, best[5]


def test_best_window_matches_restatement(monkeypatch):
    cfg = {"start_cutoff_sec": 50.0, "min_points": 20, "min_duration_sec": 100.0, "outlier_z": 2.0,
           "max_outlier_refit_frac": 0.2, "noise_eps": 0.5}
    rng = np.random.default_rng(5)
    for block in (2_000_000, 500):
        monkeypatch.setattr(kernels, "BLOCK", block)
        for _ in range(5):
            t = np.arange(0, 400, 4.0)
            y = 400 + 0.05 * t + rng.normal(0, 0.8, len(t))
            y[rng.integers(0, len(t), 4)] += 9
            w = kernels.best_window(t, y, cfg)
            assert (w["first"], w["end"]) == reference_window(t, y, cfg)


def test_evaluate_cycles_on_clean_ramp(spark):
    rows = []
    for c in range(3):
        for i in range(60):
            ts = T0 + dt.timedelta(hours=8, minutes=15 * c, seconds=4 * i)
            rows.append(("c1", ts, 410 + 0.05 * 4 * i + (0.3 if i % 2 else -0.3), 25.0, 0))
    d = spark.createDataFrame(rows, "ch string, ts timestamp_ntz, v double, temp double, flag int")
    out = cycles.evaluate_cycles(d, ["ch"], "ts", "v", "temp", "flag").toPandas()
    assert len(out) == 3
    assert np.allclose(out["flux_slope"], 0.05, atol=2e-3)
    assert np.allclose(out["slope_ts"], 0.05, atol=2e-3)
    assert (out["n_points_total"] == 60).all() and (out["qc_flag"] == 0).all()


def test_bimodality_kernel_and_native_agree(spark):
    low, high = np.linspace(395, 398, 8), np.linspace(430, 433, 8)
    args = {"bin_width": 5.0, "min_gap_bins": 4, "min_side_points": 3, "min_values": 10}
    yes = kernels.bimodality(np.concatenate([low, high]), **args)
    assert yes[0] and yes[1] >= 20
    d = spark.createDataFrame([("a", float(v)) for v in [*low, *high]], "k string, v double")
    r = cycles.bimodality(d, ["k"], "v").first()
    assert (r["bimodal_flag"], r["bimodal_gap_ppm"]) == (True, yes[1])
    assert r["bimodal_lower_mean"] == pytest.approx(yes[2])


def test_t_tail_known_values():
    got = t_two_sided(np.array([2.228138852, 0.0, 12.706204736, 1.96]), np.array([10.0, 5.0, 1.0, 1e6]))
    assert np.allclose(got, [0.05, 1.0, 0.05, 0.0499958], atol=1e-6)


def brute_partition(x, pen, size):
    n = len(x)
    cost = lambda a, b: float(np.sum((x[a:b] - x[a:b].mean()) ** 2))
    best = {0: (-pen, [])}
    for e in range(size, n + 1):
        opts = [(best[s][0] + cost(s, e) + pen, [*best[s][1], s]) for s in best if e - s >= size]
        if opts:
            best[e] = min(opts, key=lambda o: o[0])
    return [c for c in best[n][1] if c > 0]


def step_signal(spark):
    rng = np.random.default_rng(0)
    x = np.concatenate([rng.normal(400, 2, 60), rng.normal(440, 2, 60), rng.normal(420, 2, 40)])
    d = spark.createDataFrame([("a", int(i), float(v)) for i, v in enumerate(x)], "s string, us bigint, v double")
    return x, changepoints.prepare_signal(d, ["s"], ["us"], "v")


def test_change_points_on_steps(spark):
    x, s = step_signal(spark)
    got = sorted(r["k"] for r in changepoints.binary_segmentation(s, ["s"], penalty=200.0, min_size=5).collect())
    assert got == [60, 120]
    two = sorted(r["k"] for r in changepoints.binary_segmentation(s, ["s"], n_breaks=2, min_size=5).collect())
    assert two == [60, 120]
    opt = sorted(r["k"] for r in changepoints.optimal_partition(s, ["s"], 200.0, 5).collect())
    assert opt == brute_partition(x, 200.0, 5)
    seg = changepoints.segment_table(s, ["s"], changepoints.binary_segmentation(s, ["s"], n_breaks=3, min_size=5))
    kept = sorted(r["k"] for r in changepoints.prune_breaks(seg, ["s"], 0.9).collect())
    assert kept == [60, 120]


def test_optimal_partition_matches_brute_force_on_noise():
    rng = np.random.default_rng(8)
    for _ in range(5):
        x = rng.normal(0, 1, 70) + np.repeat(rng.normal(0, 2, 7), 10)
        assert changepoints._pelt(x, 6.0, 3) == brute_partition(x, 6.0, 3)


def test_light_response_recovers_parameters(spark):
    rng = np.random.default_rng(2)
    rad = rng.uniform(0, 900, 500)
    par = rad * 2.02
    a = 0.04 * par * 12 / (0.04 * par + 12) - 2
    rows = [("c", float(r), float(-v), True) for r, v in zip(rad, a + rng.normal(0, 0.05, 500), strict=True)]
    d = spark.createDataFrame(rows, "ch string, rad double, flux double, day boolean")
    r = validation.light_response(d, "ch", "flux", "rad", "day").first()
    assert r["alpha"] == pytest.approx(0.04, rel=0.05)
    assert r["Amax"] == pytest.approx(12, rel=0.02)
    assert r["Rd"] == pytest.approx(2, rel=0.05)
    assert r["status"] == "PASS"
    # No point of a fine grid around the fit is better.
    obs = np.array([-x[2] for x in rows])

    def rss(al, am, rd):
        return np.sum((obs - (al * par * am / (al * par + am) - rd)) ** 2)

    base = rss(r["alpha"], r["Amax"], r["Rd"])
    for f in itertools.product((0.999, 1.0, 1.001), repeat=3):
        assert base <= rss(r["alpha"] * f[0], r["Amax"] * f[1], r["Rd"] * f[2]) * (1 + 1e-6)


def test_q10_recovers_known_value(spark):
    rng = np.random.default_rng(4)
    temp = rng.uniform(18, 34, 300)
    rows = [("c", float(t), float(3 * 2 ** ((t - 25) / 10)), False) for t in temp]
    d = spark.createDataFrame(rows, "ch string, temp double, flux double, day boolean")
    r = validation.q10_response(d, ["ch"], "flux", "temp", "day").first()
    assert r["Q10"] == pytest.approx(2.0) and r["R_ref"] == pytest.approx(3.0) and r["status"] == "PASS"


def test_anomaly_flags_rank_injected_outliers_first(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(0, 1, (400, 3))
    x[:5] += 9
    rows = [(i, *map(float, v), 0) for i, v in enumerate(x)]
    d = spark.createDataFrame(rows, "id int, r2 double, nrmse double, snr double, flux_qc int")
    p = anomaly_flags(d, ["id"], trees=60, max_samples=128).toPandas()
    assert set(p.nsmallest(5, "ml_if_score")["id"]) == set(range(5))
    assert set(p.nlargest(5, "ml_mcd_dist")["id"]) == set(range(5))
    assert (p[p["id"] < 5]["ml_anomaly_flag"] == 1).all()
    with pytest.raises(ValueError):
        anomaly_flags(d.select("id", "r2"), ["id"])


def test_rank_share_handles_ties_and_nulls(spark):
    d = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 1.0, 5.0, None])], "i int, v double")
    got = column(anomaly.rank_share(d, F.col("v"), "s"), "s")
    # The unknown ranks at the median (1.0), so three values share ranks 1-3.
    assert got == pytest.approx([1 / 3, 1 / 3, 1.0, 0.0])


@pytest.mark.parametrize("split", [False, True])
def test_number_rows(spark, split, request):
    if split:
        request.getfixturevalue("cut_series")
    d = spark.range(500).select((F.col("id") * 7919 % 500).alias("v"))
    p = number_rows(d.repartition(7), [F.col("v")], "n").toPandas()
    assert (p["n"] == p["v"] + 1).all()
    assert not math.isnan(pd.to_numeric(p["n"]).sum())


def test_optimal_partition_over_ranges(spark, monkeypatch):
    """Series longer than a range, and a whole series of readings, against brute force."""
    monkeypatch.setattr(changepoints, "RANGE_ROWS", 17)
    rng = np.random.default_rng(8)
    series = {"a": rng.normal(size=90), "b": rng.normal(size=40) + np.repeat([0, 9], 20), None: rng.normal(size=2), "d": rng.normal(size=34)}
    rows = [(s, i, float(i), float(v), 1) for s, x in series.items() for i, v in enumerate(x)]
    signal = spark.createDataFrame(rows, "s string, i long, at double, x double, step long")
    got = changepoints.optimal_partition(signal, ["s"], 3.0, 4).collect()
    for s, x in series.items():
        assert sorted(r["k"] for r in got if r["s"] == s) == (brute_partition(x, 3.0, 4) if len(x) >= 8 else []), s


def test_optimal_partition_query_searches_readings(spark):
    """Breaks lie inside days: positions are readings, not the thirty daily means."""
    from respira.catalog.series_stats import optimal_partition

    assert optimal_partition(spark, "/root/testdata/sf0.001").agg({"k": "max"}).first()[0] > 31


def test_logger_with_given_names_line(spark, tmp_path):
    from respira.sources.logger import read_logger

    names = '"TIMESTAMP","RECORD","CO2"'
    (tmp_path / "a.dat").write_text(f'"TOA5","x"\n{names}\n"TS","RN","ppm"\n"","","Avg"\n"2024-01-01 00:00:00",1,400.5\n"2024-01-01 00:00:30",2,"NAN"\n')
    given, found = (read_logger(spark, str(tmp_path), names_line=n) for n in (names, None))
    assert given.columns == ["TIMESTAMP", "RECORD", "CO2", "_file"]
    got = [tuple(r) for r in given.orderBy("RECORD").collect()]
    assert [r[1:3] for r in got] == [(1.0, 400.5), (2.0, None)]
    assert got == [tuple(r) for r in found.select(*given.columns).orderBy("RECORD").collect()]
