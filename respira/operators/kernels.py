"""Per-cycle numerics on the time and value arrays of single cycles, called from Arrow batches.

Candidate windows are evaluated as rows of a matrix, in blocks, so memory stays near ``BLOCK`` values per cycle.
"""

from __future__ import annotations

import numpy as np

from respira.functions.special import t_two_sided
from respira.operators import slopes

BLOCK = 2_000_000
Z95 = 1.959963984540054


def aicc(rss, n, k):
    """Corrected information criterion of a least-squares fit with ``k`` parameters; inf without spare points."""
    rss, n = np.maximum(np.asarray(rss, dtype=float), 1e-12), np.asarray(n, dtype=float)
    spare = n - k - 1
    with np.errstate(divide="ignore", invalid="ignore"):
        v = n * np.log(rss / n) + 2 * k + 2 * k * (k + 1) / spare
    return np.where(spare > 0, v, np.inf)


def _line(t, y, use):
    """Least-squares lines of many point subsets at once: rows of ``use`` select points of ``t`` and ``y``."""
    n = use.sum(axis=1)
    tc, yc = t - t.mean(), y - y.mean()
    mt, my = use @ tc / n, use @ yc / n
    sxx = use @ (tc * tc) - n * mt * mt
    sxy = use @ (tc * yc) - n * mt * my
    with np.errstate(divide="ignore", invalid="ignore"):
        slope = np.where(sxx > 0, sxy / sxx, np.nan)
    icpt = my + y.mean() - slope * (mt + t.mean())
    res = y[None, :] - (slope[:, None] * t[None, :] + icpt[:, None])
    rss = np.where(use, res * res, 0.0).sum(axis=1)
    return n, slope, icpt, res, rss


def _masked_median(v, use):
    s = np.sort(np.where(use, v, np.inf), axis=1)
    n = use.sum(axis=1)
    rows = np.arange(len(n))
    return (s[rows, (n - 1) // 2] + s[rows, n // 2]) / 2


def _monotonic(y, use, slope, eps):
    """Share of steps between neighbouring selected points, larger than ``eps``, that go the way of the slope."""
    out = np.full(len(slope), np.nan)
    for i, (u, s) in enumerate(zip(use, slope, strict=True)):
        v = y[u]
        if len(v) < 3 or s == 0 or np.isnan(s):
            continue
        d = np.diff(v)
        d = d[np.abs(d) > eps]
        if len(d):
            out[i] = np.mean(np.sign(d) == np.sign(s))
    return out


def window_candidates(t, y, first, ends, cfg):
    """Fit every window from ``first`` to one of ``ends``; outliers are left out once where few enough.

    Returns arrays (end, duration, aicc, outlier_frac, monotonicity) of usable windows and their point masks.
    """
    tt, yy = t[first : ends[-1] + 1], y[first : ends[-1] + 1]
    rows = max(1, BLOCK // len(tt))
    parts = []
    for at in range(0, len(ends), rows):
        e = ends[at : at + rows]
        use = np.arange(len(tt))[None, :] <= (e - first)[:, None]
        n, slope, _, res, rss = _line(tt, yy, use)
        score = aicc(rss, n, 2)
        med = _masked_median(res, use)
        dev = np.abs(res - med[:, None])
        mad = _masked_median(dev, use)
        with np.errstate(divide="ignore", invalid="ignore"):
            odd = use & (mad[:, None] > 0) & (0.6745 * dev / mad[:, None] > cfg["outlier_z"])
        frac = odd.sum(axis=1) / n
        left = n - odd.sum(axis=1)
        refit = (frac > 0) & (frac <= cfg["max_outlier_refit_frac"]) & (left >= cfg["min_points"])
        keep = np.where(refit[:, None], use & ~odd, use)
        n2, slope2, _, _, rss2 = _line(tt, yy, keep)
        score2 = np.where(refit, aicc(rss2, n2, 2), score)
        ok = np.isfinite(score) & np.isfinite(score2) & ~np.isnan(slope2)
        mono = _monotonic(yy, keep, slope2, cfg["noise_eps"])
        parts.append((e[ok], tt[e[ok] - first] - tt[0], score2[ok], frac[ok], mono[ok]))
    return [np.concatenate(p) for p in zip(*parts, strict=True)]


def _mask_of_window(t, y, first, end, cfg):
    use = np.zeros(len(t), dtype=bool)
    use[first : end + 1] = True
    sub = slice(first, end + 1)
    whole = np.ones((1, end + 1 - first), dtype=bool)
    n, _, _, res, _ = _line(t[sub], y[sub], whole)
    med = np.median(res)
    dev = np.abs(res[0] - med)
    mad = np.median(dev)
    if mad > 0:
        odd = 0.6745 * dev / mad > cfg["outlier_z"]
        if 0 < odd.mean() <= cfg["max_outlier_refit_frac"] and n[0] - odd.sum() >= cfg["min_points"]:
            use[np.flatnonzero(use)[odd]] = False
    return use


def best_window(t, y, cfg):
    """Choose the regression window of one cycle; ``None`` if it has too few points after the dead time.

    Among windows within 2 of the lowest criterion: the most monotonic, then fewest outliers, then longest, then first.
    """
    first = int(np.searchsorted(t, cfg["start_cutoff_sec"], side="left"))
    if len(t) < cfg["min_points"] or first >= len(t) - cfg["min_points"]:
        return None
    ends = np.arange(max(first + cfg["min_points"] - 1, 1), len(t))
    ends = ends[t[ends] - t[first] >= cfg["min_duration_sec"]]
    if len(ends):
        e, dur, score, frac, mono = window_candidates(t, y, first, ends, cfg)
    if len(ends) == 0 or len(e) == 0:
        use = np.zeros(len(t), dtype=bool)
        use[first:] = True
        return {"first": first, "end": len(t) - 1, "use": use, "outlier_frac": 0.0, "fallback": True}
    near = np.flatnonzero(score <= score.min() + 2)
    m = np.where(np.isnan(mono[near]), -1.0, mono[near])
    pick = near[np.lexsort((e[near], -dur[near], frac[near], -m))[0]]
    use = _mask_of_window(t, y, first, int(e[pick]), cfg)
    return {"first": first, "end": int(e[pick]), "use": use, "outlier_frac": float(frac[pick]), "fallback": False}


def theil_sen(t, y):
    """Median pairwise slope, matching intercept and 95 % rank interval; points in order of time."""
    s = slopes.PairSlopes(t, y)
    if s.count == 0:
        return np.nan, np.nan, np.nan, np.nan
    mid = float((s.at((s.count - 1) // 2) + s.at(s.count // 2)) / 2)

    def ties(v):
        k = np.unique(v, return_counts=True)[1].astype(float)
        return np.sum(k * (k - 1) * (2 * k + 5))

    n = len(y)
    var = (n * (n - 1) * (2 * n + 5) - ties(t) - ties(y)) / 18.0
    sd = np.sqrt(max(var, 0.0))
    hi = min(int(np.round((s.count + Z95 * sd) / 2.0)), s.count - 1)
    lo = max(int(np.round((s.count - Z95 * sd) / 2.0)) - 1, 0)
    return mid, float(np.median(y) - mid * np.median(t)), float(s.at(lo)), float(s.at(hi))


def quadratic_aicc(t, y):
    """Criterion of the parabola through the same points, on centred and scaled time."""
    c = t - t.mean()
    scale = np.abs(c).max() or 1.0
    x = np.vander(c / scale, 3)
    coef, *_ = np.linalg.lstsq(x, y, rcond=None)
    r = y - x @ coef
    return float(aicc(r @ r, len(t), 3))


def bimodality(y, bin_width, min_gap_bins, min_side_points, min_values):
    """Longest run of empty bins between occupied ones splits the values in two groups if both are populated."""
    none = (False, 0.0, np.nan, np.nan)
    v = y[np.isfinite(y)]
    if len(v) < min_values or np.ptp(v) < bin_width * (min_gap_bins + 2):
        return none
    bins = np.unique(np.floor(v / bin_width))
    empty = np.diff(bins) - 1
    k = int(np.argmax(empty))
    if empty[k] < min_gap_bins:
        return none
    split = (bins[k] + 1 + bins[k] + 1 + empty[k]) * bin_width / 2
    low, high = v[v < split], v[v >= split]
    if min(len(low), len(high)) < min_side_points:
        return none
    return True, float(empty[k] * bin_width), float(low.mean()), float(high.mean())


def cycle_metrics(t, y, cfg):
    """All regression metrics of one CO2 cycle; ``None`` where no window can be fitted."""
    w = best_window(t, y, cfg)
    if w is None:
        return None
    tu, yu = t[w["use"]], y[w["use"]]
    n, slope, icpt, _, rss = (v[0] for v in _line(tu, yu, np.ones((1, len(tu)), dtype=bool)))
    syy = float(np.sum((yu - yu.mean()) ** 2))
    sxx = float(np.sum((tu - tu.mean()) ** 2))
    r2 = 1 - rss / syy if syy > 0 else 0.0
    rmse = float(np.sqrt(rss / n))
    p = se = np.nan
    if not w["fallback"] and n > 2:
        se = float(np.sqrt(rss / (n - 2) / sxx))
        p = float(t_two_sided(slope / se if se > 0 else np.inf, n - 2))
    ts, _, ts_lo, ts_hi = theil_sen(tu, yu)
    lin, quad = float(aicc(rss, n, 2)), quadratic_aicc(tu, yu)
    span, dur = float(np.ptp(yu)), float(tu[-1] - tu[0])
    sigma = np.nan
    if cfg["noise_win_sec"] is not None:
        head = y[t <= cfg["noise_win_sec"]]
        if len(head) >= cfg["noise_min_points"]:
            mad = np.median(np.abs(head - np.median(head)))
            sigma = 1.4826 * mad if mad > 0 else np.nan
    mono = _monotonic(y, w["use"][None, :], np.array([slope]), cfg["noise_eps"])[0]
    bi = bimodality(y, **cfg["bimodal"])
    return {
        "window_start_sec": float(t[w["first"]]),
        "window_end_sec": float(t[w["end"]]),
        "duration_sec": dur,
        "n_points_used": int(n),
        "flux_slope": float(slope),
        "flux_intercept": float(icpt),
        "r2": float(r2),
        "p_value": p,
        "std_err": se,
        "rmse": rmse,
        "nrmse": rmse / span if span > 0 else np.nan,
        "snr": abs(slope) * dur / rmse if rmse > 0 else np.nan,
        "snr_noise": abs(slope) * dur / sigma if sigma > 0 else np.nan,
        "noise_sigma": sigma,
        "monotonicity": float(mono),
        "outlier_frac": w["outlier_frac"],
        "aicc_linear": lin,
        "aicc_quadratic": quad,
        "delta_aicc": quad - lin,
        "slope_ts": ts,
        "slope_ts_low": ts_lo,
        "slope_ts_high": ts_hi,
        "slope_diff_pct": abs(slope - ts) / max(abs(slope), 1e-9),
        "co2_range": span,
        "bimodal_flag": bi[0],
        "bimodal_gap_ppm": bi[1],
        "bimodal_lower_mean": bi[2],
        "bimodal_upper_mean": bi[3],
    }


def h2o_metrics(t, y, min_points, min_duration_sec):
    """Water-vapour metrics of one cycle; ``None`` if it is too short."""
    if len(t) < min_points or t[-1] - t[0] < min_duration_sec:
        return None
    t = t - t[0]
    slope_ts, icpt_ts, _, _ = theil_sen(t, y)
    n, _, _, res, rss = _line(t, y, np.ones((1, len(t)), dtype=bool))
    res, rss = res[0], float(rss[0])
    syy = float(np.sum((y - y.mean()) ** 2))
    span, dur, noise = float(np.ptp(y)), float(t[-1]), float(np.std(res))
    mad = float(np.median(np.abs(res - np.median(res))))
    d = np.diff(y)
    d = d[np.abs(d) > 0.05]
    mono = np.nan if len(d) == 0 else float(np.mean(d > 0 if slope_ts > 0 else d < 0))
    return {
        "h2o_slope": slope_ts,
        "h2o_intercept": icpt_ts,
        "h2o_r2": 1 - rss / syy if syy > 0 else 0.0,
        "h2o_nrmse": float(np.sqrt(rss / n[0])) / span if span > 0 else np.nan,
        "h2o_snr": abs(slope_ts) * dur / noise if noise > 0 else np.nan,
        "h2o_outlier_frac": float(np.mean(np.abs(res) > (2.5 * mad if mad > 0 else 1e-9))),
        "h2o_monotonic_frac": mono,
        "h2o_n_points": int(n[0]),
        "h2o_duration": dur,
        "h2o_conc_mean": float(y.mean()),
        "h2o_conc_range": span,
    }
