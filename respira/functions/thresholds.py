"""Default settings and grading limits. Results depend on these exact numbers."""

from __future__ import annotations

CYCLE_SETTINGS = {
    "gap_sec": 300.0,
    "start_cutoff_sec": 50.0,
    "min_points": 20,
    "min_duration_sec": 180.0,
    "outlier_z": 2.0,
    "max_outlier_refit_frac": 0.2,
    "noise_eps": 0.5,
    "noise_win_sec": None,
    "noise_min_points": 5,
}

CO2_DAY = {
    "min_points": 8,
    "min_duration_sec": 60,
    "r2_A": 0.90,
    "r2_B": 0.70,
    "nrmse_A": 0.10,
    "nrmse_B": 0.20,
    "snr_A": 10.0,
    "snr_B": 3.0,
    "monotonic_A": 0.80,
    "monotonic_B": 0.45,
    "outlier_A": 0.05,
    "outlier_B": 0.15,
    "curvature_aicc": -4.0,
    "curvature_aicc_C": -12.0,
    "slope_diff_A": 0.30,
    "slope_diff_B": 0.60,
    "signal_ppm_guard": 5.0,
    "b_count_C": 3,
}

CO2_NIGHT = {
    "min_points": 8,
    "min_duration_sec": 60,
    "r2_A": 0.70,
    "r2_B": 0.40,
    "nrmse_A": 0.25,
    "nrmse_B": 0.40,
    "snr_A": 5.0,
    "snr_B": 2.0,
    "monotonic_A": 0.50,
    "monotonic_B": 0.30,
    "outlier_A": 0.10,
    "outlier_B": 0.20,
    "curvature_aicc": -8.0,
    "curvature_aicc_C": -16.0,
    "slope_diff_A": 0.40,
    "slope_diff_B": 0.80,
    "signal_ppm_guard": 3.0,
    "b_count_C": 4,
}

H2O_DAY = {
    "r2_A": 0.70,
    "r2_B": 0.50,
    "nrmse_A": 0.15,
    "nrmse_B": 0.25,
    "snr_A": 5.0,
    "snr_B": 3.0,
    "monotonic_A": 0.70,
    "monotonic_B": 0.40,
    "outlier_A": 0.15,
    "outlier_B": 0.25,
    "signal_mmol_guard": 0.3,
}

H2O_NIGHT = {
    "r2_A": 0.50,
    "r2_B": 0.25,
    "nrmse_A": 0.25,
    "nrmse_B": 0.45,
    "snr_A": 3.0,
    "snr_B": 1.5,
    "monotonic_A": 0.50,
    "monotonic_B": 0.30,
    "outlier_A": 0.20,
    "outlier_B": 0.30,
    "signal_mmol_guard": 0.15,
}

HARD_LIMITS = {"max_abs_slope": 10.0, "max_abs_flux": 100.0, "max_co2_range": 2000.0}

WPL_LIMITS = {
    "valid_frac_A": 0.98,
    "valid_frac_B": 0.95,
    "rel_change_p95_A": 0.04,
    "rel_change_p95_B": 0.07,
    "factor_max_B": 1.08,
}

BIMODAL = {"bin_width": 5.0, "min_gap_bins": 4, "min_side_points": 3, "min_values": 10}

WINDOW_SETTINGS = {
    "r2_good": 0.90,
    "r2_ok": 0.70,
    "nrmse_good": 0.10,
    "nrmse_ok": 0.20,
    "snr_good": 5.0,
    "snr_ok": 1.5,
    "outlier_good": 0.05,
    "outlier_ok": 0.15,
    "slope_diff_good": 0.30,
    "slope_diff_ok": 0.60,
    "aicc_good": -4.0,
    "aicc_ok": -8.0,
    "weights": {"regression": 0.35, "robustness": 0.25, "sensor_qc": 0.15, "drift": 0.15, "cross_chamber": 0.10},
    "drift_window_days": 30,
    "seasonal_detrend_days": 90,
    "drift_zscore_bad": 2.5,
    "drift_zscore_moderate": 1.5,
    "daytime_hours": (6, 18),
    "min_cycle_coverage": 0.70,
    "min_good_fraction": 0.60,
    "confidence_good": 0.65,
    "min_window_days": 5,
    "flexibility_buffer": 2,
    "min_score_for_export": 0.55,
}

