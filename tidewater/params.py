"""Default QC parameters.

FIXED VALUES: these numbers must equal the reference configuration for the
flags to agree; they are stated here plainly, in the reference's order.
Operators take a plain ``dict`` so a user can override any of them.
"""

from __future__ import annotations

import copy

# --- fixed values (QC parameter file) -------------------------------------
DEFAULT_PARAMETERS: dict = {
    "base": {"time_since_sun_above_horizon": 1.0},
    "track_check": {
        "min_speed": 8.50,
        "amax": 15.00,
        "amaxx": 20.00,
        "amin": 0.0,
        "max_multiplier": 1.25,
        "min_multiplier": 0.75,
        "max_direction_change": 60.0,
        "max_speed_change": 10.00,
        "max_absolute_speed": 40.00,
        "max_midpoint_discrepancy": 150.0,
    },
    "IQUAM_track_check": {
        "number_of_neighbours": 5,
        "buoy_speed_limit": 15.0,
        "ship_speed_limit": 60.0,
        "delta_d": 1.11,
        "delta_t": 0.01,
    },
    "IQUAM_spike_check": {
        "number_of_neighbours": 5,
        "max_gradient_space": 0.5,
        "max_gradient_time": 1.0,
        "ship_delta_t": 2.0,
        "buoy_delta_t": 1.0,
    },
    "saturated_runs": {"min_time_threshold": 48.0, "shortest_run": 4},
    "multiple_rounded_values": {"threshold": 0.5, "min_count": 20},
    "find_repeated_values": {"threshold": 0.7, "min_count": 20},
    "bayesian_buddy_check": {
        "prior_probability_of_gross_error": 0.05,
        "quantization_interval": 0.1,
        "limits": [2, 2, 4],
        "noise_scaling": 3.0,
        "measurement_error": 1.0,
    },
    "mds_buddy_check": {
        "limits": [[1, 1, 2], [2, 2, 2], [1, 1, 4], [2, 2, 4]],
        "number_of_obs_thresholds": [[0, 5, 15, 100], [0], [0, 5, 15, 100], [0]],
        "multipliers": [[4.0, 3.5, 3.0, 2.5], [4.0], [4.0, 3.5, 3.0, 2.5], [4.0]],
    },
    "slp_buddy_check": {
        "limits": [[1, 1, 0], [2, 2, 0], [3, 3, 0], [4, 4, 0]],
        "number_of_obs_thresholds": [[0, 5, 15, 100], [0], [0, 5, 15, 100], [0]],
        "multipliers": [[4.0, 3.5, 3.0, 2.5], [4.0], [4.0, 3.5, 3.0, 2.5], [4.0]],
    },
    "W": {"hard_limits": [0.0, 50.0], "variable_limit": 4.0},
    "SLP": {"maximum_anomaly": 10.0, "maximum_standardised_anomaly": 3.0, "lowbar": 10.0},
    "SST": {
        "freezing_point": -1.8,
        "freeze_check_n_sigma": 2.0,
        "maximum_anomaly": 8.0,
        "hard_limits": [-5.0, 45.0],
    },
    "AT": {
        "maximum_anomaly": 10.0,
        "maximum_standardised_anomaly": 5.5,
        "minmax_standard_deviation": [1.0, 4.0],
        "hard_limits": [-80.0, 65.0],
    },
    "DAT": {
        "maximum_anomaly": 10.0,
        "maximum_standardised_anomaly": 5.5,
        "minmax_standard_deviation": [1.0, 4.0],
        "hard_limits": [-80.0, 65.0],
    },
    "DPT": {
        "maximum_standardised_anomaly": 5.5,
        "minmax_standard_deviation": [1.0, 4.0],
        "hard_limits": [-80.0, 65.0],
    },
    "SHU": {"hard_limits": [0.0, 500.0]},
    "RH": {"hard_limits": [0.0, 150.0]},
    "buoy_aground_check": {"smooth_win": 41, "min_win_period": 8, "max_win_period": 10},
    "new_buoy_aground_check": {"smooth_win": 41, "min_win_period": 8},
    "buoy_speed_check": {"speed_limit": 2.5, "min_win_period": 0.8, "max_win_period": 1.0},
    "new_buoy_speed_check": {"speed_limit": 3.0, "min_win_period": 0.375},
    "buoy_tail_check": {
        "long_win_len": 121,
        "long_err_std_n": 3.0,
        "short_win_len": 30,
        "short_err_std_n": 3.0,
        "short_win_n_bad": 2,
        "drift_inter": 0.29,
        "drif_intra": 1.00,
        "background_err_lim": 0.3,
    },
    "buoy_bias_noise_check": {
        "n_eval": 30,
        "bias_lim": 1.10,
        "drif_intra": 1.0,
        "drif_inter": 0.29,
        "err_std_n": 3.0,
        "n_bad": 2,
        "background_err_lim": 0.3,
    },
}

# --- fixed values (legacy base-QC bundle, older fixed limits) --------------
LEGACY_PRESET: dict = {
    "SST": {"maximum_anomaly": 8.0},
    "AT": {"maximum_anomaly": 10.0},
    "mat_blacklist_deck193_end_year": 1893,
}

# Earth radius (km) and nautical-mile factor used by the track checks.
EARTH_RADIUS_KM = 6371.0088
KM_TO_NM = 0.539957


def parameters(overrides: dict | None = None) -> dict:
    """Deep copy of the defaults with ``overrides`` merged one level deep."""
    out = copy.deepcopy(DEFAULT_PARAMETERS)
    for key, value in (overrides or {}).items():
        if isinstance(value, dict) and isinstance(out.get(key), dict):
            out[key].update(value)
        else:
            out[key] = value
    return out
