"""Feature settings: which calculators run, with which parameters, and names.

A setting maps a calculator name to ``None`` (no parameters) or a list of
parameter dicts.  Output names follow the public convention
``<variable>__<calculator>[__<key>_<value>]...`` with keys sorted and string
values in double quotes, so a raw variable column (named exactly like the
variable) can never collide with a feature column.
"""

from __future__ import annotations

from itertools import product

# ---------------------------------------------------------------------------
# Calculator parameter grids of the three public tiers.
# Grids are written as the rules that generate them.
# ---------------------------------------------------------------------------
MINIMAL = {
    "sum_values": None, "median": None, "mean": None, "length": None,
    "standard_deviation": None, "variance": None, "root_mean_square": None,
    "maximum": None, "absolute_maximum": None, "minimum": None,
}

COMPREHENSIVE = {
    "variance_larger_than_standard_deviation": None,
    "has_duplicate_max": None,
    "has_duplicate_min": None,
    "has_duplicate": None,
    "sum_values": None,
    "abs_energy": None,
    "mean_abs_change": None,
    "mean_change": None,
    "mean_second_derivative_central": None,
    "median": None,
    "mean": None,
    "length": None,
    "standard_deviation": None,
    "variation_coefficient": None,
    "variance": None,
    "skewness": None,
    "kurtosis": None,
    "root_mean_square": None,
    "absolute_sum_of_changes": None,
    "longest_strike_below_mean": None,
    "longest_strike_above_mean": None,
    "count_above_mean": None,
    "count_below_mean": None,
    "last_location_of_maximum": None,
    "first_location_of_maximum": None,
    "last_location_of_minimum": None,
    "first_location_of_minimum": None,
    "percentage_of_reoccurring_values_to_all_values": None,
    "percentage_of_reoccurring_datapoints_to_all_datapoints": None,
    "sum_of_reoccurring_values": None,
    "sum_of_reoccurring_data_points": None,
    "ratio_value_number_to_time_series_length": None,
    "sample_entropy": None,
    "maximum": None,
    "absolute_maximum": None,
    "minimum": None,
    "benford_correlation": None,
    "time_reversal_asymmetry_statistic": [{"lag": lag} for lag in range(1, 4)],
    "c3": [{"lag": lag} for lag in range(1, 4)],
    "cid_ce": [{"normalize": True}, {"normalize": False}],
    "symmetry_looking": [{"r": r * 0.05} for r in range(20)],
    "large_standard_deviation": [{"r": r * 0.05} for r in range(1, 20)],
    "quantile": [{"q": q} for q in [.1, .2, .3, .4, .6, .7, .8, .9]],
    "autocorrelation": [{"lag": lag} for lag in range(10)],
    "agg_autocorrelation": [{"f_agg": s, "maxlag": 40} for s in ["mean", "median", "var"]],
    "partial_autocorrelation": [{"lag": lag} for lag in range(10)],
    "number_cwt_peaks": [{"n": n} for n in [1, 5]],
    "number_peaks": [{"n": n} for n in [1, 3, 5, 10, 50]],
    "binned_entropy": [{"max_bins": 10}],
    "index_mass_quantile": [{"q": q} for q in [.1, .2, .3, .4, .6, .7, .8, .9]],
    "cwt_coefficients": [{"widths": (2, 5, 10, 20), "coeff": c, "w": w}
                         for c in range(15) for w in (2, 5, 10, 20)],
    "spkt_welch_density": [{"coeff": c} for c in [2, 5, 8]],
    "ar_coefficient": [{"coeff": c, "k": 10} for c in range(11)],
    "change_quantiles": [{"ql": ql, "qh": qh, "isabs": b, "f_agg": f}
                         for ql in [0., .2, .4, .6, .8] for qh in [.2, .4, .6, .8, 1.]
                         for b in [False, True] for f in ["mean", "var"] if ql < qh],
    "fft_coefficient": [{"coeff": k, "attr": a}
                        for a, k in product(["real", "imag", "abs", "angle"], range(100))],
    "fft_aggregated": [{"aggtype": s} for s in ["centroid", "variance", "skew", "kurtosis"]],
    "value_count": [{"value": v} for v in [0, 1, -1]],
    "range_count": [{"min": -1, "max": 1}, {"min": -1e12, "max": 0}, {"min": 0, "max": 1e12}],
    "approximate_entropy": [{"m": 2, "r": r} for r in [.1, .3, .5, .7, .9]],
    "friedrich_coefficients": [{"coeff": c, "m": 3, "r": 30} for c in range(4)],
    "max_langevin_fixed_point": [{"m": 3, "r": 30}],
    "linear_trend": [{"attr": a} for a in ["pvalue", "rvalue", "intercept", "slope", "stderr"]],
    "agg_linear_trend": [{"attr": a, "chunk_len": i, "f_agg": f}
                         for a in ["rvalue", "intercept", "slope", "stderr"]
                         for i in [5, 10, 50] for f in ["max", "min", "mean", "var"]],
    "augmented_dickey_fuller": [{"attr": a} for a in ["teststat", "pvalue", "usedlag"]],
    "number_crossing_m": [{"m": 0}, {"m": -1}, {"m": 1}],
    "energy_ratio_by_chunks": [{"num_segments": 10, "segment_focus": i} for i in range(10)],
    "ratio_beyond_r_sigma": [{"r": x} for x in [0.5, 1, 1.5, 2, 2.5, 3, 5, 6, 7, 10]],
    "count_above": [{"t": 0}],
    "count_below": [{"t": 0}],
    "lempel_ziv_complexity": [{"bins": x} for x in [2, 3, 5, 10, 100]],
    "fourier_entropy": [{"bins": x} for x in [2, 3, 5, 10, 100]],
    "permutation_entropy": [{"tau": 1, "dimension": x} for x in [3, 4, 5, 6, 7]],
    "query_similarity_count": [{"query": None, "threshold": 0.0}],
    "mean_n_absolute_max": [{"number_of_maxima": 7}],
}

# The efficient tier drops the calculators whose cost is quadratic in the window.
_HIGH_COST = ("approximate_entropy", "sample_entropy")
EFFICIENT = {k: v for k, v in COMPREHENSIVE.items() if k not in _HIGH_COST}

# Calculators whose name carries an implied extra parameter.
_IMPLIED = {"augmented_dickey_fuller": {"autolag": "AIC"}}

TIERS = {"minimal": MINIMAL, "efficient": EFFICIENT, "comprehensive": COMPREHENSIVE}


def resolve(settings) -> dict:
    """A tier name, a complexity level (0, 1, other) or an explicit dict."""
    if isinstance(settings, dict):
        return settings
    if isinstance(settings, int):
        return MINIMAL if settings == 0 else EFFICIENT if settings == 1 else COMPREHENSIVE
    try:
        return TIERS[settings]
    except KeyError:
        raise ValueError(f"unknown feature settings {settings!r}") from None


def _fmt(v) -> str:
    return f'"{v}"' if isinstance(v, str) else str(v)


def param_suffix(params: dict | None) -> str:
    if not params:
        return ""
    return "__" + "__".join(f"{k}_{_fmt(v)}" for k, v in sorted(params.items()))


def feature_specs(settings) -> list[tuple[str, dict | None, str]]:
    """``(calculator, params, suffix)`` for every feature of a setting, in setting order."""
    out = []
    for calc, grid in resolve(settings).items():
        for params in (grid if grid else [None]):
            shown = dict(params or {})
            shown.update(_IMPLIED.get(calc, {}))
            out.append((calc, params, f"{calc}{param_suffix(shown)}"))
    return out


def feature_name(variable: str, suffix: str) -> str:
    return f"{variable}__{suffix}"
