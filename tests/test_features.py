"""Feature values against plain-Python truth per window (every native calculator),
block-size invariance, array calculators, and tier sizes."""

import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tsengine.functions import arrays as A
from tsengine.functions.native import NATIVE
from tsengine.functions.settings import feature_specs
from tsengine.operators.roll import prepare_series, roll_lengths
from tsengine.plans.extract import array_features, extract_features

NATIVE_SETTINGS = {
    "sum_values": None, "mean": None, "length": None, "standard_deviation": None, "variance": None,
    "root_mean_square": None, "maximum": None, "absolute_maximum": None, "minimum": None, "abs_energy": None,
    "absolute_sum_of_changes": None, "mean_abs_change": None, "mean_change": None,
    "mean_second_derivative_central": None, "variation_coefficient": None,
    "variance_larger_than_standard_deviation": None, "skewness": None, "kurtosis": None,
    "large_standard_deviation": [{"r": 0.05}, {"r": 0.25}], "cid_ce": [{"normalize": True}, {"normalize": False}],
    "c3": [{"lag": k} for k in (1, 2, 3)], "time_reversal_asymmetry_statistic": [{"lag": k} for k in (1, 2, 3)],
    "autocorrelation": [{"lag": k} for k in range(10)], "value_count": [{"value": v} for v in (0, 1, -1)],
    "range_count": [{"min": -1, "max": 1}, {"min": -1e12, "max": 0}, {"min": 0, "max": 1e12}],
    "count_above": [{"t": 0}], "count_below": [{"t": 0}], "number_crossing_m": [{"m": 0}, {"m": -1}, {"m": 1}],
    "first_location_of_maximum": None, "last_location_of_maximum": None, "first_location_of_minimum": None,
    "last_location_of_minimum": None, "has_duplicate_max": None, "has_duplicate_min": None,
    "linear_trend": [{"attr": a} for a in ("pvalue", "rvalue", "intercept", "slope", "stderr")],
}


def truth(calc, p, x):
    n = len(x)
    d = np.diff(x)
    mean, std, var = x.mean(), x.std(), x.var()
    if calc == "sum_values": return x.sum()
    if calc == "mean": return mean
    if calc == "length": return n
    if calc == "standard_deviation": return std
    if calc == "variance": return var
    if calc == "root_mean_square": return math.sqrt((x * x).mean())
    if calc == "maximum": return x.max()
    if calc == "minimum": return x.min()
    if calc == "absolute_maximum": return np.abs(x).max()
    if calc == "abs_energy": return (x * x).sum()
    if calc == "absolute_sum_of_changes": return np.abs(d).sum()
    if calc == "mean_abs_change": return np.abs(d).mean() if n > 1 else math.nan
    if calc == "mean_change": return (x[-1] - x[0]) / (n - 1) if n > 1 else math.nan
    if calc == "mean_second_derivative_central":
        return (x[-1] - x[-2] - x[1] + x[0]) / (2 * (n - 2)) if n > 2 else math.nan
    if calc == "variation_coefficient": return std / mean if mean != 0 else math.nan
    if calc == "variance_larger_than_standard_deviation": return float(var > std)
    if calc == "skewness": return pd.Series(x).skew()
    if calc == "kurtosis": return pd.Series(x).kurt()
    if calc == "large_standard_deviation": return float(std > p["r"] * (x.max() - x.min()))
    if calc == "cid_ce":
        if p["normalize"]:
            if std == 0: return 0.0
            z = (x - mean) / std
            return math.sqrt((np.diff(z) ** 2).sum())
        return math.sqrt((d ** 2).sum())
    if calc == "c3":
        k = p["lag"]
        if 2 * k >= n: return 0.0
        return np.mean((np.roll(x, -2 * k) * np.roll(x, -k) * x)[: n - 2 * k])
    if calc == "time_reversal_asymmetry_statistic":
        k = p["lag"]
        if 2 * k >= n: return 0.0
        one, two = np.roll(x, -k), np.roll(x, -2 * k)
        return np.mean((two * two * one - one * x * x)[: n - 2 * k])
    if calc == "autocorrelation":
        k = p["lag"]
        if n <= k: return math.nan
        v = x.var()
        if np.isclose(0, v): return math.nan
        return np.sum((x[: n - k] - mean) * (x[k:] - mean)) / ((n - k) * v)
    if calc == "value_count": return float(np.sum(x == p["value"]))
    if calc == "range_count": return float(np.sum((x >= p["min"]) & (x < p["max"])))
    if calc == "count_above": return np.sum(x >= p["t"]) / n
    if calc == "count_below": return np.sum(x <= p["t"]) / n
    if calc == "number_crossing_m": return float(np.where(np.diff(x > p["m"]))[0].size)
    if calc == "first_location_of_maximum": return np.argmax(x) / n
    if calc == "last_location_of_maximum": return 1.0 - np.argmax(x[::-1]) / n
    if calc == "first_location_of_minimum": return np.argmin(x) / n
    if calc == "last_location_of_minimum": return 1.0 - np.argmin(x[::-1]) / n
    if calc == "has_duplicate_max": return float(np.sum(x == x.max()) >= 2)
    if calc == "has_duplicate_min": return float(np.sum(x == x.min()) >= 2)
    if calc == "linear_trend":
        if n < 2: return math.nan
        res = dict(zip(("slope", "intercept", "rvalue", "pvalue", "stderr"), A._linregress(np.arange(n), x)))
        return res[p["attr"]]
    raise KeyError(calc)


def _series(spark, value_type="decimal(18,2)", seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    start = dt.datetime(2024, 1, 1)
    for var, n in (("a", 60), ("b", 45)):
        hours = np.sort(rng.choice(np.arange(150), size=n, replace=False))  # gaps, incl. empty blocks
        vals = np.round(rng.normal(3, 2, n), 2)
        vals[rng.integers(0, n, 6)] = 0.0          # value_count / crossings
        vals[5] = vals[3]                           # duplicates
        for h, v in zip(hours, vals):
            rows.append((var, start + dt.timedelta(hours=int(h)), float(v)))
    df = spark.createDataFrame(rows, "variable string, datetime timestamp_ntz, value double")
    return df.withColumn("value", F.col("value").cast(value_type)), rows


@pytest.mark.parametrize("value_type,block", [("decimal(18,2)", 6 * 3600), ("double", 86_400), ("double", 10 ** 7)])
def test_native_features_match_truth(spark, value_type, block):
    df, rows = _series(spark, value_type)
    got = extract_features(df, NATIVE_SETTINGS, include_raw=False, block_seconds=block, prepared=True).toPandas()
    specs = feature_specs(NATIVE_SETTINGS)
    assert {s[0] for s in specs} <= NATIVE
    data = pd.DataFrame(rows, columns=["variable", "datetime", "value"]).sort_values(["variable", "datetime"])
    expected = {}
    for var, g in data.groupby("variable"):
        x_all = g["value"].to_numpy(dtype=float)
        for i, t in enumerate(g["datetime"]):
            x = x_all[: i + 1]
            for calc, p, suffix in specs:
                with np.errstate(all="ignore"):
                    expected[(var, pd.Timestamp(t), f"{var}__{suffix}")] = truth(calc, p, x)
    assert len(got) == len(expected)
    bad = []
    for r in got.itertuples(index=False):
        e = expected[(r.variable, pd.Timestamp(r.datetime), r.feature)]
        v = r.value
        if e is None or (isinstance(e, float) and math.isnan(e)):
            if not (v is None or (isinstance(v, float) and math.isnan(v))):
                bad.append((r.feature, v, e))
        elif v is None or not math.isclose(v, float(e), rel_tol=1e-7, abs_tol=1e-7):
            bad.append((r.variable, r.datetime, r.feature, v, e))
    assert not bad, bad[:10]


def test_moments_fixture(spark):
    df = spark.createDataFrame([("v", dt.datetime(2024, 1, 1, h), float(x)) for h, x in ((0, 1), (1, 5))],
                               "variable string, datetime timestamp_ntz, value double")
    out = {r.feature: r.value for r in extract_features(df, "minimal", prepared=True)
           .filter(F.col("datetime") == dt.datetime(2024, 1, 1, 1)).collect()}
    assert out["v__mean"] == 3 and out["v__median"] == 3 and out["v__variance"] == 4
    assert out["v__standard_deviation"] == 2 and math.isclose(out["v__root_mean_square"], math.sqrt(13))
    assert out["v__maximum"] == 5 and out["v__minimum"] == 1 and out["v__sum_values"] == 6
    assert out["v__length"] == 2 and out["v"] == 5


def test_array_features_use_whole_prefix(spark):
    df, rows = _series(spark, "double", seed=5)
    specs = [s for s in feature_specs("efficient") if s[0] in ("median", "quantile", "fft_coefficient",
                                                              "number_peaks", "binned_entropy",
                                                              "ratio_beyond_r_sigma", "count_above_mean")][:40]
    got = array_features(df, specs, block_seconds=20 * 3600).toPandas()
    data = pd.DataFrame(rows, columns=["variable", "datetime", "value"]).sort_values(["variable", "datetime"])
    exp = {}
    for var, g in data.groupby("variable"):
        x_all = g["value"].to_numpy(dtype=float)
        for i, t in enumerate(g["datetime"]):
            vals = A.window_values(x_all[: i + 1], specs)
            if specs[0][0] == "median":
                pass
            for (calc, p, suffix), v in zip(specs, vals):
                if calc == "median":
                    v = float(np.median(x_all[: i + 1]))
                if calc == "quantile":
                    v = float(np.quantile(x_all[: i + 1], p["q"]))
                exp[(var, pd.Timestamp(t), f"{var}__{suffix}")] = v
    assert len(got) == len(exp)
    for r in got.itertuples(index=False):
        e = exp[(r.variable, pd.Timestamp(r.datetime), r.feature)]
        if math.isnan(e):
            assert r.value is None or math.isnan(r.value)
        else:
            assert math.isclose(r.value, e, rel_tol=1e-12, abs_tol=1e-12), (r.feature, r.value, e)


def test_roll_lengths_and_ffill(spark):
    d = [dt.datetime(2024, 1, 1, h) for h in range(3)]
    s = spark.createDataFrame([("x", t, 1.0) for t in d], "variable string, datetime timestamp_ntz, value double")
    assert [r.length for r in roll_lengths(s).orderBy("end").collect()] == [1, 2, 3]
    assert [r.length for r in roll_lengths(s, max_timeshift=1).orderBy("end").collect()] == [1, 2, 2]
    ff = spark.createDataFrame([("A", d[0], 1.0), ("A", d[1], None), ("B", d[0], None), ("B", d[1], 4.0)],
                               "variable string, datetime timestamp_ntz, value double")
    out = prepare_series(ff, "ffill", block_seconds=3600).orderBy("variable", "datetime").collect()
    assert [(r.variable, r.value) for r in out] == [("A", 1.0), ("A", 1.0), ("B", 4.0)]


def test_tier_sizes():
    assert len(feature_specs("minimal")) == 10
    assert len(feature_specs("efficient")) == 777
    assert len(feature_specs("comprehensive")) == 783
    names = [s[2] for s in feature_specs("efficient")]
    assert 'fft_coefficient__attr_"real"__coeff_0' in names
    assert "symmetry_looking__r_0.15000000000000002" in names
    assert 'change_quantiles__f_agg_"mean"__isabs_False__qh_0.2__ql_0.0' in names
    assert len(set(names)) == len(names)


def test_array_calculators_known_values():
    x = np.array([1.0, 3.0, 2.0, 5.0, 4.0, 6.0, 0.0])
    assert A.f_fft_coefficient(x, {"coeff": 1, "attr": "abs"}) == pytest.approx(abs(np.fft.rfft(x)[1]))
    assert A.f_number_peaks(x, {"n": 1}) == 3  # 3, 5 and 6
    assert A.f_index_mass_quantile(x, {"q": 0.5}) == pytest.approx((np.argmax(np.cumsum(x) / x.sum() >= 0.5) + 1) / 7)
    assert A.f_ratio_beyond_r_sigma(x, {"r": 1}) == pytest.approx(np.mean(np.abs(x - x.mean()) > x.std()))
    assert A.f_energy_ratio_by_chunks(x, {"num_segments": 2, "segment_focus": 0}) == pytest.approx(
        (x[:4] ** 2).sum() / (x ** 2).sum())
    assert A.f_longest_strike_above_mean(x, {}) == 3  # 5, 4, 6 above the mean 3
    assert A.f_permutation_entropy(np.array([1.0, 2, 3, 4]), {"dimension": 3, "tau": 1}) == 0.0
    assert A.f_count_above_mean(x, {}) == 3
    # AR(1) with constant recovered exactly from a noiseless series
    y = [1.0]
    for _ in range(40):
        y.append(0.5 + 0.8 * y[-1] + 0.01 * math.sin(len(y)))
    coef = A.f_ar_coefficient(np.array(y), {"coeff": 1, "k": 1})
    assert coef == pytest.approx(0.8, abs=0.05)
    assert A.f_query_similarity_count(x, {}) is not None


@pytest.mark.parametrize("m,block_rows", [(3, 5), (7, 2)])
def test_bounded_windows_match_truth(spark, m, block_rows):
    df, rows = _series(spark, "double", seed=11)
    settings = {"mean": None, "variance": None, "median": None, "quantile": [{"q": 0.2}], "maximum": None,
                "autocorrelation": [{"lag": 1}], "number_peaks": [{"n": 1}], "length": None}
    got = extract_features(df, settings, prepared=True, max_timeshift=m, min_timeshift=2,
                           block_rows=block_rows, block_seconds=86_400).toPandas()
    data = pd.DataFrame(rows, columns=["variable", "datetime", "value"]).sort_values(["variable", "datetime"])
    specs = feature_specs(settings)
    exp = {}
    for var, g in data.groupby("variable"):
        xa = g["value"].to_numpy(dtype=float)
        for i, t in enumerate(g["datetime"]):
            if i < 2:
                continue
            w = xa[max(i - m, 0): i + 1]
            for calc, p, suffix in specs:
                if calc == "median":
                    v = float(np.median(w))
                elif calc == "quantile":
                    v = float(np.quantile(w, p["q"]))
                else:
                    v = A.CALCULATORS[calc](w, p or {})
                exp[(var, pd.Timestamp(t), f"{var}__{suffix}")] = v
            exp[(var, pd.Timestamp(t), var)] = w[-1]
    assert len(got) == len(exp)
    for r in got.itertuples(index=False):
        e = exp[(r.variable, pd.Timestamp(r.datetime), r.feature)]
        if math.isnan(e):
            assert r.value is None or math.isnan(r.value)
        else:
            assert math.isclose(r.value, e, rel_tol=1e-12, abs_tol=1e-12), (r.feature, r.value, e)


def test_min_timeshift_on_expanding(spark):
    df, rows = _series(spark, "double", seed=2)
    out = extract_features(df, {"mean": None}, prepared=True, min_timeshift=4)
    n_rows = len(rows) - 2 * 4
    assert out.count() == 2 * n_rows  # mean + raw value per kept window end


def test_empty_and_single_row_series(spark):
    schema = "variable string, datetime timestamp_ntz, value double"
    empty = spark.createDataFrame([], schema)
    assert extract_features(empty, "minimal").count() == 0
    one = spark.createDataFrame([("v", dt.datetime(2024, 1, 1), 4.0)], schema)
    out = {r.feature: r.value for r in extract_features(one, "minimal").collect()}
    assert len(out) == 11 and out["v__variance"] == 0.0 and out["v__median"] == 4.0 and out["v"] == 4.0
