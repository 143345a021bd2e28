"""Bounded windows by frames, and degree 3 and 4 sums beyond 38 digits."""

import datetime as dt
import math
from decimal import Decimal

import numpy as np
import pytest

from tsengine.functions.arrays import window_values
from tsengine.functions.native import NATIVE
from tsengine.functions.settings import feature_specs
from tsengine.plans.extract import extract_features

T0 = dt.datetime(2024, 1, 1)


def _series(spark, values, kind):
    rows = [("a", T0 + dt.timedelta(hours=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"variable string, datetime timestamp, value {kind}")


def _native_settings():
    grid = {}
    for calc, params, _ in feature_specs("efficient"):
        if calc in NATIVE:
            grid.setdefault(calc, []).append(params)
    return {c: (p if p[0] else None) for c, p in grid.items()}


@pytest.mark.parametrize("shift", [0, 11])
def test_framed_windows_equal_array_calculators(spark, shift):
    values = [Decimal(v) for v in ("3.5 1 4 1 -5.25 9 2 6 5 3 5 8 9 7 9 3 2 -3 8 4").split()]
    specs = [s for s in feature_specs(_native_settings()) if s[0] in NATIVE]
    out = extract_features(_series(spark, values, "decimal(18,2)"), _native_settings(), include_raw=False,
                           max_timeshift=shift, block_rows=6, block_seconds=5 * 3600)
    got = {(r["datetime"], r["feature"]): r["value"] for r in out.collect()}
    x = np.array([float(v) for v in values])
    assert len(got) == len(values) * len(specs)
    for e in range(len(x)):
        want = window_values(x[max(e - shift, 0):e + 1], specs)
        for (_, _, name), w in zip(specs, want):
            g = got[(T0 + dt.timedelta(hours=e), f"a__{name}")]
            if w is None or (isinstance(w, float) and math.isnan(w)):
                assert g is None or math.isnan(g), (e, name, g)
            else:
                assert g == pytest.approx(w, rel=1e-7, abs=1e-7), (e, name)


def test_large_fixed_point_values_keep_moments(spark):
    values = [Decimal(v) for v in ("2000000000000.25 2000300000000 1999000000000.5 2100000000000 1500000000000 "
                                   "1900000000000 2300000000000").split()]
    settings = {"skewness": None, "kurtosis": None, "c3": [{"lag": 1}],
                "time_reversal_asymmetry_statistic": [{"lag": 1}]}
    specs = feature_specs(settings)
    x = np.array([float(v) for v in values])
    for options in ({}, {"max_timeshift": 20}, {"block_seconds": 3 * 3600}):
        out = extract_features(_series(spark, values, "decimal(18,2)"), settings, include_raw=False, **options)
        got = {(r["datetime"], r["feature"]): r["value"] for r in out.collect()}
        for e in (4, 5, 6):
            for (_, _, name), w in zip(specs, window_values(x[:e + 1], specs)):
                assert got[(T0 + dt.timedelta(hours=e), f"a__{name}")] == pytest.approx(w, rel=1e-6), (options, e, name)
