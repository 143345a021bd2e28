"""Positions in any order, order statistics and counts beside moving thresholds."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsengine.functions import ordered
from tsengine.functions.arrays import CALCULATORS
from tsengine.operators.rank import number_rows, running_sum
from tsengine.plans.extract import extract_features

START = dt.datetime(2024, 1, 1)
SETTINGS = {"median": None, "quantile": [{"q": q} for q in (0.0, .1, .25, .5, .9, 1.0)],
            "count_above_mean": None, "count_below_mean": None, "ratio_beyond_r_sigma": [{"r": r} for r in (0.5, 1, 2.5)],
            "symmetry_looking": [{"r": r} for r in (0.0, 0.05, 0.3)]}


def series_of(spark, data, kind="decimal(18,2)"):
    rows = [(v, START + dt.timedelta(hours=i), x) for v, xs in data.items() for i, x in enumerate(xs)]
    random.Random(3).shuffle(rows)
    return spark.createDataFrame(rows, "variable string, datetime timestamp, value double").withColumn(
        "value", F.col("value").cast(kind))


def test_number_rows_and_running_sums_follow_the_order(spark):
    rnd = random.Random(1)
    rows = [("hot" if i % 3 else f"k{i % 7}", rnd.randrange(40), i, rnd.randrange(5)) for i in range(900)] + [(None, 1, 901, 2)]
    df = spark.createDataFrame(rows, "k string, x int, i int, w int").repartition(5)
    got = {r["i"]: r for r in number_rows(df, ["k"], ["x", "i"], "place", count="n").collect()}
    sums = {r["i"]: r["total"] for r in running_sum(df, ["k"], ["x", "i"], "w", "total").collect()}
    assert len(got) == len(sums) == len(rows)
    for key in {r[0] for r in rows} - {None}:
        mine, total = sorted((r for r in rows if r[0] == key), key=lambda r: (r[1], r[2])), 0
        for place, r in enumerate(mine):
            total += r[3]
            assert got[r[2]]["place"] == place and got[r[2]]["n"] == len(mine) and sums[r[2]] == total
    assert number_rows(df.where("false"), ["k"], ["x"]).collect() == []


@pytest.mark.parametrize("fan,block_rows", [(2, 5), (5, 64), (16, 4096)])
def test_windows_match_numpy_whatever_the_tree(spark, monkeypatch, fan, block_rows):
    monkeypatch.setattr(ordered, "FAN", fan)
    monkeypatch.setattr(ordered.ordered_features, "__defaults__",
                        (*ordered.ordered_features.__defaults__[:-1], block_rows))
    rnd = random.Random(2)
    data = {"walk": np.cumsum([rnd.choice([-1, 1, 0.5]) for _ in range(70)]).tolist(),
            "flat": [3.0] * 20, "one": [7.25], "ties": [rnd.choice([1.0, 2.0, -4.5]) for _ in range(40)]}
    got = {(r["variable"], r["datetime"], r["feature"]): r["value"]
           for r in extract_features(series_of(spark, data), SETTINGS, include_raw=False).collect()}
    specs = ordered_specs()
    assert len(got) == sum(map(len, data.values())) * len(specs)
    for v, xs in data.items():
        for i in range(len(xs)):
            window = np.array(xs[:i + 1])
            for calc, params, suffix in specs:
                value = got[v, START + dt.timedelta(hours=i), f"{v}__{suffix}"]
                assert value == pytest.approx(CALCULATORS[calc](window, params), abs=1e-9), (v, i, suffix)


def ordered_specs():
    from tsengine.functions.settings import feature_specs
    return feature_specs(SETTINGS)


def test_double_series_and_empty_input(spark):
    data = {"d": [0.1, -2.5, 1e9, 0.1, -0.0, 0.0]}
    rows = extract_features(series_of(spark, data, "double"), {"median": None}, include_raw=False).orderBy("datetime").collect()
    assert [r["value"] for r in rows] == [float(np.median(data["d"][:i + 1])) for i in range(6)]
    none = series_of(spark, data).where("false")
    assert extract_features(none, {"median": None, "count_above_mean": None}, include_raw=False).collect() == []


def test_plan_has_no_python_node(spark):
    feats = extract_features(series_of(spark, {"a": [1.0, 2.0, 3.0]}), "minimal")
    assert "Python" not in feats._jdf.queryExecution().toString() and "Pandas" not in feats._jdf.queryExecution().toString()


@pytest.mark.parametrize("block_seconds", [3 * 3600, 7 * 86_400])
def test_reoccurring_values_match_numpy(spark, block_seconds):
    rnd = random.Random(9)
    names = ["has_duplicate", "percentage_of_reoccurring_values_to_all_values",
             "percentage_of_reoccurring_datapoints_to_all_datapoints", "sum_of_reoccurring_values",
             "sum_of_reoccurring_data_points", "ratio_value_number_to_time_series_length"]
    data = {"t": [rnd.choice([1.5, 2.0, -3.25, 0.0]) for _ in range(30)], "same": [2.0] * 12, "new": [float(i) for i in range(9)]}
    got = extract_features(series_of(spark, data), {n: None for n in names}, include_raw=False, block_seconds=block_seconds)
    got = {(r["variable"], r["datetime"], r["feature"]): r["value"] for r in got.collect()}
    for v, xs in data.items():
        for i in range(len(xs)):
            for n in names:
                want = CALCULATORS[n](np.array(xs[:i + 1]), None)
                assert got[v, START + dt.timedelta(hours=i), f"{v}__{n}"] == pytest.approx(want), (v, i, n)


@pytest.mark.parametrize("kind", ["decimal(18,2)", "double"])
def test_prefix_lookups_match_numpy(spark, kind):
    rnd = random.Random(12)
    settings = {"energy_ratio_by_chunks": [{"num_segments": m, "segment_focus": i} for m in (3, 10) for i in range(m)],
                "index_mass_quantile": [{"q": q} for q in (.1, .25, .5, .9)]}
    data = {"w": [rnd.choice([-2.5, 0.0, 1.0, 4.0, 7.25]) for _ in range(37)], "zero": [0.0] * 12, "same": [1.0] * 23, "one": [-3.0]}
    got = extract_features(series_of(spark, data, kind), settings, include_raw=False)
    got = {(r["variable"], r["datetime"], r["feature"]): r["value"] for r in got.collect()}
    from tsengine.functions.settings import feature_specs
    for v, xs in data.items():
        for i in range(len(xs)):
            for calc, params, suffix in feature_specs(settings):
                want = CALCULATORS[calc](np.array(xs[:i + 1]), params)
                value = got[v, START + dt.timedelta(hours=i), f"{v}__{suffix}"]
                assert value is None if np.isnan(want) else value == pytest.approx(want), (v, i, suffix)
