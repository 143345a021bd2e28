"""Property tests: invariance to input order / partitioning, test-statistic identities."""

import datetime as dt

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tsengine.functions.stats import by_adjust, kendall_tau_b
from tsengine.operators.resample import resample_last
from tsengine.plans.extract import extract_features


def test_resample_and_features_ignore_row_order_and_partitions(spark):
    rng = np.random.default_rng(9)
    rows = [("a" if i % 3 else "b", dt.datetime(2024, 1, 1) + dt.timedelta(minutes=int(m)), i,
             float(np.round(rng.normal(10, 3), 2)))
            for i, m in enumerate(rng.choice(5000, 400, replace=False))]
    df = spark.createDataFrame(rows, "coin string, ts timestamp_ntz, seq bigint, prices double")
    base = resample_last(df, 900)
    shuffled = resample_last(df.orderBy(F.rand(3)).repartition(7), 900)
    assert sorted(map(tuple, base.collect())) == sorted(map(tuple, shuffled.collect()))
    long = base.select(F.col("coin").alias("variable"), F.col("bin").alias("datetime"), F.col("prices").alias("value"))
    f1 = extract_features(long, "minimal").collect()
    f2 = extract_features(long.orderBy(F.rand(5)).repartition(5), "minimal", block_seconds=3 * 3600).collect()
    a = {(r.variable, r.datetime, r.feature): r.value for r in f1}
    b = {(r.variable, r.datetime, r.feature): r.value for r in f2}
    assert a.keys() == b.keys()
    assert all((a[k] is None and b[k] is None) or abs(a[k] - b[k]) <= 1e-9 * max(1.0, abs(a[k])) for k in a)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(-1e3, 1e3, allow_nan=False), min_size=3, max_size=40, unique=True))
def test_tau_identities(xs):
    x = np.array(xs)
    assert abs(kendall_tau_b(x, x)[0] - 1.0) < 1e-12
    assert abs(kendall_tau_b(x, -x)[0] + 1.0) < 1e-12


@settings(max_examples=60, deadline=None)
@given(st.lists(st.floats(0, 1, allow_nan=False), min_size=1, max_size=50))
def test_by_adjusted_monotone_and_bounded(ps):
    p = np.array(ps)
    adj = by_adjust(p)
    assert np.all(adj >= p - 1e-15) and np.all(adj <= 1.0)
    order = np.argsort(p, kind="stable")
    assert np.all(np.diff(adj[order]) >= -1e-15)
    kept = [int(np.sum(adj <= lv)) for lv in (0.2, 0.1, 0.05, 0.01)]
    assert kept == sorted(kept, reverse=True)
