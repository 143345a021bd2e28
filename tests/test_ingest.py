"""Sources, resampling, alignment, reshaping (hand-checkable fixtures)."""

import datetime as dt

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tsengine.operators.align import align_long, melt_long, pivot_features, variable_names, wide_join
from tsengine.operators.resample import resample_last
from tsengine.sources.catalog import lookup_ids, top_n
from tsengine.operators.roll import prepare_series
from tsengine.sources.market import (
    bin_step_seconds, parse_payload, payload_to_ticks, read_market_chart, ticks_to_payload, time_range,
)

T = dt.datetime


def ticks(spark, rows):
    return spark.createDataFrame(rows, "coin string, ts timestamp_ntz, seq bigint, prices double")


def test_bucket_anchor_gap_and_null(spark):
    rows = [("a", T(2024, 1, 1, 2, 0), 2, 3.0), ("a", T(2024, 1, 1, 0, 40), 0, 1.0),
            ("a", T(2024, 1, 1, 0, 41), 1, None)]
    out = resample_last(ticks(spark, rows), 35 * 60).orderBy("bin").collect()
    assert [(r.bin, r.prices) for r in out] == [
        (T(2024, 1, 1, 0, 35), 1.0), (T(2024, 1, 1, 1, 10), None), (T(2024, 1, 1, 1, 45), 3.0)]
    rows[2] = ("a", T(2024, 1, 1, 0, 41), 1, 2.0)
    first = resample_last(ticks(spark, rows), 35 * 60).orderBy("bin").first()
    assert first.prices == 2.0


def test_resample_matches_pandas(spark):
    idx = pd.date_range("2024-01-01 00:03", periods=50, freq="7min")
    vals = [float(i % 9) if i % 5 else None for i in range(50)]
    rows = [("a", t.to_pydatetime(), i, v) for i, (t, v) in enumerate(zip(idx, vals))]
    got = resample_last(ticks(spark, rows), 35 * 60).orderBy("bin").toPandas()
    exp = pd.Series(vals, index=idx).resample("35min").last()
    assert list(got["bin"]) == list(exp.index)
    assert [None if pd.isna(v) else v for v in got["prices"]] == [None if pd.isna(v) else v for v in exp]


def test_bin_rule():
    assert bin_step_seconds(1, 1) == 300
    assert bin_step_seconds(1, 3) == 900
    assert bin_step_seconds(30, 2) == 7200
    with pytest.raises(ValueError):
        bin_step_seconds(90, 1)


def test_positional_zip_raises_on_unequal_lengths(spark):
    doc = '{"prices": [[1000, 1.0], [2000, 2.0]], "market_caps": [[1000, 5.0]], "total_volumes": [[1000, 1], [2000, 2]]}'
    df = parse_payload(spark.createDataFrame([("btc", doc)], "coin string, payload string"), "payload")
    with pytest.raises(Exception):
        payload_to_ticks(df).collect()


def test_payload_roundtrip(spark):
    rows = [("btc", T(2024, 1, 1, 0, 0, 1), 0, 1.5, 10.0, 3.0), ("btc", T(2024, 1, 1, 0, 5), 1, 2.5, 11.0, 4.0)]
    t = spark.createDataFrame(rows, "coin string, ts timestamp_ntz, seq bigint, prices double, "
                                    "market_caps double, total_volumes double")
    back = payload_to_ticks(parse_payload(ticks_to_payload(t), "payload").drop("day")).orderBy("ts").collect()
    assert [(r.ts, r.prices, r.market_caps, r.total_volumes) for r in back] == [
        (T(2024, 1, 1, 0, 0, 1), 1.5, 10.0, 3.0), (T(2024, 1, 1, 0, 5), 2.5, 11.0, 4.0)]


def test_time_range(spark):
    rows = [("a", T(2024, 1, d), d, float(d)) for d in range(1, 11)]
    out = time_range(ticks(spark, rows), T(2024, 1, 8), 3).collect()
    assert sorted(r.seq for r in out) == [5, 6, 7, 8]


def _binned(spark, rows):
    return spark.createDataFrame(rows, "coin string, bin timestamp_ntz, p double")


def test_left_join_and_suffixes(spark):
    b = _binned(spark, [("btc", T(2024, 1, 1, h), float(h)) for h in (1, 2, 3)]
                + [("eth", T(2024, 1, 1, h), 10.0 * h) for h in (2, 3, 4)]
                + [("usdt", T(2024, 1, 1, h), 100.0 * h) for h in (1, 2, 3)])
    assert variable_names(["btc", "eth", "usdt"], ["p"]) == ["p", "p eth", "p usdt"]
    wide = wide_join(b, ["btc", "eth", "usdt"], ["p"]).orderBy("datetime").collect()
    assert [r.datetime.hour for r in wide] == [1, 2, 3]
    assert [r["p eth"] for r in wide] == [None, 20.0, 30.0]
    long = align_long(b, ["btc", "eth", "usdt"], ["p"])
    assert long.count() == 9 and long.filter(F.col("value").isNull()).count() == 1


def test_melt_keeps_nulls_and_pivot_roundtrip(spark):
    w = spark.createDataFrame([(T(2024, 1, 1), 1.0, None), (T(2024, 1, 2), 2.0, 5.0)],
                              "datetime timestamp_ntz, a double, b double")
    long = melt_long(w)
    assert long.count() == 4
    back = pivot_features(long).orderBy("datetime").collect()
    assert [(r.a, r.b) for r in back] == [(1.0, None), (2.0, 5.0)]


def test_top_n_and_lookup(spark):
    m = spark.createDataFrame([("x", 5.0), ("y", 9.0), ("z", 9.0), ("w", 1.0)], "id string, market_cap double")
    assert [(r.id, r.rank) for r in top_n(m, 3).orderBy("rank").collect()] == [("y", 1), ("z", 2), ("x", 3)]
    lst = spark.createDataFrame([("1", "Bitcoin"), ("2", "Ether")], "id string, name string")
    req = spark.createDataFrame([(0, "Ether"), (1, "Bitcoin"), (2, "Ether")], "pos int, name string")
    assert [r.id for r in lookup_ids(lst, req).collect()] == ["2", "1", "2"]
    with pytest.raises(KeyError):
        lookup_ids(lst, spark.createDataFrame([(0, "Doge")], "pos int, name string"))


@pytest.mark.parametrize("chunk", [1, 3, 1000])
def test_dense_grid_chunks_match_pandas(spark, chunk):
    idx = pd.date_range("2024-01-01 00:03", periods=40, freq="13min")
    rows = [("a", t.to_pydatetime(), i, float(i)) for i, t in enumerate(idx) if i % 4]
    got = resample_last(ticks(spark, rows), 600, grid_chunk=chunk).orderBy("bin").toPandas()
    s = pd.Series([r[3] for r in rows], index=[pd.Timestamp(r[1]) for r in rows]).resample("10min").last()
    assert list(got["bin"]) == list(s.index)
    assert [None if pd.isna(v) else v for v in got["prices"]] == [None if pd.isna(v) else v for v in s]


@pytest.mark.parametrize("block", [60, 3600, 86_400 * 30])
def test_positions_and_shifts_match_window_functions(spark, block):
    from pyspark.sql import Window

    from tsengine.operators.roll import shift_rows, with_positions
    rows = [(k, T(2024, 1, 1) + dt.timedelta(minutes=7 * i + 3 * (k == "b")), float(i))
            for k in ("a", "b") for i in range(50) if (i * 7) % 11]
    df = spark.createDataFrame(rows, "k string, t timestamp_ntz, v double")
    w = Window.partitionBy("k").orderBy("t")
    exp = df.select("k", "t", (F.row_number().over(w) - 1).alias("pos"),
                    F.lag("v", 2).over(w).alias("lag2"), F.lead("v", 1).over(w).alias("lead1"))
    got = with_positions(df, "t", ["k"], block)
    got = shift_rows(got, "t", ["v"], 2, ["k"], block_seconds=block).withColumnRenamed("v_lag2", "lag2")
    got = shift_rows(got, "t", ["v"], -1, ["k"], block_seconds=block).withColumnRenamed("v_lead1", "lead1")
    a = sorted(tuple(r) for r in got.select("k", "t", "pos", "lag2", "lead1").collect())
    b = sorted(tuple(r) for r in exp.collect())
    assert a == b


def test_display_zone_across_dst(spark):
    from tsengine.sources.market import display_zone
    utc = [T(2024, 3, 31, 0, 30), T(2024, 3, 31, 1, 30), T(2024, 10, 27, 0, 30), T(2024, 10, 27, 1, 30)]
    df = spark.createDataFrame([(t,) for t in utc], "bin timestamp_ntz")
    got = [r.cet for r in df.select(display_zone("bin").alias("cet")).orderBy("bin").collect()]
    # spring forward skips 02:00-03:00 local; in autumn 02:30 local occurs twice
    assert got == [T(2024, 3, 31, 1, 30), T(2024, 3, 31, 3, 30), T(2024, 10, 27, 2, 30), T(2024, 10, 27, 2, 30)]


def test_equal_timestamps_break_ties_by_seq(spark):
    t = T(2024, 1, 1, 0, 10)
    rows = [("a", t, 7, 1.0), ("a", t, 9, 2.0), ("a", t, 8, 3.0), ("a", T(2024, 1, 1, 0, 5), 10, None)]
    df = ticks(spark, rows)
    for shuffled in (df, df.orderBy(F.rand(1)).repartition(3)):
        out = resample_last(shuffled, 3600).collect()
        assert [(r.bin, r.prices) for r in out] == [(T(2024, 1, 1), 2.0)]


@pytest.mark.parametrize("doc", ['{"prices": [[1, 2.0]', '{"error": "no such coin"}', None])
def test_bad_documents_raise(spark, doc):
    good = '{"prices": [[0, 1.0]], "market_caps": [[0, 1.0]], "total_volumes": [[0, 1.0]]}'
    df = spark.createDataFrame([("a", good), ("b", doc)], "coin string, payload string")
    with pytest.raises(Exception, match="not a market-chart document"):
        payload_to_ticks(parse_payload(df, "payload")).collect()


def test_landed_files_round_trip(spark, tmp_path):
    rows = [("a", T(2024, 1, 1, h), h, float(h), 2.0, 3.0) for h in range(3)] + [("b", T(2024, 1, 2), 0, 7.0, 8.0, 9.0)]
    df = spark.createDataFrame(rows, "coin string, ts timestamp_ntz, seq bigint, prices double, market_caps double, total_volumes double")
    path = str(tmp_path / "landed")
    ticks_to_payload(df).select("coin", "payload").write.option("maxRecordsPerFile", 1).partitionBy("coin").text(path)
    assert sorted(payload_to_ticks(read_market_chart(spark, path)).collect()) == sorted(df.collect())


@pytest.mark.parametrize("policy, want", [("drop", [1.0, 3.0]), ("ffill", [1.0, 1.0, 3.0, 3.0])])
def test_nan_counts_as_null(spark, policy, want):
    rows = [("v", T(2024, 1, 1, h), x) for h, x in enumerate([1.0, float("nan"), 3.0, None])]
    df = spark.createDataFrame(rows, "variable string, datetime timestamp_ntz, value double")
    assert [r.value for r in prepare_series(df, policy).orderBy("datetime").collect()] == want


def test_null_sort_key_raises(spark):
    df = spark.createDataFrame([("v", T(2024, 1, 1), 1.0), ("v", None, 2.0)],
                               "variable string, datetime timestamp_ntz, value double")
    for policy in ("drop", "ffill"):
        with pytest.raises(Exception, match="NULL sort key"):
            prepare_series(df, policy).collect()


def _documents(spark, *docs):
    return spark.createDataFrame([(f"c{i}", d) for i, d in enumerate(docs)], "coin string, payload string")


def test_metrics_come_from_the_payload(spark):
    from tsengine.sources.market import payload_metrics
    doc = '{"prices": [[1000, 1.5], [2000, 2]], "novel_metric": [[1500, 7], [2500, null]], "other": [[0, 1], [0, 2]]}'
    got = payload_metrics(_documents(spark, doc, '{"prices": [[5000, 3]]}', '{"prices": []}')).collect()
    at = lambda s: T(1970, 1, 1, 0, 0, s)
    assert sorted((r.coin, r.metric, r.seq, r.ts, r.value) for r in got if r.metric != "novel_metric") == [
        ("c0", "other", 0, at(1), 1.0), ("c0", "other", 1, at(2), 2.0), ("c0", "prices", 0, at(1), 1.5),
        ("c0", "prices", 1, at(2), 2.0), ("c1", "prices", 0, at(5), 3.0)]
    assert {(r.seq, r.ts, r.value) for r in got if r.metric == "novel_metric"} == {(0, at(1), 7.0), (1, at(2), None)}
    assert payload_metrics(_documents(spark, doc).where("false")).collect() == []


@pytest.mark.parametrize("doc", [
    None, "", "not json", '{"error": "limit"}', '[[1, 2]]', '{"prices": [[1000, 1]], "m": []}', '{"prices": [[1000, 1]], "m": 5}',
    '{"market_caps": [[1000, 1]]}', '{"prices": null}'])
def test_documents_that_are_none_raise(spark, doc):
    from tsengine.sources.market import payload_metrics
    with pytest.raises(Exception, match="not a market-chart document|differ in length"):
        payload_metrics(_documents(spark, doc)).collect()


def test_medians_are_exact_without_a_buffer(spark):
    from tsengine.operators.impute import impute_stats
    inf = float("inf")
    data = {"odd": [3.0, 1.0, 2.0], "even": [4.0, 1.0, 2.0, 10.0], "ties": [5.0] * 7 + [1.0], "one": [-2.5],
            "odd_cells": [None, float("nan"), inf, -inf, 1.0, 4.0], "none": [None, inf]}
    rows = [(f, x) for f, xs in data.items() for x in xs]
    got = {r.feature: (r["median"], r["min"], r["max"]) for r in
           impute_stats(spark.createDataFrame(rows, "feature string, value double").repartition(6)).collect()}
    assert got == {"odd": (2.0, 1.0, 3.0), "even": (3.0, 1.0, 10.0), "ties": (5.0, 1.0, 5.0), "one": (-2.5, -2.5, -2.5),
                   "odd_cells": (2.5, 1.0, 4.0)}
