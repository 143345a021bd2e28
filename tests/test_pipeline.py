"""Targets, imputation, selection, splits, metrics, models, and the driver contract."""

import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tsengine.functions.stats import by_adjust, kendall_tau_b, ks_2samp, t_two_sided_p
from tsengine.operators.evaluate import regression_metrics
from tsengine.operators.impute import impute
from tsengine.operators.select import fdr_select, relevance_table
from tsengine.operators.split import time_folds, time_split
from tsengine.operators.target import add_target

D = [dt.datetime(2024, 1, 1) + dt.timedelta(hours=h) for h in range(20)]


def _feats(spark, rows):
    return spark.createDataFrame(rows, "variable string, datetime timestamp_ntz, feature string, value double")


def test_targets_fixture(spark):
    f = _feats(spark, [("p", D[i], "p", v) for i, v in enumerate([100.0, 110.0, 99.0])])
    price = add_target(f, "p", "price", drop_last=False).orderBy("datetime").collect()
    assert [r.y_future for r in price] == [110.0, 99.0, None]
    assert price[0].lr is None
    assert math.isclose(price[1].lr, math.log(1.1)) and math.isclose(price[2].lr, math.log(0.9))
    assert math.isclose(price[2].vol, abs(math.log(0.9)))
    lr = add_target(f, "p", "log_return").orderBy("datetime").collect()
    assert len(lr) == 2 and lr[0].y_future == pytest.approx(math.log(1.1))
    pct = add_target(f, "p", "log_return", percent=True, drop_last=False).orderBy("datetime").collect()
    assert pct[1].lr == pytest.approx(100 * math.log(1.1))
    zero = _feats(spark, [("p", D[0], "p", 0.0), ("p", D[1], "p", 5.0)])
    assert add_target(zero, "p", "price", drop_last=False).orderBy("datetime").collect()[1].lr is None
    with pytest.raises(ValueError):
        add_target(f, "prices ethereum")


def test_impute_fixture(spark):
    inf = float("inf")
    vals = [1.0, None, inf, 3.0, -inf]
    f = _feats(spark, [("v", D[i], "c", v) for i, v in enumerate(vals)] + [("v", D[0], "z", None)])
    index = spark.createDataFrame([(d,) for d in D[:5]], "datetime timestamp_ntz")
    out = impute(f, index, ["c", "z"]).orderBy("feature", "datetime").collect()
    assert [r.value for r in out if r.feature == "c"] == [1.0, 2.0, 3.0, 3.0, 1.0]
    assert [r.value for r in out if r.feature == "z"] == [0.0] * 5


def test_stats_fixtures():
    assert kendall_tau_b([1, 2, 3, 4], [1, 3, 2, 4])[0] == pytest.approx(2 / 3)
    assert kendall_tau_b([1, 2, 3, 4], [4, 3, 2, 1])[0] == pytest.approx(-1.0)
    assert list(by_adjust([0.001, 0.01, 0.04])) == pytest.approx([0.0055, 0.0275, 0.22 / 3])
    assert t_two_sided_p(2.0, 10) == pytest.approx(0.07338803, abs=1e-7)
    # exact KS p against enumeration of all splits
    import itertools
    a, b = [1, 2, 5], [3, 4, 6, 7]
    d, p = ks_2samp(a, b)
    vals = a + b
    hits = tot = 0
    for comb in itertools.combinations(range(7), 3):
        aa = [vals[i] for i in comb]
        bb = [vals[i] for i in range(7) if i not in comb]
        tot += 1
        hits += ks_2samp(aa, bb, method="asymptotic")[0] >= d - 1e-12
    assert p == pytest.approx(hits / tot)


def test_kendall_tie_variance_matches_permutations():
    # asymptotic variance of S with ties equals the exact permutation variance
    x = np.array([1, 1, 2, 3, 3, 3, 4.0])
    y = np.array([2, 1, 1, 3, 5, 4, 4.0])
    import itertools
    s_vals = []
    for perm in itertools.permutations(range(7)):
        yy = y[list(perm)]
        s = sum(np.sign(x[i] - x[j]) * np.sign(yy[i] - yy[j]) for i in range(7) for j in range(i + 1, 7))
        s_vals.append(s)
    var_exact = float(np.var(s_vals))
    n = 7
    m = n * (n - 1)
    from tsengine.functions.stats import _tie_stats
    xt, x0, x1 = _tie_stats(x)
    yt, y0, y1 = _tie_stats(y)
    var = (m * (2 * n + 5) - x1 - y1) / 18 + 2 * xt * yt / m + x0 * y0 / (9 * m * (n - 2))
    assert var == pytest.approx(var_exact)


def test_fdr_select_fixture(spark):
    t = spark.createDataFrame([("a", "real", 10, 0.1, 0.001), ("b", "real", 10, 0.1, 0.01),
                               ("c", "real", 10, 0.1, 0.04), ("k", "constant", 10, None, None)],
                              "feature string, type string, n bigint, stat double, p_value double")
    out = {r.feature: r for r in fdr_select(t, 0.05).collect()}
    assert [out[f].relevant for f in "abck"] == [True, True, False, False]
    assert out["c"].p_adj == pytest.approx(0.22 / 3)


def test_relevance_types(spark):
    rows, ys = [], []
    for i, d in enumerate(D):
        y = float(i)
        ys.append((d, y))
        rows += [(d, "real", float(i) + 0.5 * (i % 3)), (d, "bin", float(i % 2)), (d, "const", 7.0)]
    m = spark.createDataFrame(rows, "datetime timestamp_ntz, feature string, value double")
    tgt = spark.createDataFrame(ys, "datetime timestamp_ntz, y_future double")
    out = {r.feature: r for r in relevance_table(m, tgt).collect()}
    assert out["const"].type == "constant" and out["const"].p_value is None
    assert out["bin"].type == "binary" and 0 <= out["bin"].p_value <= 1
    assert out["real"].type == "real" and out["real"].stat > 0.9 and out["real"].p_value < 1e-4


def test_splits(spark):
    idx = lambda n: spark.createDataFrame([(d,) for d in D[:n]], "datetime timestamp_ntz")
    s = time_split(idx(11)).orderBy("datetime").collect()
    assert [r.split for r in s].count("test") == 2 and s[-1].split == "test" and s[-3].split == "train"
    with pytest.raises(ValueError):
        time_split(idx(4))
    f = time_folds(idx(12), n_splits=5).collect()
    starts = sorted({(r.fold, min(D.index(x.datetime) for x in f if x.fold == r.fold and x.role == "test"))
                     for r in f})
    assert [s for _, s in starts] == [2, 4, 6, 8, 10]
    f11 = time_folds(idx(11), n_splits=5).filter("role = 'test'").collect()
    assert sorted(D.index(r.datetime) for r in f11) == [6, 7, 8, 9, 10]


def test_metrics_fixture(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 2.0), (3.0, 4.0)], "actual double, predicted double")
    r = regression_metrics(df).first()
    assert r.r2 == pytest.approx(0.5) and r.mae == pytest.approx(1 / 3)
    assert r.mape == pytest.approx(1 / 9) and r.std == pytest.approx(1.0)


def test_driver_contract(spark):
    import __spark_entry__ as E
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 35
    out = E.entry(spark)
    assert out.columns == ["variable", "datetime", "feature", "value"]
    assert out.count() > 0


def test_end_to_end_forecast_and_searches(spark):
    from tsengine.operators.search import sampled_search
    from tsengine.plans.pipeline import forecast, market_series
    from tsengine.sources.tables import events_ticks
    sf = "/root/testdata/sf0.001"
    long = market_series(events_ticks(spark, sf), ["purchase", "view"], timeframe=30, periods=6)
    assert long.select("variable").distinct().count() == 6
    from tsengine.plans.extract import extract_features
    feats = extract_features(long, "minimal", null_policy="ffill")
    sel, pred, metrics, model, names = forecast(spark, feats, "prices view", kind="log_return",
                                                percent=True, level=0.5, max_iter=5)
    assert "prices view" in sel.names and "lr" in sel.names
    assert pred.count() >= 1 and set(pred.columns) == {"datetime", "actual", "predicted"}
    assert metrics.first().n == pred.count()
    from tsengine.operators.align import pivot_features
    wide = pivot_features(sel.matrix.withColumnRenamed("feature", "variable"), names)
    wide = wide.join(sel.targets.select("datetime", "y_future"), "datetime")
    trials, params, _ = sampled_search(spark, wide, names, n_trials=2, n_splits=2, max_iter=3, parallelism=2)
    assert trials.count() == 4 and {"learning_rate", "max_depth"} <= set(params)


def test_early_stopping_train_objective_and_sinks(spark, tmp_path):
    from tsengine.operators.evaluate import actual_vs_predicted
    from tsengine.operators.search import assemble, fit_gbt, sampled_search
    from tsengine.sources.sinks import write_stage
    rows = [(D[i % 20] + dt.timedelta(days=i // 20), float(i % 7), float(i % 5), float((i % 7) * 2 + i % 5))
            for i in range(60)]
    df = spark.createDataFrame(rows, "datetime timestamp_ntz, a double, b double, y_future double")
    model = fit_gbt(assemble(df, ["a", "b"]), {"max_depth": 3}, max_iter=10, validation_fraction=0.2)
    assert model.getNumTrees >= 1
    trials, _, _ = sampled_search(spark, df, ["a", "b"], n_trials=1, n_splits=2, max_iter=3,
                                  objective="train", parallelism=1)
    assert trials.count() == 2
    pred = model.transform(assemble(df, ["a", "b"]))
    both = actual_vs_predicted(df, pred)
    assert both.count() == 60 and set(both.columns) == {"datetime", "actual", "predicted"}
    out = str(tmp_path / "stage")
    write_stage(spark.createDataFrame([("x", 1.0)], "variable string, value double"), out)
    assert spark.read.parquet(out).count() == 1


@pytest.mark.parametrize("p, relevant", [([0.004] + [0.9] * 9, 0), ([0.013, 0.0131, 0.0132, 0.0133], 4),
                                         ([0.0001, 0.2, 0.3], 1)])
def test_fdr_is_step_up(spark, p, relevant):
    t = spark.createDataFrame([(f"f{i}", "real", 10, 0.1, x) for i, x in enumerate(p)],
                              "feature string, type string, n bigint, stat double, p_value double")
    out = fdr_select(t, 0.05).collect()
    m, cm = len(p), sum(1 / i for i in range(1, len(p) + 1))
    for r in out:
        want = min([1.0] + [x * m * cm / (k + 1) for k, x in enumerate(sorted(p)) if x >= r.p_value])
        assert r.p_adj == pytest.approx(want) and r.relevant == (r.p_adj <= 0.05)
    assert sum(r.relevant for r in out) == relevant


def test_search_rules(spark):
    from tsengine.operators.search import effective_params, evaluation, gbt_params, random_search, stop_round
    assert stop_round([5, 4, 3, 3.5, 3.2, 2], patience=2) == 3
    assert stop_round([5, 4, 3, 3.5, 3.2, 2], patience=25) == 6
    assert effective_params({"min_child_weight": 0.5, "max_depth": 3}) == {"min_child_weight": "1", "max_depth": "3"}
    for bad in ({"learning_rate": 0}, {"learning_rate": 1.5}, {"max_depth": 31}):
        with pytest.raises(ValueError):
            gbt_params(bad)
    pred = spark.createDataFrame([(2.0, 1.0), (0.0, 3.0), (4.0, 4.0)], "actual double, predicted double")
    assert evaluation(pred, "mae") == pytest.approx(4 / 3)
    assert evaluation(pred, "rmse") == pytest.approx((10 / 3) ** 0.5)
    assert evaluation(pred, "mape") == pytest.approx(0.25)
    with pytest.raises(ValueError):
        random_search(spark, pred, ["predicted"], eval_metric="auc")


def test_enough_features_counts_the_label():
    from tsengine.operators.select import enough_features
    assert not enough_features(["a", "b", "c", "d", "y_future"])
    assert enough_features(["a", "b", "c", "d", "e", "y_future"])


def _cells(spark, columns, y):
    """Long matrix and target of named columns."""
    start = dt.datetime(2024, 1, 1)
    rows = [(start + dt.timedelta(hours=i), name, float(x)) for name, xs in columns.items() for i, x in enumerate(xs)]
    ys = [(start + dt.timedelta(hours=i), float(v)) for i, v in enumerate(y)]
    return (spark.createDataFrame(rows, "datetime timestamp, feature string, value double").repartition(5),
            spark.createDataFrame(ys, "datetime timestamp, y_future double"))


@pytest.mark.parametrize("fan,block_rows", [(2, 7), (16, 4096)])
def test_relevance_by_blocked_counts_matches_the_whole_column(spark, monkeypatch, fan, block_rows):
    from tsengine.functions import ordered
    from tsengine.operators.select import relevance_table
    monkeypatch.setattr(ordered, "FAN", fan)
    rng = np.random.default_rng(8)
    n = 60
    y = rng.integers(0, 12, n) / 4
    columns = {"real": rng.normal(size=n), "ties": rng.integers(0, 4, n), "follows": y + rng.normal(size=n) / 9, "up": np.arange(n),
               "binary": rng.integers(0, 2, n) * 5 - 2, "binary_follows": (y > 1.4), "constant": np.full(n, 3.0)}
    got = {r["feature"]: r for r in relevance_table(*_cells(spark, columns, y), block_rows=block_rows).collect()}
    assert set(got) == set(columns) and all(r["n"] == n for r in got.values())
    assert got["constant"]["type"] == "constant" and got["constant"]["stat"] is None and got["constant"]["p_value"] is None
    for name in ("real", "ties", "follows", "up"):
        tau, p = kendall_tau_b(columns[name], y)
        assert got[name]["type"] == "real" and got[name]["stat"] == pytest.approx(tau) and got[name]["p_value"] == pytest.approx(p)
    for name in ("binary", "binary_follows"):
        x = np.asarray(columns[name], float)
        d, p = ks_2samp(y[x == x.min()], y[x == x.max()])
        assert got[name]["type"] == "binary" and got[name]["stat"] == pytest.approx(d) and got[name]["p_value"] == pytest.approx(p)


def test_relevance_without_pairs_and_ks_rule_by_parameter(spark):
    from tsengine.operators.select import relevance_table
    matrix, target = _cells(spark, {"a": [1, 2], "b": [0, 0]}, [1, 1])
    got = {r["feature"]: r for r in relevance_table(matrix, target).collect()}
    assert got["a"]["type"] == "binary" and got["a"]["stat"] == 0 and got["b"]["type"] == "constant"
    assert relevance_table(matrix.where("false"), target).collect() == []
    matrix, target = _cells(spark, {"a": [0, 0, 0, 1, 1, 1, 1]}, [1, 2, 3, 4, 5, 6, 7])
    exact, limit = (relevance_table(matrix, target, ks_method=m).first()["p_value"] for m in ("exact", "asymptotic"))
    assert exact == pytest.approx(2 / 35) and limit != pytest.approx(exact)


def test_report_says_whether_enough_is_left(spark):
    from tsengine.operators.select import with_enough
    def report(relevant, keep):
        rows = [(f"f{i}", i < relevant) for i in range(8)]
        out = with_enough(spark.createDataFrame(rows, "feature string, relevant boolean"), keep).collect()
        assert sum(r["kept"] for r in out) == len({f"f{i}" for i in range(relevant)} | (set(keep) & {r["feature"] for r in out}))
        return {r["enough"] for r in out}
    assert report(4, []) == {False} and report(5, []) == {True}          # with the label 5 and 6
    assert report(4, ["f1"]) == {False} and report(4, ["f7"]) == {True} and report(3, ["f7", "f6"]) == {True}
