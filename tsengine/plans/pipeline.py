"""End-to-end compositions.

The reference runs the same pipeline in three execution flavours; here they
are one code path whose semantic differences are parameters:

=================  ===================  ====================
aspect             batch-graph flavour  in-memory flavour
=================  ===================  ====================
nulls after roll   ``null_policy='drop'``  ``null_policy='ffill'``
log-return scale   ``percent=False``      ``percent=True``
kept extra columns none                 target, lr, vol, y_future
=================  ===================  ====================
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsengine.operators.align import align_long, pivot_features
from tsengine.operators.evaluate import regression_metrics
from tsengine.operators.impute import impute
from tsengine.operators.resample import resample_last
from tsengine.operators.search import assemble, fit_gbt, predict
from tsengine.operators.select import enough_features, select_features
from tsengine.operators.split import time_split
from tsengine.operators.target import add_target, target_rows
from tsengine.plans.extract import extract_features
from tsengine.session import materialize
from tsengine.sources.catalog import top_coin_ids
from tsengine.sources.market import DEFAULT_METRICS, bin_step_seconds, payload_to_ticks, read_market_chart, time_range


def market_series(ticks: DataFrame, coins: Sequence[str], timeframe: float = 1, periods: int = 1,
                  metrics: Sequence[str] = DEFAULT_METRICS, step_seconds: int | None = None) -> DataFrame:
    """Ticks of ranked coins -> long aligned series ``datetime, variable, value``.

    Bins are ``periods`` x 5 min for a range of at most one day, else
    ``periods`` hours (or ``step_seconds``); coins align on the first coin's bins.
    """
    step = step_seconds or bin_step_seconds(timeframe, periods)
    coins = list(coins)
    binned = resample_last(ticks.filter(F.col("coin").isin(coins)), step, values=list(metrics))
    return align_long(binned, coins, metrics)


def market_path(spark: SparkSession, landed: str, markets: DataFrame, n: int, as_of, timeframe: float,
                periods: int = 1, metrics: Sequence[str] = DEFAULT_METRICS) -> DataFrame:
    """Landed documents of the ``n`` top-ranked coins -> long aligned series of
    the last ``timeframe`` days, sorted by variable and time.

    The ranking is the coin universe, its first coin the base; files of other
    coins are not read when they lie in ``coin=<id>`` folders.
    """
    coins = top_coin_ids(markets, n)
    docs = read_market_chart(spark, landed, metrics, coins)
    ticks = time_range(payload_to_ticks(docs, metrics), as_of, timeframe)
    return market_series(ticks, coins, timeframe, periods, metrics).orderBy("variable", "datetime")


@dataclass
class SelectionResult:
    matrix: DataFrame            # imputed long matrix of the kept names (datetime, feature, value)
    targets: DataFrame           # datetime, target, lr, vol, y_future
    names: list[str]
    table: DataFrame             # relevance table
    enough: bool = field(default=False)


def select_stage(features: DataFrame, target: str, kind: str = "price", periods: int = 1,
                 percent: bool = False, level: float = 0.05, keep_targets: bool = True,
                 fit_until=None) -> SelectionResult:
    """Targets, imputation and FDR selection on long features."""
    features = materialize(features)
    targets = materialize(add_target(features, target, kind, periods, percent))
    extra = target_rows(targets, ("lr", "vol")) if keep_targets else None
    long = features.select("datetime", "feature", "value")
    if extra is not None:
        long = long.unionByName(extra)
    index = targets.select("datetime")
    names = sorted(r[0] for r in long.select("feature").distinct().collect())
    matrix = materialize(impute(long, index, names))
    always = [target, "lr", "vol"] if keep_targets else []
    kept, table = select_features(matrix, targets, level, always_keep=always, fit_until=fit_until)
    kept_matrix = matrix.filter(F.col("feature").isin(kept))
    return SelectionResult(kept_matrix, targets, kept, table, enough_features([*kept, "y_future"]))


def forecast(spark: SparkSession, features: DataFrame, target: str, kind: str = "price",
             periods: int = 1, percent: bool = False, level: float = 0.05,
             params: dict | None = None, max_iter: int = 100, test_fraction: float = 0.2, fit_until=None):
    """Select, split by time, fit a boosted-tree model, predict and score.

    ``fit_until`` keeps the selection from seeing rows from that time on.
    Returns ``(selection, predictions, metrics, model, feature_names)``.
    """
    sel = select_stage(features, target, kind, periods, percent, level, fit_until=fit_until)
    feats = [n for n in sel.names if n != "y_future"]
    wide = pivot_features(sel.matrix.withColumnRenamed("feature", "variable"), feats)
    wide = wide.join(sel.targets.select("datetime", "y_future"), "datetime")
    split = time_split(wide, "datetime", test_fraction)
    data = assemble(split, feats)
    model = fit_gbt(data.filter(F.col("split") == "train"), params or {}, max_iter=max_iter)
    pred = predict(model, data.filter(F.col("split") == "test"))
    metrics = regression_metrics(pred)
    return sel, pred, metrics, model, feats

