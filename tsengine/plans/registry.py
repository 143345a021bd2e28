"""Registered queries: one per operator family, each reading the driver tables.

Stand-in mapping (the tables hold no market data): coin = ``events.event_type``,
ticks = events (``tsengine.sources.tables.events_ticks``).  Aligned queries use
a fixed, user-chosen coin universe (``COINS``, base coin first), as a caller
of the reference passes a list of coin names; ranking is exercised by q03.
Every query takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the oracle SQL in ``tsengine.plans.oracle``.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsengine.functions.settings import COMPREHENSIVE, EFFICIENT
from tsengine.operators.align import align_long, melt_long, pivot_features, wide_join
from tsengine.operators.evaluate import actual_vs_predicted, importances, regression_metrics
from tsengine.operators.impute import impute
from tsengine.operators.resample import resample_last
from tsengine.operators.roll import prepare_series, roll_lengths, shift_rows
from tsengine.operators.search import assemble, fit_gbt, predict, random_search, sampled_search
from tsengine.operators.select import fdr_select, relevance_table, select_features, with_enough
from tsengine.operators.split import time_folds, time_split
from tsengine.operators.target import add_target
from tsengine.plans.extract import extract_features
from tsengine.plans.pipeline import market_path
from tsengine.session import checkpoint_dir, materialize
from tsengine.sources.catalog import lookup_ids, top_n
from tsengine.sources.market import (
    display_zone, payload_metrics, payload_to_ticks, read_documents, read_market_chart, ticks_to_payload, time_range,
)
from tsengine.sources.tables import (
    customer_markets, events_markets, events_ticks, table,
)

# Fixed query parameters.
METRICS = ("prices", "market_caps", "total_volumes")
COINS = ("purchase", "view", "click", "error", "signup")   # every event type; base coin first
HOUR = 3600
DAY = 86_400
ODD_STEP = 35 * 60          # does not divide a day: exercises the day anchor
AS_OF = dt.datetime(2024, 1, 20)
RANGE_DAYS = 7
TOP_COINS = 3
TARGET = "prices view"      # a suffixed (non-base) variable
TAIL_ROWS = 30
SPLITS = 5
FDR_LEVEL = 0.10
P_ROUND = 9                 # decimals kept for p-values
ROUND = 12                  # decimals kept for outputs of transcendental functions


def as_double(df: DataFrame) -> DataFrame:
    """Fixed-point output columns as DOUBLE (exact sums happen before; this only
    fixes the result type so every consumer sees plain floating-point values)."""
    from pyspark.sql.types import DecimalType
    return df.select(*[F.col(f"`{f.name}`").cast("double").alias(f.name) if isinstance(f.dataType, DecimalType)
                       else F.col(f"`{f.name}`") for f in df.schema.fields])


def coins(spark: SparkSession, sf: str) -> list[str]:
    return list(COINS)


def binned(spark: SparkSession, sf: str, step: int = HOUR, dense: bool = True) -> DataFrame:
    return resample_last(events_ticks(spark, sf), step, values=list(METRICS), dense=dense)


def aligned(spark: SparkSession, sf: str, step: int = HOUR) -> DataFrame:
    cs = coins(spark, sf)
    b = resample_last(events_ticks(spark, sf).filter(F.col("coin").isin(cs)), step, values=list(METRICS))
    return align_long(b, cs, METRICS)


def minimal_features(spark: SparkSession, sf: str, step: int = HOUR, keep: bool = False) -> DataFrame:
    feats = extract_features(aligned(spark, sf, step), "minimal", null_policy="drop")
    return materialize(feats) if keep else feats


# --- sources ---------------------------------------------------------------

def _q01_time_range_scan(spark, sf):
    return time_range(events_ticks(spark, sf), AS_OF, RANGE_DAYS)


def q02_market_chart_json(spark, sf):
    return payload_to_ticks(read_market_chart(spark, _landed(spark, sf)))


def q50_payload_metrics(spark, sf):
    """Every metric that landed documents hold, one of them ("spreads") declared nowhere."""
    ticks = events_ticks(spark, sf).withColumn("spreads", F.col("prices") - F.col("total_volumes"))
    return payload_metrics(read_documents(spark, _landed(spark, sf, ticks, (*METRICS, "spreads"))))


def _landed(spark, sf, ticks=None, metrics=METRICS):
    """The stand-in's files: one document per coin and day in the shared folder."""
    docs = ticks_to_payload(events_ticks(spark, sf) if ticks is None else ticks, metrics)
    landed = f"{checkpoint_dir(spark).rstrip('/')}/landed-{uuid.uuid4().hex}"
    (docs.select("coin", "payload").write.option("maxRecordsPerFile", 1).partitionBy("coin").text(landed))
    return landed


def q45_market_path(spark, sf):
    """Ranking, landed files, time range, bins, alignment on the top coin, long and sorted."""
    return market_path(spark, _landed(spark, sf), events_markets(spark, sf), TOP_COINS, AS_OF, RANGE_DAYS)


def q03_top_n(spark, sf):
    return top_n(customer_markets(spark, sf), 10)


def q04_id_lookup(spark, sf):
    cust = table(spark, sf, "customer")
    # request: every customer name (position = key order); ids from the customer list
    request = cust.select(F.col("c_custkey").alias("pos"), F.col("c_name").alias("name"))
    coin_list = cust.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_name").alias("name"))
    return lookup_ids(coin_list, request)


# --- resampling, alignment, reshaping ---------------------------------------

def _q05_resample_last(spark, sf):
    return binned(spark, sf, HOUR, dense=False)


def _q06_resample_dense_anchor(spark, sf):
    return binned(spark, sf, ODD_STEP, dense=True)


def _q07_wide_left_join(spark, sf):
    cs = coins(spark, sf)
    return wide_join(binned(spark, sf), cs, METRICS)


def _q08_unpivot(spark, sf):
    cs = coins(spark, sf)
    wide = wide_join(binned(spark, sf), cs, METRICS)
    return melt_long(wide, ["datetime"])


# --- rolling ---------------------------------------------------------------

def q09_roll_windows(spark, sf):
    series = prepare_series(aligned(spark, sf, DAY), "drop")
    return roll_lengths(series)


def _q10_ffill(spark, sf):
    return prepare_series(aligned(spark, sf), "ffill")


def q11_minimal_features(spark, sf):
    return minimal_features(spark, sf)


def _q12_drop_policy(spark, sf):
    return prepare_series(aligned(spark, sf), "drop")


def q13_pivot(spark, sf):
    feats = minimal_features(spark, sf, DAY)
    return pivot_features(feats.select("datetime", F.col("feature").alias("variable"), "value"))


def q14_window_last_union(spark, sf):
    return extract_features(aligned(spark, sf), {"mean": None}, null_policy="ffill")


# --- targets, imputation ------------------------------------------------------

def _target(spark, sf, kind):
    t = add_target(minimal_features(spark, sf, keep=True), TARGET, kind, periods=1)
    return t.select("datetime", "target", F.round("lr", ROUND).alias("lr"), F.round("vol", ROUND).alias("vol"),
                    F.round("y_future", ROUND).alias("y_future"))


def q15_target_price(spark, sf):
    return _target(spark, sf, "price")


def q16_target_log_return(spark, sf):
    return _target(spark, sf, "log_return")


def q17_target_volatility(spark, sf):
    return _target(spark, sf, "volatility")


def q52_target_percent_ahead(spark, sf):
    """Log returns in percent, three rows ahead."""
    t = add_target(minimal_features(spark, sf, keep=True), TARGET, "log_return", periods=3, percent=True)
    return t.select("datetime", "target", *[F.round(c, P_ROUND).alias(c) for c in ("lr", "vol", "y_future")])


def _matrix(spark, sf, step=HOUR):
    feats = minimal_features(spark, sf, step, keep=True)
    targets = materialize(add_target(feats, "prices", "price", periods=1))
    index = targets.select("datetime")
    names = sorted(r[0] for r in feats.select("feature").distinct().collect())
    return materialize(impute(feats.select("datetime", "feature", "value"), index, names)), targets


def q18_impute(spark, sf):
    return _matrix(spark, sf)[0]


def q51_impute_infinite(spark, sf):
    """Raw series with infinite, missing and undefined cells by the hour, imputed."""
    long = aligned(spark, sf).withColumn("feature", F.col("variable"))
    h = F.hour("datetime")
    x = F.col("value").cast("double")
    x = (F.when(h % 7 == 0, F.lit(float("inf"))).when(h % 7 == 1, F.lit(float("-inf")))
         .when(h % 7 == 2, F.lit(float("nan"))).when(h % 7 == 3, F.lit(None)).otherwise(x))
    long = materialize(long.select("datetime", "feature", x.alias("value")))
    names = sorted(r[0] for r in long.select("feature").distinct().collect())
    return impute(long, long.select("datetime").distinct(), names)


# --- selection ---------------------------------------------------------------

def _round_columns(df, *columns):
    return df.withColumns({c: F.round(c, P_ROUND) for c in columns})


def q20_relevance(spark, sf):
    m, targets = _matrix(spark, sf)
    return _round_columns(relevance_table(m, targets), "p_value")


def q22_fdr(spark, sf):
    m, targets = _matrix(spark, sf)
    out = fdr_select(relevance_table(m, targets), FDR_LEVEL)
    return _round_columns(out, "p_adj").select("feature", "rank", "p_adj", "relevant")


def q23_select(spark, sf):
    m, targets = _matrix(spark, sf)
    keep = ["prices"]
    _, table_ = select_features(m, targets, FDR_LEVEL, always_keep=keep)
    return _round_columns(with_enough(table_, keep), "stat", "p_value", "p_adj")


def q44_nan_as_null(spark, sf):
    """Forward fill of a DOUBLE series where every fifth hour of the day is NaN."""
    x = F.when(F.hour("datetime") % 5 == 0, float("nan")).otherwise(F.col("value").cast("double"))
    return prepare_series(aligned(spark, sf).withColumn("value", x), "ffill")


# --- splits, evaluation -------------------------------------------------------

def _index(spark, sf):
    return add_target(minimal_features(spark, sf, keep=True), TARGET, "price").select("datetime")


def q24_time_split(spark, sf):
    return time_split(_index(spark, sf))


def q25_folds(spark, sf):
    return time_folds(_index(spark, sf), n_splits=SPLITS)


def q26_metrics(spark, sf):
    series = materialize(prepare_series(aligned(spark, sf), "drop"))
    nxt = shift_rows(series, "datetime", ["value"], -1, keys=["variable"], suffix="_next")
    naive = nxt.select("variable", F.col("value_next").alias("actual"), F.col("value").alias("predicted")) \
        .filter(F.col("actual").isNotNull())
    m = regression_metrics(naive, by=["variable"])
    return m.select("variable", "n", F.round("r2", ROUND).alias("r2"), F.round("mae", ROUND).alias("mae"),
                    F.round("mape", ROUND).alias("mape"), F.round("std", ROUND).alias("std"),
                    F.round("mae_per_std", ROUND).alias("mae_per_std"))


def q46_actual_vs_predicted(spark, sf):
    """Next values of the target and the naive forecast of its last fifth, on one time axis."""
    series = prepare_series(aligned(spark, sf).filter(F.col("variable") == TARGET), "drop")
    nxt = materialize(shift_rows(series, "datetime", ["value"], -1, keys=["variable"], suffix="_next"))
    test = time_split(nxt.select("datetime", "value")).filter("split = 'test'")
    return as_double(actual_vs_predicted(nxt.filter(F.col("value_next").isNotNull()), test, "datetime",
                                         "value_next", "value"))


def q27_timezone(spark, sf):
    return binned(spark, sf, HOUR, dense=False).select("coin", "bin", display_zone("bin", "CET").alias("bin_cet"))


def q28_tail(spark, sf):
    t = _target(spark, sf, "price")
    return t.orderBy(F.col("datetime").desc()).limit(TAIL_ROWS)


# --- models (rows-only checks) -------------------------------------------------

def _model_data(spark, sf):
    m, targets = _matrix(spark, sf, DAY)
    names = sorted(r[0] for r in m.select("feature").distinct().collect())
    wide = pivot_features(m.withColumnRenamed("feature", "variable"), names)
    wide = wide.join(targets.select("datetime", "y_future"), "datetime")
    return wide, names


def q29_gbt_predict(spark, sf):
    wide, names = _model_data(spark, sf)
    split = assemble(time_split(wide), names)
    model = fit_gbt(split.filter("split = 'train'"), {"max_depth": 3, "learning_rate": 0.1}, max_iter=10)
    return predict(model, split.filter("split = 'test'"))


def q30_random_search(spark, sf):
    wide, names = _model_data(spark, sf)
    trials, _, _ = random_search(spark, wide, names, n_iter=2, n_splits=2, max_iter=5, parallelism=2)
    return trials


def q47_sampled_search(spark, sf):
    """Twelve draws from the whole space, eight of them proposed from finished trials."""
    wide, names = _model_data(spark, sf)
    trials, _, _ = sampled_search(spark, wide, names, n_trials=12, n_splits=2, max_iter=5, parallelism=8,
                                  eval_metric="mape", start=4, at_once=4)
    return trials


def q31_importances(spark, sf):
    wide, names = _model_data(spark, sf)
    model = fit_gbt(assemble(wide, names), {"max_depth": 3}, max_iter=5)
    return importances(spark, model, names)


# --- efficient-tier features ------------------------------------------------------

def _features(spark, sf, settings, step=HOUR):
    return extract_features(aligned(spark, sf, step), settings, null_policy="drop", include_raw=False)


CHANGE = {"abs_energy": None, "absolute_sum_of_changes": None, "mean_abs_change": None, "mean_change": None,
          "mean_second_derivative_central": None, "cid_ce": [{"normalize": True}, {"normalize": False}],
          "c3": [{"lag": k} for k in (1, 2, 3)],
          "time_reversal_asymmetry_statistic": [{"lag": k} for k in (1, 2, 3)],
          "number_crossing_m": [{"m": 0}, {"m": -1}, {"m": 1}]}
DISTRIBUTION = {"skewness": None, "kurtosis": None, "variation_coefficient": None,
                "variance_larger_than_standard_deviation": None,
                "large_standard_deviation": [{"r": r * 0.05} for r in range(1, 20)],
                "count_above": [{"t": 0}], "count_below": [{"t": 0}],
                "value_count": [{"value": v} for v in (0, 1, -1)],
                "range_count": [{"min": -1, "max": 1}, {"min": -1e12, "max": 0}, {"min": 0, "max": 1e12}]}
AUTOCORR = {"autocorrelation": [{"lag": k} for k in range(10)]}
TREND = {"linear_trend": [{"attr": a} for a in ("rvalue", "intercept", "slope", "stderr")]}
LOCATIONS = {"first_location_of_maximum": None, "last_location_of_maximum": None,
             "first_location_of_minimum": None, "last_location_of_minimum": None,
             "has_duplicate_max": None, "has_duplicate_min": None}
SPECTRAL = {k: v for k, v in EFFICIENT.items()
            if k in ("fft_coefficient", "fft_aggregated", "spkt_welch_density", "cwt_coefficients",
                     "number_cwt_peaks", "fourier_entropy", "agg_autocorrelation")}
ENTROPY = {k: v for k, v in COMPREHENSIVE.items()
           if k in ("binned_entropy", "permutation_entropy", "lempel_ziv_complexity", "sample_entropy",
                    "approximate_entropy", "benford_correlation")}
AR = {k: v for k, v in EFFICIENT.items()
      if k in ("partial_autocorrelation", "ar_coefficient", "agg_linear_trend", "augmented_dickey_fuller",
               "friedrich_coefficients", "max_langevin_fixed_point")}
ORDER = {k: v for k, v in EFFICIENT.items()
         if k in ("quantile", "symmetry_looking", "change_quantiles", "index_mass_quantile", "number_peaks",
                  "ratio_beyond_r_sigma", "count_above_mean", "count_below_mean", "longest_strike_above_mean",
                  "longest_strike_below_mean", "energy_ratio_by_chunks", "mean_n_absolute_max", "has_duplicate",
                  "percentage_of_reoccurring_values_to_all_values",
                  "percentage_of_reoccurring_datapoints_to_all_datapoints", "sum_of_reoccurring_values",
                  "sum_of_reoccurring_data_points", "ratio_value_number_to_time_series_length",
                  "linear_trend", "query_similarity_count")}


def _rounded(df):
    return df.select("variable", "datetime", "feature", F.round("value", 9).alias("value"))


def q32_change_features(spark, sf):
    return _features(spark, sf, CHANGE)


def q33_distribution_features(spark, sf):
    return _features(spark, sf, DISTRIBUTION)


def q34_autocorr(spark, sf):
    return _rounded(_features(spark, sf, AUTOCORR))


def q35_trend(spark, sf):
    return _rounded(_features(spark, sf, TREND))


def q36_spectral(spark, sf):
    return _features(spark, sf, SPECTRAL, DAY)


def q37_entropy(spark, sf):
    return _features(spark, sf, ENTROPY, DAY)


def q38_ar_pacf(spark, sf):
    return _features(spark, sf, AR, DAY)


def q39_locations(spark, sf):
    return _rounded(_features(spark, sf, LOCATIONS))


def q40_order_statistics(spark, sf):
    return _features(spark, sf, ORDER, DAY)


def q41_efficient_features(spark, sf):
    """The whole efficient tier (777 calculators per variable) on daily bins."""
    return extract_features(aligned(spark, sf, DAY), "efficient", null_policy="drop")


BOUNDED = {"sum_values": None, "mean": None, "maximum": None, "minimum": None, "length": None, "variance": None}
WINDOW_ROWS = 24


def q42_bounded_windows(spark, sf):
    """Sliding windows of the last 25 rows (``max_timeshift=24``) on halo blocks."""
    return extract_features(aligned(spark, sf), BOUNDED, null_policy="drop", max_timeshift=WINDOW_ROWS)


QUANTILES = {"median": None, "quantile": [{"q": q} for q in [.1, .2, .3, .4, .6, .7, .8, .9]]}


def q43_running_quantiles(spark, sf):
    """Running median and quantiles (descent of a tree of value ranks)."""
    return _rounded(_features(spark, sf, QUANTILES))


SHARES = {k: EFFICIENT[k] for k in ("count_above_mean", "count_below_mean", "ratio_beyond_r_sigma", "symmetry_looking")}


def q48_moving_thresholds(spark, sf):
    """Counts above and below the running mean, beyond r running deviations; mean beside median."""
    return _rounded(_features(spark, sf, SHARES))


REOCCURRING = {k: None for k in ("has_duplicate", "percentage_of_reoccurring_values_to_all_values",
                                 "percentage_of_reoccurring_datapoints_to_all_datapoints", "sum_of_reoccurring_values",
                                 "sum_of_reoccurring_data_points", "ratio_value_number_to_time_series_length")}


PREFIXES = {k: EFFICIENT[k] for k in ("energy_ratio_by_chunks", "index_mass_quantile")}


def q53_prefix_lookups(spark, sf):
    """Shares of energy by segment and places of mass quantiles, from stored prefix sums."""
    return _rounded(_features(spark, sf, PREFIXES))


def q49_reoccurring_values(spark, sf):
    """Distinct and repeated values of expanding windows."""
    return _rounded(_features(spark, sf, REOCCURRING))


def q01_time_range_scan(spark, sf):
    return as_double(_q01_time_range_scan(spark, sf))


def q05_resample_last(spark, sf):
    return as_double(_q05_resample_last(spark, sf))


def q06_resample_dense_anchor(spark, sf):
    return as_double(_q06_resample_dense_anchor(spark, sf))


def q07_wide_left_join(spark, sf):
    return as_double(_q07_wide_left_join(spark, sf))


def q08_unpivot(spark, sf):
    return as_double(_q08_unpivot(spark, sf))


def q10_ffill(spark, sf):
    return as_double(_q10_ffill(spark, sf))


def q12_drop_policy(spark, sf):
    return as_double(_q12_drop_policy(spark, sf))


QUERIES = {name: fn for name, fn in sorted(globals().items()) if name[:1] == "q" and name[1:3].isdigit()}
