"""Feature extraction over expanding windows: long series in, long features out.

``extract_features`` returns ``variable, datetime, feature, value`` with one
row per window end and feature, plus (``include_raw``) the window's own last
value as a feature named exactly like the variable.  Data stays long; pivot
only what survives selection (``operators.align.pivot_features``).

Four engines share the work:

* running-sum features (``functions.native``): Spark window + aggregate
  expressions over time blocks, exact for fixed-point input;
* order statistics and counts beside moving thresholds (``functions.ordered``):
  questions that descend a tree of value ranks level by level, joins and
  windows over blocks only;
* lookups of stored prefix sums at computed positions (``functions.prefix``);
* array features (``functions.arrays``): ``applyInPandas`` on
  ``(variable, block)`` groups.  An expanding window needs every earlier
  value, so a block's group also receives the rows of earlier blocks of the
  same variable (its prefix).  Work is parallel over blocks; memory per group
  is the prefix of one series, which is the inherent size of the window.
"""

from __future__ import annotations

import bisect
import functools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsengine.functions.arrays import CALCULATORS, window_values
from tsengine.functions.native import DEFAULT_BLOCK_SECONDS, FRAMED, NATIVE, bounded_native, native_features
from tsengine.functions.ordered import ORDERED, ordered_features
from tsengine.functions.prefix import PREFIX, prefix_features
from tsengine.functions.settings import feature_specs
from tsengine.operators.roll import prepare_series, with_positions
from tsengine.session import materialize

_ORDER_STATS = ("median", "quantile")


def extract_features(long: DataFrame, settings="minimal", null_policy: str = "drop",
                     include_raw: bool = True, variable: str = "variable", order: str = "datetime",
                     value: str = "value", block_seconds: int = DEFAULT_BLOCK_SECONDS,
                     prepared: bool = False, max_timeshift: int | None = None, min_timeshift: int = 0,
                     block_rows: int = 4096, materialize_input: bool = True) -> DataFrame:
    """Features of every rolled window of every variable (long form).

    ``settings``: tier name (``minimal``, ``efficient``, ``comprehensive``), a
    complexity level (0, 1, 2) or a dict ``{calculator: [params...] | None}``.
    Windows are expanding by default; ``max_timeshift = m`` bounds them to the
    last ``m + 1`` rows, and windows with at most ``min_timeshift`` rows are
    not produced.

    The prepared series feeds several branches (block tables, running sums,
    array groups, raw values); with ``materialize_input`` it is written once to
    the shared checkpoint folder so the source scan, resampling and alignment
    run once instead of once per branch.
    """
    series = long.select(variable, order, value) if prepared else \
        prepare_series(long, null_policy, variable, order, value, block_seconds)
    if materialize_input:
        series = materialize(series)
    specs = feature_specs(settings)
    unknown = [s[0] for s in specs if s[0] not in CALCULATORS]
    if unknown:
        raise ValueError(f"unknown calculators: {sorted(set(unknown))}")
    if max_timeshift is not None:
        return bounded_features(series, specs, int(max_timeshift), int(min_timeshift), include_raw,
                                variable, order, value, block_seconds, block_rows)
    out = _expanding(series, specs, include_raw, variable, order, value, block_seconds)
    if min_timeshift > 0:
        ends = with_positions(series.select(variable, order), order, [variable], block_seconds, "_pos")
        ends = ends.filter(F.col("_pos") >= min_timeshift).select(variable, order)
        out = out.join(ends, [variable, order], "left_semi")
    return out


def _expanding(series, specs, include_raw, variable, order, value, block_seconds):
    parts = []
    native_specs = [s for s in specs if s[0] in NATIVE]
    if native_specs:
        nat = native_features(series, native_specs, variable, order, value, block_seconds)
        parts.append(nat)
    ordered_specs = [s for s in specs if s[0] in ORDERED]
    if ordered_specs:
        parts.append(ordered_features(series, ordered_specs, variable, order, value, block_seconds))
    prefix_specs = [s for s in specs if s[0] in PREFIX]
    if prefix_specs:
        parts.append(prefix_features(series, prefix_specs, variable, order, value, block_seconds))
    array_specs = [s for s in specs if s[0] not in NATIVE | ORDERED | PREFIX]
    if array_specs:
        parts.append(array_features(series, array_specs, variable, order, value, block_seconds))
    if include_raw:
        parts.append(series.select(variable, order, F.col(variable).alias("feature"),
                                   F.col(value).cast("double").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select(variable, F.col(order).alias(order), "feature", "value")


# ---------------------------------------------------------------------------
# array features
# ---------------------------------------------------------------------------

def array_features(series: DataFrame, specs: Sequence[tuple], variable: str = "variable",
                   order: str = "datetime", value: str = "value",
                   block_seconds: int = DEFAULT_BLOCK_SECONDS) -> DataFrame:
    """Array calculators for every window end, grouped by ``(variable, block)``."""
    specs = list(specs)
    span = int(block_seconds) * 1_000_000
    rows = series.select(F.col(variable).alias("v"), F.col(order).alias("t"),
                         F.col(value).cast("double").alias("x"))
    rows = rows.withColumn("b", F.floor(F.unix_micros(F.col("t").cast("timestamp")) / F.lit(span)))
    last = rows.groupBy("v").agg(F.max("b").alias("_last_b"))
    # every row is part of the windows of its own block and of all later blocks
    fan = rows.join(last, "v").select("v", "t", "x", "b",
                                      F.explode(F.sequence("b", "_last_b")).alias("g"))
    names = [s[2] for s in specs]
    order_type = series.schema[order].dataType.simpleString()
    schema = f"v string, t {order_type}, feature string, value double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("t", kind="stable")
        x = pdf["x"].to_numpy(dtype=float)
        own = (pdf["b"] == pdf["g"]).to_numpy()
        idx = np.nonzero(own)[0]
        if len(idx) == 0:
            return _empty(pdf)
        cols = _prefix_features(x, idx, specs)
        n = len(idx)
        return pd.DataFrame({
            "v": np.repeat(pdf["v"].iloc[0], n * len(specs)),
            "t": np.repeat(pdf["t"].to_numpy()[idx], len(specs)),
            "feature": np.tile(np.array(names, dtype=object), n),
            "value": np.asarray(cols, dtype=float).reshape(-1),
        })

    out = fan.groupBy("v", "g").applyInPandas(run, schema)
    return out.select(F.col("v").alias(variable), F.col("t").alias(order),
                      F.concat(F.col("v"), F.lit("__"), F.col("feature")).alias("feature"),
                      F.when(F.isnan("value"), None).otherwise(F.col("value")).alias("value"))


def bounded_features(series: DataFrame, specs: Sequence[tuple], max_timeshift: int, min_timeshift: int = 0,
                     include_raw: bool = True, variable: str = "variable", order: str = "datetime",
                     value: str = "value", block_seconds: int = DEFAULT_BLOCK_SECONDS,
                     block_rows: int = 4096) -> DataFrame:
    """Every calculator over windows of the last ``max_timeshift + 1`` rows.

    Rows are numbered per variable (blocked positions, no single-task window),
    cut into blocks of ``block_rows`` positions, and each block's group also
    receives the ``max_timeshift`` rows before it (a halo).  A group therefore
    holds at most ``block_rows + max_timeshift`` rows, however long or skewed
    the series is.  Running-sum calculators are window frames over the blocks;
    the others are array calculators.
    """
    m, B = max_timeshift, int(block_rows)
    if m < 0 or B < 1:
        raise ValueError("max_timeshift must be >= 0 and block_rows >= 1")
    rows = series.select(F.col(variable).alias("_v"), F.col(order).alias("_t"), F.col(value).alias("_x"))
    rows = with_positions(rows, "_t", ["_v"], block_seconds, "_pos")
    parts = []
    framed = [s for s in specs if s[0] in FRAMED]
    if framed:
        parts.append(bounded_native(rows, framed, series.schema[value].dataType, m, min_timeshift, B, variable, order))
    specs = [s for s in specs if s[0] not in FRAMED]
    if specs:
        parts.append(_bounded_arrays(rows, specs, m, min_timeshift, B, variable, order))
    if include_raw:
        parts.append(rows.filter(F.col("_pos") >= min_timeshift).select(
            F.col("_v").alias(variable), F.col("_t").alias(order), F.col("_v").alias("feature"),
            F.col("_x").cast("double").alias("value")))
    return functools.reduce(DataFrame.unionByName, parts)


def _bounded_arrays(rows: DataFrame, specs: list[tuple], m: int, min_timeshift: int, B: int, variable: str,
                    order: str) -> DataFrame:
    """Array calculators over bounded windows, one group per halo block."""
    rows = rows.select(F.col("_v").alias("v"), F.col("_t").alias("t"), F.col("_x").cast("double").alias("x"),
                       F.col("_pos").alias("pos"))
    first_g = F.floor(F.col("pos") / B)
    last_g = F.floor((F.col("pos") + m) / B)
    fan = rows.select("v", "t", "x", "pos", F.explode(F.sequence(first_g, last_g)).alias("g"))
    names = [sp[2] for sp in specs]
    schema = f"v string, t {rows.schema['t'].dataType.simpleString()}, feature string, value double"

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos", kind="stable")
        x = pdf["x"].to_numpy(dtype=float)
        pos = pdf["pos"].to_numpy()
        g = int(pdf["g"].iloc[0])
        own = np.nonzero((pos // B == g) & (pos >= min_timeshift))[0]
        if len(own) == 0:
            return _empty(pdf)
        vals = _sliding_features(x, own, m, specs)
        var = pdf["v"].iloc[0]
        feats = np.array([f"{var}__{n}" for n in names], dtype=object)
        return pd.DataFrame({
            "v": np.repeat(var, len(own) * len(names)),
            "t": np.repeat(pdf["t"].to_numpy()[own], len(names)),
            "feature": np.tile(feats, len(own)),
            "value": np.asarray(vals, dtype=float).reshape(-1),
        })

    out = fan.groupBy("v", "g").applyInPandas(run, schema)
    return out.select(F.col("v").alias(variable), F.col("t").alias(order), "feature",
                      F.when(F.isnan("value"), None).otherwise(F.col("value")).alias("value"))


def _empty(pdf: pd.DataFrame) -> pd.DataFrame:
    """A typed empty result (keeps the timestamp dtype of ``t``)."""
    out = pdf.iloc[0:0][["v", "t"]].copy()
    out["feature"] = pd.Series(dtype=object)
    out["value"] = pd.Series(dtype=float)
    return out


def _sliding_features(x: np.ndarray, ends: np.ndarray, m: int, specs) -> list[list[float]]:
    """Feature values of ``x[max(e - m, 0): e + 1]`` for each end index ``e``.

    Order statistics keep a sorted copy of the current window, updated by one
    insertion and at most one removal per step.
    """
    order_specs = [i for i, s in enumerate(specs) if s[0] in _ORDER_STATS]
    other = [i for i, s in enumerate(specs) if s[0] not in _ORDER_STATS]
    other_specs = [specs[i] for i in other]
    lo = max(int(ends[0]) - m, 0)
    hi = int(ends[0])            # window is x[lo:hi+1]; srt holds x[lo:hi]
    srt = sorted(x[lo:hi].tolist())
    rows = []
    for e in ends:
        e = int(e)
        while hi <= e:
            bisect.insort(srt, x[hi])
            hi += 1
        while lo < e - m:
            del srt[bisect.bisect_left(srt, x[lo])]
            lo += 1
        vals = [math.nan] * len(specs)
        for i in order_specs:
            calc, params, _ = specs[i]
            vals[i] = _sorted_median(srt) if calc == "median" else _sorted_quantile(srt, params["q"])
        if other_specs:
            for i, v in zip(other, window_values(x[lo:e + 1], other_specs)):
                vals[i] = v
        rows.append(vals)
    return rows


def _prefix_features(x: np.ndarray, ends: np.ndarray, specs) -> list[list[float]]:
    """Feature values of ``x[:e+1]`` for each end index ``e``.

    Order statistics keep a sorted list updated one value at a time (an
    insertion per window instead of a sort); other calculators see the slice.
    """
    order_specs = [i for i, s in enumerate(specs) if s[0] in _ORDER_STATS]
    other = [i for i, s in enumerate(specs) if s[0] not in _ORDER_STATS]
    other_specs = [specs[i] for i in other]
    srt = sorted(x[:ends[0]].tolist())
    upto = ends[0]
    rows = []
    for e in ends:
        while upto <= e:
            bisect.insort(srt, x[upto])
            upto += 1
        vals = [math.nan] * len(specs)
        for i in order_specs:
            calc, params, _ = specs[i]
            vals[i] = _sorted_median(srt) if calc == "median" else _sorted_quantile(srt, params["q"])
        if other_specs:
            for i, v in zip(other, window_values(x[:e + 1], other_specs)):
                vals[i] = v
        rows.append(vals)
    return rows


def _sorted_median(srt: list) -> float:
    """Median of a sorted list: the middle value, or the mean of the middle pair."""
    n = len(srt)
    if n == 0:
        return math.nan
    k = n // 2
    return float(srt[k]) if n % 2 else (srt[k - 1] + srt[k]) / 2.0


def _sorted_quantile(srt: list, q: float) -> float:
    """Linear-interpolation quantile of a sorted list (numpy's default rule,
    including its two-sided interpolation formula)."""
    n = len(srt)
    if n == 0:
        return math.nan
    pos = (n - 1) * q
    lo = int(math.floor(pos))
    hi = min(lo + 1, n - 1)
    t = pos - lo
    a, b = srt[lo], srt[hi]
    diff = b - a
    return b - diff * (1 - t) if t >= 0.5 else a + diff * t
