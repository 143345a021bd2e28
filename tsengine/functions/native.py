"""Features computed with Spark expressions over expanding windows.

Every feature here is a function of a few *running sums* of per-row terms
(powers, lag products, indicators) plus running min / max and the first few
values of the series.  Sums decompose over time blocks, so a series is cut
into blocks of ``block_seconds``:

1. rows are partitioned by ``(variable, block)`` - a hot series spreads over
   as many tasks as it has blocks; in-block row numbers and lags come from
   one window sort;
2. a block table (one row per series and block, plus at most ``K`` edge
   values) gives each block the rows counted before it and the last ``K``
   values before it (to finish lags that cross the block start);
3. per-row terms get in-block running sums; block totals are summed into an
   exclusive prefix over the small block table and added back.

The rows are shuffled by ``(variable, block)`` (step 1); every join afterwards
is with a block table that is smaller than the data by the block length.

Fixed-point (DECIMAL) input is summed on unscaled integers in
``DECIMAL(38,0)``, so sums are exact and independent of summation order;
double input is summed in double.  Terms of degree 3 and 4 are also summed in
double: a window whose exact sum leaves 38 digits takes that sum.  A sum of
squares beyond 38 digits raises.

Bounded windows (``bounded_native``) take the same terms and formulas over
frames of ``max_timeshift`` preceding rows on halo blocks.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Calculators this module computes.
NATIVE = frozenset({
    "sum_values", "mean", "length", "standard_deviation", "variance", "root_mean_square",
    "maximum", "absolute_maximum", "minimum", "abs_energy", "absolute_sum_of_changes",
    "mean_abs_change", "mean_change", "mean_second_derivative_central", "variation_coefficient",
    "variance_larger_than_standard_deviation", "skewness", "kurtosis", "large_standard_deviation",
    "cid_ce", "c3", "time_reversal_asymmetry_statistic", "autocorrelation", "value_count",
    "range_count", "count_above", "count_below", "number_crossing_m",
    "first_location_of_maximum", "last_location_of_maximum",
    "first_location_of_minimum", "last_location_of_minimum",
    "has_duplicate_max", "has_duplicate_min", "linear_trend",
    "has_duplicate", "percentage_of_reoccurring_values_to_all_values",
    "percentage_of_reoccurring_datapoints_to_all_datapoints", "sum_of_reoccurring_values",
    "sum_of_reoccurring_data_points", "ratio_value_number_to_time_series_length",
})

# Of these, the ones that count occurrences of values: running sums over an
# expanding window (where an occurrence, once there, stays), but not over a frame.
OCCURRENCE = frozenset({
    "has_duplicate", "percentage_of_reoccurring_values_to_all_values",
    "percentage_of_reoccurring_datapoints_to_all_datapoints", "sum_of_reoccurring_values",
    "sum_of_reoccurring_data_points", "ratio_value_number_to_time_series_length",
})
FRAMED = NATIVE - OCCURRENCE

DEFAULT_BLOCK_SECONDS = 7 * 86_400
_ISCLOSE_ATOL = 1e-8  # absolute tolerance under which a variance counts as zero


@F.pandas_udf(T.DoubleType())
def _t_pvalue(t: pd.Series, df: pd.Series, p: pd.Series) -> pd.Series:
    """Two-sided Student-t p-value of the trend t statistic (fixed ``p`` wins)."""
    from tsengine.functions.stats import t_two_sided_p
    out = t_two_sided_p(t.to_numpy(dtype=float, na_value=np.nan), df.to_numpy(dtype=float, na_value=np.nan))
    fixed = p.to_numpy(dtype=float, na_value=np.nan)
    return pd.Series(np.where(np.isnan(fixed), out, fixed))


def lags_needed(specs: Sequence[tuple]) -> int:
    k = 0
    for calc, params, _ in specs:
        if calc in ("absolute_sum_of_changes", "mean_abs_change", "cid_ce", "number_crossing_m"):
            k = max(k, 1)
        elif calc == "mean_second_derivative_central":
            k = max(k, 2)
        elif calc in ("c3", "time_reversal_asymmetry_statistic"):
            k = max(k, 2 * params["lag"])
        elif calc == "autocorrelation":
            k = max(k, params["lag"])
    return k


def _dbl(c: Column) -> Column:
    return c.cast("double")


class _Terms:
    """Per-row polynomial terms in an exact integer domain (decimal) or double."""

    def __init__(self, value_type: T.DataType):
        self.exact = isinstance(value_type, T.DecimalType)
        self.scale = value_type.scale if self.exact else 0
        self.num_type = "decimal(38,0)" if self.exact else "double"

    def unit(self, c: Column) -> Column:
        """The value in the summation domain (unscaled integer for decimals)."""
        if self.exact:
            return (c * F.lit(10 ** self.scale)).cast(self.num_type)
        return c.cast("double")

    def mul(self, *cs: Column) -> Column:
        out = cs[0]
        for c in cs[1:]:
            out = (out * c).cast(self.num_type) if self.exact else out * c
        return out

    def try_mul(self, *cs: Column) -> Column:
        """A product that is NULL where it leaves the summation domain."""
        out = cs[0]
        for c in cs[1:]:
            out = F.try_multiply(out, c)
        return out

    def to_double(self, c: Column, degree: int) -> Column:
        """A sum of degree-``degree`` terms back in value units, as double."""
        if self.exact and self.scale and degree:
            return _dbl(c) / F.lit(float(10 ** (self.scale * degree)))
        return _dbl(c)


def native_features(series: DataFrame, specs: Sequence[tuple], variable: str = "variable",
                    order: str = "bin", value: str = "value",
                    block_seconds: int = DEFAULT_BLOCK_SECONDS) -> DataFrame:
    """Long features ``variable, bin, feature, value`` for every window end.

    ``series`` holds one row per ``(variable, bin)`` with a non-null value;
    the window ending at a row holds all rows of its variable up to it.
    Only specs whose calculator is in :data:`NATIVE` are computed.
    """
    specs = [s for s in specs if s[0] in NATIVE]
    if not specs:
        return series.sparkSession.createDataFrame(
            [], f"{variable} string, {order} {series.schema[order].dataType.simpleString()}, "
                "feature string, value double")
    terms = _Terms(series.schema[value].dataType)
    K = max(lags_needed(specs), 2)
    span = int(block_seconds) * 1_000_000

    rows = series.select(F.col(variable).alias("_v"), F.col(order).alias("_t"),
                         F.col(value).alias("_x"))
    rows = rows.withColumn("_b", F.floor(F.unix_micros(F.col("_t").cast("timestamp")) / F.lit(span)))
    w_in = Window.partitionBy("_v", "_b").orderBy("_t")
    w_blk = Window.partitionBy("_v", "_b")
    rows = rows.select("*", (F.row_number().over(w_in) - 1).alias("_i"),
                       F.count(F.lit(1)).over(w_blk).alias("_n_blk"),
                       *[F.lag("_x", k).over(w_in).alias(f"_lag{k}") for k in range(1, K + 1)])

    # ---- block table 1: counts and edge values ------------------------------
    edge = F.struct("_i", "_x")
    blocks = rows.groupBy("_v", "_b").agg(
        F.count(F.lit(1)).alias("_cnt"),
        F.array_sort(F.collect_list(F.when(F.col("_i") >= F.col("_n_blk") - K, edge))).alias("_tail"),
        F.array_sort(F.collect_list(F.when(F.col("_i") < K, edge))).alias("_head"),
    )
    wb = Window.partitionBy("_v").orderBy("_b")
    prev_tails = F.flatten(F.collect_list(F.transform("_tail", lambda s: s["_x"])).over(
        wb.rowsBetween(-K, -1)))
    blocks = blocks.select(
        "_v", "_b", "_cnt", "_head",
        F.coalesce(F.sum("_cnt").over(wb.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        prev_tails.alias("_prev"))
    blocks = blocks.withColumn("_prev", F.slice("_prev", F.greatest(F.size("_prev") - K + 1, F.lit(1)), K))
    # First K values of each series: only blocks starting before position K matter.
    heads = (blocks.filter(F.col("_before") < K).groupBy("_v")
             .agg(F.array_sort(F.collect_list(F.struct("_b", "_head"))).alias("_hs"))
             .select("_v", F.slice(F.flatten(F.transform("_hs", lambda s: F.transform(s["_head"], lambda e: e["_x"]))),
                                   1, K).alias("_series_head")))
    blocks = blocks.join(heads, "_v", "left").drop("_head")

    rows = rows.join(blocks, ["_v", "_b"])
    # finish lags that reach into earlier blocks
    rows = rows.selectExpr(
        "_v", "_b", "_t", "_i", "_x", "_series_head", "_before + _i as _pos",
        *[f"coalesce(_lag{k}, case when _i < {k} and size(_prev) - {k} + _i >= 0 "
          f"then element_at(_prev, cast(size(_prev) - {k} + _i + 1 as int)) end) as _lag{k}" for k in range(1, K + 1)])

    plan = _Plan(specs, terms, K)
    if plan.calcs & OCCURRENCE:
        rows = _with_occurrence(rows)
    row_terms = plan.row_terms()
    rows = rows.select("_v", "_b", "_t", "_pos", "_x", "_series_head",
                       *[F.col(f"_lag{k}") for k in range(1, K + 1)],
                       *[c.alias(n) for n, c in row_terms.items()])

    sums = list(row_terms)
    sums = [n for n in sums if n not in ("xmin", "xmax")]
    run = Window.partitionBy("_v", "_b").orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)
    run_excl = Window.partitionBy("_v", "_b").orderBy("_t").rowsBetween(Window.unboundedPreceding, -1)
    extremes = [F.min("xmin").over(run).alias("xmin__r"), F.max("xmax").over(run).alias("xmax__r")]
    if plan.need_locations:
        extremes += [F.min("xmin").over(run_excl).alias("xmin__e"), F.max("xmax").over(run_excl).alias("xmax__e")]
    rows = rows.select("*", *[plan.sum(n).over(run).alias(f"{n}__r") for n in sums], *extremes)

    tot = rows.groupBy("_v", "_b").agg(
        *[plan.sum(n).alias(n) for n in sums], F.min("xmin").alias("xmin"), F.max("xmax").alias("xmax"))
    for n in plan.high:      # a block total beyond 38 digits is NULL; the sums after it count it as lost
        tot = tot.withColumn(_LOST, F.col(_LOST) + F.col(n).isNull().cast("bigint"))
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    first = F.count(F.lit(1)).over(before) == 0
    zero = F.lit(0).cast(terms.num_type)
    tot = tot.select("_v", "_b",
                     *[F.when(first, zero).otherwise(plan.sum(n).over(before)).alias(f"{n}__p") for n in sums],
                     F.min("xmin").over(before).alias("xmin__p"), F.max("xmax").over(before).alias("xmax__p"))
    rows = rows.join(tot, ["_v", "_b"])

    acc = {n: F.col(f"{n}__r") + F.col(f"{n}__p") for n in sums if n not in plan.high}
    for n in plan.high:
        acc[n] = F.when(acc[_LOST] == 0, F.try_add(f"{n}__r", f"{n}__p"))
    acc["xmin"] = F.least(F.col("xmin__r"), F.col("xmin__p"))
    acc["xmax"] = F.greatest(F.col("xmax__r"), F.col("xmax__p"))
    keep = ["_v", "_b", "_t", "_x", "_series_head", "_pos", *[f"_lag{k}" for k in range(1, K + 1)]]
    if plan.need_locations:
        keep += ["xmin__e", "xmax__e", "xmin__p", "xmax__p"]
    rows = rows.select(*keep, *[c.alias(f"_acc_{n}") for n, c in acc.items()])
    accc = {n: F.col(f"_acc_{n}") for n in acc}
    if plan.need_locations:
        rows = _extreme_locations(rows, wb)
        accc.update({c: F.col(c) for c in _LOC_COLS})
    return _feature_rows(rows, plan, accc, variable, order)


def _with_occurrence(rows: DataFrame) -> DataFrame:
    """Adds ``_occ``: the how-manieth occurrence of its value in the series a row
    is.  Counted inside time blocks and completed from a table of one row a value
    and block, so a value that fills a series is split like the series."""
    inside = Window.partitionBy("_v", "_x", "_b").orderBy("_t")
    counts = rows.groupBy("_v", "_x", "_b").agg(F.count(F.lit(1)).alias("_here"))
    earlier = Window.partitionBy("_v", "_x").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("_v", "_x", "_b", F.coalesce(F.sum("_here").over(earlier), F.lit(0)).alias("_there"))
    rows = rows.withColumn("_nth", F.row_number().over(inside)).join(counts, ["_v", "_x", "_b"])
    return rows.withColumn("_occ", F.col("_nth") + F.col("_there")).drop("_nth", "_there")


def _feature_rows(rows: DataFrame, plan: "_Plan", accc: dict[str, Column], variable: str, order: str) -> DataFrame:
    """Long features from rows that hold the windows' sums."""
    terms = plan.t
    # shared quantities first (a2 and var alone; then std / mean from them), so
    # feature formulas reference columns instead of repeating large expressions
    base = plan.basics(accc)
    rows = rows.select("*", base["_a2"].alias("_a2"), base["_total"].alias("_total"), base["_sq"].alias("_sq"))
    n_col = F.col("_acc_n").cast("double")
    sc_lit = F.lit(float(10 ** terms.scale) if terms.exact else 1.0)
    rows = rows.select("*", (F.col("_a2") / (n_col * n_col * sc_lit * sc_lit)).alias("_var"),
                       (F.col("_total") / (n_col * sc_lit)).alias("_mean"))
    rows = rows.select("*", F.sqrt("_var").alias("_std"))
    feats = plan.feature_columns(accc, {k: F.col(k) for k in ("_a2", "_var", "_std", "_total", "_mean", "_sq")})
    feats = [(name, _t_pvalue(c["t"], c["df"], c["p"]) if name.startswith('linear_trend__attr_"pvalue"') else c)
             for name, c in feats]
    # one column per feature, then an unpivot of plain column references: each
    # feature formula stays a separately compiled expression (a single array of
    # all formulas would exceed the generated-code size limit)
    wide = rows.select(F.col("_v").alias(variable), F.col("_t").alias(order),
                       *[c.alias(f"_f{i}") for i, (_, c) in enumerate(feats)])
    long = wide.unpivot([variable, order], [f"_f{i}" for i in range(len(feats))], "_k", "value")
    names = F.create_map(*[x for i, (name, _) in enumerate(feats) for x in (F.lit(f"_f{i}"), F.lit(name))])
    return long.select(variable, order, F.concat(F.col(variable), F.lit("__"), names[F.col("_k")]).alias("feature"),
                       F.col("value"))


def bounded_native(rows: DataFrame, specs: Sequence[tuple], value_type: T.DataType, max_timeshift: int,
                   min_timeshift: int, block_rows: int, variable: str, order: str) -> DataFrame:
    """Long features over windows of the last ``max_timeshift + 1`` rows.

    ``rows`` holds ``_v, _t, _x, _pos`` (0-based position in the variable).
    Each block of ``block_rows`` positions also gets the ``max_timeshift`` rows
    before it, so a task sorts and frames at most that many rows of a series.
    A term that reaches ``k`` rows back is summed over the frame without its
    first ``k`` rows.
    """
    m, B = max_timeshift, block_rows
    terms = _Terms(value_type)
    K = max(lags_needed(specs), 2)
    fan = rows.select("*", F.explode(F.sequence(F.floor(F.col("_pos") / B), F.floor((F.col("_pos") + m) / B))).alias("_b"))
    w = Window.partitionBy("_v", "_b").orderBy("_pos")
    frame = w.rowsBetween(-m, 0)
    fan = fan.select("*", F.first("_x").over(w).alias("_centre"),
                     *[F.lag("_x", k).over(w).alias(f"_lag{k}") for k in range(1, K + 1)],
                     F.array(*[F.nth_value("_x", k).over(frame) for k in range(1, K + 1)]).alias("_series_head"))
    plan = _Plan(specs, terms, K, centre="_centre")
    row_terms = plan.row_terms()
    fan = fan.select("*", *[c.alias(n) for n, c in row_terms.items()])
    sums = []
    for n in row_terms:
        if n in ("xmin", "xmax"):
            continue
        back = plan.reach(n)
        total = plan.sum(n).over(w.rowsBetween(back - m, 0)) if back <= m else F.lit(0).cast(terms.num_type)
        sums.append(total.alias(f"_acc_{n}"))
    sums += [F.min("xmin").over(frame).alias("_acc_xmin"), F.max("xmax").over(frame).alias("_acc_xmax")]
    lo = F.greatest(F.col("_pos") - m, F.lit(0))
    if plan.need_locations:
        x = F.col("_x").cast("double")
        for name, pick, key in (("_first_max", F.max_by, -F.col("_pos")), ("_last_max", F.max_by, F.col("_pos")),
                                ("_first_min", F.min_by, F.col("_pos")), ("_last_min", F.min_by, -F.col("_pos"))):
            sums.append((pick("_pos", F.struct(x, key)).over(frame) - lo).alias(name))
    fan = fan.select("*", *sums).filter((F.floor(F.col("_pos") / B) == F.col("_b")) & (F.col("_pos") >= min_timeshift))
    acc = {n: F.col(f"_acc_{n}") for n in row_terms}
    for n in plan.high:
        acc[n] = F.when(acc[_LOST] == 0, acc[n])
    if "sxi" in acc:     # positions count from the start of the window
        start = lo.cast(terms.num_type)
        acc["sxi"] = (acc["sxi"] - acc["s1"] * start).cast(terms.num_type)
    if plan.need_locations:
        acc.update({c: F.col(c) for c in _LOC_COLS})
    return _feature_rows(fan, plan, acc, variable, order)


_LOST = "lost"       # counts rows (and block totals) without an exact term of degree 3 or 4
_LOC_COLS = ("_first_max", "_last_max", "_first_min", "_last_min")


def _extreme_locations(rows: DataFrame, wb) -> DataFrame:
    """0-based positions of the first and last occurrence of the running max / min.

    A row opens a new maximum when it exceeds every earlier value (first
    occurrence) and ties it when it is at least as large (last occurrence);
    the position of the latest such row is a running max of positions,
    which decomposes over blocks like the sums do.
    """
    m_excl = F.least(F.col("xmin__e"), F.col("xmin__p"))
    M_excl = F.greatest(F.col("xmax__e"), F.col("xmax__p"))
    x = F.col("_x").cast("double")
    flags = {
        "_first_max": F.when(M_excl.isNull() | (x > M_excl), F.col("_pos")),
        "_last_max": F.when(M_excl.isNull() | (x >= M_excl), F.col("_pos")),
        "_first_min": F.when(m_excl.isNull() | (x < m_excl), F.col("_pos")),
        "_last_min": F.when(m_excl.isNull() | (x <= m_excl), F.col("_pos")),
    }
    rows = rows.select("*", *[c.alias(f"{n}__f") for n, c in flags.items()])
    run = Window.partitionBy("_v", "_b").orderBy("_t").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[F.max(f"{n}__f").over(run).alias(f"{n}__r") for n in _LOC_COLS])
    tot = rows.groupBy("_v", "_b").agg(*[F.max(f"{n}__f").alias(n) for n in _LOC_COLS])
    before = wb.rowsBetween(Window.unboundedPreceding, -1)
    tot = tot.select("_v", "_b", *[F.max(n).over(before).alias(f"{n}__p") for n in _LOC_COLS])
    rows = rows.join(tot, ["_v", "_b"])
    return rows.select(*[c for c in rows.columns if not c.endswith(("__f", "__r", "__p", "__e"))
                         or c in ("xmin__e",)],
                       *[F.greatest(F.col(f"{n}__r"), F.col(f"{n}__p")).alias(n) for n in _LOC_COLS])


class _Plan:
    """Which running terms the requested features need, and their formulas.

    Terms are centred on the first value ``c`` of the series (``d = x - c``):
    moments, autocorrelation and trend are shift invariant, and centred sums
    are small, so exact sums stay well inside DECIMAL(38,0) and double sums
    lose little to cancellation.
    """

    def __init__(self, specs, terms: _Terms, K: int, centre: str | None = None):
        self.specs, self.t, self.K, self.centre = specs, terms, K, centre
        self.high: list[str] = []       # exact terms of degree 3 and 4; "<name>__d" holds their double twin
        calcs = {s[0] for s in specs}
        self.calcs = calcs
        self.need_locations = bool(calcs & {"first_location_of_maximum", "last_location_of_maximum",
                                            "first_location_of_minimum", "last_location_of_minimum",
                                            "has_duplicate_max", "has_duplicate_min"})

    def _c(self) -> Column:
        return self.t.unit(F.col(self.centre) if self.centre else F.element_at(F.col("_series_head"), 1))

    def sum(self, name: str) -> Column:
        return F.try_sum(F.col(name)) if name in self.high else F.sum(name)

    def reach(self, name: str) -> int:
        """How many rows before its own a term reads."""
        kind, _, lag = name.removesuffix("__d").partition("_")
        if kind in ("c3", "tra"):
            return 2 * int(lag)
        return int(lag) if kind == "ac" else int(kind in ("sad", "sdd", "nc"))

    def _double(self, acc: dict[str, Column], name: str) -> Column:
        """A sum in the summation domain as double (the twin's where the exact one is lost)."""
        return F.coalesce(_dbl(acc[name]), acc[f"{name}__d"]) if name in self.high else _dbl(acc[name])

    # -- per-row terms -----------------------------------------------------
    def row_terms(self) -> dict[str, Column]:
        t = self.t
        zero = F.lit(0).cast(t.num_type)
        one = F.lit(1).cast("bigint")
        u = t.unit(F.col("_x"))
        c = self._c()
        d = (u - c).cast(t.num_type) if t.exact else u - c
        ul = {k: t.unit(F.col(f"_lag{k}")) for k in range(1, self.K + 1)}
        dl = {k: ((v - c).cast(t.num_type) if t.exact else v - c) for k, v in ul.items()}
        out: dict[str, Column] = {
            "n": one, "s1": d, "s2": t.mul(d, d),
            "xmin": F.col("_x").cast("double"), "xmax": F.col("_x").cast("double"),
        }
        calcs = self.calcs
        lost = []

        def high(name, build, *needs):
            """A term of degree 3 or 4; 0 where a value it needs is missing."""
            if name in out:
                return
            there = F.lit(True)
            for c in needs:
                there = there & c.isNotNull()
            if not t.exact:
                out[name] = F.when(there, build(t.mul, lambda a, b: a - b)).otherwise(0.0)
                return
            exact = build(t.try_mul, F.try_subtract)
            out[name] = F.when(there, F.coalesce(exact, zero)).otherwise(zero)
            rough = build(lambda *cs: t_double.mul(*[_dbl(c) for c in cs]), lambda a, b: a - b)
            out[f"{name}__d"] = F.when(there, rough).otherwise(0.0)
            self.high.append(name)
            lost.append(there & exact.isNull())

        t_double = _Terms(T.DoubleType())
        if calcs & {"skewness", "kurtosis"}:
            high("s3", lambda mul, sub: mul(d, d, d))
        if "kurtosis" in calcs:
            high("s4", lambda mul, sub: mul(d, d, d, d))
        if calcs & {"absolute_sum_of_changes", "mean_abs_change"}:
            out["sad"] = F.coalesce(F.abs(u - ul[1]).cast(t.num_type), zero)
        if "cid_ce" in calcs:
            diff = (u - ul[1]).cast(t.num_type) if t.exact else u - ul[1]
            out["sdd"] = F.coalesce(t.mul(diff, diff), zero)
        if "linear_trend" in calcs:
            out["sxi"] = t.mul(d, F.col("_pos").cast(t.num_type))
        if calcs & OCCURRENCE:
            # a value counts once it occurs again: with its second occurrence
            # both points come in, with every further one that point
            nth = F.col("_occ")
            again = F.when(nth == 2, F.lit(2)).when(nth > 2, F.lit(1)).otherwise(F.lit(0)).cast("bigint")
            out["kinds"] = F.when(nth == 1, one).otherwise(0)
            out["rkinds"] = F.when(nth == 2, one).otherwise(0)
            out["rpoints"] = again
            out["rkindsum"] = F.when(nth == 2, u).otherwise(zero)
            out["rpointsum"] = t.mul(u, again.cast(t.num_type))
        x = F.col("_x")
        for calc, params, _ in self.specs:
            if calc == "c3":
                k = params["lag"]
                high(f"c3_{k}", lambda mul, sub, k=k: mul(u, ul[k], ul[2 * k]), ul[2 * k])
            elif calc == "time_reversal_asymmetry_statistic":
                k = params["lag"]
                high(f"tra_{k}", lambda mul, sub, k=k: sub(mul(u, u, ul[k]), mul(ul[k], ul[2 * k], ul[2 * k])), ul[2 * k])
            elif calc == "autocorrelation" and params["lag"] > 0:
                k = params["lag"]
                out.setdefault(f"ac_{k}", F.coalesce(t.mul(d, dl[k]), zero))
            elif calc == "value_count":
                out.setdefault(f"vc_{params['value']}", F.when(x == F.lit(params["value"]), one).otherwise(0))
            elif calc == "range_count":
                lo, hi = params["min"], params["max"]
                out.setdefault(f"rc_{lo}_{hi}", F.when((x >= F.lit(lo)) & (x < F.lit(hi)), one).otherwise(0))
            elif calc == "count_above":
                out.setdefault(f"ca_{params['t']}", F.when(x >= F.lit(params["t"]), one).otherwise(0))
            elif calc == "count_below":
                out.setdefault(f"cb_{params['t']}", F.when(x <= F.lit(params["t"]), one).otherwise(0))
            elif calc == "number_crossing_m":
                m = params["m"]
                cross = (x > F.lit(m)) != (F.col("_lag1") > F.lit(m))
                out.setdefault(f"nc_{m}", F.when(cross, one).otherwise(0))
        if lost:
            out[_LOST] = F.when(functools.reduce(lambda a, b: a | b, lost), one).otherwise(0)
        return {self.safe(k): v for k, v in out.items()}

    @staticmethod
    def safe(name: str) -> str:
        return name.replace("-", "m").replace(".", "p")

    # -- exact-if-possible polynomial combinations -------------------------
    def _exact(self, build_exact, build_double) -> Column:
        """An integer combination of sums: exact DECIMAL(38,0) arithmetic for
        decimal input (the double form where that leaves 38 digits), else double."""
        if self.t.exact:
            return F.coalesce(_dbl(build_exact()), build_double())
        return build_double()

    # -- feature formulas ----------------------------------------------------
    def basics(self, acc: dict[str, Column]) -> dict[str, Column]:
        """Quantities shared by many features (computed once as columns)."""
        t = self.t
        D = "decimal(38,0)"
        tm, ta, ts = F.try_multiply, F.try_add, F.try_subtract
        ni = acc["n"]
        n = _dbl(ni)
        nD = ni.cast(D) if t.exact else n
        sc = float(10 ** t.scale) if t.exact else 1.0
        s1, s2 = acc["s1"], acc["s2"]
        c = self._c()
        a2 = self._exact(lambda: ts(tm(nD, s2), tm(s1, s1)), lambda: n * _dbl(s2) - _dbl(s1) * _dbl(s1))
        total = self._exact(lambda: ta(tm(nD, c.cast(D)), s1), lambda: n * _dbl(c) + _dbl(s1))
        sq = self._exact(lambda: ta(ta(s2, tm(tm(F.lit(2).cast(D), c.cast(D)), s1)), tm(nD, tm(c.cast(D), c.cast(D)))),
                         lambda: _dbl(s2) + F.lit(2.0) * _dbl(c) * _dbl(s1) + n * _dbl(c) * _dbl(c))
        var = a2 / (n * n * F.lit(sc * sc))
        return {"_a2": a2, "_var": var, "_std": F.sqrt(var), "_total": total,
                "_mean": total / (n * F.lit(sc)), "_sq": sq}

    def feature_columns(self, acc: dict[str, Column], basics: dict[str, Column] | None = None
                        ) -> list[tuple[str, Column]]:
        t = self.t
        D = "decimal(38,0)"
        tm, ta, ts = F.try_multiply, F.try_add, F.try_subtract
        ni = acc["n"]
        n = _dbl(ni)
        nD = ni.cast(D) if t.exact else n
        sc = float(10 ** t.scale) if t.exact else 1.0
        s1, s2 = acc["s1"], acc["s2"]
        c = self._c()
        S = lambda name, deg: t.to_double(self._double(acc, self.safe(name)), deg)

        b = basics if basics is not None else self.basics(acc)
        a2, var, std, total, mean, sq = (b[k] for k in ("_a2", "_var", "_std", "_total", "_mean", "_sq"))
        mx, mn = acc["xmax"], acc["xmin"]
        head = F.col("_series_head")
        out: list[tuple[str, Column]] = []
        for calc, params, suffix in self.specs:
            v = None
            if calc == "sum_values":
                v = total / F.lit(sc)
            elif calc == "mean":
                v = mean
            elif calc == "length":
                v = n
            elif calc == "variance":
                v = var
            elif calc == "standard_deviation":
                v = std
            elif calc == "root_mean_square":
                v = F.sqrt(sq / (n * F.lit(sc * sc)))
            elif calc == "abs_energy":
                v = sq / F.lit(sc * sc)
            elif calc == "maximum":
                v = mx
            elif calc == "minimum":
                v = mn
            elif calc == "absolute_maximum":
                v = F.greatest(F.abs(mx), F.abs(mn))
            elif calc == "absolute_sum_of_changes":
                v = S("sad", 1)
            elif calc == "mean_abs_change":
                v = F.when(n > 1, S("sad", 1) / (n - 1))
            elif calc == "mean_change":
                v = F.when(n > 1, (_dbl(F.col("_x")) - _dbl(F.element_at(head, 1))) / (n - 1))
            elif calc == "mean_second_derivative_central":
                v = F.when(n > 2, (_dbl(F.col("_x")) - _dbl(F.col("_lag1"))
                                   - _dbl(F.element_at(head, 2)) + _dbl(F.element_at(head, 1))) / (F.lit(2.0) * (n - 2)))
            elif calc == "variation_coefficient":
                v = F.when(mean != 0, std / mean)
            elif calc == "variance_larger_than_standard_deviation":
                v = (var > std).cast("double")
            elif calc == "skewness":
                s3 = acc["s3"]
                a3 = self._exact(
                    lambda: ta(ts(tm(tm(nD, nD), s3), tm(tm(tm(F.lit(3).cast(D), nD), s1), s2)),
                               tm(tm(tm(F.lit(2).cast(D), s1), s1), s1)),
                    lambda: n * n * self._double(acc, "s3") - F.lit(3.0) * n * _dbl(s1) * _dbl(s2)
                    + F.lit(2.0) * _dbl(s1) * _dbl(s1) * _dbl(s1))
                v = (F.when(n < 3, F.lit(None).cast("double")).when(a2 == 0, F.lit(0.0))
                     .otherwise(F.sqrt(n) * F.sqrt(n - 1) / (n - 2) * a3 / (a2 * F.sqrt(a2))))
            elif calc == "kurtosis":
                s3, s4 = acc["s3"], acc["s4"]
                a4 = self._exact(
                    lambda: ts(ta(ts(tm(tm(tm(nD, nD), nD), s4), tm(tm(tm(tm(F.lit(4).cast(D), nD), nD), s1), s3)),
                                  tm(tm(tm(tm(F.lit(6).cast(D), nD), s1), s1), s2)),
                               tm(tm(tm(tm(F.lit(3).cast(D), s1), s1), s1), s1)),
                    lambda: n * n * n * self._double(acc, "s4") - F.lit(4.0) * n * n * _dbl(s1) * self._double(acc, "s3")
                    + F.lit(6.0) * n * _dbl(s1) * _dbl(s1) * _dbl(s2) - F.lit(3.0) * _dbl(s1) * _dbl(s1) * _dbl(s1) * _dbl(s1))
                num = (n + 1) * (n - 1) * a4
                den = (n - 2) * (n - 3) * a2 * a2
                adj = F.lit(3.0) * (n - 1) * (n - 1) / ((n - 2) * (n - 3))
                v = (F.when(n < 4, F.lit(None).cast("double")).when(den == 0, F.lit(0.0))
                     .otherwise(num / den - adj))
            elif calc == "large_standard_deviation":
                v = (std > F.lit(params["r"]) * (mx - mn)).cast("double")
            elif calc == "cid_ce":
                ce = F.sqrt(S("sdd", 2))
                v = F.when(std == 0, F.lit(0.0)).otherwise(ce / std) if params["normalize"] else ce
            elif calc == "c3":
                k = params["lag"]
                v = F.when(n <= 2 * k, F.lit(0.0)).otherwise(S(f"c3_{k}", 3) / (n - 2 * k))
            elif calc == "time_reversal_asymmetry_statistic":
                k = params["lag"]
                v = F.when(n <= 2 * k, F.lit(0.0)).otherwise(S(f"tra_{k}", 3) / (n - 2 * k))
            elif calc == "autocorrelation":
                v = self._autocorr(params["lag"], acc, n, nD, a2, var)
            elif calc == "value_count":
                v = _dbl(acc[self.safe(f"vc_{params['value']}")])
            elif calc == "range_count":
                v = _dbl(acc[self.safe(f"rc_{params['min']}_{params['max']}")])
            elif calc == "count_above":
                v = _dbl(acc[self.safe(f"ca_{params['t']}")]) / n
            elif calc == "count_below":
                v = _dbl(acc[self.safe(f"cb_{params['t']}")]) / n
            elif calc == "number_crossing_m":
                v = _dbl(acc[self.safe(f"nc_{params['m']}")])
            elif calc == "has_duplicate":
                v = (_dbl(acc["kinds"]) < n).cast("double")
            elif calc == "percentage_of_reoccurring_values_to_all_values":
                v = _dbl(acc["rkinds"]) / _dbl(acc["kinds"])
            elif calc == "percentage_of_reoccurring_datapoints_to_all_datapoints":
                v = _dbl(acc["rpoints"]) / n
            elif calc == "sum_of_reoccurring_values":
                v = S("rkindsum", 1)
            elif calc == "sum_of_reoccurring_data_points":
                v = S("rpointsum", 1)
            elif calc == "ratio_value_number_to_time_series_length":
                v = _dbl(acc["kinds"]) / n
            elif calc == "linear_trend":
                v = self._linear_trend(params["attr"], acc, n, nD, a2, mean)
            elif calc == "first_location_of_maximum":
                v = _dbl(acc["_first_max"]) / n
            elif calc == "last_location_of_maximum":
                v = (_dbl(acc["_last_max"]) + 1) / n
            elif calc == "first_location_of_minimum":
                v = _dbl(acc["_first_min"]) / n
            elif calc == "last_location_of_minimum":
                v = (_dbl(acc["_last_min"]) + 1) / n
            elif calc == "has_duplicate_max":
                v = (acc["_first_max"] != acc["_last_max"]).cast("double")
            elif calc == "has_duplicate_min":
                v = (acc["_first_min"] != acc["_last_min"]).cast("double")
            if v is not None:
                out.append((suffix, v if calc == "linear_trend" and params["attr"] == "pvalue" else v.cast("double")))
        return out

    def _centred_sum(self, cols: list[Column]) -> Column:
        """Sum of ``unit(x) - c`` over the given value columns, in the summation domain."""
        t, c = self.t, self._c()
        total = None
        for col in cols:
            term = (t.unit(col) - c).cast(t.num_type) if t.exact else t.unit(col) - c
            total = term if total is None else ((total + term).cast(t.num_type) if t.exact else total + term)
        return total

    def _autocorr(self, k, acc, n, nD, a2, var):
        t = self.t
        if k == 0:
            return F.when(F.abs(var) <= _ISCLOSE_ATOL, F.lit(None)).otherwise(F.lit(1.0))
        D = "decimal(38,0)"
        tm, ta, ts = F.try_multiply, F.try_add, F.try_subtract
        s1, p = acc["s1"], acc[f"ac_{k}"]
        first_k = self._centred_sum([F.element_at(F.col("_series_head"), j) for j in range(1, k + 1)])
        last_k = self._centred_sum([F.col("_x")] + [F.col(f"_lag{j}") for j in range(1, k)])
        kk = F.lit(k)
        # n^2 * sum((x[i-k]-m)(x[i]-m)) with m = s1/n, as an integer combination
        num = self._exact(
            lambda: ta(ts(tm(tm(nD, nD), p), tm(tm(nD, s1), ts(ts(tm(F.lit(2).cast(D), s1), last_k), first_k))),
                       tm((nD - kk).cast(D), tm(s1, s1))),
            lambda: n * n * _dbl(p) - n * _dbl(s1) * (F.lit(2.0) * _dbl(s1) - _dbl(last_k) - _dbl(first_k))
            + (n - k) * _dbl(s1) * _dbl(s1))
        return F.when((n <= k) | (F.abs(var) <= _ISCLOSE_ATOL), F.lit(None)).otherwise(num / ((n - k) * a2))

    def _linear_trend(self, attr, acc, n, nD, a2, mean):
        t = self.t
        D = "decimal(38,0)"
        sc = float(10 ** t.scale) if t.exact else 1.0
        s1, sxi = acc["s1"], acc["sxi"]
        # regress x on i = 0..n-1; sums over i have closed forms
        ssxm = (n * n - 1) * n / 12            # n * var_pop(i)
        ssym = a2 / (n * F.lit(sc * sc))       # n * var_pop(x)
        si = (nD * (nD - 1) / 2).cast(D) if t.exact else n * (n - 1) / 2
        ssxym = self._exact(lambda: F.try_subtract(F.try_multiply(nD, sxi), F.try_multiply(si, s1)),
                            lambda: n * _dbl(sxi) - _dbl(si) * _dbl(s1)) / (n * F.lit(sc))
        slope = ssxym / ssxm
        r = F.when((ssxm == 0) | (ssym == 0), F.lit(0.0)).otherwise(ssxym / F.sqrt(ssxm * ssym))
        r = F.least(F.greatest(r, F.lit(-1.0)), F.lit(1.0))
        df = n - 2
        if attr == "slope":
            return F.when(n > 1, slope)
        if attr == "intercept":
            return F.when(n > 1, mean - slope * (n - 1) / 2)
        if attr == "rvalue":
            return F.when(n > 1, r)
        if attr == "stderr":
            return F.when(n == 2, F.lit(0.0)).when(n > 2, F.sqrt((F.lit(1.0) - r * r) * ssym / ssxm / df))
        if attr == "pvalue":
            tiny = F.lit(1.0e-20)
            tstat = r * F.sqrt(df / ((F.lit(1.0) - r + tiny) * (F.lit(1.0) + r + tiny)))
            two = F.when(F.col("_x") == F.col("_lag1"), F.lit(1.0)).otherwise(F.lit(0.0))
            # resolved to a p-value by the caller (Student-t tail, see stats.py)
            return F.when(n == 2, F.struct(F.lit(None).cast("double").alias("t"), F.lit(None).cast("double").alias("df"),
                                           two.alias("p"))) \
                .when(n > 2, F.struct(tstat.alias("t"), df.alias("df"), F.lit(None).cast("double").alias("p")))
        raise ValueError(attr)
