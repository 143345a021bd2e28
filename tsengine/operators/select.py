"""Feature selection for a real-valued target: per-feature tests + FDR control.

1. ``relevance_table``: one test per feature.  Constant feature -> not tested;
   two distinct values -> two-sample Kolmogorov-Smirnov of the target split by
   the feature; otherwise Kendall tau-b with its asymptotic p-value.  Both are
   joins, sorts by range and grouped sums over all features' cells at once: no
   task holds a feature's column.

   * Kendall: rows are numbered by (value, target) and by (target, value).  A
     pair is discordant if the two orders differ on it, so a row's concordant
     partners before it are the rows up to its first number whose second number
     is less: the counting question of ``functions.ordered``, which descends
     cumulative counts of target classes, refined level by level.  Ties are
     counts of equal values.
   * Kolmogorov-Smirnov: running counts of one sample in order of the target,
     read at the last of equal targets.
   * p-values are functions of a few numbers a feature (``functions.stats``).

2. ``fdr_select``: the Benjamini-Yekutieli step-up procedure over the m tested
   features, expressed with window functions over the (one row per feature)
   table: ``p_adj = min_{j>=k} p_(j) m c(m) / j`` with ``c(m) = sum_{i<=m} 1/i``;
   features with ``p_adj <= level`` are relevant.
3. ``select_features``: names of relevant features plus ``always_keep``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsengine.functions.ordered import BLOCK_ROWS, COUNT, answer
from tsengine.functions.stats import ks_p_value
from tsengine.operators.rank import number_rows, running_sum
from tsengine.session import materialize

_BIG = "decimal(38,0)"


@F.pandas_udf(T.DoubleType())
def _normal_p(z: pd.Series) -> pd.Series:
    """Two-sided p of a normal statistic (one row a feature)."""
    return z.map(lambda v: math.erfc(v / math.sqrt(2)), na_action="ignore")


def _ks_p(method: str):
    @F.pandas_udf(T.DoubleType())
    def p(n1: pd.Series, n2: pd.Series, h: pd.Series) -> pd.Series:
        return pd.Series([ks_p_value(int(a), int(b), int(c), method) for a, b, c in zip(n1, n2, h)], dtype=float)
    return p


def _ties(cells: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Per feature: distinct values, tied pairs and the sums of the variance's corrections."""
    t = F.col("_c").cast(_BIG)
    groups = cells.groupBy("feature", *by).agg(F.count(F.lit(1)).alias("_c"))
    return groups.groupBy("feature").agg(
        F.count(F.lit(1)).alias(f"{name}_kinds"), F.sum(t * (t - 1) / 2).cast("double").alias(name),
        F.sum(t * (t - 1) * (t - 2)).cast("double").alias(f"{name}_0"),
        F.sum(t * (t - 1) * (2 * t + 5)).cast("double").alias(f"{name}_1"))


def _kendall(cells: DataFrame, block_rows: int) -> DataFrame:
    """``feature, stat, z`` of numbered cells ``(feature, x, y, _n, _p, _q)``."""
    points = cells.select(F.col("feature").alias("_v"), F.col("_p").alias("_pos"), F.col("_q").alias("_r"))
    asked = points.select("_v", "_pos", F.lit(0).alias("_ask"), F.lit(COUNT).alias("_kind"), F.col("_r").alias("_arg"))
    most = cells.agg(F.max("_n")).first()[0]
    below = answer(points, asked, most or 1, block_rows)
    agreeing = below.groupBy(F.col("_v").alias("feature")).agg(F.sum(F.col("_sum").cast(_BIG)).alias("_agree"))
    sums = agreeing
    for by, name in ((["x"], "tx"), (["y"], "ty"), (["x", "y"], "txy")):
        sums = sums.join(_ties(cells, by, name), "feature")
    sums = sums.join(cells.groupBy("feature").agg(F.count(F.lit(1)).cast("double").alias("n")), "feature")
    # no number is less: rows up to it that are not "agreeing" are discordant
    n, tx, ty = F.col("n"), F.col("tx"), F.col("ty")
    pairs = n * (n - 1) / 2
    discordant = pairs - F.col("_agree").cast("double")
    s = pairs - tx - ty + F.col("txy") - 2 * discordant
    room = (pairs - tx) * (pairs - ty)
    m = n * (n - 1)
    var = (m * (2 * n + 5) - F.col("tx_1") - F.col("ty_1")) / 18 + 2 * tx * ty / m \
        + F.when(n > 2, F.col("tx_0") * F.col("ty_0") / (9 * m * (n - 2))).otherwise(0.0)
    return sums.select("feature", F.when(room > 0, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s / F.sqrt(room)))).alias("stat"),
                       F.when((room > 0) & (var > 0), F.abs(s) / F.sqrt(var)).alias("z"))


def _kolmogorov(cells: DataFrame) -> DataFrame:
    """``feature, n1, n2, h`` of numbered cells of features with two values:
    the samples' sizes and the largest ``|c1 n2 - c2 n1|`` of their counts."""
    least = cells.groupBy("feature").agg(F.min("x").alias("_x0"))
    first = cells.join(least, "feature").withColumn("_first", (F.col("x") == F.col("_x0")).cast("int"))
    counted = running_sum(first.select("feature", "y", "_q", "_first"), ["feature"], ["_q"], "_first", "_c1")
    sizes = counted.groupBy("feature").agg(F.max("_c1").alias("n1"), (F.max("_q") + 1).alias("_n"))
    steps = counted.groupBy("feature", "y").agg(F.max("_c1").alias("_c1"), (F.max("_q") + 1).alias("_upto")).join(sizes, "feature")
    n2 = F.col("_n") - F.col("n1")
    gap = F.abs(F.col("_c1") * n2 - (F.col("_upto") - F.col("_c1")) * F.col("n1"))
    return steps.groupBy("feature").agg(F.max("n1").alias("n1"), F.max(n2).alias("n2"), F.max(gap).alias("h"))


def relevance_table(matrix_long: DataFrame, target: DataFrame, order: str = "datetime",
                    y: str = "y_future", exclude: Sequence[str] = (), ks_method: str = "exact",
                    block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``feature, type, n, stat, p_value`` for every feature of an imputed long matrix.

    ``ks_method``: ``exact`` (default, whatever the size; its cost is the product
    of the sample sizes times the distance) or ``asymptotic``.
    """
    ys = target.select(order, F.col(y).cast("double").alias("y"))
    cells = matrix_long.join(ys, order)
    if exclude:
        cells = cells.filter(~F.col("feature").isin(list(exclude)))
    cells = cells.select("feature", F.col("value").cast("double").alias("x"), "y")
    numbered = number_rows(cells, ["feature"], ["x", "y"], "_p", count="_n")
    numbered = materialize(number_rows(numbered, ["feature"], ["y", "_p"], "_q"))
    kinds = numbered.groupBy("feature", "x").agg(F.count(F.lit(1)).alias("_c")).groupBy("feature").agg(
        F.count(F.lit(1)).alias("_kinds"), F.sum("_c").alias("n"))
    kinds = materialize(kinds)

    def of(kind):
        return numbered.join(kinds.where(kind).select("feature"), "feature", "left_semi")

    real = _kendall(of(F.col("_kinds") > 2), block_rows).select("feature", "stat", _normal_p("z").alias("p_value"))
    binary = _kolmogorov(of(F.col("_kinds") == 2))
    binary = binary.select("feature", (F.col("h").cast("double") / (F.col("n1") * F.col("n2")).cast("double")).alias("stat"),
                           _ks_p(ks_method)("n1", "n2", "h").alias("p_value"))
    kind = F.when(F.col("_kinds") <= 1, "constant").when(F.col("_kinds") == 2, "binary").otherwise("real")
    return kinds.join(real.unionByName(binary), "feature", "left").select(
        "feature", kind.alias("type"), "n", "stat", "p_value")


def fdr_select(table: DataFrame, level: float = 0.05) -> DataFrame:
    """Add ``rank, p_adj, relevant`` (Benjamini-Yekutieli step-up at ``level``).

    Constant features are never relevant and do not count in ``m``.
    """
    tested = table.filter(F.col("p_value").isNotNull())
    # The relevance table has one row per feature, so ordering it in one
    # partition is cheap.
    rank = F.row_number().over(Window.orderBy("p_value", "feature"))
    whole = Window.partitionBy()
    ranked = tested.select("*", rank.cast("bigint").alias("rank"))
    cm = F.sum(F.lit(1.0) / F.col("rank")).over(whole)
    ranked = ranked.withColumn("_raw", F.col("p_value") * F.count(F.lit(1)).over(whole) * cm / F.col("rank"))
    tail = Window.orderBy(F.col("rank").desc()).rowsBetween(Window.unboundedPreceding, 0)
    p_adj = F.least(F.min("_raw").over(tail), F.lit(1.0))
    ranked = (ranked.select("feature", "type", "n", "stat", "p_value", "rank", p_adj.alias("p_adj"))
              .withColumn("relevant", F.col("p_adj") <= F.lit(level)))
    untested = table.filter(F.col("p_value").isNull()).select(
        "feature", "type", "n", "stat", "p_value", F.lit(None).cast("bigint").alias("rank"),
        F.lit(None).cast("double").alias("p_adj"), F.lit(False).alias("relevant"))
    return ranked.unionByName(untested)


def select_features(matrix_long: DataFrame, target: DataFrame, level: float = 0.05,
                    always_keep: Sequence[str] = (), order: str = "datetime", y: str = "y_future",
                    fit_until=None, exclude: Sequence[str] = ("y_future",)) -> tuple[list[str], DataFrame]:
    """Relevant feature names (sorted) plus ``always_keep``, and the relevance table.

    ``fit_until`` restricts the tests to rows before a cut-off, so that the
    selection does not see the test period (default: all rows, as the
    reference does).
    """
    m = matrix_long
    tgt = target
    if fit_until is not None:
        m = m.filter(F.col(order) < F.lit(fit_until))
        tgt = tgt.filter(F.col(order) < F.lit(fit_until))
    table = fdr_select(relevance_table(m, tgt, order, y, exclude), level)
    relevant = [r[0] for r in table.filter("relevant").select("feature").collect()]
    names = sorted(set(relevant) | set(always_keep))
    return names, table


def with_enough(table: DataFrame, always_keep: Sequence[str] = (), minimum: int = 5, label: str = "y_future") -> DataFrame:
    """The selection report: ``kept`` by feature and, the same on every row,
    ``enough`` (see :func:`enough_features`): kept columns and the label."""
    kept = F.col("relevant") | F.col("feature").isin(list(always_keep)) if always_keep else F.col("relevant")
    table = table.withColumn("kept", kept)
    others = len(set(always_keep) | {label})
    names = F.count_if(F.col("kept") & ~F.col("feature").isin([*always_keep, label])).over(Window.partitionBy()) + others
    return table.withColumn("enough", names > minimum)      # the table has one row a feature


def enough_features(names: Sequence[str], minimum: int = 5) -> bool:
    """More than ``minimum`` kept columns, the label included, count as enough."""
    return len(names) > minimum
