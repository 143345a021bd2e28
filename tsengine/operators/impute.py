"""Column-wise imputation of the (long) feature matrix.

Per feature, over the matrix rows: NULL / NaN -> median of the finite values,
+inf -> their maximum, -inf -> their minimum; a feature without any finite
value imputes 0.  Cells missing from the long form (no row for a bin) are
first gridded (rows x features) so that they are imputed too.

The median is exact at any size: all features' values are sorted by range at
once (``operators.rank``) and the middle places looked up, so no task collects a
feature's values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.operators.rank import number_rows


def _finite(c):
    return c.isNotNull() & ~F.isnan(c) & (c != F.lit(float("inf"))) & (c != F.lit(float("-inf")))


def impute_stats(long: DataFrame, feature: str = "feature", value: str = "value") -> DataFrame:
    """``feature, median, min, max`` of the finite values (one row per feature)."""
    finite = long.where(_finite(F.col(value))).select(feature, F.col(value).cast("double").alias("_x"))
    placed = number_rows(finite, [feature], ["_x"], "_place", count="_n")
    # one middle place, or the two that the median lies between
    middle = placed.where(F.abs(2 * F.col("_place") - (F.col("_n") - 1)) <= 1)
    ends = placed.where((F.col("_place") == 0) | (F.col("_place") == F.col("_n") - 1))
    return middle.groupBy(feature).agg(F.avg("_x").alias("median")).join(
        ends.groupBy(feature).agg(F.min("_x").alias("min"), F.max("_x").alias("max")), feature)


def grid(index: DataFrame, names: Sequence[str], order: str = "datetime", feature: str = "feature") -> DataFrame:
    """Every (row, feature) cell; ``names`` is bounded by the feature settings."""
    return index.select(order, F.explode(F.array(*[F.lit(n) for n in names])).alias(feature))


def impute(long: DataFrame, index: DataFrame, names: Sequence[str], order: str = "datetime",
           feature: str = "feature", value: str = "value") -> DataFrame:
    """Gridded, imputed long matrix ``datetime, feature, value`` (no NULL, NaN or inf left)."""
    cells = grid(index, names, order, feature)
    src = long.select(order, feature, F.col(value).cast("double").alias(value))
    # restrict to matrix rows before the statistics are taken
    src = src.join(index, order, "left_semi")
    filled = cells.join(src, [order, feature], "left")
    stats = impute_stats(src, feature, value)
    # one row per feature, and features grow with the variables: Spark picks the join by its size
    out = filled.join(stats, feature, "left")
    v = F.col(value)
    med, lo, hi = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("median", "min", "max"))
    fixed = (F.when(v.isNull() | F.isnan(v), med)
             .when(v == F.lit(float("inf")), hi)
             .when(v == F.lit(float("-inf")), lo)
             .otherwise(v))
    return out.select(order, feature, fixed.alias(value))
