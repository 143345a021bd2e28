"""Time-ordered splits: hold-out tail and expanding-window folds.

Both work on row positions of the distinct ``order`` values (computed in
blocks, see ``operators.roll.with_positions``), never on a global window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.functions.native import DEFAULT_BLOCK_SECONDS
from tsengine.operators.roll import with_positions


def _positions(df: DataFrame, order: str, block_seconds: int) -> tuple[DataFrame, int]:
    index = df.select(order).distinct()
    pos = with_positions(index, order, (), block_seconds, "_pos")
    n = index.count()
    return pos, n


def time_split(df: DataFrame, order: str = "datetime", test_fraction: float = 0.2,
               block_seconds: int = DEFAULT_BLOCK_SECONDS) -> DataFrame:
    """Add ``split`` in {train, test}: the last ``floor(test_fraction * n)`` rows are test.

    Raises when the train part would be empty or the test part has no row
    (fewer than ``1 / test_fraction`` rows).
    """
    pos, n = _positions(df, order, block_seconds)
    n_test = int(test_fraction * n)
    if n_test < 1 or n - n_test < 1:
        raise ValueError(f"{n} rows cannot be split with test_fraction={test_fraction}")
    role = F.when(F.col("_pos") >= n - n_test, F.lit("test")).otherwise(F.lit("train"))
    return df.join(pos.select(order, role.alias("split")), order)


def time_folds(df: DataFrame, order: str = "datetime", n_splits: int = 5,
               block_seconds: int = DEFAULT_BLOCK_SECONDS) -> DataFrame:
    """Expanding-window folds: rows of ``df`` with ``fold`` (0-based) and ``role``.

    With ``t = n // (n_splits + 1)``, fold ``j`` tests rows
    ``[n - (n_splits - j) t, n - (n_splits - j - 1) t)`` and trains on every
    earlier row.  A row appears once per fold it belongs to.
    """
    pos, n = _positions(df, order, block_seconds)
    t = n // (n_splits + 1)
    if t < 1:
        raise ValueError(f"{n} rows are too few for {n_splits} folds")
    starts = [n - (n_splits - j) * t for j in range(n_splits)]
    p = F.col("_pos")
    tags = F.array(*[
        F.when(p < F.lit(s), F.struct(F.lit(j).alias("fold"), F.lit("train").alias("role")))
        .when(p < F.lit(s + t), F.struct(F.lit(j).alias("fold"), F.lit("test").alias("role")))
        for j, s in enumerate(starts)])
    tagged = pos.select(order, F.explode(F.filter(tags, lambda e: e.isNotNull())).alias("_f"))
    return df.join(tagged, order).select(*df.columns, "_f.fold", "_f.role")
