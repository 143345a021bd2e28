"""Aligning coins on one time grid, and long <-> wide reshaping.

The reference contract between stages is the *long* series
``(datetime, variable, value)``.  Coins are aligned on the bins of the base
(first-ranked) coin with a left join: a base bin with no row for another coin
gives NULL for it, a bin only another coin has is lost.  Metric columns of
the base coin keep their names, those of coin ``c`` are suffixed ``' ' + c``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def display_name(metric: str, coin: str, rank: int) -> str:
    return metric if rank == 0 else f"{metric} {coin}"


def variable_names(coins: Sequence[str], metrics: Sequence[str]) -> list[str]:
    """Column names of the aligned wide frame, in the reference's order."""
    return [display_name(m, c, r) for r, c in enumerate(coins) for m in metrics]


def _check_coins(coins: Sequence[str]) -> list[str]:
    coins = list(coins)
    if not coins:
        raise ValueError("at least one coin is required")
    if len(set(coins)) != len(coins):
        raise ValueError("coins must be distinct")
    return coins


def align_long(binned: DataFrame, coins: Sequence[str], metrics: Sequence[str],
               series: str = "coin", bin_col: str = "bin") -> DataFrame:
    """Align binned coins on the base coin's bins and melt to ``datetime, variable, value``.

    ``coins`` is the ranked coin list (bounded by the ranking request); the
    base grid is fanned out over it with a generator, then one equi-join on
    ``(coin, bin)`` attaches the values.  Nulls are kept, as a melt keeps them.
    """
    coins = _check_coins(coins)
    base_bins = binned.filter(F.col(series) == coins[0]).select(bin_col)
    fan = F.posexplode(F.array(*[F.lit(c) for c in coins])).alias("_rank", series)
    grid = base_bins.select(bin_col, fan)
    sub = binned.filter(F.col(series).isin(coins)).select(series, bin_col, *metrics)
    joined = grid.join(sub, [series, bin_col], "left")
    long = joined.unpivot([series, "_rank", bin_col], list(metrics), "_metric", "value")
    name = F.when(F.col("_rank") == 0, F.col("_metric")).otherwise(
        F.concat(F.col("_metric"), F.lit(" "), F.col(series)))
    return long.select(F.col(bin_col).alias("datetime"), name.alias("variable"), "value")


def wide_join(binned: DataFrame, coins: Sequence[str], metrics: Sequence[str],
              series: str = "coin", bin_col: str = "bin") -> DataFrame:
    """The aligned *wide* frame: ``datetime`` plus one column per (coin, metric).

    Built as the long alignment pivoted with a fixed name list (one shuffle on
    ``datetime``) instead of a chain of N-1 joins.
    """
    coins = _check_coins(coins)
    names = variable_names(coins, metrics)
    long = align_long(binned, coins, metrics, series, bin_col)
    return long.groupBy("datetime").pivot("variable", names).agg(F.max("value")).select("datetime", *names)


def melt_long(wide: DataFrame, id_cols: Sequence[str] = ("datetime",),
              var_name: str = "variable", value_name: str = "value") -> DataFrame:
    """Wide -> long, keeping NULL values (one output row per input cell)."""
    cols = [c for c in wide.columns if c not in id_cols]
    return wide.unpivot(list(id_cols), cols, var_name, value_name)


def feature_names(long: DataFrame, feature: str = "variable", value: str = "value") -> list[str]:
    """Sorted names that hold at least one non-null value (a pass over the data).

    The result is bounded by the feature settings times the variables, not by
    the number of rows.
    """
    rows = (long.filter(F.col(value).isNotNull()).select(feature).distinct()
            .orderBy(feature).collect())
    return [r[0] for r in rows]


def pivot_features(long: DataFrame, names: Sequence[str] | None = None, index: str = "datetime",
                   feature: str = "variable", value: str = "value") -> DataFrame:
    """Long -> wide with the mean of each ``(index, feature)`` cell.

    Columns with no non-null value are not produced.  ``names`` must be the
    list of columns wanted (pivoting with a list avoids a discovery pass); when
    it is omitted the list is discovered with :func:`feature_names`.
    """
    if names is None:
        names = feature_names(long, feature, value)
    names = list(names)
    nonnull = long.filter(F.col(value).isNotNull())
    wide = nonnull.groupBy(index).pivot(feature, names).agg(F.avg(F.col(value).cast("double")))
    return wide.select(index, *names)
