"""Expanding windows over series: null policies, row positions, row shifts.

A window is keyed by ``(variable, end)`` and holds every row of the variable
up to ``end`` (rows, not time).  Windows are never materialised; features
are running aggregates (``tsengine.functions``).

Per-series work is split into time blocks (``block_seconds``) so that a
series holding a large share of all rows still spreads over many tasks:
in-block window functions run per ``(variable, block)``, and a small block
table carries what earlier blocks contribute (row counts, last non-null
value).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsengine.functions.native import DEFAULT_BLOCK_SECONDS

NULL_POLICIES = ("drop", "ffill")


def _block(order: str, block_seconds: int):
    span = int(block_seconds) * 1_000_000
    return F.floor(F.unix_micros(F.col(order).cast("timestamp")) / F.lit(span))


def nan_to_null(df: DataFrame, column: str):
    """The column with NaN as NULL (other types unchanged)."""
    c = F.col(column)
    kind = df.schema[column].dataType
    return F.when(~F.isnan(c), c) if isinstance(kind, (T.DoubleType, T.FloatType)) else c


def prepare_series(long: DataFrame, null_policy: str = "drop", variable: str = "variable",
                   order: str = "datetime", value: str = "value",
                   block_seconds: int = DEFAULT_BLOCK_SECONDS) -> DataFrame:
    """Apply the null policy to a long series; returns rows with non-null values.

    * ``drop``: null rows are removed before windows are formed, so a window
      ending on a null bin is the window of the previous non-null row;
    * ``ffill``: a null takes the last non-null value **of the same
      variable**; nulls before a variable's first value stay null and are
      removed (no value leaks from one series into the next).

    NaN counts as NULL under either policy.  A row whose sort key is NULL
    raises: it has no place in any window.
    """
    if null_policy not in NULL_POLICIES:
        raise ValueError(f"null_policy must be one of {NULL_POLICIES}")
    at = F.coalesce(F.col(order), F.raise_error(F.lit(f"NULL sort key in {order}")).cast(long.schema[order].dataType))
    src = long.select(variable, at.alias(order), nan_to_null(long, value).alias(value))
    if null_policy == "drop":
        return src.filter(F.col(value).isNotNull())
    rows = src.withColumn("_b", _block(order, block_seconds))
    run = Window.partitionBy(variable, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_in", F.last(value, ignorenulls=True).over(run))
    # every block gets a row (also blocks holding only nulls), so each can receive a carry
    last_in_block = rows.groupBy(variable, "_b").agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_last"))
    wb = Window.partitionBy(variable).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = last_in_block.select(variable, "_b", F.last("_last", ignorenulls=True).over(wb).alias("_carry"))
    rows = rows.join(carry, [variable, "_b"], "left")
    filled = F.coalesce(F.col("_in"), F.col("_carry"))
    return rows.select(variable, order, filled.alias(value)).filter(F.col(value).isNotNull())


def with_positions(df: DataFrame, order: str, keys: Sequence[str] = (),
                   block_seconds: int = DEFAULT_BLOCK_SECONDS, pos: str = "pos") -> DataFrame:
    """Add the 0-based row position within ``keys`` in ``order`` (``order`` unique per key).

    Equivalent to ``row_number() over (partition by keys order by order) - 1``
    but never puts a whole key (or, with no keys, the whole frame) in one
    task: positions are in-block row numbers plus the rows of earlier blocks.
    """
    keys = list(keys)
    rows = df.withColumn("_pb", _block(order, block_seconds))
    w_in = Window.partitionBy(*keys, "_pb").orderBy(order)
    rows = rows.withColumn("_pi", F.row_number().over(w_in) - 1)
    counts = rows.groupBy(*keys, "_pb").agg(F.count(F.lit(1)).alias("_pc"))
    wb = Window.partitionBy(*keys).orderBy("_pb").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(*keys, "_pb", F.coalesce(F.sum("_pc").over(wb), F.lit(0)).alias("_pbefore"))
    rows = rows.join(before, [*keys, "_pb"])
    return rows.withColumn(pos, (F.col("_pbefore") + F.col("_pi")).cast("bigint")).drop("_pb", "_pi", "_pbefore")


def shift_rows(df: DataFrame, order: str, columns: Sequence[str], k: int, keys: Sequence[str] = (),
               suffix: str | None = None, block_seconds: int = DEFAULT_BLOCK_SECONDS) -> DataFrame:
    """``shift(k)`` of ``columns`` by row position (k > 0: previous rows, k < 0: later rows).

    Implemented as an equi-join on ``(keys, position)``, which is parallel on
    any key distribution, instead of a lag/lead window over one partition.
    """
    keys = list(keys)
    suffix = suffix or (f"_lag{k}" if k > 0 else f"_lead{-k}")
    base = with_positions(df, order, keys, block_seconds, "_pos")
    other = base.select(*keys, (F.col("_pos") + F.lit(k)).alias("_pos"),
                        *[F.col(c).alias(f"{c}{suffix}") for c in columns])
    return base.join(other, [*keys, "_pos"], "left").drop("_pos")


def roll_lengths(series: DataFrame, variable: str = "variable", order: str = "datetime",
                 max_timeshift: int | None = None, min_timeshift: int = 0,
                 block_seconds: int = DEFAULT_BLOCK_SECONDS) -> DataFrame:
    """Window id ``(variable, end)`` and window length for every row.

    Length is ``position + 1`` for expanding windows, capped at
    ``max_timeshift + 1``; windows shorter than ``min_timeshift + 1`` are
    not produced.
    """
    pos = with_positions(series.select(variable, order), order, [variable], block_seconds)
    length = F.col("pos") + 1
    if max_timeshift is not None:
        length = F.least(length, F.lit(max_timeshift + 1))
    out = pos.select(variable, F.col(order).alias("end"), length.cast("bigint").alias("length"))
    return out.filter(F.col("length") > min_timeshift)
