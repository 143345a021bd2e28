"""Forecast targets: price, log return, one-period volatility, shifted ahead.

Targets are computed over the rows of the feature matrix (its ``datetime``
index), as shifts by row, not by time.  Shifts are equi-joins on row
positions (``operators.roll.with_positions``), so no window ever holds the
whole index in one task.

* ``lr = ln(p_t) - ln(p_{t-1})`` (x100 with ``percent=True``); Spark's ``ln``
  of 0 or a negative number is NULL, so such rows get a NULL return;
* ``vol = |lr|``;
* ``y_future`` = the chosen target ``periods`` rows ahead; ``kind`` picks it
  (``log_return`` wins over ``volatility`` when both flags are given by a caller).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tsengine.functions.native import DEFAULT_BLOCK_SECONDS
from tsengine.operators.roll import with_positions

KINDS = ("price", "log_return", "volatility")


def target_kind(lr: bool = False, vol: bool = False) -> str:
    """The reference's flag pair mapped to one kind (log return wins)."""
    return "log_return" if lr else "volatility" if vol else "price"


def matrix_index(features: DataFrame, order: str = "datetime") -> DataFrame:
    """Distinct row keys of the feature matrix (bins holding any non-null feature)."""
    return features.filter(F.col("value").isNotNull()).select(order).distinct()


def add_target(features: DataFrame, target: str, kind: str = "price", periods: int = 1,
               percent: bool = False, order: str = "datetime",
               block_seconds: int = DEFAULT_BLOCK_SECONDS, drop_last: bool = True) -> DataFrame:
    """Target table ``datetime, target, lr, vol, y_future`` over the matrix index.

    ``features`` is the long feature frame (``feature`` = ``target`` holds the
    raw values of the target variable).  With ``drop_last`` the rows whose
    ``y_future`` is NULL (the last ``periods`` rows) are removed.
    """
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}")
    if periods < 1:
        raise ValueError("periods must be >= 1")
    names = features.filter(F.col("feature") == target).limit(1).count()
    if names == 0:
        raise ValueError(f"target {target!r} is not a variable of the feature frame "
                         "(the base coin's metrics carry no suffix)")
    index = matrix_index(features, order)
    raw = features.filter(F.col("feature") == target).groupBy(order).agg(F.avg("value").alias("target"))
    base = with_positions(index.join(raw, order, "left"), order, (), block_seconds, "_pos")
    prev = base.select((F.col("_pos") + 1).alias("_pos"), F.col("target").alias("_prev"))
    rows = base.join(prev, "_pos", "left")
    lr = F.ln("target") - F.ln("_prev")
    if percent:
        lr = lr * 100
    rows = rows.select("_pos", order, "target", lr.alias("lr"))
    rows = rows.withColumn("vol", F.abs("lr"))
    src = {"price": "target", "log_return": "lr", "volatility": "vol"}[kind]
    ahead = rows.select((F.col("_pos") - periods).alias("_pos"), F.col(src).alias("y_future"))
    out = rows.join(ahead, "_pos", "left").drop("_pos")
    if drop_last:
        out = out.filter(F.col("y_future").isNotNull())
    return out.select(order, "target", "lr", "vol", "y_future")


def target_rows(targets: DataFrame, columns=("target", "lr", "vol", "y_future"), order: str = "datetime",
                names: dict | None = None) -> DataFrame:
    """Target columns as long feature rows (``feature, value``), to join the matrix."""
    names = names or {}
    return targets.select(order, F.explode(F.array(*[
        F.struct(F.lit(names.get(c, c)).alias("feature"), F.col(c).cast("double").alias("value"))
        for c in columns])).alias("_r")).select(order, "_r.feature", "_r.value")
