"""Positions and running sums in any order, without a task that holds a key.

A window over ``partition by key order by x`` sorts a whole key in one task.
Here all keys are sorted together by range, which cuts a large key into as many
sorted parts as it needs; what stands before a part follows from the parts'
totals, one row a key and part.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tsengine.session import materialize


def _sorted_parts(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """``df`` sorted by ``keys`` and ``order`` over ranged parts, with ``_part``
    and ``_at`` (ascending in the sorted order).  Written once: both the totals
    and the rows must see the same parts."""
    by = [*keys, *order]
    return materialize(df.repartitionByRange(*by).sortWithinPartitions(*by)
                       .withColumn("_key", F.struct(*keys))     # joins match null keys, too
                       .withColumn("_part", F.spark_partition_id())
                       .withColumn("_at", F.monotonically_increasing_id()))


def _before(totals: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds, by name, the sum of each column over the key's earlier parts."""
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return totals.select("*", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(n) for c, n in columns.items()])


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str], pos: str = "pos",
                count: str | None = None) -> DataFrame:
    """Add the 0-based place of every row in its key by ``order`` (unique in a
    key, or any place among equals will do) and, if named, the key's rows."""
    rows = _sorted_parts(df, keys, order)
    totals = rows.groupBy("_key", "_part").agg(F.count(F.lit(1)).alias("_rows"), F.min("_at").alias("_first"))
    totals = _before(totals, {"_rows": "_before"})
    if count:
        totals = totals.withColumn(count, F.sum("_rows").over(Window.partitionBy("_key")))
    rows = rows.join(totals.drop("_rows"), ["_key", "_part"])
    place = (F.col("_before") + F.col("_at") - F.col("_first")).cast("bigint")
    return rows.withColumn(pos, place).drop("_key", "_part", "_at", "_first", "_before")


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], sums: dict[str, str]) -> DataFrame:
    """Add, for each weight column and name in ``sums``, the sum of the weight
    over a key's rows up to and including each row by ``order``."""
    rows = _sorted_parts(df, keys, order)
    totals = rows.groupBy("_key", "_part").agg(*[F.sum(w).alias(f"_t{i}") for i, w in enumerate(sums)])
    totals = _before(totals, {f"_t{i}": f"_b{i}" for i in range(len(sums))}).select("_key", "_part", *[f"_b{i}" for i in range(len(sums))])
    inside = Window.partitionBy("_key", "_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.select("*", *[F.sum(w).over(inside).alias(f"_s{i}") for i, w in enumerate(sums)]).join(totals, ["_key", "_part"])
    return rows.select(*df.columns, *[(F.col(f"_b{i}") + F.col(f"_s{i}")).alias(n) for i, n in enumerate(sums.values())])


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], weight: str, total: str) -> DataFrame:
    """:func:`running_sums` of one weight."""
    return running_sums(df, keys, order, {weight: total})
