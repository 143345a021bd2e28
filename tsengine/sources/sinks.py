"""Stage sinks: long frames written as partitioned Parquet between stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame


def write_stage(df: DataFrame, path: str, partition_by: Sequence[str] = ("variable",),
                mode: str = "overwrite") -> None:
    """Write a stage result (e.g. long features partitioned by variable) to Parquet.

    Later stages read it back with pruning on the partition columns.
    """
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)
