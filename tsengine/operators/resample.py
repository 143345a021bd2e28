"""Time-bucket resampling: last non-null value per series and bin.

Semantics (those of a left-closed, left-labelled ``resample(step).last()``):

* a bin is ``[start, start + step)`` labelled by its start;
* bins are anchored at midnight (UTC) of the day of the series' first tick,
  not at the epoch - the two coincide whenever ``step`` divides a day, and
  then no anchor is computed at all;
* per metric, the value of the latest tick whose value is not null
  (ties on the timestamp are broken by ``order`` columns); input order never
  matters because the pick is a ``max_by`` on ``(ts, order...)``;
* with ``dense=True`` every bin between a series' first and last bin is
  emitted, with NULL metrics where no tick fell.

Plan: one partial (map-side) aggregation keyed by ``(series, bin)``; the
dense grid is generated in chunks spread over tasks, then left-joined on the
same key, so one long series never lands in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_US = 1_000_000
_DAY_US = 86_400 * _US


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _from_micros(us: Column, like_ntz: bool) -> Column:
    t = F.timestamp_micros(us)
    return t.cast("timestamp_ntz") if like_ntz else t


def _is_ntz(df: DataFrame, ts: str) -> bool:
    return df.schema[ts].dataType.typeName() == "timestamp_ntz"


def resample_last(df: DataFrame, step_seconds: int, series: str = "coin", ts: str = "ts",
                  values: Sequence[str] | None = None, order: Sequence[str] = ("seq",),
                  dense: bool = True, anchor: str = "start_day",
                  grid_chunk: int = 4096, grid_partitions: int | None = None) -> DataFrame:
    """Resample ticks to ``step_seconds`` bins; returns ``series, bin, <values>``."""
    if step_seconds <= 0:
        raise ValueError("step_seconds must be positive")
    if anchor not in ("start_day", "epoch"):
        raise ValueError("anchor must be 'start_day' or 'epoch'")
    order = [c for c in order if c in df.columns]
    values = list(values or [c for c in df.columns if c not in (series, ts, *order)])
    step = int(step_seconds) * _US
    ntz = _is_ntz(df, ts)

    src = df.select(series, ts, *order, *values).withColumn("_us", _micros(ts))
    if anchor == "epoch" or _DAY_US % step == 0:
        src = src.withColumn("_bin", F.col("_us") - F.pmod("_us", F.lit(step)))
    else:
        # Per-series anchor: a partial aggregate (one row per series), joined back.
        first = src.groupBy(series).agg(F.min("_us").alias("_first"))
        anchors = first.select(series, (F.col("_first") - F.pmod("_first", F.lit(_DAY_US))).alias("_anchor"))
        off = F.col("_us") - F.col("_anchor")
        src = src.join(anchors, series).withColumn("_bin", F.col("_anchor") + off - F.pmod(off, F.lit(step)))

    key = F.struct(F.col(ts), *[F.col(c) for c in order])
    aggs = [F.max_by(F.col(v), F.when(F.col(v).isNotNull(), key)).alias(v) for v in values]
    binned = src.groupBy(series, "_bin").agg(*aggs)

    if dense:
        grid = dense_grid(binned, series, "_bin", step, grid_chunk, grid_partitions)
        binned = grid.join(binned, [series, "_bin"], "left")
    return binned.select(series, _from_micros(F.col("_bin"), ntz).alias("bin"), *values)


def dense_grid(binned: DataFrame, series: str, bin_us: str, step_us: int,
               chunk: int = 4096, partitions: int | None = None) -> DataFrame:
    """Every bin (epoch micros) from each series' first to last bin.

    The range is cut into chunks of ``chunk`` bins; chunk rows are spread over
    ``partitions`` tasks before the bins are generated, so generation work is
    parallel even for one very long series.
    """
    rng = binned.groupBy(series).agg(F.min(bin_us).alias("_lo"), F.max(bin_us).alias("_hi"))
    n_chunks = F.floor((F.col("_hi") - F.col("_lo")) / F.lit(step_us * chunk)).cast("bigint")
    chunks = rng.select(series, "_lo", "_hi", F.explode(F.sequence(F.lit(0).cast("bigint"), n_chunks)).alias("_c"))
    spread = partitions or int(binned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    chunks = chunks.repartition(spread, series, "_c")
    start = F.col("_lo") + F.col("_c") * F.lit(step_us * chunk)
    stop = F.least(F.col("_hi"), start + F.lit(step_us * (chunk - 1)))
    return chunks.select(series, F.explode(F.sequence(start, stop, F.lit(step_us).cast("bigint"))).alias(bin_us))
