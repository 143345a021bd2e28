"""Market-chart payloads: landed JSON documents -> typed tick rows.

A payload is one JSON document per coin and day range holding parallel
arrays of ``[epoch_ms, value]`` pairs, one array per metric.  Instead of
calling a web service from inside a job, payloads are landed as files under
``<root>/coin=<id>/<range>.json`` and read here; one file is one task, so
ingestion scales with the number of files.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Metric arrays of a market-chart payload, and the bin rule
# (5 minutes x periods for a range of at most one day, else 1 hour x periods;
# hourly history is available for at most 89 days).
DEFAULT_METRICS = ("prices", "market_caps", "total_volumes")
INTRADAY_STEP_SECONDS = 5 * 60
HOURLY_STEP_SECONDS = 60 * 60
MAX_HOURLY_DAYS = 89

_PAIRS = T.ArrayType(T.ArrayType(T.DoubleType()))


def payload_schema(metrics: Sequence[str] = DEFAULT_METRICS) -> T.StructType:
    return T.StructType([T.StructField(m, _PAIRS) for m in metrics])


def bin_step_seconds(timeframe: float, periods: int = 1, strict: bool = True) -> int:
    """Bin width for a day range: 5 min x periods when ``timeframe <= 1``, else 1 h x periods."""
    if periods < 1:
        raise ValueError("periods must be >= 1")
    if strict and timeframe > MAX_HOURLY_DAYS:
        raise ValueError(f"hourly bins exist for at most {MAX_HOURLY_DAYS} days, got {timeframe}")
    base = INTRADAY_STEP_SECONDS if timeframe <= 1 else HOURLY_STEP_SECONDS
    return int(periods * base)


def read_market_chart(spark: SparkSession, path: str,
                      metrics: Sequence[str] = DEFAULT_METRICS, coins: Sequence[str] | None = None) -> DataFrame:
    """Read landed payload files into ``(coin, <metric> array<array<double>>)``.

    Each file holds one document.  The coin id comes from the ``coin=<id>``
    directory (partition discovery), else from the file stem.  The schema is
    declared, so no inference pass runs over the files.  ``coins`` keeps only
    those coins' files.
    """
    raw = spark.read.text(path, wholetext=True)
    if "coin" not in raw.columns:
        stem = F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.json)?$", 1)
        raw = raw.withColumn("coin", stem)
    if coins is not None:
        raw = raw.filter(F.col("coin").isin(list(coins)))
    return parse_payload(raw.select(F.col("coin").cast("string").alias("coin"), "value"), "value", metrics)


def parse_payload(df: DataFrame, json_col: str, metrics: Sequence[str] = DEFAULT_METRICS) -> DataFrame:
    """Typed parse of a payload text column (``from_json`` with a declared schema).

    A document that is NULL, malformed, or lacks a metric array (an error
    object, say) raises with its first characters: it must not vanish.
    """
    text = F.col(json_col)
    doc = F.from_json(text, payload_schema(metrics))
    keep = [c for c in df.columns if c != json_col]
    bad = F.concat(F.lit("not a market-chart document: "), F.coalesce(F.substring(text, 1, 80), F.lit("NULL")))

    def present(m):
        # inside each array's expression, so that pruning columns cannot remove the check
        return F.coalesce(F.col("_doc")[m], F.raise_error(bad).cast(_PAIRS)).alias(m)

    return df.select(*keep, text, doc.alias("_doc")).select(*keep, *[present(m) for m in metrics])


def payload_to_ticks(payload: DataFrame, metrics: Sequence[str] = DEFAULT_METRICS,
                     coin: str = "coin", time_from: str = "prices") -> DataFrame:
    """Line up parallel metric arrays by position and type each tick.

    * arrays are zipped **by position**, not by their own timestamps; unequal
      lengths raise (a silent NULL pad would shift values between ticks);
    * the timestamp is element 0 of the ``time_from`` pair, as epoch ms (UTC);
    * every metric keeps element 1 of its pair.

    Returns ``coin, ts TIMESTAMP_NTZ (UTC wall clock), seq BIGINT, <metrics> DOUBLE``.
    """
    n0 = F.coalesce(F.size(F.col(metrics[0])), F.lit(-1))
    same = F.lit(True)
    for m in metrics[1:]:
        same = same & (F.coalesce(F.size(F.col(m)), F.lit(-1)) == n0)
    # The check sits inside the exploded expression so it cannot be pruned away.
    zipped_arr = F.when(same, F.arrays_zip(*metrics)).otherwise(
        F.raise_error(F.lit("payload metric arrays differ in length")))
    zipped = payload.select(coin, F.posexplode(zipped_arr).alias("seq", "z"))
    ms = F.col("z")[time_from][0]
    ts = F.timestamp_millis(ms.cast("bigint")).cast("timestamp_ntz")
    return zipped.select(
        F.col(coin).alias("coin"), ts.alias("ts"), F.col("seq").cast("bigint").alias("seq"),
        *[F.col("z")[m][1].alias(m) for m in metrics])


def payload_metrics(payload: DataFrame, json_col: str = "payload", coin: str = "coin",
                    time_from: str = "prices") -> DataFrame:
    """Ticks of whatever metrics a document has: ``coin, ts, seq, metric, value``.

    The document is read as a VARIANT; each of its keys is a metric, so one that
    nobody declared needs no change of a schema.  Positions line up as in
    :func:`payload_to_ticks`: the time is element 0 of the pair of ``time_from``
    at the same position, and arrays of unequal length raise, as do NULL and
    malformed documents and keys that are no arrays of pairs.
    """
    bad = F.concat(F.lit("not a market-chart document: "), F.coalesce(F.substring(json_col, 1, 80), F.lit("NULL")))
    doc = F.coalesce(F.try_parse_json(json_col), F.raise_error(bad).cast("variant"))
    kept = payload.select(F.col(coin).alias("coin"), doc.alias("_doc"), bad.alias("_bad"))
    # an object's arrays; a document that is none has no such map
    arrays = F.try_variant_get("_doc", "$", "map<string, array<array<double>>>")
    kept = kept.select("coin", F.coalesce(arrays, F.raise_error(F.col("_bad")).cast("map<string, array<array<double>>>"))
                       .alias("_arrays"), "_bad")
    times = F.coalesce(F.col("_arrays")[time_from], F.raise_error(F.col("_bad")).cast("array<array<double>>"))
    # one row a document and metric, then one a position
    rows = kept.select("coin", times.alias("_times"), F.explode("_arrays").alias("metric", "_pairs"))
    same = F.size("_pairs") == F.size("_times")
    zipped = F.when(same, F.arrays_zip(F.col("_times").alias("t"), F.col("_pairs").alias("p"))).otherwise(
        F.raise_error(F.lit("payload metric arrays differ in length")))
    rows = rows.select("coin", "metric", F.posexplode(zipped).alias("seq", "z"))
    ts = F.timestamp_millis(F.col("z")["t"][0].cast("bigint")).cast("timestamp_ntz")
    return rows.select("coin", ts.alias("ts"), F.col("seq").cast("bigint").alias("seq"), "metric", F.col("z")["p"][1].alias("value"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Landed files as ``coin, payload`` text, one document a file."""
    raw = spark.read.text(path, wholetext=True)
    if "coin" not in raw.columns:
        raw = raw.withColumn("coin", F.regexp_extract(F.input_file_name(), r"([^/]+?)(\.json)?$", 1))
    return raw.select(F.col("coin").cast("string").alias("coin"), F.col("value").alias("payload"))


def ticks_to_payload(ticks: DataFrame, metrics: Sequence[str] = DEFAULT_METRICS,
                     coin: str = "coin", ts: str = "ts", seq: str = "seq", period: str = "day") -> DataFrame:
    """Inverse of :func:`payload_to_ticks`: one JSON document per coin and period.

    Used to land data in the provider's format.  A document covers one range
    (a UTC day by default, as a provider response does; ``period='hour'`` for
    very dense coins), so no document grows with the history.
    Returns ``coin, day TIMESTAMP (period start), payload STRING``.
    """
    ms = F.unix_millis(F.col(ts).cast("timestamp")).cast("double")
    pairs = [F.array(ms, F.col(m).cast("double")).alias(m) for m in metrics]
    order = F.struct(F.col(ts).alias("t"), F.col(seq).alias("s"))
    if period not in ("day", "hour"):
        raise ValueError("period must be 'day' or 'hour'")
    start = F.date_trunc(period, F.col(ts).cast("timestamp"))
    rows = ticks.select(coin, start.alias("day"), F.struct(order.alias("o"), *pairs).alias("r"))
    doc = rows.groupBy(coin, "day").agg(F.array_sort(F.collect_list("r")).alias("rs"))
    body = F.struct(*[F.transform("rs", _field(m)).alias(m) for m in metrics])
    return doc.select(F.col(coin).alias("coin"), "day", F.to_json(body).alias("payload"))


def _field(name: str):
    return lambda r: r[name]


def time_range(df: DataFrame, as_of, days: float, ts: str = "ts") -> DataFrame:
    """Keep ticks in ``[as_of - days, as_of]``; ``as_of`` is explicit for reproducible runs."""
    as_of = _to_ntz(as_of)
    start = as_of - dt.timedelta(days=days)
    c = F.col(ts)
    return df.filter((c >= F.lit(start)) & (c <= F.lit(as_of)))


def display_zone(col: str | Column, zone: str = "CET") -> Column:
    """Relabel a UTC instant to a zone's wall clock, for display only.

    Never group or join on the result: one autumn hour repeats.
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.from_utc_timestamp(c.cast("timestamp"), zone).cast("timestamp_ntz")


def _to_ntz(value) -> dt.datetime:
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value)
    if isinstance(value, dt.datetime) and value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return value
