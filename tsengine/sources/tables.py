"""Stand-in inputs read from the driver's parquet tables.

The tables hold no market data, so these adapters only *rename and type*
columns into the schemas the pipeline consumes; they aggregate nothing.

* ``events``   -> intraday ticks: coin = ``event_type``, ts = ``ts``,
  prices = ``value``, market_caps = ``user_id``, total_volumes = ``props.k``;
  ``event_id`` breaks ties on equal timestamps.
* ``orders``   -> daily ticks: coin = ``o_orderpriority``, ts = ``o_orderdate``,
  prices = ``o_totalprice``, market_caps = ``o_custkey``,
  total_volumes = ``o_orderkey``; ties on a date are broken by ``o_orderkey``.
* ``customer`` -> market ranking (id, market_cap).
* ``nation``   -> coin list (id, symbol, name).

Metrics are typed ``DECIMAL(18,2)``: the stand-in prices are quoted to the
cent, and fixed-point input lets every running sum downstream be exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

METRIC_TYPE = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(
        F.col("event_type").alias("coin"),
        F.col("ts"),
        F.col("event_id").alias("seq"),
        F.col("value").cast(METRIC_TYPE).alias("prices"),
        F.col("user_id").cast(METRIC_TYPE).alias("market_caps"),
        F.get_json_object("props", "$.k").cast(METRIC_TYPE).alias("total_volumes"),
    )


def orders_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderpriority").alias("coin"),
        F.col("o_orderdate").alias("ts"),
        F.col("o_orderkey").alias("seq"),
        F.col("o_totalprice").cast(METRIC_TYPE).alias("prices"),
        F.col("o_custkey").cast(METRIC_TYPE).alias("market_caps"),
        F.col("o_orderkey").cast(METRIC_TYPE).alias("total_volumes"),
    )


def customer_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_name").alias("id"), F.col("c_acctbal").alias("market_cap"))


def nation_coin_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    return n.select(F.col("n_nationkey").cast("string").alias("id"),
                    F.lower(F.substring("n_name", 1, 3)).alias("symbol"),
                    F.col("n_name").alias("name"))


def events_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market ranking for the event coins: total traded value per coin (X3 shape)."""
    e = table(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("id")).agg(F.sum("value").alias("market_cap"))
