"""Forecast evaluation: R2, MAE, MAPE, target spread, score ratio, importances."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def regression_metrics(df: DataFrame, actual: str = "actual", predicted: str = "predicted",
                       by: Sequence[str] = ()) -> DataFrame:
    """``n, r2, mae, mape, std, mae_per_std`` (per ``by`` group).

    ``r2 = 1 - SSres / SStot``; ``std`` is the sample standard deviation of
    ``actual``, and ``mae_per_std`` the error in units of it.  Fixed-point input is summed exactly
    (``SStot = sum(y^2) - sum(y)^2 / n``); floating-point input takes Spark's
    ``var_samp``, which does not cancel.  Rows whose actual value is 0 have no
    percentage error and are left out of ``mape``; ``n_zero_actual`` counts them.
    """
    y, p = F.col(actual), F.col(predicted)
    e = y - p
    n = F.count(y)
    aggs = [n.alias("n"), F.sum(e * e).alias("_sse"), F.sum(y).alias("_sy"),
            F.sum(y * y).alias("_syy"), F.sum(F.abs(e)).alias("_sae"),
            F.avg(F.try_divide(F.abs(e).cast("double"), F.abs(y).cast("double"))).alias("mape")]
    aggs += [F.var_samp(y).alias("_var"), F.count_if(y == 0).alias("n_zero_actual")]
    g = df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)
    nd = F.col("n").cast("double")
    if isinstance(df.schema[actual].dataType, (T.DoubleType, T.FloatType)):
        sstot_n = F.col("_var") * nd * (nd - 1)
    else:
        sstot_n = (F.col("n") * F.col("_syy") - F.col("_sy") * F.col("_sy")).cast("double")  # n * SStot
    r2 = F.lit(1.0) - F.try_divide(F.col("_sse").cast("double") * nd, sstot_n)
    # sample std from the same sums: sqrt((n*syy - sy^2) / (n (n-1)))
    std = F.sqrt(F.try_divide(sstot_n, nd * (nd - 1)))
    mae = F.try_divide(F.col("_sae").cast("double"), nd)
    return g.select(*by, F.col("n").cast("bigint").alias("n"), r2.alias("r2"), mae.alias("mae"), "mape",
                    std.alias("std"), F.try_divide(mae, std).alias("mae_per_std"), "n_zero_actual")


def actual_vs_predicted(actual: DataFrame, predicted: DataFrame, order: str = "datetime",
                        actual_col: str = "y_future", predicted_col: str = "prediction") -> DataFrame:
    """Actual and predicted series aligned on ``order`` (full outer join)."""
    a = actual.select(order, F.col(actual_col).alias("actual"))
    p = predicted.select(order, F.col(predicted_col).alias("predicted"))
    return a.join(p, order, "full_outer")


def importances(spark: SparkSession, model, names: Sequence[str]) -> DataFrame:
    """Feature importances of a tree model as ``feature, importance`` sorted descending."""
    vals = model.featureImportances.toArray().tolist()
    rows = list(zip(names, [float(v) for v in vals]))
    schema = T.StructType([T.StructField("feature", T.StringType()), T.StructField("importance", T.DoubleType())])
    return spark.createDataFrame(rows, schema).orderBy(F.col("importance").desc(), "feature")
