"""Tree-model training and hyper-parameter search on time-ordered folds.

Trees are ``pyspark.ml`` gradient-boosted regressors (distributed, binned
splits).  Searches draw parameter sets with a seeded generator, evaluate each
draw on expanding-window folds (``operators.split.time_folds``; training
never sees later rows) and record a trials table
``trial, fold, params MAP<STRING,STRING>, metric``.  Every fit is a Spark job;
the driver only loops over the (bounded) number of draws and folds.

Parameter mapping from the reference's booster names:
``learning_rate -> stepSize`` (in (0, 1]), ``max_depth -> maxDepth`` (at most 30),
``subsample -> subsamplingRate``, ``colsample_bytree -> featureSubsetStrategy``
(a fraction, applied per split rather than per tree),
``min_child_weight -> minInstancesPerNode`` (rounded up to whole rows; the
trials table holds the value used), ``gamma -> minInfoGain``.  A value out of
range raises.  ``lambda``, ``alpha``, ``num_parallel_tree`` and ``grow_policy``
have no equivalent: a draw or search space that names one raises, and the default
spaces leave them out (``mapped``).

``sampled_search`` proposes draws that learn from finished trials
(``operators.parzen``).  Searches stop boosting early by default.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsengine.operators.parzen import START, draw_uniform, propose
from tsengine.operators.split import time_folds, time_split

# The reference's random-search grid and sampled-search space.
DEFAULT_GRID = {
    "num_parallel_tree": [1, 3, 5, 10, 20],
    "learning_rate": [0.01, 0.05, 0.1, 0.5, 1],
    "max_depth": [3, 6, 12, 24],
    "gamma": [0, 0.01, 0.05, 0.1, 0.5, 1],
    "min_child_weight": [0.5, 1, 3, 5],
    "subsample": [0.5, 0.75, 1.0],
    "colsample_bytree": [0.5, 0.75, 1.0],
    "grow_policy": ["depthwise", "lossguide"],
}
DEFAULT_SPACE = {
    "lambda": ("log", 1e-8, 100.0),
    "alpha": ("log", 1e-8, 100.0),
    "colsample_bytree": ("uniform", 0.2, 1.0),
    "max_depth": ("int", 2, 20),
    "min_child_weight": ("log", 1e-8, 100.0),
    "learning_rate": ("log", 1e-8, 1.0),
    "gamma": ("log", 1e-8, 1.0),
}
EVAL_METRICS = ("mae", "rmse", "mape")
PATIENCE = 25   # rounds without a gain before boosting stops
VALIDATION = 0.2   # tail of the training rows that boosting is stopped by
UNMAPPED = ("lambda", "alpha", "num_parallel_tree", "grow_policy")

TRIALS_SCHEMA = T.StructType([
    T.StructField("trial", T.IntegerType()), T.StructField("fold", T.IntegerType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metric", T.DoubleType())])


def mapped(space: dict) -> dict:
    """``space`` without the parameters that have no equivalent here."""
    return {k: v for k, v in space.items() if k not in UNMAPPED}


def refuse_unmapped(params: dict) -> None:
    refused = sorted(set(params) & set(UNMAPPED))
    if refused:
        raise ValueError(f"no equivalent in GBTRegressor: {refused}")


def gbt_params(params: dict, max_iter: int = 100) -> dict:
    """Booster parameter names -> ``GBTRegressor`` keyword arguments."""
    refuse_unmapped(params)
    out = {"maxIter": int(max_iter)}
    if "learning_rate" in params:
        out["stepSize"] = float(params["learning_rate"])
        if not 0.0 < out["stepSize"] <= 1.0:
            raise ValueError(f"learning_rate must be in (0, 1]: {params['learning_rate']}")
    if "max_depth" in params:
        out["maxDepth"] = int(params["max_depth"])
        if not 0 <= out["maxDepth"] <= 30:
            raise ValueError(f"max_depth must be in 0..30: {params['max_depth']}")
    if "subsample" in params:
        out["subsamplingRate"] = float(params["subsample"])
    if "colsample_bytree" in params:
        frac = float(params["colsample_bytree"])
        out["featureSubsetStrategy"] = "all" if frac >= 1.0 else repr(frac)
    if "min_child_weight" in params:
        out["minInstancesPerNode"] = max(1, int(math.ceil(float(params["min_child_weight"]))))
    if "gamma" in params:
        out["minInfoGain"] = float(params["gamma"])
    return out


def effective_params(params: dict) -> dict[str, str]:
    """The draw as recorded: values as used, whole rows for ``min_child_weight``."""
    used = {k: str(v) for k, v in params.items()}
    if "min_child_weight" in params:
        used["min_child_weight"] = str(gbt_params(params)["minInstancesPerNode"])
    return used


def assemble(df: DataFrame, features: Sequence[str], out: str = "features") -> DataFrame:
    """Fixed-order feature vector; invalid values raise (impute first)."""
    return VectorAssembler(inputCols=list(features), outputCol=out, handleInvalid="error").transform(df)


def fit_gbt(train: DataFrame, params: dict, label: str = "y_future", features_col: str = "features",
            max_iter: int = 100, seed: int = 7, validation_fraction: float | None = None,
            order: str = "datetime", patience: int = PATIENCE):
    """Fit a boosted-tree regressor.

    With ``validation_fraction`` the last rows of ``train`` (by ``order``) are a
    validation set: boosting keeps the rounds up to the lowest absolute error
    on it that no later one of the next ``patience`` rounds improves.  The
    same seed grows the same trees, so the shorter model is a second fit.
    """
    def fit(data, rounds):
        return GBTRegressor(featuresCol=features_col, labelCol=label, seed=seed,
                            **gbt_params(params, rounds)).fit(data)

    if not validation_fraction:
        return fit(train, max_iter)
    parts = time_split(train, order, validation_fraction)
    head = parts.filter(F.col("split") == "train")
    model = fit(head, max_iter)
    rounds = stop_round(model.evaluateEachIteration(parts.filter(F.col("split") == "test"), "absolute"), patience)
    return model if rounds == max_iter else fit(head, rounds)


def stop_round(errors: Sequence[float], patience: int = PATIENCE) -> int:
    """Rounds to keep: up to the best error before ``patience`` rounds without a gain."""
    best = 0
    for i, e in enumerate(errors):
        if e < errors[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def predict(model, df: DataFrame, order: str = "datetime", label: str = "y_future") -> DataFrame:
    """``datetime, actual, predicted`` for the rows of ``df``."""
    return model.transform(df).select(order, F.col(label).alias("actual"), F.col("prediction").alias("predicted"))


def evaluation(pred: DataFrame, eval_metric: str = "mae") -> float:
    """``mae``, ``rmse`` or ``mape`` of ``actual, predicted`` (``mape`` leaves out rows whose actual value is 0)."""
    error = F.abs(F.col("actual") - F.col("predicted")).cast("double")
    value = {"mae": F.avg(error), "rmse": F.sqrt(F.avg(error * error)),
             "mape": F.avg(F.try_divide(error, F.abs(F.col("actual")).cast("double")))}[check_metric(eval_metric)]
    out = pred.agg(value).first()[0]
    if out is None:
        raise ValueError(f"no row to evaluate {eval_metric} on")
    return float(out)


def check_metric(name: str) -> str:
    if name not in EVAL_METRICS:
        raise ValueError(f"eval_metric must be one of {EVAL_METRICS}: {name!r}")
    return name


def _draw_grid(grid: dict, n_iter: int, seed: int) -> list[dict]:
    keys = sorted(grid)
    sizes = [len(grid[k]) for k in keys]
    total = math.prod(sizes)
    rng = random.Random(seed)
    picks = rng.sample(range(total), min(n_iter, total))
    out = []
    for code in picks:
        d = {}
        for k, s in zip(keys, sizes):
            code, i = divmod(code, s)
            d[k] = grid[k][i]
        out.append(d)
    return out


class _Trials:
    """Runs draws on time-ordered folds; one row a draw and fold."""

    def __init__(self, matrix: DataFrame, n_splits: int, label: str, order: str, max_iter: int, parallelism: int,
                 objective: str, validation_fraction: float | None, eval_metric: str):
        self.n_splits, self.label, self.order, self.max_iter = n_splits, label, order, max_iter
        self.parallelism, self.objective = max(1, parallelism), objective
        self.validation_fraction, self.eval_metric = validation_fraction, check_metric(eval_metric)
        self.folds = time_folds(matrix.select(order, label, "features"), order, n_splits).persist()
        self.rows: list[tuple] = []
        self.draws: list[dict] = []

    def _run(self, job):
        t, f = job
        fold = self.folds.filter(F.col("fold") == f)
        train = fold.filter(F.col("role") == "train")
        model = fit_gbt(train, self.draws[t], self.label, max_iter=self.max_iter,
                        validation_fraction=self.validation_fraction, order=self.order)
        scored = train if self.objective == "train" else fold.filter(F.col("role") == "test")
        return (t, f, effective_params(self.draws[t]),
                -evaluation(predict(model, scored, self.order, self.label), self.eval_metric))

    def run(self, draws: list[dict]) -> None:
        for d in draws:      # an impossible draw raises before the first fit
            gbt_params(d, self.max_iter)
        first = len(self.draws)
        self.draws += draws
        jobs = [(t, f) for t in range(first, len(self.draws)) for f in range(self.n_splits)]
        with ThreadPoolExecutor(max_workers=self.parallelism) as pool:
            self.rows += list(pool.map(self._run, jobs))

    def finished(self) -> list[tuple[dict, float]]:
        """Every draw with its mean score over the folds."""
        scores: dict[int, list[float]] = {}
        for t, _, _, score in self.rows:
            scores.setdefault(t, []).append(score)
        return [(self.draws[t], sum(x) / len(x)) for t, x in sorted(scores.items())]


def _search(spark, matrix, features, next_draws, n_splits, label, order, max_iter, parallelism, objective,
            validation_fraction, eval_metric):
    """``next_draws(finished)`` gives the next draws to run, none at the end."""
    data = assemble(matrix, features).persist()
    try:
        trials = _Trials(data, n_splits, label, order, max_iter, parallelism, objective, validation_fraction, eval_metric)
        try:
            while draws := next_draws(trials.finished()):
                trials.run(draws)
        finally:
            trials.folds.unpersist()
        table = spark.createDataFrame(trials.rows, TRIALS_SCHEMA)
        params = trials.draws[best_trial(table).first()["trial"]]
        return table, params, fit_gbt(data, params, label, max_iter=max_iter, validation_fraction=validation_fraction,
                                      order=order)
    finally:
        data.unpersist()


def best_trial(trials: DataFrame) -> DataFrame:
    """``trial, params, score`` of the draw with the best mean fold score (larger is better)."""
    per = trials.groupBy("trial").agg(F.avg("metric").alias("score"), F.first("params").alias("params"))
    return per.orderBy(F.col("score").desc(), "trial").limit(1)


def random_search(spark: SparkSession, matrix: DataFrame, features: Sequence[str], grid: dict | None = None,
                  n_iter: int = 20, n_splits: int = 5, label: str = "y_future", order: str = "datetime",
                  max_iter: int = 100, seed: int = 42, parallelism: int = 4,
                  validation_fraction: float | None = VALIDATION, eval_metric: str = "mae"):
    """Random draws without replacement from ``grid``; returns ``(trials, best_params, refit_model)``.

    The score is the negative ``eval_metric`` on each fold's test rows;
    boosting stops early on the last ``validation_fraction`` of each training
    part (never on the fold's test rows); None turns that off.
    """
    draws = _draw_grid(grid or mapped(DEFAULT_GRID), n_iter, seed)
    return _search(spark, matrix, features, lambda finished: [] if finished else draws, n_splits, label, order,
                   max_iter, parallelism, "validation", validation_fraction, eval_metric)


def sampled_search(spark: SparkSession, matrix: DataFrame, features: Sequence[str], space: dict | None = None,
                   n_trials: int = 50, n_splits: int = 5, label: str = "y_future", order: str = "datetime",
                   max_iter: int = 100, seed: int = 42, parallelism: int = 4, objective: str = "validation",
                   validation_fraction: float | None = VALIDATION, eval_metric: str = "mae", sampler: str = "parzen",
                   start: int = START, at_once: int = 1):
    """Log-uniform / uniform / integer draws from ``space``; same outputs as :func:`random_search`.

    ``sampler='parzen'``: after ``start`` independent draws, each draw is proposed
    from the scores of all finished trials; ``at_once`` draws are proposed and
    run together (more are faster and learn later).  ``'independent'`` never
    looks at scores.  The same seed and ``at_once`` propose the same draws for
    the same scores.

    ``objective='train'`` scores each draw on its own training rows (the
    reference's objective: the last training metric); ``'validation'`` (default)
    scores it on the fold's later test rows.
    """
    if objective not in ("train", "validation"):
        raise ValueError("objective must be 'train' or 'validation'")
    if sampler not in ("parzen", "independent"):
        raise ValueError("sampler must be 'parzen' or 'independent'")
    if at_once < 1:
        raise ValueError("at_once must be at least 1")
    space = mapped(DEFAULT_SPACE) if space is None else space
    refuse_unmapped(space)
    rng = random.Random(seed)

    def next_draws(finished):
        left = n_trials - len(finished)
        if len(finished) < start or sampler == "independent":
            many = left if sampler == "independent" else min(left, start - len(finished))
            return [draw_uniform(space, rng) for _ in range(many)]
        return [propose(space, finished, rng, start) for _ in range(min(left, at_once))]

    return _search(spark, matrix, features, next_draws, n_splits, label,
                   order, max_iter, parallelism, objective, validation_fraction, eval_metric)
