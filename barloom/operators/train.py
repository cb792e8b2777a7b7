"""Training, time-ordered cross-validation and grid search."""

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from itertools import product

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import config
from barloom.operators.evaluate import METRICS, metrics
from barloom.operators.series import POS, SERIES
from barloom.operators.split import fold_part, with_folds
from barloom.session import stored

MODEL_TYPES = ("random_forest",)
CV_METRICS = ("mse", "rmse", "mae", "r2")
VECTOR = "_features"
LEAST = {"numTrees": 1, "maxDepth": 0, "minInstancesPerNode": 1, "maxBins": 2}


def make_model(
    features: Sequence[str],
    target: str = "Close",
    model_type: str = "random_forest",
    seed: int = config.SEED,
    **params,
) -> Pipeline:
    """An unfitted model. ``params`` are forest parameters by their Spark name.

    Every split may look at all features (regression forests do), which makes
    the trees differ by their bootstrap samples only. A tree of depth 0 is the
    mean of its rows; there must be a tree, and no depth is below 0.
    """
    if model_type not in MODEL_TYPES:
        raise ValueError(f"unsupported model type: {model_type}")
    settings = {
        "numTrees": config.N_TREES, "maxDepth": config.MAX_DEPTH,
        "minInstancesPerNode": config.MIN_LEAF, "maxBins": 256,
        "featureSubsetStrategy": "all",
    } | params
    for name, least in LEAST.items():
        if settings[name] < least:
            raise ValueError(f"{name} must be at least {least}, got {settings[name]}")
    return Pipeline(stages=[
        VectorAssembler(inputCols=list(features), outputCol=VECTOR),
        RandomForestRegressor(
            featuresCol=VECTOR, labelCol=target, predictionCol="prediction", seed=seed, **settings
        ),
    ])


def fit(df: DataFrame, features: Sequence[str], target: str = "Close", **params) -> PipelineModel:
    rows = df.where(F.col(target).isNotNull())
    return make_model(features, target, **params).fit(rows)


def predict(model: PipelineModel | None, df: DataFrame) -> DataFrame:
    if model is None:
        raise ValueError("the model must be trained before making predictions")
    return model.transform(df).drop(VECTOR)


def importances(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, importance), highest first: a row per feature column."""
    names = model.stages[0].getInputCols()
    values = model.stages[-1].featureImportances.toArray()
    table = spark.createDataFrame(
        [(n, float(v)) for n, v in zip(names, values)], "feature string, importance double"
    )
    return table.orderBy(F.desc("importance"), "feature")


def _marked(df: DataFrame, features: Sequence[str], target: str, n_folds: int) -> DataFrame:
    """What the fits of all folds and parameters read: the needed columns, stored once,
    with the folds as bits. Every fit is a scan with a filter."""
    columns = list(dict.fromkeys([SERIES, POS, *features, target]))
    return stored(with_folds(df.select(*columns), n_folds), "folds")


def _fold_scores(marked, fold, features, target, params) -> tuple:
    model = fit(fold_part(marked, fold, "train"), features, target, **params)
    scored = predict(model, fold_part(marked, fold, "test")).withColumn("fold", F.lit(fold))
    row = metrics(scored, by=("fold",), actual=target).first()
    return (fold, *(row[m] for m in CV_METRICS))


def cross_validate(
    df: DataFrame,
    features: Sequence[str],
    target: str = "Close",
    n_folds: int = config.N_FOLDS,
    parallel: int = 2,
    **params,
) -> DataFrame:
    """MSE, RMSE, MAE and R2 of each expanding-window fold: one fit per fold.

    ``df`` holds the training part with its positions.
    """
    marked = _marked(df, features, target, n_folds)
    with ThreadPoolExecutor(parallel) as pool:
        scores = list(pool.map(
            lambda i: _fold_scores(marked, i, features, target, params), range(n_folds)
        ))
    columns = ", ".join(f"{m} double" for m in CV_METRICS)
    return df.sparkSession.createDataFrame(scores, f"fold int, {columns}")


def cv_summary(scores: DataFrame) -> DataFrame:
    """Mean and population standard deviation of each metric over the folds."""
    return scores.agg(
        *[F.avg(m).alias(f"{m}_mean") for m in CV_METRICS],
        *[F.stddev_pop(m).alias(f"{m}_std") for m in CV_METRICS],
    )


def grid_search(
    df: DataFrame,
    features: Sequence[str],
    target: str = "Close",
    grid: dict[str, list] = config.GRID,
    n_folds: int = config.N_FOLDS,
    parallel: int = 2,
) -> DataFrame:
    """Mean MSE over the folds for each parameter combination, best first."""
    names = list(grid)
    combos = [dict(zip(names, values)) for values in product(*grid.values())]
    jobs = [(c, i) for c in range(len(combos)) for i in range(n_folds)]
    marked = _marked(df, features, target, n_folds)
    with ThreadPoolExecutor(parallel) as pool:
        scores = list(pool.map(
            lambda job: (job[0], _fold_scores(marked, job[1], features, target, combos[job[0]])),
            jobs,
        ))
    rows = []
    for c, combo in enumerate(combos):
        mse = [s[1] for k, s in scores if k == c]
        rows.append((*[int(combo[n]) for n in names], sum(mse) / len(mse)))
    columns = ", ".join(f"{n} int" for n in names)
    table = df.sparkSession.createDataFrame(rows, f"{columns}, mse_mean double")
    return table.orderBy("mse_mean", *names)


@dataclass
class Training:
    """Result of a training run."""

    model: PipelineModel
    features: list[str]
    params: dict
    importances: DataFrame
    cv_scores: DataFrame | None = None
    best_params: dict | None = None
    metrics: dict[str, dict[str, float]] = field(default_factory=dict)


def train(
    df: DataFrame,
    features: Sequence[str],
    target: str = "Close",
    perform_cv: bool = True,
    perform_grid_search: bool = False,
    grid: dict[str, list] = config.GRID,
    n_folds: int = config.N_FOLDS,
    parallel: int = 2,
    **params,
) -> Training:
    """Optional grid search, optional cross-validation, final fit, importances,
    and the metrics of every part. ``df`` is a stored, prepared table with
    ``split``; all fitting happens on its training rows."""
    spark = df.sparkSession
    rows = df.where("split = 'train'")
    best = None
    if perform_grid_search:
        top = grid_search(rows, features, target, grid, n_folds, parallel).first()
        best = {n: top[n] for n in grid}
        params = params | best
    scores = None
    if perform_cv:
        scores = cross_validate(rows, features, target, n_folds, parallel, **params)
    model = fit(rows, features, target, **params)
    found = metrics(predict(model, df), by=("split",), actual=target).collect()
    return Training(
        model=model, features=list(features), params=params,
        importances=importances(spark, model), cv_scores=scores, best_params=best,
        metrics={r["split"]: {m: r[m] for m in METRICS} for r in found},
    )
