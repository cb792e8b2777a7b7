"""Saving and loading a trained model with everything scoring needs.

A save goes to a folder of its own. When all of it is written, one line in the
manifest beside the folders names it: this is the commit. Loading reads the
manifest first, so it never sees a save that broke off, and a reader keeps the
files of the save it opened while a newer one is written.
"""

import json
import uuid
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from barloom import config
from barloom.operators.prepare import Preprocessor, Statistics
from barloom.operators.train import Training
from barloom.sources.sinks import write_importances

METADATA = (
    "model_name string, model_version string, model_type string, save_timestamp string, "
    "params string, best_params string, cv_scores string, evaluation string, features array<string>"
)


# One line per committed save, in the order of ``number``.
MANIFEST = "number long, version string, folder string, committed_at timestamp_ntz"


@dataclass(frozen=True)
class SavedModel:
    model: PipelineModel
    preprocessor: Preprocessor
    bounds: DataFrame
    metadata: DataFrame | None
    version: str = config.MODEL_VERSION


def save_model(
    training: Training,
    preprocessor: Preprocessor,
    bounds: DataFrame,
    path: str,
    version: str = config.MODEL_VERSION,
    at: Column | None = None,
) -> str:
    """Write model, fitted statistics, category codes, clip bounds, importances and metadata
    to a new folder below ``path/saves``, then commit it as the latest save of ``version``.

    Returns the folder. Without the commit, the save before stays the latest one.
    """
    spark = bounds.sparkSession
    path = path.rstrip("/")
    name = f"{version}-{uuid.uuid4().hex}"
    folder = f"{path}/saves/{name}"
    at = F.localtimestamp() if at is None else at
    training.model.write().overwrite().save(f"{folder}/model")
    preprocessor.statistics.to_table(spark).coalesce(1).write.mode("overwrite").parquet(
        f"{folder}/statistics"
    )
    preprocessor.codes.write.mode("overwrite").parquet(f"{folder}/codes")
    bounds.write.mode("overwrite").parquet(f"{folder}/bounds")
    write_importances(training.importances, f"{folder}/feature_importance")
    cv = None
    if training.cv_scores is not None:
        cv = json.dumps([r.asDict() for r in training.cv_scores.orderBy("fold").collect()])
    row = (
        config.MODEL_NAME, version, "random_forest", None, json.dumps(training.params),
        json.dumps(training.best_params) if training.best_params else None, cv,
        json.dumps({"scale": preprocessor.scale, "summary": training.metrics}),
        preprocessor.features,
    )
    stamp = F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss")
    spark.createDataFrame([row], METADATA).withColumn("save_timestamp", stamp).coalesce(
        1
    ).write.mode("overwrite").json(f"{folder}/metadata")
    _commit(spark, path, version, name, at)
    return folder


def saves(spark: SparkSession, path: str) -> DataFrame:
    """The committed saves below ``path`` (``MANIFEST``); none if nothing was saved."""
    try:
        return spark.read.schema(MANIFEST).json(f"{path.rstrip('/')}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def _commit(spark: SparkSession, path: str, version: str, name: str, at: Column) -> None:
    number = (saves(spark, path).agg(F.max("number")).first()[0] or 0) + 1
    # A single file, which appears under its name when it is whole.
    spark.range(1).select(
        F.lit(number).cast("long").alias("number"), F.lit(version).alias("version"),
        F.lit(name).alias("folder"), at.cast("timestamp_ntz").alias("committed_at"),
    ).coalesce(1).write.mode("append").json(f"{path}/manifest")


def _latest(spark: SparkSession, path: str, version: str | None) -> tuple[str, str]:
    """Version and folder. Saves that were committed at once have one number; the name decides."""
    known = saves(spark, path)
    if version is not None:
        known = known.where(F.col("version") == version)
    last = known.orderBy(F.desc("number"), F.desc("folder")).first()
    if last is None:
        raise FileNotFoundError(f"no model in {path}" + (f" of version {version}" if version else ""))
    return last["version"], f"{path.rstrip('/')}/saves/{last['folder']}"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}")


def load_model(
    spark: SparkSession, path: str, version: str | None = config.MODEL_VERSION
) -> SavedModel:
    """The latest committed save of a version, of any version with ``None``.

    A missing model is an error, missing metadata is not.
    """
    version, folder = _latest(spark, path, version)
    statistics = Statistics.from_table(_table(spark, folder, "statistics"))
    model = PipelineModel.load(f"{folder}/model")
    scale = True
    try:
        metadata = spark.read.schema(METADATA).json(f"{folder}/metadata")
        scale = json.loads(metadata.first()["evaluation"])["scale"]
    except AnalysisException:
        metadata = None
    preprocessor = Preprocessor(
        _table(spark, folder, "codes"), statistics, list(model.stages[0].getInputCols()), scale
    )
    return SavedModel(model, preprocessor, _table(spark, folder, "bounds"), metadata, version)


def model_info(saved: SavedModel) -> DataFrame:
    """One row: name, version, type, training date, feature count, metrics."""
    if saved.metadata is None:
        raise ValueError("the model was saved without metadata")
    return saved.metadata.select(
        "model_name", "model_version", "model_type",
        F.col("save_timestamp").alias("training_date"),
        F.size("features").cast("long").alias("feature_count"),
        F.get_json_object("evaluation", "$.summary").alias("performance_metrics"),
    )
