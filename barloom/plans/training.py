"""Raw bars to a saved model."""

from pyspark.sql import DataFrame

from barloom import config
from barloom.operators.persist import save_model
from barloom.operators.train import CV_METRICS, Training, cv_summary, train
from barloom.plans.etl import Prepared, prepare_bars
from barloom.sources.sinks import append_run, write_features, write_summary


def run_values(training: Training) -> dict[tuple[str, str], float]:
    """What the run table keeps of a training run."""
    out = {("param", k): v for k, v in training.params.items()}
    if training.cv_scores is not None:
        row = cv_summary(training.cv_scores).first()
        out |= {("cv", f"{m}_{s}"): row[f"{m}_{s}"] for m in CV_METRICS for s in ("mean", "std")}
    for part, values in training.metrics.items():
        out |= {(part, m): v for m, v in values.items()}
    # One row per feature column of the table.
    out |= {("importance", r["feature"]): r["importance"] for r in training.importances.collect()}
    return out


def train_and_save(
    raw: DataFrame,
    path: str,
    run_id: str,
    version: str = config.MODEL_VERSION,
    prepare_options: dict | None = None,
    **train_options,
) -> tuple[Prepared, Training]:
    """The whole job: data, model, evaluation; everything is written below ``path``."""
    prepared = prepare_bars(raw, **(prepare_options or {}))
    write_features(prepared.features, f"{path}/features")
    write_summary(prepared.summary, f"{path}/summary", version)
    training = train(prepared.table, prepared.preprocessor.features, **train_options)
    save_model(training, prepared.preprocessor, prepared.bounds, f"{path}/models", version)
    append_run(raw.sparkSession, f"{path}/runs", run_id, run_values(training))
    return prepared, training
