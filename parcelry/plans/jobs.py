"""The four jobs: drift-gated refresh, candidate training, promotion and batch scoring."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelry.contract import SNAPSHOT_DATE, TARGET, TrainingOptions
from parcelry.functions.columns import nan_to_null
from parcelry.operators.cleaning import clean, remove_outliers, select_training_columns
from parcelry.operators.drift import BINS, MODERATE, drift_verdict, take_snapshot
from parcelry.operators.features import Preprocessor
from parcelry.operators.intervals import evaluate_and_calibrate
from parcelry.operators.models import fit_model, inner_model
from parcelry.operators.scoring import score_table
from parcelry.operators.splitting import exact_split, with_split_hash
from parcelry.operators.versions import (
    IMPROVEMENT,
    METRIC,
    PRODUCTION,
    production_metric,
    promote_versions,
    promotion_gate,
    register_versions,
    run_metric,
)
from parcelry.sources.commits import update_table
from parcelry.sources.models import TrainedModel
from parcelry.sources.snapshots import load_snapshot, save_snapshot
from parcelry.session import held, new_shared_path, use_checkpoints
from parcelry.sources.tables import scan_priced, store_extract, write_csv


def refresh_job(
    spark: SparkSession,
    properties: DataFrame,
    snapshot_path: str,
    extract_path: str | None = None,
    extract_format: str = "csv",
    threshold: float = MODERATE,
    bins: int = BINS,
) -> DataFrame:
    """Extract priced rows, compare them with the stored snapshot and return the verdict row.

    With an extract path the rows are written there and read back, so that all passes see the
    same rows even if the source moves on.

    The snapshot is replaced when the verdict asks for retraining, and written when there was
    none. Failures surface; they never read as "no drift".
    """
    priced = scan_priced(properties)
    if extract_path:
        priced = store_extract(priced, extract_path, extract_format)
    snapshot = load_snapshot(spark, snapshot_path)
    needed = [c for c in (TARGET, SNAPSHOT_DATE) if c in priced.columns]
    with held(priced.select(*needed)) as prices:
        verdict = drift_verdict(prices, snapshot, threshold)
        row = verdict.first()
        if snapshot is None or row["should_retrain"]:
            save_snapshot(spark, snapshot_path, take_snapshot(prices, bins))
    return spark.createDataFrame([row], verdict.schema)


@dataclass(frozen=True)
class TrainingResult:
    trained: TrainedModel
    metrics: dict
    run_id: str


def training_rows(properties: DataFrame, options: TrainingOptions) -> DataFrame:
    """Cleaned feature and target rows with the split key, as one lazy plan."""
    cleaned = clean(properties, options, keep=[options.split_key])
    bounded = remove_outliers(cleaned, options)
    return nan_to_null(select_training_columns(bounded, options.target, [options.split_key]))


def train_job(spark: SparkSession, properties: DataFrame, options: TrainingOptions = TrainingOptions()) -> TrainingResult:
    """Clean, split, fit, evaluate and calibrate one candidate model.

    The cleaned rows are written once to the shared folder: every pass reads single columns of them, and
    a lost executor does not bring the deduplication back.
    """
    cleaned = training_rows(scan_priced(properties, options.target), options)
    rows = store_extract(with_split_hash(cleaned, options.split_key, options.seed), new_shared_path(spark, "training"))
    train, test = exact_split(rows, options.split_key, options.test_size, options.seed)
    preprocessor = Preprocessor().fit(train, hold=False)
    model = fit_model(
        spark, train, preprocessor, options.target, options.model_type,
        options.hyperparameters, options.seed, options.target_transform,
    )
    outcome = model.transform(test).select(F.col(options.target).alias("actual"), "prediction")
    with held(outcome) as scored:
        metrics, interval = evaluate_and_calibrate(scored, "actual", "prediction")
    test_size = interval["calibration_size"]
    metadata = {
        "model_type": type(inner_model(model)).__name__,
        "model_key": options.model_type,
        "target_transform": options.target_transform,
        "hyperparameters": dict(options.hyperparameters),
        "test_metrics": metrics,
        "val_metrics": None,
        "feature_names": preprocessor.feature_names,
        "prediction_interval": interval,
        "train_size": rows.count() - test_size,
        "val_size": 0,
        "test_size": test_size,
    }
    return TrainingResult(TrainedModel(model, preprocessor, metadata), metrics, uuid.uuid4().hex)


def run_metrics(spark: SparkSession, result: TrainingResult) -> DataFrame:
    """model_runs rows of a training run, written together with the run so that the gate
    always finds its metric.
    """
    rows = [(result.run_id, f"test_{name}", float(value)) for name, value in result.metrics.items() if value is not None]
    return spark.createDataFrame(rows, "run_id string, metric_name string, metric_value double")


def promote_job(
    versions: DataFrame,
    runs: DataFrame,
    candidates: DataFrame,
    stage: str = PRODUCTION,
    metric_name: str = METRIC,
    threshold: float = IMPROVEMENT,
) -> tuple[DataFrame, DataFrame]:
    """Gate candidates (model_name, run_id[, position]), register and promote those that pass.

    Candidates of one model go one after another, each against the production just set; the last that
    passes ends in the stage. Returns the verdicts and the version table to store next; promote_in_store
    commits it. The verdicts and the new versions, a row per candidate each,
    are checkpointed, since several steps read them.
    """
    metric = run_metric(runs, metric_name).withColumnRenamed("metric_value", "candidate_metric")
    measured = candidates.join(metric, "run_id", "left")
    use_checkpoints(versions.sparkSession)
    gated = promotion_gate(measured, production_metric(versions, runs, metric_name), threshold).checkpoint()
    registered = register_versions(versions, gated, stage).checkpoint()
    grown = versions.select("model_name", "version", "run_id", "stage").unionByName(registered)
    last = registered.groupBy("model_name").agg(F.max("version").alias("version"))
    after = promote_versions(grown, last, stage, on_missing="keep")
    verdicts = gated.join(registered.select("model_name", "run_id", "version"), ["model_name", "run_id"], "left")
    return verdicts, after


def promote_in_store(
    spark: SparkSession,
    path: str,
    runs: DataFrame,
    candidates: DataFrame,
    stage: str = PRODUCTION,
    metric_name: str = METRIC,
    threshold: float = IMPROVEMENT,
) -> tuple[DataFrame, int]:
    """promote_job on a stored version table: gate, register and promote as one commit. Returns the verdicts and its number.

    Where another writer commits first, the candidates are gated anew against the table it has left. A store without a
    version starts from an empty table.
    """
    verdicts = []

    def change(versions: DataFrame | None) -> DataFrame:
        if versions is None:
            versions = spark.createDataFrame([], "model_name string, version bigint, run_id string, stage string")
        found, after = promote_job(versions, runs, candidates, stage, metric_name, threshold)
        verdicts[:] = [found]
        return after

    number = update_table(spark, path, change)
    return verdicts[0], number


def score_job(
    requests: DataFrame,
    trained: TrainedModel,
    output_path: str,
    centroids: DataFrame | None = None,
    on_missing_location: str = "impute",
) -> str:
    """Score a whole table and write it as CSV."""
    return write_csv(score_table(requests, trained, centroids, on_missing_location), output_path)
