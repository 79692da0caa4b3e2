"""Saved models: the fitted chain, the preprocessor constants and the run metadata.

The three parts of a model are written into a folder of their own, and a manifest that names it is committed last. A reader
goes by the newest manifest, so it never sees parts of two models, and a save that ends half-way changes nothing.
"""

from __future__ import annotations

import json
import logging
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from parcelry.operators.features import FittedPreprocessor
from parcelry.sources import commits

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class TrainedModel:
    """Everything scoring needs."""

    model: PipelineModel
    preprocessor: FittedPreprocessor
    metadata: dict


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    spark.createDataFrame([(text,)], "value string").write.mode("overwrite").text(path)


def _read_text(spark: SparkSession, path: str) -> str | None:
    try:
        return spark.read.option("wholetext", "true").text(path).first()["value"]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def save_model(spark: SparkSession, trained: TrainedModel, path: str) -> str:
    """Save as the next version below path; earlier versions stay."""
    folder = commits.new_folder(path, "artifact")
    trained.model.save(f"{folder}/model")
    _write_text(spark, f"{folder}/preprocessor", trained.preprocessor.to_json())
    _write_text(spark, f"{folder}/metadata", json.dumps(trained.metadata))
    commits.append(spark, path, lambda number, before: {"data": folder[len(path) + 1 :]})
    return path


def load_model(spark: SparkSession, path: str, version: int | None = None) -> TrainedModel:
    """Load the newest saved model, or a given version. Only the metadata may be absent.

    A folder without a manifest is taken as one model's three parts themselves.
    """
    manifest = commits.latest(spark, path)[1] if version is None else commits.read(spark, path, version)
    if manifest is not None:
        path = f"{path}/{manifest['data']}"
    if _read_text(spark, f"{path}/model/metadata") is None:
        raise FileNotFoundError(f"No saved model at {path}/model; save_model writes one")
    constants = _read_text(spark, f"{path}/preprocessor")
    if constants is None:
        raise FileNotFoundError(f"No saved preprocessor at {path}/preprocessor; save_model writes one")
    metadata = _read_text(spark, f"{path}/metadata")
    if metadata is None:
        log.warning("No metadata at %s; continuing without.", path)
    return TrainedModel(
        PipelineModel.load(f"{path}/model"),
        FittedPreprocessor.from_json(constants),
        json.loads(metadata) if metadata else {},
    )
