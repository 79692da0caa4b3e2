"""Score a table with a trained model, keeping its original columns."""

from __future__ import annotations

from functools import partial

from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelry.contract import require_columns
from parcelry.operators.cleaning import fill_optional, rename_aliases
from parcelry.operators.intervals import add_interval, with_forest_bounds
from parcelry.operators.location import backfill_location, district_centroids, split_missing_location
from parcelry.operators.models import LEAF, inner_model
from parcelry.sources.models import TrainedModel

OUTPUTS = ("prediction", "lower_bound", "upper_bound")


def prepare_requests(
    df: DataFrame, centroids: DataFrame | None = None, on_missing_location: str = "impute"
) -> DataFrame:
    """Feature columns under their contract names, with optional values and positions filled.

    Rows left without a position are imputed by the model's preprocessor, or dropped here
    with on_missing_location="reject"; rejected_requests returns those.
    """
    if on_missing_location not in ("impute", "reject"):
        raise ValueError("on_missing_location must be 'impute' or 'reject'")
    placed = _placed(df, centroids)
    if on_missing_location == "reject":
        placed = split_missing_location(placed)[0]
    return fill_optional(placed)


def rejected_requests(df: DataFrame, centroids: DataFrame | None = None) -> DataFrame:
    """Rows whose position is missing even after the district backfill."""
    return split_missing_location(_placed(df, centroids))[1]


def _placed(df: DataFrame, centroids: DataFrame | None) -> DataFrame:
    return backfill_location(
        rename_aliases(df), district_centroids(df.sparkSession) if centroids is None else centroids
    )


def predict(df: DataFrame, trained: TrainedModel) -> DataFrame:
    """Add a prediction column to a table that already has the feature columns."""
    require_columns(df, trained.preprocessor.input_columns)
    return trained.model.transform(df)


def score_table(
    df: DataFrame,
    trained: TrainedModel,
    centroids: DataFrame | None = None,
    on_missing_location: str = "impute",
) -> DataFrame:
    """The original columns plus prediction, lower_bound and upper_bound.

    Map-only, but for a forest without a calibrated interval whose leaves are too many to send.
    """
    kept = [c for c in df.columns if c not in OUTPUTS]
    carried = df.select(*kept, F.struct(*kept).alias("__original"))
    scored = predict(prepare_requests(carried, centroids, on_missing_location), trained)
    inner = inner_model(trained.model)
    forest = None
    if isinstance(inner, RandomForestRegressionModel):
        transform = trained.metadata.get("target_transform", "log1p")
        forest = partial(with_forest_bounds, model=inner, leaf=LEAF, target_transform=transform)
    bounded = add_interval(scored, trained.metadata.get("prediction_interval"), forest=forest)
    return bounded.select("__original.*", *OUTPUTS)
