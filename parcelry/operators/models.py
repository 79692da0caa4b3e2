"""Regression models: estimators by name, target transform, fitting and prediction."""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.ml.regression import GBTRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelry.operators.features import ASSEMBLED, FittedPreprocessor
from parcelry.operators.leafwise import LeafwiseOptions, fit_leafwise
from parcelry.session import use_checkpoints

log = logging.getLogger(__name__)

LABEL, RAW, LEAF = "__label", "__raw_prediction", "__leaf"

#: Spark's own limit, which stands for "unlimited".
DEEPEST = 30
#: Columns up to which ridge is solved by its normal equation; Spark's own limit.
NORMAL_COLUMNS = 4096
#: Candidate splits of a numeric feature for the families that would try every value.
BINS = 256

# Accepted model names and the family each one means.
MODEL_TYPES = {
    "gradient_boosting": "gradient_boosting",
    "GradientBoostingRegressor": "gradient_boosting",
    "hist_gradient_boosting": "hist_gradient_boosting",
    "HistGradientBoostingRegressor": "hist_gradient_boosting",
    "random_forest": "random_forest",
    "RandomForestRegressor": "random_forest",
    "ridge": "ridge",
    "Ridge": "ridge",
}

# Hyperparameters each family accepts, under Spark's names, and their defaults.
PARAMETERS = {
    "hist_gradient_boosting": {
        "learning_rate": "stepSize",
        "max_iter": "maxIter",
        "min_samples_leaf": "minInstancesPerNode",
        "max_depth": "maxDepth",
        "max_bins": "maxBins",
        "max_leaf_nodes": "maxLeafNodes",
        "l2_regularization": "l2",
        "early_stopping": "earlyStopping",
        "validation_fraction": "validationFraction",
        "n_iter_no_change": "noChange",
        "tol": "tol",
    },
    "gradient_boosting": {
        "learning_rate": "stepSize",
        "n_estimators": "maxIter",
        "min_samples_leaf": "minInstancesPerNode",
        "max_depth": "maxDepth",
        "subsample": "subsamplingRate",
        "max_features": "featureSubsetStrategy",
        "min_impurity_decrease": "minInfoGain",
    },
    "random_forest": {
        "n_estimators": "numTrees",
        "min_samples_leaf": "minInstancesPerNode",
        "max_depth": "maxDepth",
        "bootstrap": "bootstrap",
        "max_features": "featureSubsetStrategy",
        "min_impurity_decrease": "minInfoGain",
        "max_samples": "subsamplingRate",
    },
    "ridge": {"alpha": "alpha", "fit_intercept": "fitIntercept", "max_iter": "maxIter", "tol": "tol"},
}
DEFAULTS = {
    "hist_gradient_boosting": {
        "stepSize": 0.1, "maxIter": 100, "minInstancesPerNode": 20, "maxDepth": None, "maxBins": 255, "maxLeafNodes": 31,
    },
    "gradient_boosting": {"stepSize": 0.1, "maxIter": 100, "minInstancesPerNode": 1, "maxDepth": 3, "maxBins": BINS},
    "random_forest": {"numTrees": 100, "minInstancesPerNode": 1, "maxDepth": DEEPEST, "maxBins": BINS, "featureSubsetStrategy": "all"},
    "ridge": {"alpha": 1.0},
}
#: What the options of leaf-wise boosting are called among the parameters.
_LEAFWISE = {
    "stepSize": "learning_rate",
    "maxIter": "max_iter",
    "minInstancesPerNode": "min_samples_leaf",
    "maxDepth": "max_depth",
    "maxBins": "max_bins",
    "maxLeafNodes": "max_leaf_nodes",
    "l2": "l2_regularization",
    "earlyStopping": "early_stopping",
    "validationFraction": "validation_fraction",
    "noChange": "n_iter_no_change",
    "tol": "tol",
    "seed": "seed",
}
_CLASSES = {
    "gradient_boosting": GBTRegressor,
    "random_forest": RandomForestRegressor,
    "ridge": LinearRegression,
}


def model_family(model_type: str) -> str:
    if model_type not in MODEL_TYPES:
        raise ValueError(f"model_type '{model_type}' is unknown; choose one of {sorted(MODEL_TYPES)}")
    return MODEL_TYPES[model_type]


def _spark_value(name: str, value):
    """A hyperparameter's value as its Spark parameter takes it."""
    if name == "max_features":
        return "all" if value == 1.0 and isinstance(value, float) else str(value)
    if name == "max_samples":
        return float(value)
    return value


def model_parameters(model_type: str, hyperparameters: Mapping | None, seed: int) -> dict:
    """Spark parameters for the accepted hyperparameters; the others are logged as warnings and left out.

    An unlimited depth, an explicit None or a forest's default, becomes Spark's limit of 30, which is logged; histogram
    boosting grows leaf by leaf up to max_leaf_nodes, 31 by default and unlimited if None, at any depth.
    """
    family = model_family(model_type)
    accepted = PARAMETERS[family]
    given = dict(hyperparameters or {})
    if given.get("max_samples") is not None and not 0 < given["max_samples"] <= 1:
        log.warning("max_samples is a share of the rows here; %s is left out", given.pop("max_samples"))
    ignored = sorted(k for k, v in given.items() if k not in accepted and v is not None)
    if ignored:
        log.warning("%s has no counterpart for these hyperparameters, left out: %s", model_type, ignored)
    chosen = {**DEFAULTS[family]}
    if family in ("gradient_boosting", "random_forest") and "max_depth" in given and given["max_depth"] is None:
        chosen["maxDepth"] = DEEPEST
    if "max_leaf_nodes" in accepted and "max_leaf_nodes" in given:
        chosen["maxLeafNodes"] = given["max_leaf_nodes"]
    chosen.update((accepted[k], _spark_value(k, v)) for k, v in given.items() if k in accepted and v is not None)
    if chosen.get("maxDepth") == DEEPEST:
        log.warning("%s is unlimited in depth; trees stop at Spark's limit of %d", model_type, DEEPEST)
    if family != "ridge":
        chosen["seed"] = seed
    return chosen


def make_estimator(
    model_type: str, hyperparameters: Mapping | None, seed: int, labelled: DataFrame | None = None
):
    """Unfitted Spark estimator. Histogram boosting has none of Spark's; leafwise_options are what it is fitted with.

    Ridge needs the labelled rows: Spark scales its penalty by the label deviation and the
    row count, so those two turn alpha into the matching regParam. Up to NORMAL_COLUMNS columns it is solved by the normal
    equation, beyond by L-BFGS with the same penalty, whose passes add up one vector a task; neither penalises the
    intercept, and both end at the same coefficients.
    """
    family = model_family(model_type)
    if family == "hist_gradient_boosting":
        raise ValueError("histogram boosting is fitted by fit_model")
    chosen = model_parameters(model_type, hyperparameters, seed)
    shared = {"featuresCol": ASSEMBLED, "labelCol": LABEL, "predictionCol": RAW}
    if family == "ridge":
        alpha = float(chosen.pop("alpha"))
        wide = labelled.schema[ASSEMBLED].metadata["ml_attr"]["num_attrs"] > NORMAL_COLUMNS
        # the normal equation scales the penalty by the deviation over n, L-BFGS by that over n - 1
        spread = F.stddev_samp(LABEL) if wide else F.stddev_pop(LABEL)
        size = labelled.agg(spread.alias("spread"), F.count(LABEL).alias("rows")).first()
        penalty = alpha * (size["spread"] or 0.0) / size["rows"]
        solver = {"solver": "l-bfgs", "tol": 1e-12, "maxIter": 1000, **chosen} if wide else {"solver": "normal", **chosen}
        return LinearRegression(regParam=penalty, elasticNetParam=0.0, standardization=False, **shared, **solver)
    if family == "random_forest":
        shared["leafCol"] = LEAF
    return _CLASSES[family](**shared, **chosen)


def leafwise_options(hyperparameters: Mapping | None, seed: int) -> LeafwiseOptions:
    chosen = model_parameters("hist_gradient_boosting", hyperparameters, seed)
    return LeafwiseOptions(**{_LEAFWISE[k]: v for k, v in chosen.items()})


def transform_target(y: Column, target_transform: str) -> Column:
    return F.log1p(y) if target_transform == "log1p" else y


def invert_target(p: Column, target_transform: str) -> Column:
    return F.expm1(p) if target_transform == "log1p" else p


def fit_model(
    spark: SparkSession,
    train: DataFrame,
    preprocessor: FittedPreprocessor,
    target: str,
    model_type: str,
    hyperparameters: Mapping | None = None,
    seed: int = 42,
    target_transform: str = "log1p",
) -> PipelineModel:
    """Fit on the transformed target. The result maps raw feature columns to a prediction
    in target units and saves as one artifact.
    """
    use_checkpoints(spark)
    label = transform_target(F.col(target).cast("double"), target_transform).alias(LABEL)
    rows = train.select(*preprocessor.input_columns, label).filter(F.col(LABEL).isNotNull())
    stages = preprocessor.stages(spark)
    for stage in stages:
        rows = stage.transform(rows)
    if model_family(model_type) == "hist_gradient_boosting":
        numbers, places = preprocessor.binned_columns
        sizes = [len(f.categories) for f in preprocessor.categorical]
        columns = {"featuresCol": ASSEMBLED, "labelCol": LABEL, "predictionCol": RAW}
        fitted = fit_leafwise(rows, numbers, places, sizes, LABEL, leafwise_options(hyperparameters, seed), **columns)
    else:
        ready = rows.select(ASSEMBLED, LABEL)
        fitted = make_estimator(model_type, hyperparameters, seed, ready).fit(ready)
    back = f"expm1({RAW})" if target_transform == "log1p" else RAW
    inverse = SQLTransformer(statement=f"SELECT *, {back} AS prediction FROM __THIS__")
    return PipelineModel([*stages, fitted, inverse])


def inner_model(model: PipelineModel):
    """The regression stage inside the saved chain."""
    return model.stages[-2]


def feature_importance(spark: SparkSession, model: PipelineModel, names: list[str], top: int = 10) -> DataFrame:
    """Most important features first; a tie goes by name. Linear models have none."""
    inner = inner_model(model)
    if not hasattr(inner, "featureImportances"):
        raise ValueError("importances are kept by tree models only; this one has none")
    rows = list(zip(names, [float(v) for v in inner.featureImportances.toArray()]))
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)
