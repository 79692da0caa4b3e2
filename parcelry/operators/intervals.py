"""Prediction intervals from relative errors, by segment of the predicted value."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable
from itertools import accumulate

from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelry.functions.columns import is_present, pick_by_edges, sorted_array_quantile
from parcelry.operators.metrics import CHEAP, metric_columns
from parcelry.operators.order_stats import GAP_ROWS, Wanted, linear_grid, order_statistics
from parcelry.session import new_shared_path

log = logging.getLogger(__name__)

# How intervals are calibrated.
METHOD = "segmented_relative_error_quantile"
ALPHA = 0.05
SEGMENTS = 5
MIN_SEGMENT_ROWS = 10

#: Leaves of a forest, 8 bytes each, that may go to every task as a constant of the plan.
LEAVES_SENT = 100_000

INTERVAL_SCHEMA = (
    "method string, alpha double, coverage double, num_segments int, segment_edges array<double>, "
    "relative_error_quantiles_by_segment array<double>, "
    "relative_error_quantiles struct<global: double>, calibration_size bigint"
)


def non_negative(p: Column) -> Column:
    return F.when(p < 0, F.lit(0.0)).otherwise(p)


def relative_error(y: Column, p: Column) -> Column:
    """|y - p| over |y|, with p lifted to 0 and |y| to 1 at least."""
    return F.abs(y - non_negative(p)) / F.greatest(F.abs(y), F.lit(1.0))


def calibrate_interval(
    df: DataFrame,
    actual: str,
    predicted: str,
    segments: int = SEGMENTS,
    alpha: float = ALPHA,
    min_rows: int = MIN_SEGMENT_ROWS,
    gap_rows: int = GAP_ROWS,
) -> dict:
    """Error quantile of each predicted-value segment; small segments use the overall one."""
    return evaluate_and_calibrate(df, actual, predicted, segments, alpha, min_rows, gap_rows)[1]


def evaluate_and_calibrate(
    df: DataFrame,
    actual: str,
    predicted: str,
    segments: int = SEGMENTS,
    alpha: float = ALPHA,
    min_rows: int = MIN_SEGMENT_ROWS,
    gap_rows: int = GAP_ROWS,
) -> tuple[dict, dict]:
    """The evaluation metrics and the interval of the rows that have both values.

    The metrics are aggregated in the first pass of the rank search, which also finds the cheap segment's
    cutoff; its mean error comes with the first pass of the segments' search.
    """
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    pairs = df.filter(is_present(y) & is_present(p)).select(
        y.alias("y"), p.alias("raw"), non_negative(p).alias("p"), relative_error(y, p).alias("error")
    )
    coverage = 1 - alpha
    overall = order_statistics(
        pairs,
        {
            "edges": Wanted(F.col("p"), linear_grid(segments)[1:-1]),
            "error": Wanted(F.col("error"), (coverage,), "higher"),
            "cheap": Wanted(F.col("y"), (CHEAP,)),
        },
        metric_columns(F.col("y"), F.col("raw")),
        gap_rows=gap_rows,
    )
    if not overall.counts["error"]:
        raise ValueError("Nothing to calibrate on: an interval needs rows with both a price and a prediction")
    edges = list(accumulate(overall.values["edges"], max))
    everywhere, cutoff = overall.values["error"][0], overall.values["cheap"][0]
    segment = pick_by_edges(F.col("p"), edges, list(range(segments)))
    each = order_statistics(
        pairs.select(segment.alias("segment"), "error", "y", "raw"),
        {
            f"segment {i}": Wanted(F.when(F.col("segment") == i, F.col("error")), (coverage,), "higher")
            for i in range(segments)
        },
        {"cheap_segment_mae": F.avg(F.when(F.col("y") <= F.lit(cutoff), F.abs(F.col("y") - F.col("raw"))))},
        gap_rows=gap_rows,
    )
    metrics = {**overall.also, "cheap_segment_mae": each.also["cheap_segment_mae"], "cheap_segment_cutoff_p25": cutoff}
    return metrics, {
        "method": METHOD,
        "alpha": alpha,
        "coverage": coverage,
        "num_segments": segments,
        "segment_edges": edges,
        "relative_error_quantiles_by_segment": [
            each.values[s][0] if each.counts[s] >= min_rows else everywhere for s in each.counts
        ],
        "relative_error_quantiles": {"global": everywhere},
        "calibration_size": overall.counts["error"],
    }


def interval_frame(spark: SparkSession, interval: dict) -> DataFrame:
    row = {**interval, "relative_error_quantiles": (interval["relative_error_quantiles"]["global"],)}
    fields = ["method", "alpha", "coverage", "num_segments", "segment_edges"]
    fields += ["relative_error_quantiles_by_segment", "relative_error_quantiles", "calibration_size"]
    return spark.createDataFrame([tuple(row[f] for f in fields)], INTERVAL_SCHEMA)


def error_quantile(p: Column, interval: dict | None) -> Column | None:
    """Relative error quantile for each prediction, or None when the interval has no usable form.

    The segment form needs one more quantile than edges. Failing that, two edges with low, mid
    and high quantiles serve, each defaulting to the overall one.
    """
    if not interval or interval.get("method") != METHOD:
        return None
    edges = [float(e) for e in interval.get("segment_edges") or []]
    by_segment = interval.get("relative_error_quantiles_by_segment")
    if isinstance(by_segment, list) and by_segment and len(edges) == len(by_segment) - 1:
        return pick_by_edges(p, edges, [float(q) for q in by_segment])
    bands = interval.get("relative_error_quantiles") or {}
    if len(edges) == 2 and bands:
        overall = float(bands.get("global", 0.0))
        return pick_by_edges(p, edges, [float(bands.get(b, overall)) for b in ("low", "mid", "high")])
    return None


def add_interval(
    df: DataFrame,
    interval: dict | None,
    prediction: str = "prediction",
    forest: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Add lower_bound and upper_bound in the units of the prediction.

    Without a usable calibration the bounds come from the forest's trees if given, as a function
    that adds them, else they equal the prediction.
    """
    raw = F.col(prediction)
    p = non_negative(raw)
    q = error_quantile(p, interval)
    if q is not None:
        lower = F.greatest(F.lit(0.0), F.col("__p") * (F.lit(1.0) - F.col("__q")))
        upper = F.col("__p") * (F.lit(1.0) + F.col("__q"))
        bounds = df.withColumns({"__p": p, "__q": q}).withColumns({"lower_bound": lower, "upper_bound": upper})
        return bounds.drop("__p", "__q")
    if forest is not None:
        return forest(df)
    log.warning("No interval for this model; bounds equal the prediction.")
    return df.withColumns({"lower_bound": raw, "upper_bound": raw})


def interval_margin(df: DataFrame, coverage: float = 1 - ALPHA, prediction: str = "prediction") -> DataFrame:
    """Half width of the interval, the same as a percentage of the prediction, and the level."""
    half = (F.col("upper_bound") - F.col("lower_bound")) / F.lit(2.0)
    share = half / F.nullif(F.col(prediction), F.lit(0.0)) * F.lit(100.0)
    return df.withColumns(
        {"margin": half, "margin_pct": share, "confidence_level": F.lit(coverage * 100.0)}
    )


def leaf_values(model: RandomForestRegressionModel) -> DataFrame:
    """(tree, values): the leaves' values of every tree, from the node table that Spark writes with a model.

    Nodes are numbered from the top, a node before its left and then its right side, and Spark counts leaves
    in that order.
    """
    spark = SparkSession.active()
    path = new_shared_path(spark, "forest")
    model.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select(F.col("treeID").alias("tree"), "nodeData.*")
    ordered = F.sort_array(F.collect_list(F.struct("id", "prediction")))
    return nodes.where(F.col("leftChild") < 0).groupBy("tree").agg(ordered["prediction"].alias("values"))


def with_forest_bounds(
    df: DataFrame,
    model: RandomForestRegressionModel,
    leaf: str,
    target_transform: str,
    leaves_sent: int = LEAVES_SENT,
) -> DataFrame:
    """Add lower_bound and upper_bound: 2.5 and 97.5 percentiles over the trees' own predictions.

    leaf holds each tree's leaf number, which the model adds in its one pass over the rows,
    so no tree is applied a second time. A forest of at most leaves_sent leaves goes to the rows as one constant;
    the leaves of a larger one are joined by tree and number. The rows are then written once, so that their
    numbers hold, and only these and their leaf numbers are shuffled.
    """
    leaves, trees = leaf_values(model), model.getNumTrees

    def bounds(values: Column) -> dict[str, Column]:
        if target_transform == "log1p":
            values = F.transform(values, lambda v: F.expm1(v))
        ordered = F.array_sort(values)
        return {c: sorted_array_quantile(ordered, trees, q) for c, q in (("lower_bound", 0.025), ("upper_bound", 0.975))}

    numbers = F.transform(vector_to_array(F.col(leaf)), lambda at: at.cast("int"))
    if leaves.agg(F.sum(F.size("values"))).first()[0] <= leaves_sent:
        values = [row["values"] for row in leaves.orderBy("tree").collect()]
        table = F.from_json(F.lit(json.dumps(values)), "array<array<double>>")
        return df.withColumns(bounds(F.transform(numbers, lambda at, tree: table[tree][at])))
    path = new_shared_path(df.sparkSession, "forest-rows")
    df.withColumn("__row", F.monotonically_increasing_id()).write.parquet(path)
    rows = df.sparkSession.read.parquet(path)
    each = leaves.select("tree", F.posexplode("values").alias("leaf", "value"))
    met = rows.select("__row", F.posexplode(numbers).alias("tree", "leaf")).join(each, ["tree", "leaf"])
    found = met.groupBy("__row").agg(F.collect_list("value").alias("__values"))
    found = found.select("__row", *[c.alias(name) for name, c in bounds(F.col("__values")).items()])
    return rows.drop("lower_bound", "upper_bound").join(found, "__row", "left").drop("__row")
