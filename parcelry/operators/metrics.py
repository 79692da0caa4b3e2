"""Regression metrics as single aggregates over (actual, predicted) columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelry.operators.order_stats import Wanted, order_statistics

# Fixed value: the quantile of the price up to which rows count as cheap.
CHEAP = 0.25


def metric_columns(y: Column, p: Column) -> dict[str, Column]:
    """r2, rmse, mae and mse over the rows that have both values. r2 compares squared error with the spread of y."""
    error = y - p
    y = F.when(error.isNotNull(), y)
    squared = F.sum(error * error)
    spread = F.var_pop(y) * F.count(y)
    perfect = F.when(squared == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return {
        "r2": F.when(spread == 0, perfect).otherwise(F.lit(1.0) - squared / F.nullif(spread, F.lit(0.0))),
        "rmse": F.sqrt(F.avg(error * error)),
        "mae": F.avg(F.abs(error)),
        "mse": F.avg(error * error),
    }


def regression_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    return df.agg(*[c.alias(name) for name, c in metric_columns(y, p).items()])


def evaluation_metrics(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    """Regression metrics plus the mean error over rows priced at or below the 25th percentile."""
    y, p = F.col(actual).cast("double"), F.col(predicted).cast("double")
    cutoff = order_statistics(df, {"y": Wanted(y, (CHEAP,))}).values["y"]
    columns = metric_columns(y, p)
    if cutoff:
        columns["cheap_segment_mae"] = F.avg(F.when(y <= F.lit(cutoff[0]), F.abs(y - p)))
        columns["cheap_segment_cutoff_p25"] = F.lit(cutoff[0])
    return df.agg(*[c.alias(name) for name, c in columns.items()])
