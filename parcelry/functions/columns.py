"""Column expressions shared by the operators. All run in the JVM; Bucketizer's lookup is a function per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def named(name: str) -> Column:
    """Reference a top-level column whatever characters its name holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def is_present(x: Column) -> Column:
    """True for a value that is neither NULL nor NaN; x must be floating."""
    return x.isNotNull() & ~F.isnan(x)


def without_nan(x: Column) -> Column:
    """NULL in place of NaN, so that missing has one spelling."""
    return F.nanvl(x, F.lit(None))


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in every floating column.

    Apply it after filters: a filter on a wrapped column cannot reach the file scan.
    """
    floating = {f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    if not floating:
        return df
    return df.select(
        *[without_nan(named(c)).alias(c) if c in floating else named(c) for c in df.columns]
    )


def pick_by_edges(x: Column, edges: Sequence[float], values: Sequence) -> Column:
    """values[number of edges at or below x], NULL for NULL x.

    The edges are a few sorted constants. A balanced CASE keeps the lookup inside generated
    code, where a lambda over an array would be interpreted; with_bucket suits many edges.
    """
    if len(values) != len(edges) + 1:
        raise ValueError("pick_by_edges needs one more value than edges")

    def branch(low: int, high: int) -> Column:
        if low == high:
            return F.lit(values[low])
        middle = (low + high + 1) // 2
        return F.when(x < F.lit(edges[middle - 1]), branch(low, middle - 1)).otherwise(
            branch(middle, high)
        )

    return F.when(x.isNotNull(), branch(0, len(edges)))


def with_bucket(df: DataFrame, x: str, edges: Sequence[float]) -> DataFrame:
    """Add the 0-based bucket of x over the edges: [a, b) each, the last one [a, b].

    NULL for values outside the edges. Bucketizer finds the bucket by binary search, at the
    same cost for any number of edges.
    """
    value = F.col(x)
    inside = F.when((value >= F.lit(edges[0])) & (value <= F.lit(edges[-1])), value)
    df = df.withColumn("__inside", inside)
    if len(edges) == 2:
        df = df.withColumn("bucket", F.when(F.col("__inside").isNotNull(), F.lit(0)))
    else:
        finder = Bucketizer(splits=list(edges), inputCol="__inside", outputCol="bucket", handleInvalid="keep")
        df = finder.transform(df).withColumn("bucket", F.col("bucket").cast("int"))
    return df.drop("__inside")


def clip(x: Column, low: float, high: float) -> Column:
    """x limited to [low, high]; NULL stays NULL."""
    return F.when(x < F.lit(low), F.lit(low)).when(x > F.lit(high), F.lit(high)).otherwise(x)


def sorted_array_quantile(values: Column, size: int, q: float) -> Column:
    """Linear-interpolation quantile over a sorted array column of known length."""
    position = (size - 1) * q
    below = int(position)
    above = min(below + 1, size - 1)
    a, b = values[below], values[above]
    return a + (b - a) * F.lit(position - below)


def hex_prefix_as_int(text: Column, start: int, length: int) -> Column:
    """length hex digits of text from the 1-based start, as BIGINT."""
    return F.conv(F.substring(text, start, length), 16, 10).cast("bigint")


def sql_double(value: float) -> str:
    """SQL literal holding exactly this double."""
    return f"{float(value)!r}D"


def sql_string(value: str) -> str:
    """SQL literal holding exactly this text."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
