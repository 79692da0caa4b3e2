"""Left joins onto lookups with unique keys, safe for large lookups and hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPREAD = 1024


def lookup_join(df: DataFrame, lookup: DataFrame, key: str, known_unique: bool = False) -> DataFrame:
    """Left join where lookup has one row per key; a repeated lookup key fails the query.

    One plan over one scan of each side. Spark broadcasts the lookup where its bytes are below
    spark.sql.autoBroadcastJoinThreshold; beyond, the join shuffles and adaptive execution splits a hot
    key's partition. A NULL key matches nothing and is spread by the row's hash, lest all such rows
    meet in one task. known_unique skips the check for a lookup that was grouped by the key.
    """
    columns = [key, *[c for c in df.columns if c != key], *[c for c in lookup.columns if c != key]]
    if not known_unique:
        lookup = _checked(lookup, key)
    given = [c for c in df.columns if not df.schema[c].dataType.simpleString().startswith("map")]
    spread = F.when(F.col(key).isNull(), F.pmod(F.xxhash64(*given), F.lit(_SPREAD)) + 1).otherwise(F.lit(0).cast("bigint"))
    left = df.withColumn("__spread", spread)
    right = lookup.withColumn("__spread", F.lit(0).cast("bigint"))
    return left.join(right, [key, "__spread"], "left").select(*columns)


def _checked(lookup: DataFrame, key: str) -> DataFrame:
    """One row per key. The check stands in the key itself, which no select can prune from the join."""
    others = [c for c in lookup.columns if c != key]
    grouped = lookup.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("__key")).agg(
        F.count(F.lit(1)).alias("__rows"), F.first(F.struct(F.lit(0), *others)).alias("__rest")
    )
    fault = F.raise_error(F.concat(F.lit(f"lookup holds a '{key}' more than once; rows would multiply: "), F.col("__key").cast("string")))
    once = F.when(F.col("__rows") == 1, F.col("__key")).otherwise(fault.cast(lookup.schema[key].dataType))
    return grouped.select(once.alias(key), *[F.col("__rest")[c].alias(c) for c in others])
