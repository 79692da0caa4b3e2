"""Repeatable train/test splits that do not depend on partitioning or row order."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelry.functions.columns import hex_prefix_as_int, named
from parcelry.operators.order_stats import Wanted, order_statistics
from parcelry.session import held

PARTS = 1 << 32


def _digest(key: str, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), named(key).cast("string")))


def hash_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a 32-bit hash of the key, in one map step. The size is approximate.

    Rows without a key go to train.
    """
    part = hex_prefix_as_int(_digest(key, seed), 1, 8)
    in_test = F.coalesce(part, F.lit(PARTS)) < round(test_size * PARTS)
    return df.filter(~in_test), df.filter(in_test)


def with_split_hash(df: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """Add the hash columns that exact_split cuts on; worth it before keeping a table."""
    digest = _digest(key, seed)
    return df.withColumns({"__h1": hex_prefix_as_int(digest, 1, 13), "__h2": hex_prefix_as_int(digest, 14, 13)})


def exact_split(df: DataFrame, key: str, test_size: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Train and test rows with exactly ceil(n * test_size) test rows, for a unique key.

    The test rows have the smallest hashes. The cut is found by rank selection over the
    hash, so nothing is sorted. Rows that share a key share a side. A missing key is an error.
    """
    if "__h1" in df.columns:
        in_test = _smallest(df, test_size)
        keyed = df
    else:
        keyed = with_split_hash(df, key, seed)
        with held(keyed.select("__h1", "__h2")) as hashes:
            in_test = _smallest(hashes, test_size)
    in_test = F.coalesce(in_test, F.lit(False))
    return keyed.filter(~in_test).drop("__h1", "__h2"), keyed.filter(in_test).drop("__h1", "__h2")


def _smallest(hashes: DataFrame, share: float) -> Column:
    """Condition that exactly ceil(n * share) of n rows with distinct hashes meet."""
    h1, h2 = F.col("__h1"), F.col("__h2")
    cut = order_statistics(hashes, {"h": Wanted(h1, (share,), "count")}, {"rows": F.count(F.lit(1))})
    lacking = cut.also["rows"] - cut.counts["h"]
    if lacking:
        raise ValueError(f"exact_split needs a key on every row; {lacking} rows have none")
    if not cut.counts["h"]:
        return F.lit(False)
    at = int(cut.values["h"][0])
    ties = hashes.agg(F.count_if(h1 < at).alias("under"), F.count_if(h1 == at).alias("tied")).first()
    wanted = math.ceil(cut.counts["h"] * share) - ties["under"]
    if wanted >= ties["tied"]:
        return h1 <= at
    among = (wanted - 0.5) / ties["tied"]
    tied = order_statistics(hashes.filter(h1 == at), {"h": Wanted(h2, (among,), "count")})
    return (h1 < at) | ((h1 == at) & (h2 <= int(tied.values["h"][0])))
