"""Hashed text features and follow-the-regularised-leader learning, shared by the two classifiers."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelry.llm.common import Words, mapped, mix, pieces

BITS = 20
BIAS = 0
PASSES = 3
SCORE_BYTES = 1 << 20
#: Buckets whose weights are worked out at once on the driver.
SLICE = 1 << 14


def token_hashes(texts: pa.Array, lower: bool) -> tuple[np.ndarray, np.ndarray]:
    words = Words(texts, lower=lower, marks=True)
    return words.hashes(), words.bounds


def features(hashes: np.ndarray, bounds: np.ndarray, orders: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of the token n-grams, n up to `orders`, of each text, and their bounds.

    Bucket 0 is the bias and belongs to every text.
    """
    n = len(bounds) - 1
    owner = np.repeat(np.arange(n), np.diff(bounds))
    keys = [np.arange(n, dtype=np.int64) << BITS]
    run = hashes
    with np.errstate(over="ignore"):
        for order in range(orders):
            if order:
                run = mix(run[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[order:])
                same = owner[order:] == owner[: len(owner) - order]
            else:
                run, same = mix(run), slice(None)
            bucket = (run >> np.uint64(64 - BITS)).astype(np.int64)
            keys.append((owner[: len(run)] << BITS | np.maximum(bucket, 1))[same])
    keys = np.unique(np.concatenate(keys))
    return (keys & (1 << BITS) - 1).astype(np.int32), np.searchsorted(keys >> BITS, np.arange(n + 1))


class FollowTheLeader:
    """Weights by the proximal rule: per-bucket steps, small sums held at zero. The bias is not held."""

    def __init__(self, step: float = 0.5, ease: float = 1.0, lasso: float = 3.0, ridge: float = 1.0):
        self.step, self.ease, self.lasso, self.ridge = step, ease, lasso, ridge
        self.sums = np.zeros(1 << BITS)
        self.squares = np.zeros(1 << BITS)

    def weights(self, at: np.ndarray) -> np.ndarray:
        z = self.sums[at]
        hold = np.where(at == BIAS, 0.0, self.lasso)
        rate = (self.ease + np.sqrt(self.squares[at])) / self.step + self.ridge
        return np.where(np.abs(z) > hold, -(z - np.sign(z) * hold) / rate, 0.0)

    def all_weights(self) -> np.ndarray:
        """The weights of all buckets, a slice at a time, so that little is held beside them."""
        out = np.empty(1 << BITS)
        for a in range(0, len(out), SLICE):
            out[a : a + SLICE] = self.weights(np.arange(a, a + SLICE))
        return out

    def learn(self, at: np.ndarray, slope: np.ndarray | float, now: np.ndarray) -> None:
        """Take a gradient over the distinct buckets `at`, whose weights now are `now`."""
        before = self.squares[at]
        after = before + slope * slope
        self.sums[at] += slope - (np.sqrt(after) - np.sqrt(before)) / self.step * now
        self.squares[at] = after


def chance(logit):
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, training: Column, key: str, rows: int) -> DataFrame:
    """(key, text, label, place) of at most `rows` labelled keys, a row each, picked by a hash of the key.

    A key with several labels takes the largest, one with several texts the least; null labels and keys are left out. Only
    the picked keys, `rows` at most, are broadcast; the rows of a key collapse in each task before they are shuffled.
    """
    known = labels.where(training & F.col(label).isNotNull() & F.col(key).isNotNull())
    known = known.groupBy(key).agg(F.max(label).cast("int").alias("label"))
    picked = known.withColumn("place", F.xxhash64(F.col(key), F.lit(17))).orderBy("place", key).limit(rows)
    met = docs.select(key, "text").join(F.broadcast(picked), key)
    return met.groupBy(key, "label", "place").agg(F.min("text").alias("text")).select(key, "text", "label", "place")


def train(sample: DataFrame, learn: Callable[[FollowTheLeader, pa.RecordBatch], None], schema: str, featurise: Callable) -> np.ndarray:
    """Weights after PASSES passes over the sample in order of place.

    The sample is bounded, so one task streams it; what it has learned, two numbers for each bucket
    touched and so 2**20 pairs at most, goes through the driver from pass to pass.
    """

    def run(batches):
        leader = FollowTheLeader()
        sums, squares = state.value
        leader.sums[:], leader.squares[:] = sums, squares
        for batch in batches:
            learn(leader, batch)
        at = np.flatnonzero(leader.squares).astype(np.int32)
        yield pa.record_batch([pa.array(at), pa.array(leader.sums[at]), pa.array(leader.squares[at])], names=["at", "sum", "square"])

    leader = FollowTheLeader()
    ordered = mapped(sample, featurise, f"place long, label int, {schema}").repartition(1).sortWithinPartitions("place")
    ordered = ordered.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for _ in range(PASSES):
            state = sample.sparkSession.sparkContext.broadcast((leader.sums, leader.squares))
            found = mapped(ordered, run, "at int, sum double, square double").toArrow()
            at = found["at"].to_numpy()
            leader.sums[at], leader.squares[at] = found["sum"].to_numpy(), found["square"].to_numpy()
            state.destroy()
            del found, at
            pa.default_memory_pool().release_unused()
    finally:
        ordered.unpersist()
    return leader.all_weights()


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32), pa.int32()), pa.array(values, kind))


def arrays(column: pa.Array) -> list[np.ndarray]:
    bounds = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
    values = column.flatten().to_numpy()
    return [values[a:b] for a, b in zip(bounds, bounds[1:])]


def scored(docs: DataFrame, weights: np.ndarray, orders: int, lower: bool, column: str) -> DataFrame:
    """docs with a column: the logistic of the sum of the weights of a text's buckets, all texts whole."""
    sent = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))
    columns = docs.columns

    def run(batches):
        w = sent.value
        for batch in batches:
            scores = [np.zeros(0)]
            for a, b in pieces(batch.column("text"), SCORE_BYTES):
                at, bounds = features(*token_hashes(batch.column("text")[a:b], lower), orders)
                scores.append(chance(np.add.reduceat(w[at].astype(np.float64), bounds[:-1])))
            yield pa.record_batch([*batch.columns, pa.array(np.concatenate(scores))], names=[*columns, column])

    return mapped(docs, run, T.StructType([*docs.schema, T.StructField(column, T.DoubleType())]))
