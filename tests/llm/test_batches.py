"""Batches that tasks hold whole in the executor and in Python."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelry.llm import linear, nearcopies, superstrings

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def limit(spark):
    """The session's setting, as it was again after the test."""
    before = spark.conf.get(LIMIT)
    spark.conf.unset(LIMIT)
    yield
    spark.conf.set(LIMIT, before)


def met(df):
    """(bytes, rows) of the batches that a task gets as the plan of df runs."""

    def sizes(batches):
        for batch in batches:
            yield pa.record_batch([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["bytes", "rows"])

    return [tuple(r) for r in df.mapInArrow(sizes, "bytes long, rows long").collect()]


def one_task(spark, rows, repeats):
    text = F.concat_ws(" ", F.col("id"), F.repeat(F.lit("word "), repeats))
    return spark.range(rows).coalesce(1).select(F.col("id").alias("doc_id"), text.alias("text"))


def test_a_task_gets_its_texts_in_small_batches(spark, limit):
    docs = one_task(spark, 3000, 800)
    found = met(linear.scored(docs, np.zeros(1 << linear.BITS), 1, True, "score"))
    assert sum(n for _, n in found) == 3000 and len(found) > 2
    assert max(size for size, _ in found) < 4_500_000


def test_a_long_text_is_a_batch_alone(spark, limit):
    found = met(linear.scored(one_task(spark, 3, 1_200_000), np.zeros(1 << linear.BITS), 1, True, "score"))
    assert [n for _, n in found] == [1, 1, 1]


@pytest.mark.parametrize("of", [lambda d: nearcopies.signatures(d, "doc_id"), lambda d: superstrings.packed(d, "doc_id")])
def test_a_lower_limit_stays(spark, limit, of):
    spark.conf.set(LIMIT, "1k")
    of(one_task(spark, 3, 10))
    assert spark.conf.get(LIMIT) == "1k"


def test_the_driver_holds_little_beside_the_weights():
    draw, leader = np.random.default_rng(5), linear.FollowTheLeader()
    leader.sums[:], leader.squares[:] = draw.normal(0, 5, 1 << linear.BITS), draw.random(1 << linear.BITS)
    plain = leader.weights(np.arange(1 << linear.BITS))
    tracemalloc.start()
    weights = leader.all_weights()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert np.array_equal(weights, plain) and peak < 1.5 * weights.nbytes
