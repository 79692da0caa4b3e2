"""Quality classifier: hashed word n-grams, logistic regression by follow-the-regularised-leader.

Features are the distinct 1- and 2-grams of words and runs of punctuation, hashed to 2**20 buckets. A
bounded sample of labelled rows is learned from in a few passes. Scores are sparse sums over the buckets of a whole text.

Defined cases: a null or empty text has the bias alone and still gets a score; null labels are left out;
without labelled rows every score is 0.5; a key with several labels takes the largest; repeated rows each
get a score; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from parcelry.llm import linear
from parcelry.llm.common import pieces

ORDERS = 2
#: Most labelled rows to learn from.
SAMPLE_ROWS = 16_000


def fit(docs: DataFrame, labels: DataFrame, label: str, training: Column, key: str = "doc_id", rows: int = SAMPLE_ROWS) -> np.ndarray:
    """Weights learned from at most `rows` labelled rows where `training`, a test of the key, holds."""

    def featurise(batches):
        for batch in batches:
            for a, b in pieces(batch.column("text")):
                at, bounds = linear.features(*linear.token_hashes(batch.column("text")[a:b], lower=False), ORDERS)
                yield pa.record_batch(
                    [batch.column("place")[a:b], batch.column("label")[a:b], linear.lists(at, bounds, pa.int32())],
                    names=["place", "label", "at"],
                )

    def learn(leader, batch):
        for at, y in zip(linear.arrays(batch.column("at")), batch.column("label").to_numpy()):
            now = leader.weights(at)
            leader.learn(at, linear.chance(now.sum()) - y, now)

    sample = linear.labelled_sample(docs, labels, label, training, key, rows)
    return linear.train(sample, learn, "at array<int>", featurise)


def score(docs: DataFrame, weights: np.ndarray, key: str = "doc_id") -> DataFrame:
    """(key, score) of every row, score in 0 to 1, higher where label 1 is likelier."""
    return linear.scored(docs.select(key, "text"), weights, ORDERS, False, "score").select(key, "score")
