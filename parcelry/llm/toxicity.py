"""Toxicity classifier with counterfactual regularisation.

A logistic model over hashed word 1- and 2-grams. Where a labelled text names a group of people, a second
text is made by swapping each identity term for another of its set; the loss is the usual one plus
PENALTY times the squared difference of the two logits, so that a mention of a group by itself does not
move the score. Learning is a few passes of follow-the-regularised-leader over a bounded sample.

Defined cases: as for the quality classifier. A text without identity terms has no penalty.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelry.llm import linear
from parcelry.llm.common import Words, pieces

#: Terms that stand for each other when swapped, in lower case.
IDENTITY_TERMS = (
    ("women", "men"), ("woman", "man"), ("female", "male"), ("girls", "boys"), ("girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"), ("gay", "straight", "lesbian", "bisexual"),
    ("african", "european", "american", "mexican", "chinese", "indian"),
    ("immigrant", "citizen"), ("immigrants", "citizens"), ("disabled", "blind", "deaf"), ("old", "young"),
    ("frauen", "männer"), ("frau", "mann"), ("femmes", "hommes"), ("femme", "homme"),
    ("mujeres", "hombres"), ("mujer", "hombre"),
)
ORDERS = 2
PENALTY = 1.0
SAMPLE_ROWS = 16_000


def swaps(terms=IDENTITY_TERMS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the terms, sorted, and of what each is swapped for: the next of its set."""
    pairs = [(a, group[(i + 1) % len(group)]) for group in terms for i, a in enumerate(group)]
    before, after = (Words(pa.array([" ".join(x)])).hashes() for x in zip(*pairs))
    order = np.argsort(before)
    return before[order], after[order]


def swapped(hashes: np.ndarray, before: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The token hashes with identity terms swapped, and which were."""
    at = np.minimum(np.searchsorted(before, hashes), len(before) - 1)
    hit = before[at] == hashes
    return np.where(hit, after[at], hashes), hit


def fit(docs: DataFrame, labels: DataFrame, label: str, training: Column, key: str = "doc_id", rows: int = SAMPLE_ROWS, penalty: float = PENALTY) -> np.ndarray:
    """Weights learned from at most `rows` labelled rows where `training`, a test of the key, holds."""
    before, after = swaps()

    def featurise(batches):
        for batch in batches:
            for a, b in pieces(batch.column("text")):
                hashes, bounds = linear.token_hashes(batch.column("text")[a:b], lower=True)
                other, hit = swapped(hashes, before, after)
                named = np.add.reduceat(np.append(hit, False), bounds[:-1]) * (np.diff(bounds) > 0) > 0
                at, at_bounds = linear.features(hashes, bounds, ORDERS)
                to, to_bounds = linear.features(other, bounds, ORDERS)
                sizes = np.where(named, np.diff(to_bounds), 0)
                to = to[np.repeat(named, np.diff(to_bounds))]
                yield pa.record_batch(
                    [
                        batch.column("place")[a:b], batch.column("label")[a:b], linear.lists(at, at_bounds, pa.int32()),
                        linear.lists(to, np.concatenate([[0], np.cumsum(sizes)]), pa.int32()),
                    ],
                    names=["place", "label", "at", "swapped_at"],
                )

    def learn(leader, batch):
        columns = (linear.arrays(batch.column(n)) for n in ("at", "swapped_at"))
        for at, to, y in zip(*columns, batch.column("label").to_numpy()):
            now = leader.weights(at)
            slope = linear.chance(now.sum()) - y
            if not len(to):
                leader.learn(at, slope, now)
                continue
            gap = 2 * penalty * np.clip(now.sum() - leader.weights(to).sum(), -4, 4)
            both = np.union1d(at, to)
            leader.learn(both, np.isin(both, at) * (slope + gap) - np.isin(both, to) * gap, leader.weights(both))

    sample = linear.labelled_sample(docs, labels, label, training, key, rows)
    return linear.train(sample, learn, "at array<int>, swapped_at array<int>", featurise)


def score(docs: DataFrame, weights: np.ndarray, key: str = "doc_id") -> DataFrame:
    """(key, score) of every row, score in 0 to 1, higher where label 1 is likelier."""
    return linear.scored(docs.select(key, "text"), weights, ORDERS, True, "score").select(key, "score")


def accepted(docs: DataFrame, weights: np.ndarray, limit: float = 0.5) -> DataFrame:
    """The rows of docs that score below the limit, as they are."""
    found = linear.scored(docs, weights, ORDERS, True, "__toxicity")
    return found.where(F.col("__toxicity") < limit).select(*docs.columns)
