import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from parcelry.llm import linear, quality, toxicity


def sentences(spark, seed=1, n=600):
    draw = random.Random(seed)
    neutral = [f"n{i}" for i in range(80)]
    rows = []
    for i in range(n):
        words = [draw.choice(neutral) for _ in range(12)]
        bad = i % 3 == 0
        if bad:
            words.insert(draw.randrange(12), draw.choice(["vile", "nasty"]))
        # a group is named more often in bad sentences
        if draw.random() < (0.8 if bad else 0.1):
            words.insert(draw.randrange(12), "muslim")
        rows.append((i, " ".join(words), int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string, label int")


def test_features_are_distinct_n_grams():
    hashes, bounds = linear.token_hashes(pa.array(["a b a b", "", None, "a!!"]), True)
    at, cuts = linear.features(hashes, bounds, 2)
    assert np.diff(cuts).tolist() == [1 + 2 + 2, 1, 1, 1 + 2 + 1]
    assert (at[cuts[:-1]] == linear.BIAS).all()


@pytest.mark.parametrize("model", [quality, toxicity])
def test_held_out_accuracy(spark, model):
    rows = sentences(spark)
    weights = model.fit(rows, rows.select("doc_id", "label"), "label", F.col("doc_id") % 5 != 0)
    found = model.score(rows, weights).join(rows, "doc_id").where("doc_id % 5 = 0")
    right = found.where((F.col("score") >= 0.5).cast("int") == F.col("label")).count()
    assert right / found.count() > 0.95


def test_penalty_takes_the_weight_off_neutral_mentions(spark):
    rows = sentences(spark)
    asked = spark.createDataFrame([(1, "n1 n2 muslim n3"), (2, "n1 n2 christian n3"), (3, "n1 vile n3")], "doc_id long, text string")
    gap = {}
    for penalty in (0.0, 3.0):
        weights = toxicity.fit(rows, rows.select("doc_id", "label"), "label", F.lit(True), penalty=penalty)
        score = {r.doc_id: r.score for r in toxicity.score(asked, weights).collect()}
        gap[penalty] = score[1] - score[2]
        assert score[3] > 0.5
    assert abs(gap[3.0]) < 0.3 * gap[0.0]


def test_swaps_lead_round_each_set():
    before, after = toxicity.swaps()
    assert sorted(before.tolist()) == sorted(after.tolist()) and (before != after).all()


@pytest.mark.parametrize("model", [quality, toxicity])
def test_odd_rows(spark, odd_docs, no_docs, model):
    labels = spark.createDataFrame([(2, 1), (2, 0), (6, 0), (4, None), (None, 1), (77, 1)], "doc_id long, label int")
    weights = model.fit(odd_docs, labels, "label", F.lit(True))
    found = model.score(odd_docs, weights).collect()
    assert len(found) == odd_docs.count() and all(0 <= r.score <= 1 for r in found)
    assert len({r.score for r in found if r.doc_id in (1, 2, 3, 5)}) == 1
    none = model.fit(odd_docs, labels.limit(0), "label", F.lit(True))
    assert {r.score for r in model.score(odd_docs, none).collect()} == {0.5}
    assert model.score(no_docs, weights).collect() == []
    assert (model.fit(no_docs, labels, "label", F.lit(True)) == 0).all()


def test_accepted_rows_keep_their_columns(odd_docs):
    weights = np.zeros(1 << linear.BITS)
    assert toxicity.accepted(odd_docs, weights, 0.6).collect() == odd_docs.collect()
    assert toxicity.accepted(odd_docs, weights, 0.5).collect() == []


def test_sample_is_bounded(spark):
    rows = sentences(spark)
    sample = linear.labelled_sample(rows, rows.select("doc_id", "label"), "label", F.lit(True), "doc_id", 50)
    assert sample.count() == 50


def test_sample_holds_one_row_a_key(spark):
    docs = spark.createDataFrame([(1, f"t{i}") for i in range(400)] + [(2, None), (3, "c"), (None, "d")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, label int")
    sample = linear.labelled_sample(docs, labels, "label", F.lit(True), "doc_id", 2)
    assert sorted((r.doc_id, r.text, r.label) for r in sample.collect()) == [(1, "t0", 1), (2, None, 0)]


def plain_leader(sample, swap, penalty, lower):
    """Bucket to weight by the same rules, one float at a time."""

    def buckets(text):
        return linear.features(*linear.token_hashes(pa.array([text]), lower), 2)[0].tolist()

    sums, squares = {}, {}

    def weight(i):
        z, n, hold = sums.get(i, 0.0), squares.get(i, 0.0), 0.0 if i == linear.BIAS else 3.0
        return 0.0 if abs(z) <= hold else -(z - math.copysign(hold, z)) / ((1.0 + math.sqrt(n)) / 0.5 + 1.0)

    for _ in range(linear.PASSES):
        for text, label in sample:
            at, other = buckets(text), swap(text)
            logit = sum(weight(i) for i in at)
            slope = 1 / (1 + math.exp(-logit)) - label
            slopes = dict.fromkeys(at, slope)
            if other is not None:
                to = buckets(other)
                gap = 2 * penalty * min(max(logit - sum(weight(i) for i in to), -4), 4)
                slopes = {i: (i in at) * (slope + gap) - (i in to) * gap for i in {*at, *to}}
            held = {i: weight(i) for i in slopes}
            for i, g in slopes.items():
                n = squares.get(i, 0.0)
                sums[i] = sums.get(i, 0.0) + g - (math.sqrt(n + g * g) - math.sqrt(n)) / 0.5 * held[i]
                squares[i] = n + g * g
    return {i: weight(i) for i in sums}


def swapped_words(text):
    follows = {a: group[(k + 1) % len(group)] for group in toxicity.IDENTITY_TERMS for k, a in enumerate(group)}
    words = text.split()
    return " ".join(follows.get(w, w) for w in words) if any(w in follows for w in words) else None


@pytest.mark.parametrize("model, swap, lower", [(quality, lambda text: None, False), (toxicity, swapped_words, True)])
def test_learning_against_plain_updates(spark, model, swap, lower):
    rows = sentences(spark, n=150)
    labels = rows.select("doc_id", "label")
    sample = linear.labelled_sample(rows, labels, "label", F.lit(True), "doc_id", 1000).orderBy("place").collect()
    expected = plain_leader([(r.text, r.label) for r in sample], swap, toxicity.PENALTY, lower)
    weights = model.fit(rows, labels, "label", F.lit(True))
    found = {i: weights[i] for i in np.flatnonzero(weights).tolist()}
    assert found == pytest.approx({i: w for i, w in expected.items() if w}, abs=1e-9) and len(found) > 5
