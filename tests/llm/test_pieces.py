import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from parcelry.llm import pieces
from parcelry.llm.common import mix


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.read_vocabulary(pieces.MODEL)


def test_samples_follow_the_weights_of_the_paths(vocabulary):
    names = {t.decode(): i for i, t in enumerate(vocabulary.texts) if vocabulary.normal[i] and t}

    def paths(word):
        if not word:
            yield (), 0.0
        for n in range(1, len(word) + 1):
            if word[:n] in names:
                for rest, weight in paths(word[n:]):
                    yield (names[word[:n]], *rest), weight + pieces.THETA * vocabulary.scores[names[word[:n]]]

    n = 40_000
    sampler = pieces.Sampler(vocabulary, pieces.THETA)
    for word in ("thing", "and", "ooo"):
        weights = {p: math.exp(w) for p, w in paths(" " + word)}
        ids, bounds = sampler.segment(pa.array([word] * n), mix(np.arange(n, dtype=np.uint64)))
        seen = Counter(tuple(ids[a:b].tolist()) for a, b in zip(bounds, bounds[1:]))
        assert set(seen) <= set(weights)
        for path, weight in weights.items():
            assert abs(seen[path] / n - weight / sum(weights.values())) < 0.012


def test_samples_do_not_depend_on_the_batch(vocabulary):
    sampler = pieces.Sampler(vocabulary, pieces.THETA)
    texts = ["some words here", "", "x" * 300, "tab\tand\nline", None, "▁ 漢字 🙂", "   "]
    seeds = mix(np.arange(len(texts), dtype=np.uint64))
    ids, bounds = sampler.segment(pa.array(texts), seeds)
    for i, t in enumerate(texts):
        alone, _ = sampler.segment(pa.array([t], pa.string()), seeds[i : i + 1])
        assert ids[bounds[i] : bounds[i + 1]].tolist() == alone.tolist()


def test_round_trip_and_seeds(spark, odd_docs, no_docs, vocabulary):
    docs = odd_docs.drop("row")
    decoded = pieces.decode(pieces.encode(docs, vocabulary), vocabulary).collect()
    assert len(decoded) == docs.count() and all(r.decoded == (r.text or "") for r in decoded)
    assert all(r.piece_ids == [] for r in decoded if not r.text)
    again = {(r.doc_id, r.text): r.piece_ids for r in pieces.encode(docs.repartition(5), vocabulary).collect()}
    assert again == {(r.doc_id, r.text): r.piece_ids for r in decoded}
    equal = spark.createDataFrame([(i, "something and other things " * 20) for i in range(3)], "doc_id long, text string")
    first, other = (sorted(pieces.encode(equal, vocabulary, seed=s).collect()) for s in (0, 1))
    assert len({tuple(r.piece_ids) for r in [*first, *other]}) == 6  # equal texts, other keys or seeds
    assert pieces.decode(pieces.encode(no_docs, vocabulary), vocabulary).collect() == []


def test_round_trip_in_one_pass(odd_docs, no_docs, vocabulary):
    docs = odd_docs.withColumnsRenamed({"row": "seed", "tag": "piece_ids", "key": "decoded"})
    decoded = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    assert sorted(decoded.columns) == sorted(docs.columns) and {r.seed for r in decoded.collect()} == {"row"}
    found = pieces.roundtrip(docs, vocabulary).collect()
    assert len(found) == docs.count() and all(r.lossless for r in found)
    order = lambda rows: sorted((str(r.doc_id), list(r.piece_ids)) for r in rows)
    assert order(found) == order(decoded.collect())
    assert pieces.roundtrip(no_docs, vocabulary).collect() == []
