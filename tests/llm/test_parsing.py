import hashlib
import itertools
import random

import numpy as np
import pytest

from made_texts import some_texts
from parcelry.llm import parsing


def test_equal_substrings_share_names():
    rng = np.random.default_rng(2)
    draw = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    core = draw(4000)
    a, b, c = parsing.sketches([core, draw(37) + core + draw(11), draw(4000)])
    assert parsing.likeness(a[None], b[None])[0] > 0.8
    assert parsing.likeness(a[None], c[None])[0] < 0.1


def test_phrases_do_not_depend_on_the_neighbouring_texts():
    texts = some_texts(4) + ["", "a", "aaaaaaaaaa", "ab" * 50]
    together = parsing.sketches(texts)
    alone = np.concatenate([parsing.sketches([t]) for t in texts])
    assert (together == alone).all()


M = 2**64 - 1


def scrambled(x):
    """The mixing function on one Python integer."""
    x &= M
    x = ((x ^ x >> 30) * 0xBF58476D1CE4E5B9) & M
    x = ((x ^ x >> 27) * 0x94D049BB133111EB) & M
    return x ^ x >> 31


def plain_phrases(names):
    """One level of parsing, name by name."""
    runs = [(name, len(list(same))) for name, same in itertools.groupby(names)]
    names = [scrambled(name + n * 0xC2B2AE3D27D4EB4F) if n > 1 else name for name, n in runs]
    labels, width = names, 64
    for _ in range(parsing.TOSSES):
        tossed = []
        for i, label in enumerate(labels):
            left = labels[i - 1] if i else label ^ 2**width - 1
            bit = next(b for b in range(width) if label >> b & 1 != left >> b & 1)
            tossed.append(2 * bit + (label >> bit & 1))
        labels, width = tossed, 8
    phrases = []
    for i, name in enumerate(names):
        last = i == len(names) - 1
        if not i or labels[i] < labels[i - 1] and (last or labels[i] <= labels[i + 1]):
            phrases.append([])
        phrases[-1].append(name)
    return [scrambled(sum(scrambled(name + k * 0x9E3779B97F4A7C15) for k, name in enumerate(p))) for p in phrases]


def plain_sketch(text):
    names, least = [scrambled(ord(c) + 7) for c in text], {}
    for level in range(1, parsing.LEVELS + 1):
        if not names:
            break
        names = plain_phrases(names)
        if len(names) == 1 or level >= parsing.LEAST_LEVEL:
            for name in names:
                value = scrambled(name + level)
                least[value >> 58] = min(value, least.get(value >> 58, M))
        if len(names) == 1:
            break
    return [min(scrambled(least[k]) & 0xFFFF, parsing.EMPTY - 1) if k in least else parsing.EMPTY for k in range(parsing.SLOTS)]


def test_sketches_against_plain_parsing():
    draw = random.Random(8)
    texts = some_texts(11) + ["", "a", "aa", "aaaaaaaaaa", "ab" * 50, "漢字🙂" * 9]
    texts += ["".join(draw.choice("abcdefgh ") for _ in range(draw.randint(1, 900))) for _ in range(30)]
    assert parsing.sketches(texts).tolist() == [plain_sketch(t) for t in texts]


def test_phrases_are_bounded():
    names = np.random.default_rng(1).integers(0, 2**63, 100_000).astype(np.uint64)
    phrases, _ = parsing._level(names, np.array([0, len(names)]))
    assert len(names) / 5 < len(phrases) < len(names) / 2


@pytest.mark.parametrize("parts", [1, 7])
def test_edited_texts(make_docs, parts, spark):
    texts = some_texts(9)
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        found = sorted(parsing.compare_edited(make_docs(texts)).collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    prints = {r.doc_id: r.fingerprint for r in parsing.fingerprint(make_docs(texts)).collect()}
    assert [r.doc_id for r in found] == list(range(len(texts)))
    for i, r in enumerate(found):
        after = texts[(i + 1) % len(texts)]
        half = len(texts[i]) // 2
        edited = texts[i][: len(texts[i]) - half] + after[:half]
        assert (r.n_chars, r.edited_sha256) == (len(texts[i]), hashlib.sha256(edited.encode()).hexdigest())
        assert r.fingerprint == prints[i]
        own, changed, other = (parsing.sketches([t]) for t in (texts[i], edited, after))
        assert r.near_edited == parsing.likeness(own, changed)[0] and r.near_next == parsing.likeness(own, other)[0]


def test_odd_rows(odd_docs, no_docs, spark):
    found = parsing.compare_edited(odd_docs).collect()
    assert len(found) == odd_docs.count()
    empty = {r.fingerprint for r in found if r.n_chars == 0}
    assert len(empty) == 1 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert parsing.compare_edited(no_docs).collect() == []
    alone = parsing.compare_edited(spark.createDataFrame([(5, "abcd")], "doc_id long, text string")).first()
    assert alone.near_next == 1.0 and alone.edited_sha256 == hashlib.sha256(b"abab").hexdigest()


def test_text_keys(spark):
    docs = spark.createDataFrame([("a", "abcd"), ("b", "efgh")], "doc_id string, text string")
    assert parsing.fingerprint(docs).count() == 2
    with pytest.raises(ValueError, match="numeric"):
        parsing.compare_edited(docs)
