import random
import re

import numpy as np
import pyarrow as pa
import pytest

from made_texts import some_texts
from parcelry.llm import substrings, suffixes, superstrings
from parcelry.llm.suffixes import BlindTrie


def brute_words(rows, window):
    """rows (key, text) in order; (n_words, n_removed, kept) of each."""
    seen, out = set(), []
    for _, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        gone = [False] * len(words)
        for i in range(len(words) - window + 1):
            run = tuple(words[i : i + window])
            if run in seen:
                gone[i : i + window] = [True] * window
            seen.add(run)
        out.append((len(words), sum(gone), None if text is None else " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def brute_bytes(texts, window):
    data = [(t or "").encode() for t in texts]
    count = {}
    for d in data:
        for i in range(len(d) - window + 1):
            count[d[i : i + window]] = count.get(d[i : i + window], 0) + 1
    out = []
    for d in data:
        gone = [False] * len(d)
        for i in range(len(d) - window + 1):
            if count[d[i : i + window]] > 1:
                gone[i : i + window] = [True] * window
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), spans, bytes(b for b, g in zip(d, gone) if not g)))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_words_against_brute_force(make_docs, seed):
    texts = some_texts(seed)
    found = sorted(substrings.without_repeats(make_docs(texts), window=6, gram=2).collect())
    assert [tuple(r)[1:] for r in found] == brute_words(list(enumerate(texts)), 6)


@pytest.mark.parametrize("seed,window,gram", [(3, 30, 8), (4, 60, 20), (5, 48, 10)])
def test_bytes_against_brute_force(make_docs, seed, window, gram):
    texts = some_texts(seed, words=5)
    found = sorted(suffixes.without_repeats(make_docs(texts), window=window, gram=gram).collect())
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found] == brute_bytes(texts, window)


def test_crowded_buckets_are_split(make_docs, monkeypatch):
    monkeypatch.setattr(superstrings, "CROWD", 2)
    texts = some_texts(6, words=4)
    found = sorted(suffixes.without_repeats(make_docs(texts), window=48, gram=10).collect())
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found] == brute_bytes(texts, 48)


def test_a_line_amid_own_bytes_fills_no_bucket(make_docs, monkeypatch):
    """A line shorter than the window in every text: its windows all differ, but for those of two texts that are nearly equal."""
    monkeypatch.setattr(superstrings, "CROWD", 5)
    draw = random.Random(9)
    own = lambda n: "".join(draw.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(n))
    line = own(150)
    texts = [own(250) + line + own(250) for _ in range(120)]
    texts += [texts[0][:-200] + own(200), texts[1][200:]]
    largest, sort = [], suffixes._sorted

    def watched(contexts, window):
        largest.append(max((r["count"] for r in contexts.groupBy("bucket").count().collect()), default=0))
        return sort(contexts, window)

    monkeypatch.setattr(suffixes, "_sorted", watched)
    found = sorted(suffixes.without_repeats(make_docs(texts)).collect())
    assert [(r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found] == brute_bytes(texts, 200)
    assert largest[0] <= superstrings.CROWD


def test_long_texts_are_taken_in_parts(monkeypatch):
    symbols = np.random.default_rng(1).integers(0, 2**63, 500).astype(np.uint64)
    symbols[300:400] = symbols[50:150]
    bounds = np.array([0, 0, 450, 500])
    whole = superstrings.superstrings(symbols, bounds, 20, 5)
    monkeypatch.setattr(superstrings, "PART", 64)
    parted = superstrings.superstrings(symbols, bounds, 20, 5)
    windows = lambda found: sorted((t, s + i, m) for t, s, n, m, _ in zip(*(x.tolist() for x in found)) for i in range(n))
    assert windows(whole) == windows(parted)


def test_blind_trie_orders_and_groups():
    draw = random.Random(8)
    pool = [bytes(draw.choice(b"ab") for _ in range(12)) for _ in range(60)]
    data = b"".join(pool) + bytes(8)
    trie = BlindTrie(data, 0, 12)
    for i in range(len(pool)):
        trie.add(12 * i)
    leaves = [sorted(x // 12 for x in leaf) for leaf in trie.leaves()]
    expected = {}
    for i, p in enumerate(pool):
        expected.setdefault(p, []).append(i)
    assert leaves == [expected[p] for p in sorted(expected)]


def test_repeated_suffixes_across_groups():
    data = b"abcdefghij" * 2 + b"abcdefghiz"
    at, group = np.array([0, 10, 20]), np.array([1, 1, 1])
    assert suffixes.repeated(data, group, at, 10).tolist() == [True, True, False]
    assert suffixes.repeated(data, np.array([1, 2, 1]), at, 9).tolist() == [True, False, True]


def test_odd_rows_of_words(odd_docs, no_docs):
    found = substrings.without_repeats(odd_docs).collect()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append((r.n_words, r.n_removed, r.kept))
    assert len(found) == odd_docs.count()
    assert by[1] == [(0, 0, None)] and by[2] == by[5] == [(0, 0, "")]
    assert by[6][0][:2] == (30_000, 0) and by[7] == [(30_000, 30_000, "")]
    assert sorted(x[:2] for x in by[8]) == [(6, 0), (7, 0), (7, 0)]
    assert substrings.without_repeats(no_docs).collect() == []
    kept = substrings.cut(odd_docs)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
    assert {r.tag for r in kept.collect()} == {"tag"}


def test_equal_rows_are_treated_alike(spark):
    text = " ".join(f"v{i}" for i in range(30))
    docs = spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")
    for parts in (1, 3):
        found = sorted(tuple(r)[:3] for r in substrings.without_repeats(docs.repartition(parts)).collect())
        assert found == [(1, 30, 0), (1, 30, 0), (2, 30, 30)]


def test_odd_rows_of_bytes(odd_docs, no_docs):
    found = suffixes.without_repeats(odd_docs).collect()
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans))
    assert len(found) == odd_docs.count()
    assert by[1] == by[2] == [(0, 0, 0)] and by[11] == [(5000, 5000, 1)]
    assert by[6] == by[7] and by[6][0][1] == by[6][0][0]
    assert suffixes.without_repeats(no_docs).collect() == []


def test_places_of_equal_rows():
    keys = pa.array([1, None, 1])
    same = superstrings.at_same_place(keys, np.array([0, 1, 2]), np.array([5, 5, 5]), np.array([0, 0, 0]))
    assert same.tolist() == [True, False, True]


def test_cut_keeps_white_space(spark):
    run = [f"v{i}" for i in range(25)]
    texts = [
        "  eins\t" + "\n".join(run) + "\r\n", "def f():\n\treturn  1\n\n", "vor\n\n" + "  ".join(run) + "\tnach é\n", " \t\n",
        "\n" + " ".join(run) + "\n", "a\n\n" + " ".join(run), None, "",
    ]
    docs = spark.createDataFrame([(i, t, len(t or "")) for i, t in enumerate(texts)], "doc_id long, text string, n_chars int")
    found = {r.doc_id: r for r in substrings.cut(docs.coalesce(1)).collect()}
    assert [found[i].text for i in range(len(texts))] == [texts[0], texts[1], "vor\n\nnach é\n", texts[3], "\n", "a\n\n", None, ""]
    assert all(r.n_chars == len(r.text) for r in found.values() if r.text is not None)
