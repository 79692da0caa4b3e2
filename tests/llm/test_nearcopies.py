import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from parcelry.llm import nearcopies
from parcelry.llm.components import components


def weights(text):
    words = text.split()
    return Counter([tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else []))


def likeness(a, b):
    return sum((a & b).values()) / max(sum((a | b).values()), 1)


def changed(text, times, draw):
    words = text.split()
    for _ in range(times):
        words[draw.randrange(len(words))] = f"c{draw.randrange(10**6)}"
    return " ".join(words)


def corpus(seed):
    draw = random.Random(seed)
    texts = []
    for _ in range(25):
        base = " ".join(f"v{draw.randrange(3000)}" for _ in range(draw.randint(30, 200)))
        texts.append(base)
        for _ in range(draw.randint(0, 5)):
            base = changed(base, draw.randint(0, 4), draw)  # chains of edits
            texts.append(base)
    texts += ["one line of seven words that repeats"] * 3 + [" ".join(["again and again we say it"] * n) for n in (5, 6, 9)]
    draw.shuffle(texts)
    return texts


def brute(texts):
    sets, parent = [weights(t) for t in texts], list(range(len(texts)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if texts[i] == texts[j] or likeness(sets[i], sets[j]) >= 0.8:
                a, b = root(i), root(j)
                parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("seed", [1, 2])
def test_groups_against_brute_force(make_docs, seed):
    texts = corpus(seed)
    found = {r.doc_id: r.class_id for r in nearcopies.groups(make_docs(texts)).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts)
    kept = {r.doc_id for r in nearcopies.keep_one(make_docs(texts)).collect()}
    assert kept == set(brute(texts))


def test_one_leader_still_finds_all_links(make_docs, monkeypatch):
    monkeypatch.setattr(nearcopies, "LEADERS", 2)
    draw = random.Random(4)
    base = " ".join(f"v{i}" for i in range(60))
    # copies of a base that are near the base but hardly near each other, and a chain
    texts = [base, *(changed(base, 1, draw) for _ in range(25))]
    found = {r.doc_id: r.class_id for r in nearcopies.groups(make_docs(texts)).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts)


def test_darts_estimate_the_weighted_likeness():
    draw = random.Random(7)
    base = [f"v{i % 70}" for i in range(300)]
    other = changed(" ".join(base), 12, draw)
    strips, bounds = nearcopies.units(pa.array([" ".join(base), other, "", "a"]))
    kept = nearcopies.darts(strips, bounds)
    assert (kept[2] == 0).all() and (kept[[0, 1, 3]] != 0).all()
    exact = likeness(weights(" ".join(base)), weights(other))
    assert abs((kept[0] == kept[1]).mean() - exact) < 0.13


def test_signatures_do_not_depend_on_the_batch():
    texts = corpus(3)
    together = nearcopies.darts(*nearcopies.units(pa.array(texts)))
    alone = np.concatenate([nearcopies.darts(*nearcopies.units(pa.array([t]))) for t in texts])
    assert (together == alone).all()


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(200, 200)]
    found = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_odd_rows(odd_docs, no_docs):
    found = [(r.doc_id, r.class_id) for r in nearcopies.groups(odd_docs).collect()]
    assert len(found) == odd_docs.count()
    by = {}
    for k, c in found:
        by.setdefault(k, set()).add(c)
    assert by[1] == {1} and by[2] == by[3] == {2} and by[5] == {5} and by[6] == by[7] == {6} and by[8] == {8}
    assert nearcopies.groups(no_docs).collect() == []
    kept = nearcopies.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    # of the empty and the long texts and the repeated row one each goes
    assert kept.count() == odd_docs.count() - 3
    assert nearcopies.keep_one(no_docs).collect() == []


@pytest.mark.parametrize("block", [2, 1024])
def test_blocks_find_all_links_without_leaders(make_docs, monkeypatch, block):
    """One large group of texts that have drifted apart, and links only between some of them."""
    monkeypatch.setattr(nearcopies, "ROUNDS", 0)
    monkeypatch.setattr(nearcopies, "BLOCK", block)
    draw = random.Random(7)
    base = " ".join(f"b{draw.randrange(500)}" for _ in range(90))
    texts = [base, *[changed(base, draw.randint(0, 8), draw) for _ in range(40)]]
    found = {r.doc_id: r.class_id for r in nearcopies.groups(make_docs(texts)).collect()}
    assert [found[i] for i in range(len(texts))] == brute(texts)


def test_shared_units_slice_by_slice(monkeypatch):
    monkeypatch.setattr(nearcopies, "SLICE", 3)
    draw = np.random.default_rng(5)
    left, right = ([np.unique(draw.integers(0, 40, n)) for n in sizes] for sizes in ([5, 0, 30, 12], [9, 25, 1]))
    expected = [[len(set(a) & set(b)) for b in right] for a in left]
    assert nearcopies._shared(left, right).astype(int).tolist() == expected


def test_sketches_are_compared_once_in_a_plan(spark):
    rng = np.random.default_rng(5)
    a, b = (rng.integers(0, 256, (50, nearcopies._SKETCH * 8), dtype=np.uint8) for _ in range(2))
    b[:, ::3] = a[:, ::3]
    a[:, 125:] = b[:, 125:] = 0
    rows = [(str(i).encode(), x.view(np.int64).tolist(), y.view(np.int64).tolist()) for i, (x, y) in enumerate(zip(a, b))]
    made = spark.createDataFrame(rows, "text_id binary, sketch_a array<long>, sketch_b array<long>")
    found = made.select("text_id", nearcopies._equal("sketch_a", "sketch_b").alias("equal")).collect()
    assert {int(r["text_id"]): r["equal"] for r in found} == {i: int((a[i] == b[i])[:125].sum()) for i in range(50)}
    inside = "text_id binary, bucket long, component binary, size long, sketch array<long>, met long"
    led = nearcopies._led(spark.createDataFrame([], inside), 0, 0.8)
    plan = led._jdf.queryExecution().optimizedPlan().toString()
    assert 0 < plan.count(" ^ ") <= 2 * nearcopies._SKETCH
