import random
import re

import pytest
from pyspark.sql import functions as F

from made_texts import some_texts
from parcelry.llm import decontaminate, licenses


def shingles(words):
    return [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])


def brute(docs, items, split, anywhere=True):
    """(document's place, item) to the share of the item's shingles in the document; `anywhere`: an item of fewer words
    than five is held where they stand in a row, else only as the whole text.
    """
    out = {}
    for d, text in enumerate(docs):
        words = split(text or "")
        own = set(shingles(words))
        for name, item in items:
            asked = split(item or "")
            n = len(asked)
            if 0 < n < 5 and anywhere:
                share = float(any(words[i : i + n] == asked for i in range(len(words) - n + 1)))
            else:
                share = len(set(shingles(asked)) & own) / max(len(set(shingles(asked))), 1)
            if share >= 0.8:
                out[d, name] = round(share, 9)
    return out


def planted(seed):
    draw = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(500)]
    items = [(i, " ".join(draw.choice(vocabulary) for _ in range(n))) for i, n in enumerate([3, 5, 6, 8, 9, 15, 16, 17, 30, 40, 70, 12, 25])]
    docs = some_texts(seed, n=20)
    for i, item in items * 3:
        words = item.split()
        if draw.random() < 0.6:
            words[draw.randrange(len(words))] = "changed"
        around = [[draw.choice(vocabulary) for _ in range(draw.randint(0, 90))] for _ in range(2)]
        docs.append(" ".join(around[0] + words + around[1]))
    return [*docs, None, "", items[0][1], items[1][1].upper()], [*items, (98, None), (99, "")]


@pytest.mark.parametrize("block", [1 << 20, 40])
def test_decontamination_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_SHINGLES", block)
    docs, items = planted(5)
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    expected = brute(docs, items, lambda t: t.lower().split(), True)
    found = {(r.doc_id, r.item_id): round(r.containment, 9) for r in decontaminate.contained(table, asked).collect()}
    assert found == expected and len(expected) > 20
    clean = {r.doc_id for r in decontaminate.clean(table, asked).collect()}
    assert clean == set(range(len(docs))) - {d for d, _ in expected}


@pytest.mark.parametrize("block", [4096, 30])
def test_licenses_against_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(licenses, "BLOCK_SHINGLES", block)
    docs, items = planted(6)
    named = [(f"t{i}", t) for i, t in items]
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    known = spark.createDataFrame(named, "template string, text string")
    expected = brute(docs, named, lambda t: [w for w in re.split(r"[\W_]+", t.lower()) if w], False)
    found = {(r.doc_id, r.template): round(r.containment, 9) for r in licenses.scan(table, known).collect()}
    assert found == expected and len(expected) > 20


def test_odd_rows(spark, odd_docs, no_docs):
    found = licenses.scan(odd_docs, licenses.templates(spark)).collect()
    assert [(r.doc_id, r.template, r.containment) for r in found] == [(12, "cc-by-nc-line", 1.0)]
    assert licenses.scan(no_docs, licenses.templates(spark)).collect() == []
    assert licenses.scan(odd_docs, licenses.templates(spark).limit(0)).collect() == []
    items = spark.createDataFrame([(1, "one two three four five six seven"), (2, None)], "item_id long, text string")
    assert sorted(tuple(r) for r in decontaminate.contained(odd_docs, items).collect()) == [(8, 1, 1.0), (8, 1, 1.0)]
    assert decontaminate.contained(no_docs, items).collect() == []
    assert decontaminate.contained(odd_docs, items.limit(0)).collect() == []
    kept = decontaminate.clean(odd_docs, items)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 2


def test_short_items_are_found_inside_texts(spark):
    docs = ["one two alpha beta gamma three four", "alpha beta", "Alpha  beta\ngamma", "beta alpha gamma x y z", "", None]
    items = [(1, "alpha beta gamma"), (2, "GAMMA"), (3, "alpha beta gamma"), (4, " "), (5, "beta gamma")]
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").coalesce(1)
    asked = spark.createDataFrame(items, "item_id long, text string")
    found = sorted(tuple(r) for r in decontaminate.contained(table, asked).collect())
    assert found == [(d, i, 1.0) for d, i in ((0, 1), (0, 2), (0, 3), (0, 5), (2, 1), (2, 2), (2, 3), (2, 5), (3, 2))]
    assert [r.doc_id for r in decontaminate.clean(table, asked).collect()] == [1, 4, 5]


def test_licences_tell_their_kin_apart(spark):
    texts = dict(licenses.TEMPLATES)
    asked = ["mit-text", "mit-0-text", "bsd-2-text", "bsd-3-text", "isc-text", "0bsd-text", "gpl-2-notice", "lgpl-3-notice", "agpl-3-notice", "zlib-text"]
    docs = spark.createDataFrame([(k, "File one.\n" + texts[k].replace(", ", ",\n") + "\nMore words follow here.") for k in asked], "doc_id string, text string")
    found = licenses.scan(docs, licenses.templates(spark)).where("containment = 1").groupBy("doc_id").agg(F.collect_set("template").alias("t")).collect()
    held = {r.doc_id: {t for t in r.t if not t.startswith("warranty")} for r in found}
    assert all(k in held[k] for k in asked)
    assert "mit-text" not in held["mit-0-text"] and "bsd-3-text" not in held["bsd-2-text"] and "isc-text" not in held["0bsd-text"]
    assert not {"gpl-2-notice", "gpl-3-notice", "agpl-3-notice"} & held["lgpl-3-notice"]
    assert held["zlib-text"] == {"zlib-text"}


def test_no_python_on_the_native_path(spark, odd_docs):
    plan = licenses.scan(odd_docs, licenses.templates(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def interrupted():
    """Texts that hold most of an item with other words in between, at every offset; the items; and what each text holds."""
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in (32, 59)]
    docs = []
    for (n, item), between in ((items[0], 10), (items[0], 20), (items[1], 40), (items[1], 4000)):
        words = item.split()
        for offset in range(0, 32, 3):
            docs.append((n, " ".join([f"a{k}" for k in range(offset)] + words[: n // 2] + [f"b{k}" for k in range(between)] + words[n // 2 :] + ["c"] * 90)))
    expected = {(d, n): round((n - 8) / (n - 4), 9) for d, (n, _) in enumerate(docs)}
    return [text for _, text in docs], items, expected


def test_interrupted_items_are_found_anywhere(spark):
    docs, items, expected = interrupted()
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id long, text string")
    assert {(r.doc_id, r.item_id): round(r.containment, 9) for r in decontaminate.contained(table, asked).collect()} == expected
    assert decontaminate.clean(table, asked).collect() == []


def test_interrupted_licenses_are_found_anywhere(spark):
    docs, items, expected = interrupted()
    table = spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string")
    known = spark.createDataFrame(items, "template long, text string")
    assert {(r.doc_id, r.template): round(r.containment, 9) for r in licenses.scan(table, known).collect()} == expected
