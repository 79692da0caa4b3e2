"""The pipeline against a brute-force version of each stage on the smallest tables."""

import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from parcelry.llm import pieces, toxicity
from parcelry.llm.common import crc_mod, table
from test_containment import brute as brute_items
from test_nearcopies import brute as brute_groups

FOLDER = "/root/testdata/sf0.001"


def brute_cut(texts, window=20):
    """The texts without words under a window that has started before, each with the white space after it."""
    seen, out = set(), []
    for text in texts:
        words = list(re.finditer(r"[^\x20\x09-\x0D]+", text or ""))
        gone = set()
        for i in range(len(words) - window + 1):
            run = tuple(w[0] for w in words[i : i + window])
            if run in seen:
                gone.update(range(i, i + window))
            seen.add(run)
        kept, at = [], 0
        for i, word in enumerate(words):
            if i in gone:
                kept.append(text[at : word.start()])
                at = words[i + 1].start() if i + 1 < len(words) else len(text)
        out.append(None if text is None else "".join(kept) + text[at:])
    return out


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs, out = table(spark, FOLDER, "documents"), []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"file://{folder}/{i}")
        docs = spark.read.parquet(f"file://{folder}/{i}")
        out.append({r["doc_id"]: r for r in docs.collect()})
    return out


def test_stages(spark, steps):
    docs = table(spark, FOLDER, "documents")
    weights = toxicity.fit(docs, table(spark, FOLDER, "labels"), "toxic", crc_mod(F.col("doc_id"), 5) != 0)
    score = {r.doc_id: r.score for r in toxicity.score(docs, weights).collect()}
    assert set(steps[0]) == {k for k, s in score.items() if s < 0.5}
    keys = sorted(steps[0])
    groups = brute_groups([steps[0][k].text for k in keys])
    assert set(steps[1]) == {keys[g] for g in groups}
    keys = sorted(steps[1])
    assert [steps[2][k].text for k in keys] == brute_cut([steps[1][k].text for k in keys])
    assert all(r.n_chars == len(r.text) for r in steps[2].values())
    keys = sorted(steps[2])
    items = [(r.item_id, r.text) for r in table(spark, FOLDER, "benchmark").collect()]
    dirty = {keys[d] for d, _ in brute_items([steps[2][k].text for k in keys], items, lambda t: t.lower().split())}
    assert set(steps[3]) == set(keys) - dirty
    vocabulary = pieces.read_vocabulary(pieces.MODEL)
    assert set(steps[4]) == set(steps[3])
    for k, r in steps[4].items():
        assert r.lossless and b"".join(vocabulary.texts[i] for i in r.piece_ids)[1:].decode() == steps[3][k].text


def test_columns_stay(spark, steps):
    columns = table(spark, FOLDER, "documents").columns
    assert all(list(next(iter(s.values())).asDict()) == columns for s in steps[:4])


def test_run_has_the_rows_of_the_stages(spark, steps):
    assert {r.doc_id: r.piece_ids for r in corpus_pipeline.run(spark, FOLDER).collect()} == {k: r.piece_ids for k, r in steps[4].items()}
