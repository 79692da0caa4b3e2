import random

import pytest


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and columns with names that operators use inside."""
    words = [f"w{i}" for i in range(40)]
    draw = random.Random(3)
    long = " ".join(draw.choice(words) for _ in range(30_000))
    rows = [
        (None, "ein text ohne nummer"), (None, None), (1, None), (2, ""), (3, ""), (4, "a"), (5, " \t\n"), (6, long), (7, long),
        (8, "one two three four five six seven"), (8, "one two three four five six seven"), (8, "another text under the same key"),
        (9, "12 34 !! ??"), (10, "▁ é 漢字 🙂 \x00 end"), (11, "x" * 5000), (12, "Licensed under CC BY-NC 4.0."),
    ]
    names = "score bucket spans tag key place size kept held_out rest packed label band row n"
    schema = "doc_id long, text string, " + ", ".join(f"{n} string" for n in names.split())
    return spark.createDataFrame([(*r, *names.split()) for r in rows], schema)


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return odd_docs.limit(0)


@pytest.fixture
def make_docs(spark):
    def make(texts):
        return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)

    return make
