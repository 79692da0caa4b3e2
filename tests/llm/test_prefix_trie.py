"""The trie against a plain version that walks every conversation."""

import hashlib
import random
import re
import zlib

import pytest

from parcelry.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, node string, depth string, conv string, part string"


def digest(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, digest(role or "", text or ""), role or "", text or ""))
    own = {c: [(role, text) for *_, role, text in sorted(turns)] for c, turns in convs.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - c % 20, [])[:h] + own[c][h:]
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for node, of in members.items():
        under = [n for n in members if n[: len(node)] == node]
        leaves = [n for n in under if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in under)]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in under if n)
        ends = ",".join(str(c) for c in sorted(of) if len(whole[c]) == len(node))
        out.append((
            min(of), len(node), min(members[node[:-1]]) if node else None, len(of),
            sum(len(n) == len(node) + 1 for n in under), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=str)


def found(spark, rows, **options):
    df = spark.createDataFrame([(*r, "n", "d", "c", "p") for r in rows], SCHEMA).repartition(3)
    return sorted((tuple(r) for r in prefix_trie.trie(df, **options).collect()), key=str)


def made(seed, convs=70, texts=3):
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(200), convs):
        for turn in range(draw.choice([1, 2, 3, 5, 9])):
            rows.append((c, turn, draw.choice(["user", "tool"]) if turn % 2 else "user", " ".join(["w"] * draw.randint(1, texts))))
    return rows


@pytest.mark.parametrize("options", [{}, {"local": 1, "chunk": 2}])
def test_against_brute_force(spark, options):
    rows = made(1)
    assert found(spark, rows, **options) == brute(rows)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    rows = [(c, t, "user", f"turn {t}") for c in (0, 40) for t in range(30)]
    rounds, split = [], prefix_trie._round
    monkeypatch.setattr(prefix_trie, "_round", lambda *x: rounds.append(1) or split(*x))
    assert found(spark, rows, local=2, chunk=8) == brute(rows)
    assert len(rounds) <= 7


def test_odd_rows(spark):
    long = " ".join(["lang"] * 50_000)
    rows = [
        (None, 1, "user", "nobody's"), (1, None, None, None), (1, None, "user", None), (1, 3, None, "a b"), (1, 3, "user", "c"), (1, 3, "user", "c"),
        (2, 0, "user", ""), (2, 1, "", "x\ty\n"), (21, 5, "user", long), (21, 6, "user", long), (22, 0, "user", long), (45, 0, "a", "b"), (46, 0, "ab", ""),
        (7, 1, "", ""),
    ]
    assert found(spark, rows) == brute(rows)


def test_nothing(spark):
    assert found(spark, []) == [] and found(spark, [(None, 1, "user", "x")]) == []


def test_more_ends_than_one_list(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "LISTED", 3)
    rows = [(20 * c, 0, "user", "same") for c in range(25)]
    assert found(spark, rows) == brute(rows)
