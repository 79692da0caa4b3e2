"""The automaton and the secret scan against the standard regular expressions."""

import random
import re

import pyarrow as pa
import pytest

from parcelry.llm import secrets
from parcelry.llm.automaton import compiled, parse

SCANNER = secrets.Scanner(secrets.RULES)


def brute(text):
    out = []
    for k, rule in enumerate(secrets.RULES):
        for m in re.finditer(rule.pattern, text or "", re.ASCII | (re.IGNORECASE if rule.either_case else 0)):
            if len(m[0]) >= rule.least and (not rule.least_value or len(m[2]) >= rule.least_value):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def made(seed, n=400):
    draw = random.Random(seed)
    bits = [
        "password", "PassWd", "secret", "token", "api_key", "apikey", "API_KEY", "AKIA", "AKIAABCD1234", "0123456789abcdef", "deadbeef", "=", ":", " ", "  ", '"', "'",
        "\n", ", ", "é", "🙂", "abc", "token", "XYZ9", "-----BEGIN ", "RSA ", "PRIVATE KEY-----", "eyJ", "ghp_", "npm_", "A1b2C3d4E5f6G7h8", ".", "_",
    ]
    return ["".join(draw.choice(bits) for _ in range(draw.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("longest", [secrets.SIDE_BY_SIDE, 3])
def test_against_regular_expressions(monkeypatch, longest):
    monkeypatch.setattr(secrets, "SIDE_BY_SIDE", longest)
    texts = [*made(1), None, "", "password=" + "x" * 20_000, "token:token:abcdefgh", "password: token: abcdefgh", "f" * 23 + ",", "f" * 24]
    found = SCANNER.spans(pa.array(texts))
    assert found == [brute(t) for t in texts]
    assert sum(map(len, found)) > 150


@pytest.mark.parametrize("pattern", ["a", "(a|b)*c", "a?b{2}", "[^a-y]+z", "a{1,3}b*", "(ab|a)(c|bcd)", r"\x20\.\n", "(a?){3}b"])
def test_automaton_against_fullmatch(pattern):
    made, whole = compiled([(pattern, False)], anywhere=False), re.compile(pattern)
    draw = random.Random(pattern)
    for _ in range(400):
        text = "".join(draw.choice("abcdz .\n") for _ in range(draw.randint(0, 6)))
        state = 0
        for byte in text.encode():
            state = made.table[state, byte]
        assert bool(made.accepts[state]) == bool(whole.fullmatch(text)), text


def test_automaton_is_least():
    assert len(compiled([("(a|b)(c|d)|(a|b)c", False)], anywhere=False).accepts) == 4
    assert compiled([("a", True)], anywhere=False).accepts[compiled([("a", True)], anywhere=False).table[0, ord("A")]] == 1


@pytest.mark.parametrize("pattern", ["a.b", "^a", "a)", r"\d", "é"])
def test_unknown_forms_are_errors(pattern):
    with pytest.raises(ValueError):
        parse(pattern)


def test_rules_of_one_class_are_met_by_runs():
    texts = pa.array(["ab cd " * 30, "0" * 24, "a" * 23 + " " + "b" * 23])
    assert [[s for s in spans if s[1] == 2] for spans in SCANNER.spans(texts)] == [[], [(0, 2, 24)], []]


def test_odd_rows(odd_docs, no_docs):
    found = secrets.find(odd_docs)
    rows = found.collect()
    assert found.columns == [*odd_docs.columns, "secrets"] and len(rows) == odd_docs.count()
    names = [r.kind for r in secrets.RULES]
    for r in rows:
        assert [(s.start, names.index(s.kind), s.end) for s in r.secrets] == brute(r.text)
        assert r.tag == "tag"
    assert secrets.find(no_docs).collect() == []
    assert secrets.find(found).columns == found.columns
