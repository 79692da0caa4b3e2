"""Language identification by rank-order profiles of character n-grams.

A language's profile is its most frequent n-grams (one to three characters, words padded with a
blank) in order of frequency. A document is compared by the out-of-place distance: over its own most
frequent n-grams, the sum of how far each stands from its place in the profile, an absent one
counting as far as can be. The nearest profile wins; equal distances go to the language that sorts first.

Defined cases: a null text, or one without a letter (marks alone are none), is `und` with score 0; rows without a text or a
language teach nothing; without any profile everything is `und`; repeated rows count as often as
they occur; texts of any length are read whole.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelry.llm.common import pieces

UNKNOWN = "und"
PROFILE = 300
SIZES = (1, 2, 3)
_BITS = 21  # of a code point
_TOP = 0x40000  # no letter lies beyond the third plane


@cache
def _letters(kinds: str) -> np.ndarray:
    """Which of the code points below _TOP are of these kinds: L a letter, M a mark on one."""
    return np.fromiter((unicodedata.category(chr(c))[0] in kinds for c in range(_TOP)), bool, _TOP)


def _grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For a few texts: (text, n-gram, count), sorted by text and n-gram.

    An n-gram is its code points in 21 bits each; a blank stands for any run of other characters.
    """
    lowered = [t.lower() for t in texts]
    joined = "\x00".join(["", *lowered, ""])
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    sizes = np.fromiter(map(len, lowered), np.int64, len(lowered))
    owner = np.repeat(np.arange(len(lowered) + 1), np.concatenate([[1], sizes + 1]))  # 1-based; separators belong to the text before
    letter = _letters("LM")[np.minimum(points, _TOP - 1)] & (points < _TOP)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the first blank after a word
    keep[0] = True
    points, owner, letter = np.where(letter, points, 32)[keep], owner[keep], letter[keep]
    after = np.roll(owner, -1)
    owner = np.where(letter, owner, after)  # a blank goes with what follows it
    seen = np.zeros(_TOP, bool)
    seen[points] = True
    symbols = np.flatnonzero(seen)
    code = (np.cumsum(seen) - 1)[points]
    bits = max(int(len(symbols) - 1).bit_length(), 1)
    whole = bits * max(SIZES)
    if whole + 2 + (len(texts) + 1).bit_length() > 62:  # many letters at once: halve the work
        half = len(texts) // 2
        a, b = _grams(texts[:half]), _grams(texts[half:])
        return np.concatenate([a[0], b[0] + half]), np.concatenate([a[1], b[1]]), np.concatenate([a[2], b[2]])
    keys = []
    for size in SIZES:
        n = max(len(code) - size + 1, 0)
        value = np.zeros(n, np.int64)
        for k in range(size):
            value = value << bits | code[k : n + k]
        first, second = letter[:n], letter[min(1, size - 1) : n + min(1, size - 1)]
        inner = first | second if size == 2 else second
        whose = np.where(first, owner[:n], owner[min(1, size - 1) : n + min(1, size - 1)])
        keys.append(((whose << 2 | size) << whole | value)[inner])
    keys = np.concatenate(keys)
    keys.sort()
    first = np.flatnonzero(np.concatenate([keys[:1] == keys[:1], keys[1:] != keys[:-1]]))
    counts = np.diff(np.concatenate([first, [len(keys)]]))
    keys = keys[first]
    text, size = (keys >> whole + 2) - 1, keys >> whole & 3
    gram = np.zeros(len(keys), np.int64)
    for k in range(max(SIZES)):
        digit = symbols[keys >> np.maximum(size - 1 - k, 0) * bits & (1 << bits) - 1]
        gram = np.where(k < size, gram << _BITS | digit, gram)
    return text, gram, counts


def _rows(batch: pa.RecordBatch) -> Iterator[tuple[int, int, list[str]]]:
    texts = batch.column("text")
    for a, b in pieces(texts, 1 << 18):
        yield a, b, [t or "" for t in texts[a:b].to_pylist()]


def learn(docs: DataFrame, profile: int = PROFILE) -> DataFrame:
    """Profiles (lang, gram, place) of the languages of docs, places from 0; equal counts by n-gram."""

    def count(batches):
        held: dict[str, dict[int, int]] = {}
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            for a, b, texts in _rows(batch):
                text, gram, counts = _grams(texts)
                codes = {lang: k for k, lang in enumerate(sorted(set(langs[a:b])))}
                lang = np.array([codes[x] for x in langs[a:b]])[text]
                for name, k in codes.items():
                    own = lang == k
                    grams, where = np.unique(gram[own], return_inverse=True)
                    sums = np.bincount(where, counts[own], len(grams)).astype(np.int64)
                    into = held.setdefault(name, {})
                    for g, c in zip(grams.tolist(), sums.tolist()):
                        into[g] = into.get(g, 0) + c
            if sum(map(len, held.values())) > 200_000:
                yield from flush(held)
        yield from flush(held)

    def flush(held):
        for lang, counts in held.items():
            if counts:
                yield pa.record_batch([pa.array([lang] * len(counts)), pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], names=["lang", "gram", "n"])
        held.clear()

    rows = docs.where("text is not null and lang is not null").select("text", "lang")
    totals = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    return totals.withColumn("turn", turn).where(F.col("turn") <= profile).select("lang", "gram", (F.col("turn") - 1).alias("place"))


def predict(docs: DataFrame, key: str, profiles: DataFrame, profile: int = PROFILE) -> DataFrame:
    """(key, lang_pred, score) of every row; score is one less the distance over the largest possible.

    The profiles, at most `profile` rows a language, go to the tasks as arrays.
    """
    learned = profiles.collect()
    langs = sorted({r["lang"] for r in learned})
    grams = np.array(sorted({r["gram"] for r in learned}), np.int64)
    places = np.full((len(grams) + 1, len(langs)), -1, np.int32)
    for r in learned:
        places[np.searchsorted(grams, r["gram"]), langs.index(r["lang"])] = r["place"]

    def label(batches):
        for batch in batches:
            out_lang, out_score = [], []
            for a, b, texts in _rows(batch):
                lang, score = nearest(texts)
                out_lang += lang
                out_score += score
            yield pa.record_batch([batch.column(key), pa.array(out_lang, pa.string()), pa.array(out_score, pa.float64())], names=[key, "lang_pred", "score"])

    def nearest(texts):
        text, gram, counts = _grams(texts)
        single = gram < 1 << _BITS
        known = np.bincount(text[single][_letters("L")[gram[single]]], minlength=len(texts)) > 0
        if not known.any() or not langs:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        order = np.lexsort((gram, -counts, text))
        text, gram = text[order], gram[order]
        bounds = np.searchsorted(text, np.arange(len(texts) + 1))
        place = np.arange(len(text)) - bounds[text]
        top = place < profile
        text, gram, place = text[top], gram[top], place[top]
        at = np.minimum(np.searchsorted(grams, gram), len(grams) - 1)
        at = np.where(grams[at] == gram, at, len(grams))
        there = places[at]
        far = np.where(there < 0, profile, np.abs(there - place[:, None]))
        size = np.bincount(text, minlength=len(texts))
        total = np.stack([np.bincount(text, far[:, k], len(texts)) for k in range(len(langs))], 1)
        best = total.argmin(1)
        likeness = 1 - total.min(1) / np.maximum(size * profile, 1)
        return [langs[k] if own else UNKNOWN for k, own in zip(best, known)], np.where(known, likeness, 0.0).tolist()

    return docs.select(key, "text").mapInArrow(label, docs.select(key).schema.add("lang_pred", "string").add("score", "double"))


def identify(docs: DataFrame, training: Column, key: str = "doc_id") -> DataFrame:
    """Predict every row of docs after learning from the rows where `training` holds."""
    return predict(docs, key, learn(docs.where(training)))
