"""Benchmark decontamination: size-partitioned MinHash containment search, verified by shingles.

Items are partitioned by their number of words; class c holds items of up to LEAST_WORDS * 2**c words, the
bound. Each class has bands of one row; a row's minimum is the least of an item's distinct shingles (five words,
lower-cased) by the row's hash. A document shares the band if it has this shingle anywhere, which is as likely as the
share of the item it holds, however long it is and wherever the parts stand. A class has as many bands as make a miss of
a document with NEAR of an item less likely than MISS. Items that share a band are verified by exact
containment: the share of the item's distinct shingles that the whole document has.

A document holds an item if it contains NEAR of it or more, in one piece or with other words in between. Items of
fewer words than a shingle are a class of their own, without bands: a document holds one where all its words stand in a row.

Items are a query set, sent to the tasks in blocks of at most BLOCK_SHINGLES shingles; every block
scans all documents.

Defined cases: null texts and items hold nothing, nor do items without words; an item of one common word is held by every
document with that word; repeated items each report;
repeated document keys report once per row; whole texts are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelry.llm.common import NEAR, SHINGLE_WORDS, Words, mapped, mix, pieces, salted, shingles

LEAST_WORDS = 8
MISS = 1e-7
BLOCK_SHINGLES = 1 << 20


def bands(bound: int, near: float = NEAR) -> int:
    """Rows, each a band, that find an item of the class in a document that holds it but for MISS."""
    share = min(math.ceil(near * n) / n for n in range(1, bound - SHINGLE_WORDS + 2))
    return 1 if share == 1 else math.ceil(math.log(MISS) / math.log(1 - share))


def size_class(words: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(np.maximum(words, LEAST_WORDS) / LEAST_WORDS)).astype(np.int64)


class Block:
    """Items to look for: their shingles, and which items' bands hold a shingle."""

    def __init__(self, ids: list, texts: list[str]):
        words = Words(pa.array(texts, pa.string()), lower=True)
        grams, bounds = shingles(words.hashes(), words.bounds)
        counts = np.diff(words.bounds)
        kinds = size_class(counts)
        self.ids = np.array(ids)
        self.runs = {n: _by_run(grams[bounds[:-1][counts == n]], np.flatnonzero(counts == n)) for n in np.unique(counts).tolist() if 0 < n < SHINGLE_WORDS}
        sizes = np.where(counts < SHINGLE_WORDS, 0, np.diff(bounds))
        grams = grams[np.repeat(sizes > 0, np.diff(bounds))]
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        self.all, number = np.unique(grams, return_inverse=True)
        self.sets = [np.unique(number[a:b]) for a, b in zip(bounds, bounds[1:])]
        self.held = np.zeros(len(self.all), bool)
        self.sieve = np.zeros(1 << 24, bool)
        self.sieve[self.all >> np.uint64(40)] = True
        least, whose = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for kind in np.unique(kinds).tolist():
            members = np.array([i for i in np.flatnonzero(kinds == kind) if len(self.sets[i])], np.int64)
            if not len(members):
                continue
            sizes = np.array([len(self.sets[i]) for i in members])
            own = np.concatenate([self.sets[i] for i in members])
            for salt in salted(kind + 1, bands(LEAST_WORDS << kind)):
                row = mix(self.all[own] ^ salt)
                low = np.minimum.reduceat(row, np.cumsum(sizes) - sizes)
                least.append(own[row == np.repeat(low, sizes)])  # one an item, its shingles being distinct
                whose.append(members)
        least, whose = np.concatenate(least), np.concatenate(whose)
        order = np.argsort(least, kind="stable")
        self.members = whose[order]
        self.bounds = np.searchsorted(least[order], np.arange(len(self.all) + 1))

    def hits(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of the shingles that belong to any item, and their numbers in `all`."""
        at = np.flatnonzero(self.sieve[grams >> np.uint64(40)])
        if not len(self.all):
            return at[:0], at[:0]
        found = np.minimum(np.searchsorted(self.all, grams[at]), len(self.all) - 1)
        same = self.all[found] == grams[at]
        return at[same], found[same]

    def find(self, numbers: np.ndarray) -> Iterator[tuple[int, float]]:
        """(item's place, containment) of one document; numbers: the shingles it has."""
        numbers = np.unique(numbers)
        members = [self.members[a:b] for a, b in zip(self.bounds[numbers], self.bounds[numbers + 1]) if a < b]
        if not members:
            return
        self.held[numbers] = True
        shares = [(item, float(self.held[self.sets[item]].mean())) for item in np.unique(np.concatenate(members)).tolist()]
        self.held[numbers] = False
        yield from ((item, share) for item, share in shares if share >= NEAR)


    def find_short(self, hashes: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int]]:
        """(text, item's place) of the items of fewer words than a shingle; hashes: the words of the texts."""
        for n, (runs, members, cuts) in self.runs.items():
            own, own_bounds = shingles(hashes, bounds, n)
            number = np.minimum(np.searchsorted(runs, own), len(runs) - 1)
            at = np.flatnonzero(runs[number] == own)
            text = np.searchsorted(own_bounds, at, "right") - 1
            for i, k in np.unique(np.stack([text, number[at]]), axis=1).T.tolist():
                yield from ((i, item) for item in members[cuts[k] : cuts[k + 1]].tolist())


def _by_run(runs: np.ndarray, members: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct runs in order, and for run k the members[cuts[k] : cuts[k + 1]]."""
    order = np.argsort(runs, kind="stable")
    distinct, cuts = np.unique(runs[order], return_index=True)
    return distinct, members[order], np.append(cuts, len(order))


def _blocks(items: DataFrame, item_key: str) -> Iterator[list]:
    """Items in blocks of a bounded number of words, an item of more alone."""
    block, held = [], 0
    for row in items.select(item_key, "text").where(f"text is not null and {item_key} is not null").toLocalIterator():
        n = len(row["text"].split())
        if block and held + n > BLOCK_SHINGLES:
            yield block
            block, held = [], 0
        block.append((row[item_key], row["text"]))
        held += n
    if block:
        yield block


def contained(docs: DataFrame, items: DataFrame, key: str = "doc_id", item_key: str = "item_id") -> DataFrame:
    """(key, item_key, containment) of each document that holds NEAR or more of an item."""
    spark = docs.sparkSession
    schema = docs.select(key).schema.add(item_key, items.schema[item_key].dataType).add("containment", "double")
    found = []
    for block in _blocks(items, item_key):
        sent = spark.sparkContext.broadcast(tuple(zip(*block)))
        found.append(mapped(docs.select(key, "text").where("text is not null"), _search(sent, key, item_key), schema))
    out = found[0] if found else docs.limit(0).select(key).withColumn(item_key, F.lit(None).cast(items.schema[item_key].dataType)).withColumn("containment", F.lit(None).cast("double"))
    for part in found[1:]:
        out = out.unionByName(part)
    return out


def _held(block: Block, texts: pa.Array) -> Iterator[tuple[int, int, float]]:
    """(text, item's place, containment) of a batch."""
    for a, b in pieces(texts):
        words = Words(texts[a:b], lower=True)
        hashes = words.hashes()
        grams, bounds = shingles(hashes, words.bounds)
        hits, numbers = block.hits(grams)
        cuts = np.searchsorted(hits, bounds)
        for i in np.flatnonzero(np.diff(cuts)).tolist():
            for item, share in block.find(numbers[cuts[i] : cuts[i + 1]]):
                yield a + i, item, share
        for i, item in block.find_short(hashes, words.bounds):
            yield a + i, item, 1.0


def _search(sent, key: str, item_key: str):
    def search(batches):
        block = Block(*map(list, sent.value))
        for batch in batches:
            found = list(_held(block, batch.column("text")))
            rows, items, shares = zip(*found) if found else ((), (), ())
            yield pa.record_batch(
                [batch.column(key).take(pa.array(rows, pa.int64())), pa.array(block.ids[list(items)]), pa.array(shares, pa.float64())],
                names=[key, item_key, "containment"],
            )

    return search


def clean(docs: DataFrame, items: DataFrame, item_key: str = "item_id") -> DataFrame:
    """The rows of docs that hold no item, as they are. Nothing is shuffled."""
    for block in _blocks(items, item_key):
        sent = docs.sparkSession.sparkContext.broadcast(tuple(zip(*block)))
        docs = mapped(docs, _without(sent), docs.schema)
    return docs


def _without(sent):
    def without(batches):
        block = Block(*map(list, sent.value))
        for batch in batches:
            dirty = np.zeros(batch.num_rows, bool)
            for row, _, _ in _held(block, batch.column("text")):
                dirty[row] = True
            yield batch.filter(pa.array(~dirty))

    return without
