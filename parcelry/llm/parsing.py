"""Document fingerprints by locally consistent parsing.

A text is a row of names, first its code points. One level: runs of an equal name become one name;
deterministic coin tossing, repeated, gives each name a small label that depends on a few left
neighbours and differs from the next one; a phrase begins where the label is least among its neighbours; a
phrase's name is the hash of its names. Phrases are bounded in length, and where they begin depends on the
neighbourhood alone, so equal substrings get equal names inside, wherever they stand.

The fingerprint keeps, in SLOTS slots, 16 bits of the least name of the levels from LEAST_LEVEL on (of every
level for texts that have no higher one); the likeness of two is the share of equal slots among those that either has filled.

Defined cases: a null text counts as empty; the fingerprints of two empty texts are alike (1), an empty and
another text's are not (0); equal texts have equal fingerprints; keys are taken in ascending order, null
first and equal ones by text; the next of the last is the first, and a table of one row is its own next. Comparing
with the next text needs a numeric key; fingerprints alone take any.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelry.functions.columns import with_bucket
from parcelry.llm.common import mix

LEVELS = 5
LEAST_LEVEL = 2
TOSSES = 3
SLOTS = 64
EMPTY = 0xFFFF
_PIECE = 1 << 18


def _toss(labels: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Twice the lowest bit in which a label differs from the one to the left, plus that bit."""
    left = np.empty_like(labels)
    left[1:] = labels[:-1]
    left[first] = ~labels[first]
    differ = labels ^ left
    at = np.bitwise_count((differ & -differ) - labels.dtype.type(1))
    return (2 * at + ((labels >> at.astype(labels.dtype)) & labels.dtype.type(1)).astype(np.uint8)).astype(np.uint8)


def _level(names: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The names of the phrases of each row of names, and the new bounds; no row may be empty."""
    starts = np.zeros(len(names), bool)
    starts[bounds[:-1]] = True
    new = starts.copy()
    new[1:] |= names[1:] != names[:-1]
    at = np.flatnonzero(new)
    if len(at) < len(names):
        long = np.diff(np.append(at, len(names))).astype(np.uint64)
        names = np.where(long > 1, mix(names[at] + long * np.uint64(0xC2B2AE3D27D4EB4F)), names[at])
        starts = starts[at]
    first = np.flatnonzero(starts)
    labels = names
    for _ in range(TOSSES):
        labels = _toss(labels, first)
    low = np.empty(len(labels), bool)
    low[1:] = labels[1:] < labels[:-1]
    rising = labels[:-1] <= labels[1:]
    rising[first[1:] - 1] = True  # the last of a row has nothing to its right
    low[:-1] &= rising
    low[first] = True
    begin = np.flatnonzero(low)
    place = np.arange(len(names)) - np.repeat(begin, np.diff(np.append(begin, len(names))))
    spread = mix(names + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    phrases = mix(np.add.reduceat(spread, begin))
    return phrases, np.append(np.searchsorted(begin, first), len(begin))


def _sketch(texts: list[str]) -> np.ndarray:
    out = np.full((len(texts), SLOTS), np.iinfo(np.uint64).max, np.uint64)
    some = np.flatnonzero([bool(t) for t in texts])
    if len(some):
        bounds = np.concatenate([[0], np.cumsum([len(texts[i]) for i in some])])
        names = mix(np.frombuffer("".join(texts[i] for i in some).encode("utf-32-le", "surrogatepass"), np.uint32) + np.uint64(7))
        for level in range(1, LEVELS + 1):
            names, bounds = _level(names, bounds)
            sizes = np.diff(bounds)
            # a text with one phrase left has nothing higher; so every text fills a slot
            use = np.repeat((sizes == 1) | (level >= LEAST_LEVEL), sizes)
            scrambled = mix(names[use] + np.uint64(level))
            owner = np.repeat(some, sizes)[use]
            where = owner * SLOTS + (scrambled >> np.uint64(58)).astype(np.int64)
            order = np.argsort(where)
            where, scrambled = where[order], scrambled[order]
            top = np.flatnonzero(np.append(True, where[1:] != where[:-1])) if len(where) else np.zeros(0, np.int64)
            flat = out.reshape(-1)
            if len(top):
                flat[where[top]] = np.minimum(flat[where[top]], np.minimum.reduceat(scrambled, top))
            more = sizes > 1
            if not more.any():
                break
            names, some = names[np.repeat(more, sizes)], some[more]
            bounds = np.concatenate([[0], np.cumsum(sizes[more])])
    small = mix(out) & np.uint64(0xFFFF)
    return np.where(out == np.iinfo(np.uint64).max, EMPTY, np.minimum(small, np.uint64(EMPTY - 1))).astype(np.uint16)


def sketches(texts: list[str]) -> np.ndarray:
    """A row of SLOTS 16-bit numbers for each text; EMPTY where a slot has nothing."""
    parts, first, size = [np.zeros((0, SLOTS), np.uint16)], 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= _PIECE or i == len(texts) - 1:
            parts.append(_sketch(texts[first : i + 1]))
            first, size = i + 1, 0
    return np.concatenate(parts)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal slots among those that either sketch has filled; 1 for two empty ones."""
    filled = (a != EMPTY) | (b != EMPTY)
    n = filled.sum(1)
    return np.where(n > 0, ((a == b) & filled).sum(1) / np.maximum(n, 1), 1.0)


def _hex(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes().hex() for r in rows.astype(">u2")], pa.string())


def fingerprint(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, fingerprint) of every row, in hexadecimal."""

    def run(batches):
        for batch in batches:
            rows = sketches([t or "" for t in batch.column("text").to_pylist()])
            yield pa.record_batch([batch.column(key), _hex(rows)], names=[key, "fingerprint"])

    return docs.select(key, "text").mapInArrow(run, T.StructType([docs.schema[key], T.StructField("fingerprint", T.StringType())]))


def in_order(docs: DataFrame, key: str, parts: int) -> DataFrame:
    """docs in `parts` ranges of the key, sorted, each followed by the first row of the next range.

    Adds `bucket` and `tail`, which marks such a copy; the last range is followed by the first row of all.
    Only the cuts and the ranges that have rows, `parts` at most, go through the driver.
    """
    if not isinstance(docs.schema[key].dataType, T.NumericType):
        raise ValueError(f"Texts are ordered by a numeric key; '{key}' is {docs.schema[key].dataType.simpleString()}")
    number = F.col(key).cast("double")
    cuts = docs.select(number.alias("x")).approxQuantile("x", [i / parts for i in range(1, parts)], 0.1 / parts) if parts > 1 else []
    edges = [float("-inf"), *sorted(set(cuts)), float("inf")]
    rows = with_bucket(docs.select(key, "text", number.alias("__x")), "__x", edges)
    rows = rows.select(key, "text", F.coalesce("bucket", F.lit(-1)).alias("bucket"))
    least = rows.groupBy("bucket").agg(F.min(key).alias(key)).orderBy("bucket").collect()
    follows = [(least[i]["bucket"], least[(i + 1) % len(least)]["bucket"], least[(i + 1) % len(least)][key]) for i in range(len(least))]
    schema = T.StructType([T.StructField("__to", T.IntegerType()), T.StructField("bucket", T.IntegerType()), T.StructField("__least", docs.schema[key].dataType)])
    next_of = F.broadcast(docs.sparkSession.createDataFrame(follows, schema))
    first = rows.join(next_of, "bucket").where(F.col(key).eqNullSafe(F.col("__least")))
    first = first.groupBy("__to", key).agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    first = first.select(key, "text", F.col("__to").alias("bucket"), F.lit(True).alias("tail"))
    both = rows.withColumn("tail", F.lit(False)).unionByName(first)
    spread = docs.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return both.repartition(int(spread), "bucket").sortWithinPartitions("bucket", "tail", key, "text")


def compare_edited(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Fingerprints of each text, of its edited text, and their likeness; see the columns below.

    The edited text keeps the first half and takes, instead of its last n // 2 code points, the first as many of the next
    text in order of the key.
    """
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = T.StructType(
        [
            docs.schema[key],
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )

    def run(batches):
        kept = None
        for batch in batches:
            for a in range(0, batch.num_rows, 1000):
                rows = pa.Table.from_batches([batch.slice(a, 1000)])
                rows = pa.concat_tables([kept, rows]).combine_chunks() if kept is not None else rows
                yield pair(rows)
                kept = rows.slice(rows.num_rows - 1)  # the last waits for its next

    def pair(rows):
        texts = [t or "" for t in rows.column("text").to_pylist()]
        own = [i for i, t in enumerate(rows.column("tail").to_pylist()[:-1]) if not t]
        following = [texts[i + 1] for i in own]
        mine = [texts[i] for i in own]
        edited = [t[: len(t) - len(t) // 2] + n[: len(t) // 2] for t, n in zip(mine, following)]
        plain, changed = sketches(texts), sketches(edited)
        at = np.array(own, np.int64)
        shas = [hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edited]
        columns = [
            rows.column(key).take(pa.array(at)).combine_chunks(), pa.array([len(t) for t in mine], pa.int64()), pa.array(shas, pa.string()),
            _hex(plain[at]), _hex(changed), pa.array(likeness(plain[at], changed)), pa.array(likeness(plain[at], plain[at + 1])),
        ]
        return pa.record_batch(columns, names=schema.names)

    return in_order(docs, key, 8 * spread).mapInArrow(run, schema)
