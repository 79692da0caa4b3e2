"""Repeated windows of symbols: what byte and word deduplication share.

A window is `window` consecutive symbols of one text. It is named by its minimizer, the
least-hashed run of `gram` symbols in it, so that equal windows have equal names wherever they stand.
Consecutive windows of a text with the same minimizer form a superstring; their number is a fraction of the
number of windows. Equal superstrings repeat as a whole and are settled by comparing their names
and hashes. Only a minimizer that stands in different superstrings leaves its windows to be compared one by one,
and of equal superstrings only the first one's.

Places are ordered by (key, start). A row's place carries 24 bits of its text's hash besides the start, so
that rows of one key and different texts are kept apart; such rows count as one document.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelry.llm.common import mapped, mix, pieces, powers, prefix_sums

TAG_BITS = 24
#: Symbols handled at once; a longer text is taken in overlapping parts.
PART = 1 << 21
_PLACE_BITS = np.uint64(24)
#: Contents of a minimizer from which its bucket is split.
CROWD = 1000
#: Kinds of a superstring: the only one or first of its batch, the first of several in it, a later one.
FIRST, REPEATED, LATER = 0, 1, 2


def tag(text: Column) -> Column:
    return F.xxhash64(text).bitwiseAND(F.lit((1 << TAG_BITS) - 1))


def superstrings(symbols: np.ndarray, bounds: np.ndarray, window: int, gram: int):
    """(text, start, windows, minimizer, content) of every superstring, in order; all arrays."""
    found = []
    for first, last in _parts(bounds, window):
        part = _superstrings(symbols[first:last], np.clip(bounds, first, last) - first, window, gram)
        text, start = part[0], part[1] + first
        found.append((text, start - bounds[text], *part[2:]))
    if not found:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _parts(bounds: np.ndarray, window: int):
    """Ranges of symbols of about PART, whole texts where they fit; parts of a longer one share window - 1 symbols."""
    first = 0
    while first < len(bounds) - 1:
        last = max(int(np.searchsorted(bounds, bounds[first] + PART, "right")) - 1, first + 1)
        a, b = int(bounds[first]), int(bounds[last])
        while b - a > PART:
            yield a, a + PART
            a += PART - window + 1
        yield a, b
        first = last


def _superstrings(symbols, bounds, window, gram):
    total = len(symbols)
    if total < window:
        nothing = np.zeros(0, np.int64)
        return nothing, nothing, nothing, nothing.astype(np.uint64), nothing.astype(np.uint64)
    with np.errstate(over="ignore"):
        sums, inverse = prefix_sums(symbols), powers(total + 1)[1]
        grams = mix((sums[gram:] - sums[:-gram]) * inverse[: total - gram + 1])
        keys = grams >> _PLACE_BITS << _PLACE_BITS
        keys |= np.arange(len(keys), dtype=np.uint64)
        span, wide = 1, window - gram + 1
        while 2 * span <= wide:
            keys = np.minimum(keys[:-span], keys[span:])
            span *= 2
        if span < wide:
            keys = np.minimum(keys[: span - wide], keys[wide - span :])
        sizes = np.diff(bounds)
        usable = np.maximum(sizes - window + 1, 0)
        inside = np.arange(int(usable.sum())) + np.repeat(bounds[:-1] - (np.cumsum(usable) - usable), usable)
        lowest = (keys[inside] & np.uint64((1 << int(_PLACE_BITS)) - 1)).astype(np.int64)
        begin = np.flatnonzero(np.append(True, lowest[1:] != lowest[:-1])) if len(lowest) else np.zeros(0, np.int64)
        number = np.diff(np.append(begin, len(lowest)))
        start, end = inside[begin], inside[begin] + number + window - 1
        content = mix((sums[end] - sums[start]) * inverse[start] ^ mix(number.astype(np.uint64)))
    text = np.searchsorted(bounds, start, "right") - 1
    return text, start, number, grams[lowest[begin]], content


def windows(symbols: np.ndarray, start: np.ndarray, number: np.ndarray, window: int):
    """(superstring, offset, hash) of every window of some superstrings; start and number in symbols."""
    with np.errstate(over="ignore"):
        sums, inverse = prefix_sums(symbols), powers(len(symbols) + 1)[1]
        which = np.repeat(np.arange(len(start)), number)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
        at = start[which] + offset
        return which, offset, mix((sums[at + window] - sums[at]) * inverse[at])


def at_same_place(keys: pa.Array, text: np.ndarray, places: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether each place has the key and the start of another one of the batch: rows that are equal."""
    code = keys.dictionary_encode().indices.fill_null(-1).to_numpy()[text]
    return (places == places[other]) & (code == code[other])


def found(docs: DataFrame, key: str, symbols, window: int, gram: int, piece_bytes: int = 1 << 21) -> DataFrame:
    """(minimizer, content, key, place, windows, kind) of every superstring of docs.

    Equal superstrings of a batch are told apart before the shuffle: the later ones of them get a name of
    their own, so that a frequent one sends a row a batch into its group.
    """

    def run(batches):
        for batch in batches:
            batch = batch.sort_by([(key, "ascending"), ("tag", "ascending")])
            for a, b in pieces(batch.column("text"), piece_bytes):
                yield one(batch.slice(a, b - a))

    def one(rows):
        text, start, number, minimizer, content = superstrings(*symbols(rows.column("text")), window, gram)
        places = start << TAG_BITS | rows.column("tag").to_numpy()[text]
        with np.errstate(over="ignore"):
            name = mix(minimizer ^ mix(content))
            _, first, back, times = np.unique(name, return_index=True, return_inverse=True, return_counts=True)
            same_place = at_same_place(rows.column(key), text, places, first[back])
            kind = np.where(times[back] == 1, FIRST, np.where(same_place, REPEATED, LATER))
            own = mix(name + np.arange(len(name), dtype=np.uint64) + np.uint64(rows.num_rows) + mix(places.astype(np.uint64)))
        minimizer = np.where(kind == LATER, own, minimizer)
        whose = rows.column(key).take(pa.array(text))
        return pa.record_batch(
            [pa.array(minimizer.view(np.int64)), pa.array(content.view(np.int64)), whose, pa.array(places), pa.array(number.astype(np.int16)), pa.array(kind.astype(np.int8))],
            names=schema.names,
        )

    schema = T.StructType(
        [
            T.StructField("minimizer", T.LongType()),
            T.StructField("content", T.LongType()),
            T.StructField("key", docs.schema[key].dataType),
            T.StructField("place", T.LongType()),
            T.StructField("windows", T.ShortType()),
            T.StructField("kind", T.ByteType()),
        ]
    )
    rows = docs.where(F.col("text").isNotNull()).select(key, "text", tag(F.col("text")).alias("tag"))
    return mapped(rows, run, schema)


def judged(superstrings: DataFrame, every: bool) -> DataFrame:
    """(key, place, windows, minimizer, gone, open, crowded) of the superstrings that repeat or are open.

    gone: all its windows repeat and are to go, every time (`every`) or but for the first. open: it is the
    first of its content, and its minimizer stands in other contents too; crowded: in more than CROWD of them.
    One shuffle, by minimizer.
    """
    same = Window.partitionBy("minimizer", "content").orderBy("key", "place")
    near = Window.partitionBy("minimizer")
    judged = (
        superstrings.repartition("minimizer")
        .withColumn("first", F.rank().over(same) == 1)
        .withColumn("follower", F.lead("kind").over(same).isNotNull())
        .withColumn("branches", F.min("content").over(near) != F.max("content").over(near))
        .withColumn("crowded", F.count(F.when(F.col("first"), 1)).over(near) > CROWD)
    )
    later = (F.col("kind") == LATER) | ~F.col("first")
    gone = later | (F.col("follower") | (F.col("kind") == REPEATED)) if every else later
    judged = judged.select("key", "place", "windows", "minimizer", gone.alias("gone"), (F.col("first") & F.col("branches") & (F.col("kind") != LATER)).alias("open"), "crowded")
    return judged.where("gone or open")


def packed(docs: DataFrame, key: str, carry: bool = False) -> DataFrame:
    """(key, tag, packed) of docs: texts compressed for the shuffle; null stays null. `carry` adds the other columns as `rest`."""
    others = [c for c in docs.columns if c != "text"] if carry else []
    rest = [F.struct(*others).alias("rest")] if carry else []
    rows = docs.select(F.col(key).alias("key"), tag(F.coalesce("text", F.lit(""))).alias("tag"), *rest, "text")

    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary())
            found = pa.array([press.compress(t.as_buffer()) if t.is_valid else None for t in texts], pa.binary())
            yield pa.record_batch([*batch.columns[:-1], found], names=names)

    names = [*rows.columns[:-1], "packed"]
    return mapped(rows, run, T.StructType([*rows.schema.fields[:-1], T.StructField("packed", T.BinaryType())]))


def unpacked(column: pa.Array) -> pa.Array:
    press = zstandard.ZstdDecompressor()
    return pa.array([press.decompress(t.as_buffer()) if t.is_valid else None for t in column], pa.large_binary()).cast(pa.large_string())


def beside(texts: DataFrame, spans: DataFrame, how: str) -> DataFrame:
    """packed texts with `spans`, the list of what spans (key, place, ...) holds for the row."""
    fields = [c for c in spans.columns if c not in ("key", "place")]
    start = F.shiftright("place", TAG_BITS).cast("int").alias("start")
    listed = spans.select("key", F.col("place").bitwiseAND(F.lit((1 << TAG_BITS) - 1)).alias("tag"), F.struct(start, *fields).alias("span"))
    listed = listed.groupBy(F.col("key").alias("of_key"), F.col("tag").alias("of_tag")).agg(F.collect_list("span").alias("spans"))
    met = texts["key"].eqNullSafe(listed["of_key"]) & (texts["tag"] == listed["of_tag"])
    return texts.join(listed, met, how).drop("of_key", "of_tag")


def span_arrays(column: pa.ListArray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Row of each span of a batch, and the fields of all."""
    counts = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    flat = column.flatten()
    fields = {f.name: flat.field(f.name).to_numpy(zero_copy_only=False) for f in flat.type}
    return np.repeat(np.arange(len(counts)), counts), fields


def covered(bounds: np.ndarray, text: np.ndarray, start: np.ndarray, number: np.ndarray, window: int) -> np.ndarray:
    """Which symbols of a batch some window covers that starts at one of `number` places from `start`."""
    change = np.zeros(int(bounds[-1]) + 1, np.int32)
    first = bounds[text] + start
    np.add.at(change, first, 1)
    np.add.at(change, first + number + window - 1, -1)
    return np.cumsum(change[:-1]) > 0

