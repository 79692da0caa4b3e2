"""Removal of repeated byte strings by deep-shallow sorting of suffixes.

A suffix is what follows a byte, up to `window` bytes. Only suffixes that may repeat are sorted: those of open
superstrings (see superstrings), which share a minimizer, the name of their bucket. In a bucket a multikey
quicksort orders them to SHALLOW bytes, a character of eight bytes in each pass; groups that still agree have a
long common prefix, and each is ordered by a blind trie: a suffix is led down by single bytes without
comparing, compared once with the leaf where it ends, and put in where the two part. Suffixes that meet
in a leaf are equal over the whole window. Buckets of more than CROWD superstrings, as a line in a third of all
documents makes, are halved (see _halved): a superstring becomes two, of the windows that begin far before the minimizer and of those
that begin near it, each in the bucket of the bytes around the minimizer which all its windows share, and so on while a bucket
is crowded. A superstring has two rows a round, not one a window; a bucket with one content is passed over.

Every byte goes that is covered by a `window`-byte string which also starts anywhere else, in the same text
included; overlaps count, and strings are judged on the input.

Defined cases: a null text is empty; a shorter text than the window keeps all; equal rows are different
documents, so both lose what they share; rows of equal key and different texts are kept apart; other columns
are ignored. What is left need not be valid UTF-8 and is returned as bytes.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from parcelry.llm import superstrings
from parcelry.llm.common import mix, pieces, powers, prefix_sums, removed, salted, stored, utf8

WINDOW = 200
GRAM = 64
SHALLOW = 32
PIECE = 1 << 19
#: Bytes of suffix text that are sorted at once; a larger bucket is sorted alone.
SORTED_BYTES = 1 << 21
_SYMBOLS = salted(101, 256)


def _symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    data, bounds = utf8(texts)
    return _SYMBOLS[data], bounds


class BlindTrie:
    """Suffixes that agree on `agreed` bytes, led apart by the byte at each branch's depth."""

    def __init__(self, data: bytes, agreed: int, window: int):
        self.data, self.agreed, self.window = data, agreed, window
        self.root = None  # a leaf is a list of suffixes, a branch a pair (depth, {byte: below})

    def add(self, at: int) -> None:
        if self.root is None:
            self.root = [at]
            return
        data, path, node = self.data, [], self.root
        while type(node) is tuple:
            path.append(node)
            below = node[1].get(data[at + node[0]])
            node = below if below is not None else next(iter(node[1].values()))
        depth = self._parting(at, node[0])
        if depth == self.window:
            node.append(at)
            return
        above = None
        for branch in path:
            if branch[0] >= depth:
                break
            above = branch
        if above is None:
            node = self.root
        else:
            node = above[1][data[at + above[0]]]
        if type(node) is tuple and node[0] == depth:
            node[1][data[at + depth]] = [at]
            return
        some = node
        while type(some) is tuple:
            some = next(iter(some[1].values()))
        branch = (depth, {data[some[0] + depth]: node, data[at + depth]: [at]})
        if above is None:
            self.root = branch
        else:
            above[1][data[at + above[0]]] = branch

    def _parting(self, a: int, b: int) -> int:
        """First place where two suffixes differ, or the window."""
        low, size = self.agreed, self.window
        x, y = self.data[a + low : a + size], self.data[b + low : b + size]
        if x == y:
            return size
        differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
        return size - 1 - (differ.bit_length() - 1) // 8

    def leaves(self):
        """Leaves in order of their suffixes."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if type(node) is tuple:
                stack.extend(node[1][b] for b in sorted(node[1], reverse=True))
            elif node:
                yield node


def repeated(data: bytes, group: np.ndarray, at: np.ndarray, window: int) -> np.ndarray:
    """Which suffixes, at places `at` of data, have an equal one in their group."""
    out = np.zeros(len(at), bool)
    letters = np.frombuffer(data + bytes(8), np.uint8)
    eight = np.ndarray(len(data) + 1, ">u8", letters.tobytes(), strides=(1,))
    left = np.arange(len(at))
    for depth in range(0, min(SHALLOW, window), 8):
        own = eight[at[left] + depth].astype(np.uint64)
        if window - depth < 8:
            own >>= np.uint64(8 * (8 - window + depth))
        order = np.lexsort((own, group))
        left, group, own = left[order], group[order], own[order]
        new = np.append(True, (group[1:] != group[:-1]) | (own[1:] != own[:-1])) if len(left) else np.zeros(0, bool)
        group = np.cumsum(new)
        shared = np.bincount(group)[group] > 1 if len(group) else np.zeros(0, bool)
        left, group = left[shared], group[shared]
    agreed = min(SHALLOW, window)
    first = np.flatnonzero(np.append(True, group[1:] != group[:-1])) if len(group) else np.zeros(0, np.int64)
    places, number = at[left].tolist(), {int(p): i for p, i in zip(at[left], left)}
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(left)]):
        trie = BlindTrie(data, agreed, window)
        for place in places[a:b]:
            trie.add(place)
        for leaf in trie.leaves():
            if len(leaf) > 1:
                out[[number[p] for p in leaf]] = True
    return out


def _contexts(texts: DataFrame, opened: DataFrame, window: int, gram: int) -> DataFrame:
    """(bucket, key, place, windows, at, crowded, context) of the open superstrings: their bytes, and the minimizer's place in them."""

    def run(batches):
        for batch in batches:
            texts = superstrings.unpacked(batch.column("packed"))
            for a, b in pieces(texts, PIECE):
                yield one(batch.slice(a, b - a), texts[a:b])

    def one(rows, texts):
        data, bounds = utf8(texts)
        text, span = superstrings.span_arrays(rows.column("spans"))
        start, number, bucket = span["start"].astype(np.int64), span["windows"].astype(np.int64), span["minimizer"]
        size = number + window - 1
        ends = np.cumsum(size)
        at = np.repeat(bounds[text] + start - (ends - size), size) + np.arange(int(ends[-1]) if len(ends) else 0)
        found = _minimizer_places(data, bounds[text] + start, number, bucket.view(np.uint64), window, gram)
        context = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(np.append(0, ends).astype(np.int64).tobytes()), pa.py_buffer(data[at].tobytes())])
        place = start << superstrings.TAG_BITS | rows.column("tag").to_numpy()[text]
        return pa.record_batch(
            [pa.array(bucket), rows.column("key").take(pa.array(text)), pa.array(place), pa.array(number.astype(np.int32)), pa.array(found.astype(np.int32)), pa.array(span["crowded"]), context.cast(pa.binary())],
            names=schema.names,
        )

    schema = _context_schema(opened.schema["key"], T.StructField("crowded", T.BooleanType()))
    return superstrings.beside(texts, opened, "inner").mapInArrow(run, schema)


def _context_schema(key: T.StructField, *more: T.StructField) -> T.StructType:
    return T.StructType(
        [
            T.StructField("bucket", T.LongType()),
            key,
            T.StructField("place", T.LongType()),
            T.StructField("windows", T.IntegerType()),
            T.StructField("at", T.IntegerType()),
            *more,
            T.StructField("context", T.BinaryType()),
        ]
    )


def _minimizer_places(data: np.ndarray, start: np.ndarray, number: np.ndarray, minimizer: np.ndarray, window: int, gram: int) -> np.ndarray:
    """Where in each superstring its minimizer begins: the first gram of that hash which stands in all of its windows."""
    if not len(start):
        return np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        sums, inverse = prefix_sums(_SYMBOLS[data]), powers(len(data) + 1)[1]
        first = number - 1  # the last window begins there; the first one holds no gram beyond window - gram
        count = window - gram + 1 - first
        which = np.repeat(np.arange(len(start)), count)
        place = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + first[which]
        at = start[which] + place
        same = np.flatnonzero(mix((sums[at + gram] - sums[at]) * inverse[at]) == minimizer[which])
    _, one = np.unique(which[same], return_index=True)
    return place[same[one]]


def _halved(crowded: DataFrame, window: int, gram: int) -> DataFrame:
    """The windows of crowded superstrings in halves of a range, each named by the bytes that all windows of the half share.

    A range (low, high) holds the windows with low to high bytes before the minimizer, and so window - gram less as many after it.
    All windows of a range share the low bytes before it, the minimizer, and the bytes after it that the last of
    them has; equal windows are in the same range under the same name. A range of one place is named by whole windows.
    """

    def run(batches):
        for batch in batches:
            yield one(batch.to_pydict())

    def one(rows):
        out = {name: [] for name in schema.names}
        for bucket, key, place, windows, at, low, high, context in zip(*(rows[n] for n in ("bucket", "key", "place", "windows", "at", "low", "high", "context"))):
            middle = (low + high) // 2
            for a, b in ((low, middle), (middle + 1, high)) if low < high else ():
                first, last = at - min(b, at), at - max(a, at - windows + 1)  # offsets of the windows of this half
                if first > last:
                    continue
                shared = context[at - a : at + window - b]
                name = xxhash.xxh3_64_intdigest(shared, seed=a << 16 | b) ^ bucket & (1 << 64) - 1
                part = (name - (1 << 64) if name >> 63 else name, key, place + (first << superstrings.TAG_BITS), last - first + 1, at - first, a, b, context[first : last + window])
                for column, value in zip(out.values(), part):
                    column.append(value)
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=schema.names)

    key = crowded.schema["key"]
    schema = _context_schema(key, T.StructField("low", T.IntegerType()), T.StructField("high", T.IntegerType()))
    kinds = [pa.int64(), to_arrow_type(key.dataType), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
    return crowded.select(*schema.names).mapInArrow(run, schema)


def _uncrowded(contexts: DataFrame, window: int, gram: int, crowd: int) -> tuple[DataFrame, DataFrame, list[DataFrame]]:
    """Contexts in buckets of at most `crowd` different ones, spans (key, place, windows) that repeat already, and stored tables.

    Crowded buckets are halved until they are not. Equal contexts of a bucket repeat as a whole; one of them stays to be
    compared. A bucket with one context has nothing to compare it with.
    """
    whole = [F.lit(0).alias("low"), F.lit(window - gram).alias("high")]
    state, fits, again, kept = contexts.select("*", *whole), [], [], []
    while True:
        halves = stored(_halved(state, window, gram), "halves")
        same = halves.groupBy("bucket", "context").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "place", "windows", "at", "low", "high")).alias("one"))
        same = stored(same, "contents")
        kept += [halves, same]
        several = same.where("n > 1").select("bucket", "context")
        again.append(halves.join(several, ["bucket", "context"], "left_semi").select("key", "place", "windows"))
        sizes = same.groupBy("bucket").agg(F.count(F.lit(1)).alias("contents")).where("contents > 1")
        left = same.join(sizes, "bucket").select("bucket", "one.*", "context", "contents")
        fits.append(left.where(F.col("contents") <= crowd).select("bucket", "key", "place", "windows", "context"))
        state = left.where(F.col("contents") > crowd).where("low < high")
        if state.isEmpty():
            break
    return reduce(DataFrame.unionByName, fits), reduce(DataFrame.unionByName, again), kept




def _sorted(contexts: DataFrame, window: int) -> DataFrame:
    """(key, place, windows) of the runs of windows that repeat in their bucket."""

    def run(batches):
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch.set_column(4, "context", batch.column("context").cast(pa.large_binary())))
            size += batch.column("context").nbytes
            # rows of one bucket only are not joined before it ends
            if size >= SORTED_BYTES and held[0].column("bucket")[0] != batch.column("bucket")[-1]:
                rows = joined(held)
                buckets = rows.column("bucket").to_numpy()
                whole = int(np.searchsorted(buckets, buckets[-1]))  # the last bucket may go on
                yield from parts(rows.slice(0, whole))
                held = [rows.slice(whole)]
                size = held[0].column("context").nbytes
        if held:
            yield from parts(joined(held))

    def joined(held):
        """One batch; contexts are large binaries, which stay in one chunk beyond 2 GB."""
        return pa.Table.from_batches(held).combine_chunks().to_batches()[0]

    def parts(rows):
        """Whole buckets of about SORTED_BYTES together."""
        buckets = rows.column("bucket").to_numpy()
        total = np.append(0, np.cumsum(pc.binary_length(rows.column("context")).to_numpy().astype(np.int64)))
        ends = np.append(np.flatnonzero(buckets[1:] != buckets[:-1]) + 1, len(buckets))
        a = 0
        while a < len(buckets):
            fit = int(np.searchsorted(total[ends], total[a] + SORTED_BYTES, "right"))
            b = int(ends[max(fit - 1, int(np.searchsorted(ends, a, "right")))])
            yield one(rows.slice(a, b - a))
            a = b

    def one(rows):
        buckets, number = rows.column("bucket").to_numpy(), rows.column("windows").to_numpy().astype(np.int64)
        data, bounds = utf8_bytes(rows.column("context"))
        which = np.repeat(np.arange(len(number)), number)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(number) - number, number)
        group = np.unique(buckets, return_inverse=True)[1][which]
        again = repeated(data, group, bounds[which] + offset, window)
        which, offset = which[again], offset[again]
        first = np.append(True, (which[1:] != which[:-1]) | (offset[1:] != offset[:-1] + 1)) if len(which) else np.zeros(0, bool)
        begin = np.flatnonzero(first)
        runs = np.diff(np.append(begin, len(which)))
        place = rows.column("place").to_numpy()[which[begin]] + (offset[begin] << superstrings.TAG_BITS)
        return pa.record_batch([rows.column("key").take(pa.array(which[begin])), pa.array(place), pa.array(runs.astype(np.int32))], names=schema.names)

    def utf8_bytes(column):
        column = column.cast(pa.large_binary())
        bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
        return column.buffers()[2].to_pybytes()[bounds[0] : bounds[-1]], bounds - bounds[0]

    schema = T.StructType([contexts.schema["key"], T.StructField("place", T.LongType()), T.StructField("windows", T.IntegerType())])
    return contexts.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, schema)


def repeats(docs: DataFrame, key: str = "doc_id", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(key, place, windows) of the windows that start anywhere else too, in runs."""
    strings = superstrings.found(docs, key, _symbols, window, gram, PIECE)
    judged = stored(superstrings.judged(strings, every=True), "strings")
    gone = judged.where("gone").select("key", "place", F.col("windows").cast("int").alias("windows"))
    opened = judged.where("open").select("key", "place", "windows", "minimizer", "crowded")
    contexts = stored(_contexts(superstrings.packed(docs, key), opened, window, gram), "contexts")
    columns = ["bucket", "key", "place", "windows", "context"]
    fits, again, kept = _uncrowded(contexts.where("crowded").drop("crowded"), window, gram, superstrings.CROWD)
    compared = contexts.where("not crowded").select(*columns).unionByName(fits.select(*columns))
    found = stored(gone.unionByName(again).unionByName(_sorted(compared, window)), "spans")
    removed(judged, contexts, *kept)
    return found


def without_repeats(docs: DataFrame, key: str = "doc_id", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(key, n_bytes, n_removed, n_spans, kept) of every row; kept: the bytes left, in one piece."""

    def run(batches):
        for batch in batches:
            texts = superstrings.unpacked(batch.column("packed"))
            for a, b in pieces(texts):
                yield one(batch.slice(a, b - a), texts[a:b])

    def one(rows, texts):
        data, bounds = utf8(texts)
        text, span = superstrings.span_arrays(rows.column("spans"))
        gone = superstrings.covered(bounds, text, span["start"], span["windows"], window) if len(text) else np.zeros(len(data), bool)
        before = np.append(False, gone[:-1])[: len(gone)]
        before[bounds[:-1][bounds[:-1] < len(gone)]] = False
        spans = np.append(0, np.cumsum(gone & ~before))[bounds]
        left = np.append(0, np.cumsum(~gone))[bounds]
        kept = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(rows), [None, pa.py_buffer(left.astype(np.int64).tobytes()), pa.py_buffer(data[~gone].tobytes())])
        total = np.diff(bounds)
        return pa.record_batch([rows.column("key"), pa.array(total), pa.array(total - np.diff(left)), pa.array(np.diff(spans)), kept.cast(pa.binary())], names=schema.names)

    schema = T.StructType(
        [
            docs.schema[key],
            T.StructField("n_bytes", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("n_spans", T.LongType()),
            T.StructField("kept", T.BinaryType()),
        ]
    )
    spans = repeats(docs, key, window, gram)
    return superstrings.beside(superstrings.packed(docs, key), spans, "left").mapInArrow(run, schema)
