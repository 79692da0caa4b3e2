"""Removal of repeated word sequences by compaction of a De Bruijn graph.

An edge is a k-mer, WINDOW words in a row; its nodes are its first and last WINDOW - 1 words. Edges
that share a minimizer and stand in a row form a path without a branch inside their bucket. Equal paths of a
bucket are compacted to one by grouping them with their source coordinates (key, start): all but the first
occurrence repeat. Where a bucket holds different paths, the graph may branch: the paths are broken into edges,
which are grouped by a join on the edge itself. What repeats goes back to its documents by its
source coordinates, where paths and edges in a row join to long spans and the words are taken out.

A word goes if a window that covers it has started before: at a smaller key, or earlier in the same
document. Windows are judged on the input.

Defined cases: a null text has no words and stays null, a text without words keeps none; a shorter text than a
window keeps all; rows of equal key count as one document, ordered by start and then by text, and equal rows
are treated alike; null keys come first; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelry.llm import superstrings
from parcelry.llm.common import Words, mapped, pieces, removed, stored, utf8

WINDOW = 20
GRAM = 5


def _symbols(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    words = Words(texts)
    return words.hashes(), words.bounds


def _edges(texts: DataFrame, opened: DataFrame, window: int) -> DataFrame:
    """(minimizer, edge, key, place, later) of every edge of the open paths; later: a batch has it before."""

    def run(batches):
        for batch in batches:
            batch = batch.sort_by([("key", "ascending"), ("tag", "ascending")])
            texts = superstrings.unpacked(batch.column("packed"))
            for a, b in pieces(texts):
                yield one(batch.slice(a, b - a), texts[a:b])

    def one(rows, texts):
        symbols, bounds = _symbols(texts)
        text, span = superstrings.span_arrays(rows.column("spans"))
        order = np.lexsort((span["start"], text))
        text, start, number, minimizer = text[order], span["start"][order], span["windows"][order].astype(np.int64), span["minimizer"][order]
        which, offset, edge = superstrings.windows(symbols, bounds[text] + start, number, window)
        place = (start[which].astype(np.int64) + offset) << superstrings.TAG_BITS | rows.column("tag").to_numpy()[text[which]]
        names = edge ^ minimizer[which].view(np.uint64)
        _, first, back = np.unique(names, return_index=True, return_inverse=True)
        later = ~superstrings.at_same_place(rows.column("key"), text[which], place, first[back])
        bucket = np.where(later, names.view(np.int64) ^ place, minimizer[which])
        return pa.record_batch(
            [pa.array(bucket), pa.array(edge.view(np.int64)), rows.column("key").take(pa.array(text[which])), pa.array(place), pa.array(later)],
            names=schema.names,
        )

    schema = T.StructType(
        [
            T.StructField("minimizer", T.LongType()),
            T.StructField("edge", T.LongType()),
            opened.schema["key"],
            T.StructField("place", T.LongType()),
            T.StructField("later", T.BooleanType()),
        ]
    )
    return mapped(superstrings.beside(texts, opened, "inner"), run, schema)


def repeats(docs: DataFrame, key: str = "doc_id", window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(key, place, windows) of the windows that have started before, in runs."""
    paths = superstrings.found(docs, key, _symbols, window, gram)
    judged = stored(superstrings.judged(paths, every=False), "paths")
    gone = judged.where("gone").select("key", "place", F.col("windows").cast("int").alias("windows"))
    edges = _edges(superstrings.packed(docs, key), judged.where("open").select("key", "place", "windows", "minimizer"), window)
    first = F.rank().over(Window.partitionBy("minimizer", "edge").orderBy("key", "place")) == 1
    again = edges.withColumn("first", first).where("later or not first")
    found = stored(gone.unionByName(again.select("key", "place", F.lit(1).alias("windows"))), "spans")
    removed(judged)
    return found


def _joined(words: Words, gone: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of the words left, joined by a blank; left: how many words are left before each text."""
    starts, sizes = words.starts[~gone], (words.ends - words.starts)[~gone]
    # each kept word with a blank before it, but for the first of a text
    ahead = np.ones(len(starts), np.int64)
    ahead[left[:-1][np.diff(left) > 0]] = 0
    ends = np.cumsum(sizes + ahead)
    begin = ends - sizes
    out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
    step = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out[np.repeat(begin, sizes) + step] = words.data[np.repeat(starts, sizes) + step]
    return out, np.concatenate([[0], ends])[left]


def _own_bytes(texts: pa.Array, words: Words, gone: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and bounds of the texts without the words that go, each with the white space after it."""
    data, bounds = utf8(texts)
    change = np.zeros(len(data) + 1, np.int64)
    text_end = np.repeat(bounds[1:], np.diff(words.bounds))
    stop = np.minimum(np.append(words.starts[1:], len(data))[: len(gone)], text_end)
    np.add.at(change, words.starts[gone], 1)
    np.add.at(change, stop[gone], -1)
    keep = np.cumsum(change[:-1]) == 0
    return data[keep], np.append(0, np.cumsum(keep))[bounds]


def without_repeats(docs: DataFrame, key: str = "doc_id", window: int = WINDOW, gram: int = GRAM, carry: bool = False) -> DataFrame:
    """(key, n_words, n_removed, kept) of every row; kept: the words left, joined by a blank.

    `carry` adds the row's columns besides the text, as a struct `rest`, and keeps the text's own white space: a
    removed word goes with the white space after it.
    """

    def run(batches):
        for batch in batches:
            texts = superstrings.unpacked(batch.column("packed"))
            for a, b in pieces(texts):
                yield one(batch.slice(a, b - a), texts[a:b])

    def one(rows, texts):
        words = Words(texts)
        text, span = superstrings.span_arrays(rows.column("spans"))
        gone = superstrings.covered(words.bounds, text, span["start"], span["windows"], window) if len(text) else np.zeros(len(words.starts), bool)
        total = np.diff(words.bounds)
        left = np.concatenate([[0], np.cumsum(~gone)])[words.bounds]
        out, bounds = _own_bytes(texts, words, gone) if carry else _joined(words, gone, left)
        kept = pa.LargeStringArray.from_buffers(len(total), pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(out.tobytes()))
        kept = kept if not texts.null_count else pc.if_else(texts.is_valid(), kept, pa.scalar(None, pa.large_string()))
        return pa.record_batch([rows.column("key"), pa.array(total), pa.array(total - np.diff(left)), kept.cast(pa.string()), *(rows.column(c) for c in rest)], names=schema.names)

    rest = ["rest"] if carry else []
    schema = T.StructType(
        [
            docs.schema[key],
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
            *(T.StructField(c, T.StructType([f for f in docs.schema if f.name != "text"])) for c in rest),
        ]
    )
    spans = repeats(docs, key, window, gram)
    return mapped(superstrings.beside(superstrings.packed(docs, key, carry), spans, "left"), run, schema)


def cut(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """docs with what repeats taken out of `text`, and `n_chars`, where there is one, counted anew.

    A text that loses nothing stays as it is; of the others only the removed words and the white space after them go.
    """
    found = without_repeats(docs, key, carry=True)
    out = [F.col("kept").alias("text") if c == "text" else F.col("rest")[c].alias(c) for c in docs.columns]
    out = [F.length("kept").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else x for c, x in zip(docs.columns, out)]
    return found.select(*out)
