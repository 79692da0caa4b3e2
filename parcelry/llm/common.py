"""What the text operators share: the table of documents and whole Arrow batches as hash arrays.

A text is UTF-8 bytes; a word is a maximal run of bytes other than ASCII white space. Hashes are
fixed functions of the bytes, equal on every machine and in every process.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelry.session import new_shared_path

#: The bytes that end a word, space and U+0009 to U+000D.
WHITE_SPACE = b" \t\n\x0b\x0c\r"
#: Words of a shingle, and the likeness from which two sets of shingles count as near.
SHINGLE_WORDS = 5
NEAR = 0.8

_WORD = np.ones(256, np.uint8)
_WORD[np.frombuffer(WHITE_SPACE, np.uint8)] = 0
#: The same with ASCII punctuation and control characters as a kind of their own.
_MARK = np.array([2 * (not (chr(c).isalnum() or c >= 128)) for c in range(256)], np.uint8)
_TOKEN = np.where(_WORD == 0, 0, np.maximum(_MARK, 1)).astype(np.uint8)
_LOW_BYTES = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2**64 - 1], np.uint64)
LONG_WORD = 64
#: Bytes of a batch that a task sends to Python, a longer row alone: a little less than two of the `pieces` below.
BATCH_BYTES = 4_000_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder, which cuts its lineage."""
    path = new_shared_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def removed(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        jvm = df.sparkSession._jvm
        for file in df.inputFiles()[:1]:
            folder = jvm.org.apache.hadoop.fs.Path(file).getParent()
            folder.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(folder, True)


def mapped(df: DataFrame, run: Callable, schema) -> DataFrame:
    """df.mapInArrow(run, schema) in batches of about BATCH_BYTES; a worker gives back what it has freed.

    A batch is held whole in the executor and in Python, and by default it is all of a task's texts. Spark reads the limit as
    the plan runs, so it stays lowered for the session; a lower one is left as it is.
    """
    spark = df.sparkSession
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_SETTING)) > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))

    def tidy(batches):
        for out in run(batches):
            yield out
            del out
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(tidy, schema)


def crc_mod(key: Column, n: int) -> Column:
    """Remainder of the CRC-32 of a key's decimal text."""
    return F.crc32(key.cast("string").cast("binary")) % n


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers one to one."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def salted(seed: int, n: int) -> np.ndarray:
    """n fixed random 64-bit integers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))


#: Base of the hashes of ranges: a range's hash is a difference of prefix sums, moved to place 0.
BASE = 0x9E3779B97F4A7C15
_POWERS: list = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """At least n powers of the base and of its inverse."""
    while len(_POWERS[0]) < n:
        with np.errstate(over="ignore"):
            for k, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
                have = _POWERS[k]
                _POWERS[k] = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
    return _POWERS[0], _POWERS[1]


def prefix_sums(values: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * powers(len(values))[0][: len(values)], dtype=np.uint64)])


def inverse_powers(at: np.ndarray) -> np.ndarray:
    return powers(int(at.max()) + 1)[1][at]


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a batch and the bounds of each; a null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
    return data, bounds - bounds[0]


def pieces(texts: pa.Array, most_bytes: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about so many bytes, a longer text alone."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    first, size = 0, 0
    for i, n in enumerate(sizes):
        if size and size + n > most_bytes:
            yield first, i
            first, size = i, 0
        size += int(n)
    if first < len(sizes):
        yield first, len(sizes)


class Words:
    """Words of a batch of texts: byte bounds, and for text i the range bounds[i]:bounds[i + 1].

    With `marks`, runs of punctuation inside a word are tokens of their own.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, marks: bool = False):
        self.data, ends = utf8(pc.utf8_lower(texts) if lower else texts)
        data, n = self.data, len(self.data)
        kind = (_TOKEN if marks else _WORD)[data]
        change = np.ones(n + 1, bool)
        change[1:n] = kind[1:] != kind[:-1]
        change[ends] = True
        self.starts = np.flatnonzero(change[:-1] & (kind > 0))
        self.ends = np.flatnonzero(change[1:] & (kind > 0)) + 1
        self.bounds = np.searchsorted(self.starts, ends)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        with np.errstate(over="ignore"):
            sizes = self.ends - self.starts
            padded = np.concatenate([self.data, np.zeros(8, np.uint8)])
            eight = np.ndarray(len(self.data) + 1, "<u8", padded.tobytes(), strides=(1,))
            out = mix((eight[self.starts] & _LOW_BYTES[np.minimum(sizes, 8)]) + sizes.astype(np.uint64))
            rest = np.flatnonzero((sizes > 8) & (sizes <= LONG_WORD))
            for at in range(8, LONG_WORD, 8):
                rest = rest[sizes[rest] > at]
                if not len(rest):
                    break
                part = eight[self.starts[rest] + at] & _LOW_BYTES[np.minimum(sizes[rest] - at, 8)]
                out[rest] = mix(out[rest] * np.uint64(0x9E3779B97F4A7C15) + part)
            for i in np.flatnonzero(sizes > LONG_WORD):
                out[i] = xxhash.xxh3_64_intdigest(self.data[self.starts[i] : self.ends[i]])
        return out


def shingles(words: np.ndarray, bounds: np.ndarray, n: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words of each text, and their bounds; a shorter text is one shingle."""
    counts = np.diff(bounds)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    out_bounds = np.concatenate([[0], np.cumsum(sizes)])
    total = int(out_bounds[-1])
    starts = np.arange(total) + np.repeat(bounds[:-1] - out_bounds[:-1], sizes)
    out = np.zeros(total, np.uint64)
    padded = np.concatenate([words, np.zeros(n, np.uint64)])
    with np.errstate(over="ignore"):
        if (counts >= n).all():
            for k in range(n):
                out = mix(out * np.uint64(0x9E3779B97F4A7C15) + padded[starts + k])
        else:
            left = np.repeat(bounds[1:], sizes) - starts
            for k in range(n):
                part = mix(out * np.uint64(0x9E3779B97F4A7C15) + padded[starts + k])
                out = np.where(left > k, part, out)
    return out, out_bounds


def long_column(values: np.ndarray) -> pa.Array:
    return pa.array(values.astype(np.uint64).view(np.int64), pa.int64())
