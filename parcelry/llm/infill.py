"""Fill-in-the-middle forms of texts by piece tables.

A document is a list of descriptors (buffer, start, length) over two buffers that never change: its own text and the
sentinels. Cutting splits a descriptor in two, an arrangement permutes descriptors and puts those of the sentinels between
them, and the inverse permutation restores the text; no text is copied for it. Digests stream descriptor by descriptor.
Starts and lengths count UTF-8 bytes; cuts fall between lines, of which the last may lack its line break.

The cuts and the form are drawn from a digest of seed and key alone, so they do not depend on where a row stands.

Defined cases: a null text is empty; an empty text and one that holds a sentinel stay plain; a null key is drawn for like the
empty text; rows of equal key and text get equal forms; texts of any length are taken whole; all other columns are
kept, whatever their names, but those with the name of a result, which it replaces.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelry.llm.common import pieces, utf8

#: Sentinels before prefix, suffix and middle, and the forms.
SENTINELS = (b"<P>", b"<S>", b"<M>")
PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Parts in the order in which a form holds them: 0 is the prefix, 1 the suffix, 2 the middle.
ORDERS = {PSM: (0, 1, 2), SPM: (1, 0, 2)}
#: Of the parts of a restored text, in order.
WHOLE = (0, 2, 1)
SEED = 7
RATE = 100
SPM_RATE = 50
TEXT, SENTINEL, OUTPUT = 0, 1, 2
_BATCH = 1 << 21


@dataclass(frozen=True)
class Piece:
    """A stretch of a buffer."""

    buffer: int
    start: int
    length: int


class PieceTable:
    """Descriptors over immutable buffers of bytes."""

    def __init__(self, buffers: dict[int, memoryview], table: list[Piece]):
        self.buffers, self.table = buffers, table

    def cut(self, *places: int) -> PieceTable:
        """Descriptors split so that each place, counted in the table's bytes and in order, starts one; equal places make empty ones."""
        out, rest, at = [], list(self.table), 0
        for place in places:
            while rest and at + rest[0].length < place:
                out.append(rest.pop(0))
                at += out[-1].length
            piece = rest.pop(0)
            size = place - at
            out.append(Piece(piece.buffer, piece.start, size))
            rest.insert(0, Piece(piece.buffer, piece.start + size, piece.length - size))
            at = place
        return PieceTable(self.buffers, out + rest)

    def permuted(self, order) -> PieceTable:
        return PieceTable(self.buffers, [self.table[i] for i in order])

    def parts(self):
        """The bytes of each descriptor, without a copy."""
        for p in self.table:
            yield self.buffers[p.buffer][p.start : p.start + p.length]

    def digest(self) -> str:
        state = hashlib.sha256()
        for part in self.parts():
            state.update(part)
        return state.hexdigest()

    def bytes(self) -> bytes:
        return b"".join(self.parts())


_SENTINEL_BYTES = memoryview(b"".join(SENTINELS))
_SENTINEL_PIECES = [Piece(SENTINEL, 3 * i, 3) for i in range(3)]


def arranged(text: PieceTable, form: str) -> PieceTable:
    """prefix, middle, suffix as the form's order, each after its sentinel."""
    prefix, middle, suffix = text.table
    parts = (prefix, suffix, middle)
    table = [p for i in ORDERS[form] for p in (_SENTINEL_PIECES[i], parts[i])]
    return PieceTable({**text.buffers, SENTINEL: _SENTINEL_BYTES}, table)


def restored(output: bytes, form: str) -> PieceTable:
    """The text that an output of a form was made of, as descriptors over the output."""
    whole = PieceTable({OUTPUT: memoryview(output)}, [Piece(OUTPUT, 0, len(output))])
    if form == PLAIN:
        return whole
    order, places, at = ORDERS[form], [], 0
    for i in order:
        at = output.index(SENTINELS[i], at)
        places += [at, at + 3]
        at += 3
    cut = whole.cut(*places)  # an empty piece, then a sentinel and a part for each
    return cut.permuted([2 * order.index(i) + 2 for i in WHOLE])


def drawn(key: str, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 for a key."""
    digest = hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()
    return tuple(int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))


@dataclass
class Options:
    seed: int = SEED
    rate: int = RATE
    spm_rate: int = SPM_RATE


class Documents:
    """A batch of texts with its lines and code points, and the piece table of each."""

    def __init__(self, texts: pa.Array, keys: list[str], options: Options):
        self.data, self.bounds = utf8(texts)
        self.whole = memoryview(self.data.tobytes())
        self.breaks = np.flatnonzero(self.data == 10) + 1
        self.points = np.append(0, np.cumsum((self.data & 0xC0) != 0x80))
        self.keys, self.options = keys, options

    def __len__(self):
        return len(self.bounds) - 1

    def made(self, i: int) -> tuple[int, str, int | None, int | None, PieceTable]:
        """(lines, form, characters of the prefix, of the middle, piece table of the output) of text i."""
        a, b = int(self.bounds[i]), int(self.bounds[i + 1])
        first, last = np.searchsorted(self.breaks, [a, b], "right")
        lines = int(last - first) + (b > a and (last == first or int(self.breaks[last - 1]) < b))
        text = PieceTable({TEXT: self.whole[a:b]}, [Piece(TEXT, 0, b - a)])
        one, two, three, four = drawn(self.keys[i], self.options.seed)
        own = bytes(self.whole[a:b]) if self._may_hold(a, b) else b""
        if a == b or any(s in own for s in SENTINELS) or three % 100 >= self.options.rate:
            return lines, PLAIN, None, None, text
        low, high = sorted((one % (lines + 1), two % (lines + 1)))
        ends = [a if k == 0 else b if k == lines else int(self.breaks[first + k - 1]) for k in (low, high)]
        form = SPM if four % 100 < self.options.spm_rate else PSM
        sizes = self.points[[a, *ends]]
        output = arranged(text.cut(*(e - a for e in ends)), form)
        return lines, form, int(sizes[1] - sizes[0]), int(sizes[2] - sizes[1]), output

    def _may_hold(self, a: int, b: int) -> bool:
        return bool(((self.data[a : b - 2] == 60) & (self.data[a + 2 : b] == 62)).any()) if b - a > 2 else False


def _each(docs: DataFrame, key: str, options: Options, outputs: list[T.StructField], row):
    """docs with further columns, whose values row(documents, i) gives for text i of a batch."""
    names = [f.name for f in outputs]
    docs = docs.drop(*names)
    columns, text = docs.columns, docs.columns.index("text")
    kinds = [T.StructType([f]) for f in outputs]
    drawn_by = F.coalesce(F.col(key).cast("string"), F.lit(""))
    carried = docs.withColumn("_".join(["by", *columns]), drawn_by)  # a name that no column has

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_type

        types = [to_arrow_type(k.fields[0].dataType) for k in kinds]
        for batch in batches:
            for a, b in pieces(batch.column(text), _BATCH):
                part = batch.slice(a, b - a)
                found = Documents(part.column(text), part.column(len(columns)).to_pylist(), options)
                made = [row(found, i) for i in range(len(found))]
                arrays = [pa.array([m[k] for m in made], t) for k, t in enumerate(types)]
                yield pa.RecordBatch.from_arrays([*part.columns[: len(columns)], *arrays], names=[*columns, *names])

    return carried.mapInArrow(run, T.StructType([*docs.schema, *outputs]))


_PIECES = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("buffer", "start", "length")]))


def transform(docs: DataFrame, key: str = "doc_id", options: Options = Options()) -> DataFrame:
    """docs with `form`, `output`, its text in that form, and `pieces`, the descriptors that spell it (buffer 0 is the text, 1 the sentinels)."""

    def row(documents, i):
        _, form, _, _, output = documents.made(i)
        return form, output.bytes().decode(), [{"buffer": p.buffer, "start": p.start, "length": p.length} for p in output.table]

    fields = [T.StructField("form", T.StringType()), T.StructField("output", T.StringType()), T.StructField("pieces", _PIECES)]
    return _each(docs, key, options, fields, row)


def restore(transformed: DataFrame) -> DataFrame:
    """transformed with `restored`, the text rebuilt from `output` and `form` alone."""
    transformed = transformed.drop("restored")
    columns = transformed.columns

    def run(batches):
        for batch in batches:
            forms, outputs = batch.column(columns.index("form")).to_pylist(), batch.column(columns.index("output"))
            for a, b in pieces(outputs, _BATCH):
                texts = [restored((o or "").encode(), f).bytes().decode() for o, f in zip(outputs[a:b].to_pylist(), forms[a:b])]
                yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pa.array(texts, pa.string())], names=[*columns, "restored"])

    return transformed.mapInArrow(run, T.StructType([*transformed.schema, T.StructField("restored", T.StringType())]))


def digests(docs: DataFrame, key: str = "doc_id", options: Options = Options()) -> DataFrame:
    """docs with n, form, prefix_chars, middle_chars, output_sha256 and restored_sha256, in one pass and without sending texts on."""

    def row(documents, i):
        lines, form, prefix, middle, output = documents.made(i)
        return lines, form, prefix, middle, output.digest(), restored(output.bytes(), form).digest()

    long, string = T.LongType(), T.StringType()
    kinds = {"n": long, "form": string, "prefix_chars": long, "middle_chars": long, "output_sha256": string, "restored_sha256": string}
    return _each(docs, key, options, [T.StructField(n, k) for n, k in kinds.items()], row)
