"""Sampled SentencePiece segmentations and their decoding.

Forward filtering runs over the lattice of vocabulary pieces: the weight of a path is exp(theta times the
sum of its pieces' scores), and the forward weight of a place sums over all paths to it. Backward sampling then
draws a path from the end, each step in proportion to its share. The random numbers are hashes of the row's
key, the place of the segment in the text and the step, so equal keys and texts give equal
pieces wherever they run.

The lattice falls apart at the start of each run of blanks and around characters without a piece, as no
piece crosses them; the forward pass is made once per distinct segment of a batch. Characters without a
piece become byte pieces, and so does a literal U+2581, which keeps decoding lossless.

Defined cases: a null or empty text has no pieces and decodes to the empty text; a null key seeds like
any other value; equal rows get equal pieces; a text of any length is taken whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelry.llm.common import inverse_powers, mapped, mix, pieces, powers, prefix_sums, salted

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
THETA = 0.0005
#: Fixed value: the sign that stands for a blank in a piece.
BLANK = "▁"
_BATCH = 1 << 19
#: Pieces decoded at once.
_DECODED = 1 << 18


@dataclass
class Vocabulary:
    """Pieces by id: UTF-8 text with plain blanks, score, and whether a piece stands for one byte."""

    texts: list[bytes]
    scores: list[float]
    normal: list[bool]
    byte_ids: list[int]


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces of a SentencePiece model file that the driver can open."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    odd = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i) for i in range(len(names))]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    if not all(model.is_byte(i) for i in byte_ids):
        raise ValueError("the model needs a piece for every byte")
    texts = [b"" if o else n.replace(BLANK, " ").encode() for n, o in zip(names, odd)]
    for b, i in enumerate(byte_ids):
        texts[i] = bytes([b])
    inner = [n for n, o in zip(names, odd) if not o and BLANK in n.lstrip(BLANK)]
    if inner:
        raise ValueError(f"pieces must not go on after a blank inside them: {inner[:3]}")
    return Vocabulary(texts, [model.get_score(i) for i in range(len(names))], [not o for o in odd], byte_ids)


class Sampler:
    """A vocabulary's tables for segmenting batches."""

    def __init__(self, vocabulary: Vocabulary, theta: float):
        names = {i: t.decode() for i, t in enumerate(vocabulary.texts) if vocabulary.normal[i] and t}
        singles = sorted(ord(t) for t in names.values() if len(t) == 1)
        self.code = np.zeros(0x110000, np.uint16)
        self.code[singles] = np.arange(1, len(singles) + 1)
        self.blank = int(self.code[32])
        self.salt = salted(5, len(singles) + 1)
        usable = {i: t for i, t in names.items() if all(self.code[ord(c)] for c in t)}
        self.longest = max(map(len, usable.values()))
        keys = {}
        with np.errstate(over="ignore"):
            for i, t in usable.items():
                codes = self.code[[ord(c) for c in t]]
                keys[int((self.salt[codes] * powers(len(t))[0][: len(t)]).sum(dtype=np.uint64))] = i
        self.keys = np.array(sorted(keys), np.uint64)
        self.ids = np.array([keys[k] for k in self.keys.tolist()], np.int32)
        # hash tables of places in keys: the second holds those whose slot in the first was taken
        self.slots = np.full((2, 1 << 20), -1, np.int32)
        scrambled = mix(self.keys)
        for row, (a, b) in enumerate(zip((scrambled >> np.uint64(44)).tolist(), (scrambled & np.uint64((1 << 20) - 1)).tolist())):
            if self.slots[0, a] < 0:
                self.slots[0, a] = row
            elif self.slots[1, b] < 0:
                self.slots[1, b] = row
            else:
                raise ValueError("two pieces share both slots")
        self.weight = theta * np.array(vocabulary.scores)
        self.byte_ids = np.array(vocabulary.byte_ids, np.int32)

    def lookup(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys are pieces' hashes, and the ids of these."""
        scrambled = mix(keys)
        row = self.slots[0, scrambled >> np.uint64(44)]
        may = np.flatnonzero(row >= 0)
        row = row[may]
        other = np.flatnonzero(self.keys[row] != keys[may])
        row[other] = self.slots[1, scrambled[may[other]] & np.uint64((1 << 20) - 1)]
        hit = (row >= 0) & (self.keys[row] == keys[may])
        return may[hit], self.ids[row[hit]]

    def segment(self, texts: pa.Array, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all texts, sampled, and the bounds of each text."""
        strings = [t or "" for t in texts.to_pylist()]
        sizes = np.array([len(t) + 1 if t else 0 for t in strings], np.int64)
        text_bounds = np.concatenate([[0], np.cumsum(sizes)])
        points = np.frombuffer("".join(" " + t for t in strings if t).encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = self.code[points]
        n = len(codes)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(strings) + 1, np.int64)
        cut = np.zeros(n + 1, bool)
        cut[text_bounds] = True
        blank = codes == self.blank
        cut[1:n] |= blank[1:] & ~blank[:-1]
        odd = codes == 0
        cut[:n] |= odd
        cut[1:] |= odd
        starts = np.flatnonzero(cut[:n])
        ends = np.append(starts[1:], n)
        known = ~odd[starts]
        owner = np.searchsorted(text_bounds, starts, "right") - 1
        seeds = mix(seeds[owner] + (starts - text_bounds[owner]).astype(np.uint64) * np.uint64(0xD1342543DE82EF95))
        counts, steps = self._sample(codes, starts[known], ends[known], seeds[known])
        sizes = np.zeros(len(starts), np.int64)
        sizes[known] = counts
        strange = np.flatnonzero(~known)
        spelled = [chr(points[starts[i]]).encode("utf-8", "surrogatepass") for i in strange]
        sizes[strange] = [len(s) for s in spelled]
        ends_at = np.cumsum(sizes)
        out = np.zeros(int(ends_at[-1]), np.int32)
        last = ends_at[known] - 1
        for k, (who, ids) in enumerate(steps):
            out[last[who] - k] = ids
        if spelled:
            begin = np.repeat(ends_at[strange] - sizes[strange], sizes[strange])
            inside = np.arange(len(begin)) - np.repeat(np.cumsum(sizes[strange]) - sizes[strange], sizes[strange])
            out[begin + inside] = self.byte_ids[np.frombuffer(b"".join(spelled), np.uint8)]
        first = np.searchsorted(starts, text_bounds)
        return out, np.concatenate([[0], ends_at])[first]

    def _sample(self, codes, starts, ends, seeds):
        """Number of pieces of each segment, and for each step back the segments and the ids drawn."""
        if not len(starts):
            return np.zeros(0, np.int64), []
        with np.errstate(over="ignore"):
            sums = prefix_sums(self.salt[codes])
            lengths = ends - starts
            names = mix(((sums[ends] - sums[starts]) * inverse_powers(starts)) ^ lengths.astype(np.uint64))
            _, pick, which = np.unique(names, return_index=True, return_inverse=True)
        length = lengths[pick]
        bounds = np.concatenate([[0], np.cumsum(length)])
        at = np.arange(bounds[-1]) + np.repeat(starts[pick] - bounds[:-1], length)
        first, share, before, piece = self._filter(self.salt[codes[at]], bounds)
        # a place is the end of a character of the distinct segments
        here = bounds[1:][which] - 1
        low = bounds[:-1][which]
        who = np.arange(len(starts))
        counts = np.zeros(len(starts), np.int64)
        steps = []
        while len(who):
            with np.errstate(over="ignore"):
                chance = (mix(seeds[who] + np.uint64(len(steps) * 0xA0761D64 + 1)) >> np.uint64(11)).astype(np.float64) * 2.0**-53
            edge = first[here]
            rest = np.flatnonzero(share[edge] <= chance)
            while len(rest):
                edge[rest] += 1
                rest = rest[share[edge[rest]] <= chance[rest]]
            steps.append((who, piece[edge]))
            counts[who] += 1
            here = before[edge]
            go = here >= low[who]
            who, here = who[go], here[go]
        return counts, steps

    def _filter(self, salts, bounds):
        """The first edge that ends at each place; of each edge the running share of its end's weight, the place before, the piece.

        Edges stand in order of how far inside its segment their end is, so that all segments go forward together.
        """
        n = len(salts)
        inside = (np.arange(n) - np.repeat(bounds[:-1], np.diff(bounds))).astype(np.int32)
        with np.errstate(over="ignore"):
            sums, inverse = prefix_sums(salts), powers(n + 1)[1]
            found, ends = [], np.arange(n)
            for size in range(1, self.longest + 1):
                ends = ends[inside[ends] >= size - 1] if size > 1 else ends
                hit, ids = self.lookup((sums[ends + 1] - sums[ends + 1 - size]) * inverse[ends + 1 - size])
                found.append((ends[hit], ids))
        counts = np.zeros(n, np.int32)
        for ends, _ in found:
            counts[ends] += 1
        deep = int(inside.max()) + 1
        order = np.argsort(inside.astype(np.uint16) if deep < 1 << 16 else inside, kind="stable")
        number = counts[order]
        top = np.cumsum(number) - number
        first = np.empty(n, np.int64)
        first[order] = top
        edges = int(number.sum())
        piece, before = np.empty(edges, np.int32), np.empty(edges, np.int32)
        opens = np.zeros(edges, bool)  # the edge starts its segment
        free = first.copy()
        for size, (ends, ids) in enumerate(found, 1):
            at = free[ends]
            piece[at], before[at], opens[at] = ids, ends - size, inside[ends] == size - 1
            free[ends] += 1
        forward = np.zeros(n + 1)  # log weight of the paths to a place; the last stands for the start of a segment
        share = np.empty(edges)
        weight = self.weight[piece]
        ahead = np.where(opens, n, before)
        rounds = np.append(0, np.cumsum(np.bincount(inside, minlength=deep)))
        for a, b in zip(rounds.tolist(), rounds[1:].tolist()):
            e, f = int(top[a]), int(top[b]) if b < n else edges
            logs = weight[e:f] + forward[ahead[e:f]]
            starts, each = top[a:b] - e, number[a:b]
            most = np.maximum.reduceat(logs, starts)
            part = np.exp(logs - np.repeat(most, each))
            total = np.add.reduceat(part, starts)
            forward[order[a:b]] = most + np.log(total)
            part /= np.repeat(total, each)
            running = np.cumsum(part)
            running -= np.repeat(running[starts] - part[starts], each)
            running[starts + each - 1] = 1.0
            share[e:f] = running
        return first, np.minimum(share, 1.0), before, piece


class Speller:
    """Texts that pieces spell."""

    def __init__(self, vocabulary: Vocabulary):
        self.sizes = np.array([len(t) for t in vocabulary.texts])
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.letters = np.frombuffer(b"".join(vocabulary.texts), np.uint8)

    def spell(self, ids: np.ndarray, counts: np.ndarray) -> pa.Array:
        """The texts of the ids of several texts in a row, counts[i] of text i."""
        length = self.sizes[ids]
        ends = np.cumsum(length)
        spelled = self.letters[np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(self.begins[ids] - (ends - length), length)]
        text_ends = np.append(0, ends)[np.append(0, np.cumsum(counts))]
        keep = np.ones(len(spelled), bool)
        keep[text_ends[:-1][counts > 0]] = False  # the blank that encoding puts before a text
        bounds = text_ends - np.append(0, np.cumsum(counts > 0))
        return pa.LargeStringArray.from_buffers(len(counts), pa.py_buffer(bounds.astype(np.int64).tobytes()), pa.py_buffer(spelled[keep].tobytes()))


def _seeded(docs: DataFrame, key: str, seed: int) -> DataFrame:
    """docs with the row's seed after its columns, under a name that none of them has."""
    return docs.withColumn("_".join(["seed", *docs.columns]), F.xxhash64(F.col(key).cast("string"), F.lit(seed)))


def encode(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", seed: int = 0, theta: float = THETA) -> DataFrame:
    """docs with a column `piece_ids`, the sampled pieces of `text`; a column of that name is replaced."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    docs = docs.drop("piece_ids")
    columns = docs.columns

    def run(batches):
        sampler = Sampler(sent.value, theta)
        for batch in batches:
            seeds = batch.column(len(columns)).to_numpy().view(np.uint64)
            texts = batch.column(columns.index("text"))
            for a, b in pieces(texts, _BATCH):
                ids, bounds = sampler.segment(texts[a:b], seeds[a:b])
                found = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.record_batch([*batch.slice(a, b - a).columns[: len(columns)], found], names=[*columns, "piece_ids"])

    return mapped(_seeded(docs, key, seed), run, T.StructType([*docs.schema, T.StructField("piece_ids", T.ArrayType(T.IntegerType()))]))


def roundtrip(docs: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", seed: int = 0, theta: float = THETA) -> DataFrame:
    """(key, piece_ids, lossless): what encode gives, decoded in the same pass and compared with the text; texts do not come back."""
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches):
        sampler, speller = Sampler(sent.value, theta), Speller(sent.value)
        for batch in batches:
            seeds = batch.column(2).to_numpy().view(np.uint64)
            for a, b in pieces(batch.column(1), _BATCH):
                texts = pc.fill_null(batch.column(1)[a:b].cast(pa.large_string()), "")
                ids, bounds = sampler.segment(texts, seeds[a:b])
                lossless = pc.equal(speller.spell(ids, np.diff(bounds)), texts)
                found = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(ids, pa.int32()))
                yield pa.record_batch([batch.column(0)[a:b], found, lossless], names=schema.names)

    schema = T.StructType([docs.schema[key], T.StructField("piece_ids", T.ArrayType(T.IntegerType())), T.StructField("lossless", T.BooleanType())])
    return mapped(_seeded(docs.select(key, "text"), key, seed), run, schema)


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """encoded with a column `decoded`, the text that `piece_ids` spell; a column of that name is replaced."""
    encoded = encoded.drop("decoded")
    columns = encoded.columns
    speller = Speller(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = np.nan_to_num(batch.column("piece_ids").value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            total = np.append(0, np.cumsum(counts))
            a = 0
            while a < len(counts):
                b = max(int(np.searchsorted(total, total[a] + _DECODED, "right")) - 1, a + 1)
                part = batch.slice(a, b - a)
                text = speller.spell(part.column("piece_ids").flatten().to_numpy(), counts[a:b])
                yield pa.record_batch([*part.columns, text.cast(pa.string())], names=[*columns, "decoded"])
                a = b

    return mapped(encoded, run, T.StructType([*encoded.schema, T.StructField("decoded", T.StringType())]))
