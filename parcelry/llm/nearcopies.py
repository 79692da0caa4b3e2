"""Near-duplicate groups by DartMinHash.

A text is a weighted set: its shingles of five words, each weighing as often as it occurs. Each unit of an
element's weight is a strip on which darts arrive at random ranks, all drawn from hashes of element and
unit. A dart belongs to one of COORDINATES coordinates, and each coordinate keeps its earliest dart; two
texts keep the same one with the probability of their weighted Jaccard likeness. Only darts up to a rank of
DARTS / weight are thrown, farther ones only for texts that have left a coordinate empty.

Texts that agree on a band of ROWS coordinates share a bucket and are candidates. Equal texts are first
collapsed. In each bucket texts are held against a few leaders, the one that meets most others and some drawn by
hash; the links found join texts to components, and what follows looks only at buckets that still span
several. Pairs with a leader whose sketches (8 bits of each coordinate) can't belong to near texts are passed over; every other
one is verified by the exact likeness of the weighted sets. After ROUNDS rounds the texts outside a bucket's largest component,
few by then, are compared exactly with the bucket's others, block by block, and only links leave a task. A group is a connected
component of links.

Defined cases: a null text is its own group; equal texts, empty ones included, are one group; texts without
words are near no other text; shorter texts than a shingle are one shingle; equal keys take part once per row
and text; a group is named by its least key.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelry.llm.common import NEAR, Words, mapped, mix, pieces, removed, shingles, stored
from parcelry.llm.components import components
from parcelry.session import use_checkpoints

BANDS = 25
ROWS = 5
COORDINATES = BANDS * ROWS
DARTS = math.ceil(COORDINATES * math.log(COORDINATES) + 2 * COORDINATES)
LEADERS = 4
#: Leaders that a text is verified against.
PARTNERS = 3
ROUNDS = 1
#: Texts and units that a block of a bucket holds, about, and units that are multiplied at once.
BLOCK = 1024
BLOCK_UNITS = 1 << 21
SLICE = 1 << 12
#: Equal coordinates that a pair of likeness NEAR has but with a chance of 4e-6: four and a half deviations below the mean.
LEAST_EQUAL = math.floor(COORDINATES * NEAR - 4.5 * math.sqrt(COORDINATES * NEAR * (1 - NEAR)))
_OWNER = 52
_SKETCH = -(-COORDINATES // 8)  # 64-bit numbers of a sketch


def units(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes of (shingle, number of its occurrence) of each text, at most 4096 texts, and bounds."""
    words = Words(texts)
    grams, bounds = shingles(words.hashes(), words.bounds)
    owner = np.repeat(np.arange(len(texts), dtype=np.uint64), np.diff(bounds))
    keys = (owner << np.uint64(_OWNER)) | (grams >> np.uint64(64 - _OWNER))
    keys.sort()
    first = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, np.int64)
    number = np.arange(len(keys)) - np.repeat(first, np.diff(np.append(first, len(keys))))
    with np.errstate(over="ignore"):
        element = keys & np.uint64((1 << _OWNER) - 1)
        return mix(element + number.astype(np.uint64) * np.uint64(0xD1B54A32D192ED03)), bounds


def _rank(seed: np.ndarray) -> np.ndarray:
    return -np.log(((seed >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)


def darts(strips: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """For each text the earliest dart of each coordinate; 0 throughout for a text without strips."""
    texts = len(bounds) - 1
    weights = np.diff(bounds)
    out = np.zeros((texts, COORDINATES), np.uint64)
    todo = np.flatnonzero(weights)
    reach = DARTS
    while len(todo):
        at = np.concatenate([np.arange(bounds[i], bounds[i + 1]) for i in todo]) if len(todo) < texts else np.arange(len(strips))
        owner = np.repeat(np.arange(len(todo)), weights[todo])
        limit = reach / weights[todo]
        seed = mix(strips[at] ^ np.uint64(0x8E9D5AAB1B2C3D4F))
        rank = _rank(seed)
        slots, ranks, seeds = [], [], []
        while True:
            thrown = np.flatnonzero(rank < limit[owner])
            if not len(thrown):
                break
            owner, rank, seed = owner[thrown], rank[thrown], seed[thrown]
            coordinate = (mix(seed ^ np.uint64(0x51AFD7ED558CCD)) >> np.uint64(32)) % np.uint64(COORDINATES)
            slots.append(owner * COORDINATES + coordinate.astype(np.int64))
            ranks.append(rank)
            seeds.append(seed)
            with np.errstate(over="ignore"):
                seed = mix(seed + np.uint64(0x9E3779B97F4A7C15))
            rank = rank + _rank(seed)
        slots, ranks, seeds = np.concatenate(slots), np.concatenate(ranks), np.concatenate(seeds)
        best = np.full(len(todo) * COORDINATES, np.inf)
        np.minimum.at(best, slots, ranks)
        won = ranks == best[slots]
        kept = np.zeros(len(best), np.uint64)
        kept[slots[won]] = seeds[won]
        full = np.isfinite(best).reshape(-1, COORDINATES).all(1)
        out[todo[full]] = kept.reshape(-1, COORDINATES)[full]
        todo, reach = todo[~full], reach * 2
    return out


def _text_id(text: Column) -> Column:
    return F.unhex(F.md5(text.cast("binary")))


def signatures(docs: DataFrame, key: str) -> DataFrame:
    """(text_id, key, size, bands, sketch) of every row with a text; no bands for a text without words."""

    def run(batches):
        for batch in batches:
            for a, b in pieces(batch.column("text")):
                for c in range(a, b, 4096):
                    yield sign(batch.slice(c, min(b - c, 4096)))

    def sign(rows):
        strips, bounds = units(rows.column("text"))
        sizes = np.diff(bounds)
        kept = darts(strips, bounds)
        hashes = np.zeros((len(sizes), BANDS), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(ROWS):
                hashes = mix(hashes * np.uint64(0x9E3779B97F4A7C15) + kept[:, k::ROWS])
        ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, BANDS, 0))]).astype(np.int32)
        bands = pa.ListArray.from_arrays(pa.array(ends), pa.array(hashes[sizes > 0].reshape(-1).view(np.int64)))
        small = np.zeros((len(sizes), _SKETCH * 8), np.uint8)
        small[:, :COORDINATES] = kept & np.uint64(0xFF)
        sketch = pa.ListArray.from_arrays(pa.array(np.arange(len(sizes) + 1, dtype=np.int32) * _SKETCH), pa.array(small.view(np.int64).reshape(-1)))
        return pa.record_batch([rows.column("text_id"), rows.column(key), pa.array(sizes), bands, sketch], names=schema.names)

    schema = T.StructType(
        [
            T.StructField("text_id", T.BinaryType()),
            docs.schema[key],
            T.StructField("size", T.LongType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
            T.StructField("sketch", T.ArrayType(T.LongType())),
        ]
    )
    rows = docs.where(F.col("text").isNotNull()).select(_text_id(F.col("text")).alias("text_id"), key, "text")
    return mapped(rows, run, schema)


def _sets(docs: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """(id, units) of the wanted (text_id, least): the text is taken from the row with the least key."""

    def run(batches):
        for batch in batches:
            for a, b in pieces(batch.column("text")):
                for c in range(a, b, 4096):
                    rows = batch.slice(c, min(b - c, 4096))
                    strips, bounds = units(rows.column("text"))
                    found = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(strips.view(np.int64)))
                    yield pa.record_batch([rows.column("id"), found], names=["id", "units"])

    rows = docs.where(F.col("text").isNotNull()).select(_text_id(F.col("text")).alias("id"), F.col(key).alias("least"), "text")
    wanted = wanted.select(F.col("text_id").alias("id"), "least")
    met = rows.join(wanted, (rows["id"] == wanted["id"]) & rows["least"].eqNullSafe(wanted["least"]), "left_semi")
    return mapped(met.select("id", "text"), run, "id binary, units array<long>").dropDuplicates(["id"])


def _verified(pairs: DataFrame, sets: DataFrame, near: float) -> DataFrame:
    """The pairs (a, b) whose weighted sets are that near."""
    left = sets.select(F.col("id").alias("a"), F.col("units").alias("ua"))
    right = sets.select(F.col("id").alias("b"), F.col("units").alias("ub"))
    both = F.size(F.array_intersect("ua", "ub"))
    met = pairs.join(left, "a").join(right, "b")
    return met.where(both >= near * (F.size("ua") + F.size("ub") - both)).select("a", "b")


def _spanning(shared: DataFrame, joined: DataFrame) -> DataFrame:
    """shared with `component`, in the buckets that hold texts of different components."""
    inside = shared.join(joined.withColumnRenamed("id", "text_id"), "text_id", "left")
    inside = inside.withColumn("component", F.coalesce("component", "text_id"))
    spans = inside.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    return inside.join(spans.where("low <> high").select("bucket"), "bucket")


def _led(inside: DataFrame, turn: int, near: float) -> DataFrame:
    """Likely pairs (a, b) of each text with leaders of its buckets, but for those of its own component.

    The first leader is the text that meets most others, as a base meets its edited copies; the rest are drawn by hash.
    A text of 25 buckets meets up to a hundred leaders; the PARTNERS whose sketches agree most are verified. The others are
    not lost: what a text does not join here is compared in _across.
    """
    about = ("text_id", "component", "size", "sketch")
    drawn = [F.xxhash64("text_id", "bucket", F.lit(turn * LEADERS + k)) for k in range(1, LEADERS)]
    order = [F.struct(o.alias("o"), *about) for o in (-F.col("met"), *drawn)]
    leaders = inside.groupBy("bucket").agg(*[F.min(o).alias(f"l{k}") for k, o in enumerate(order)])
    led = inside.join(leaders, "bucket").select(*[F.col(c).alias(f"{c}_a") for c in about], F.explode(F.array(*[f"l{k}" for k in range(LEADERS)])).alias("l"))
    led = led.select(*[f"{c}_a" for c in about], *[F.col("l")[c].alias(f"{c}_b") for c in about])
    fits = F.least("size_a", "size_b") >= F.lit(near) * F.greatest("size_a", "size_b")
    likely = led.where("component_a <> component_b").where(fits).select("text_id_a", "text_id_b", _equal("sketch_a", "sketch_b").alias("equal"))
    # tested in the aggregate, so that the plan holds the long expression once; as a filter it would be copied
    met = F.when(F.col("equal") >= LEAST_EQUAL, F.struct("equal", "text_id_b"))
    best = likely.groupBy("text_id_a").agg(F.slice(F.sort_array(F.collect_set(met), asc=False), 1, PARTNERS).alias("met"))
    best = best.select("text_id_a", F.explode("met.text_id_b").alias("text_id_b"))
    return best.select(F.least("text_id_a", "text_id_b").alias("a"), F.greatest("text_id_a", "text_id_b").alias("b")).distinct()


def _across(inside: DataFrame, sets: DataFrame, near: float) -> DataFrame:
    """The pairs (a, b) of texts of one bucket and different components that are that near.

    A bucket's texts are dealt to blocks of about BLOCK texts and BLOCK_UNITS units; a task holds two blocks, counts the units
    that each two texts share, and gives out links alone. A text is sent once for each block of its bucket, not for each partner. Two
    texts of the bucket's largest component are not compared, so that a large group which hangs together costs nothing.
    """
    counted = inside.groupBy("bucket", "component").agg(F.count("*").alias("n"), F.sum("size").alias("units"))
    blocks = F.greatest(F.ceil(F.sum("n") / BLOCK), F.ceil(F.sum("units") / BLOCK_UNITS))
    about = counted.groupBy("bucket").agg(F.max(F.struct("n", "component"))["component"].alias("main"), blocks.alias("blocks"))
    own = F.pmod(F.xxhash64("text_id", "bucket"), F.col("blocks"))
    rows = inside.join(about, "bucket").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.select(
        "bucket",
        F.least("own", "other").alias("one"),
        F.greatest("own", "other").alias("two"),
        "own",
        F.col("text_id").alias("id"),
        F.xxhash64("component").alias("component"),
        (F.col("component") == F.col("main")).alias("main"),
    )
    group = ["bucket", "one", "two"]
    rows = rows.join(sets, "id").repartition(*group).sortWithinPartitions(*group)
    return mapped(rows, _links_of_blocks(near), "a binary, b binary").distinct()


def _links_of_blocks(near: float):
    """Links among the rows of each (bucket, one, two), which come in a row."""

    def run(batches):
        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            starts = _starts(rows)
            for a, b in zip(starts, starts[1:]):
                yield from links(rows.slice(a, b - a))
            held = [rows.slice(starts[-1])]  # the last group may go on
        if held:
            yield from links(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    def links(rows):
        if rows.num_rows < 2 or pc.all(rows.column("main")).as_py():
            return
        own, component, main = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("own", "component", "main"))
        sizes = rows.column("units").value_lengths().to_numpy()
        ends = np.append(0, np.cumsum(sizes))
        units = rows.column("units").flatten().to_numpy()
        first = own == rows.column("one")[0].as_py()
        left, right = np.flatnonzero(first), np.flatnonzero(~first)
        if not len(right):
            left = right = np.arange(len(own))  # a block with itself, or all that the group holds
        shared = _shared([units[ends[i] : ends[i + 1]] for i in left], [units[ends[i] : ends[i + 1]] for i in right])
        whole = sizes[left][:, None] + sizes[right][None, :] - shared
        met = (shared >= near * whole) & (component[left][:, None] != component[right][None, :]) & ~(main[left][:, None] & main[right][None, :])
        x, y = np.nonzero(met)
        pairs = [sorted(p) for p in zip(rows.column("id").take(pa.array(left[x])).to_pylist(), rows.column("id").take(pa.array(right[y])).to_pylist())]
        if pairs:
            yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*pairs)], names=["a", "b"])

    return run


def _starts(rows: pa.RecordBatch) -> list[int]:
    """First rows of the groups of a batch."""
    new = np.zeros(rows.num_rows, bool)
    new[0] = True
    for c in ("bucket", "one", "two"):
        values = rows.column(c).to_numpy()
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new).tolist()


def _shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many units each left and each right set share: 0/1 tables over the units of both, multiplied slice by slice."""
    sides = []
    for sets in (left, right):
        owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        sides.append((np.concatenate(sets) if sets else np.zeros(0, np.int64), owner))
    both = np.intersect1d(np.unique(sides[0][0]), np.unique(sides[1][0]), assume_unique=True)
    out = np.zeros((len(left), len(right)), np.float32)
    placed = []
    for units, owner in sides:
        at = np.searchsorted(both, units)
        known = at < len(both)
        known[known] = both[at[known]] == units[known]
        order = np.argsort(at[known], kind="stable")
        placed.append((at[known][order], owner[known][order]))
    for a in range(0, len(both), SLICE):
        b = min(a + SLICE, len(both))
        tables = []
        for (at, owner), n in zip(placed, out.shape):
            low, high = np.searchsorted(at, [a, b])
            one = np.zeros((n, b - a), np.float32)
            one[owner[low:high], at[low:high] - a] = 1
            tables.append(one)
        out += tables[0] @ tables[1].T
    return out


def _equal(a: str, b: str) -> Column:
    """Number of equal bytes of two sketches: every second byte of what differs has eight bits above it, which 255 more reach unless it is 0."""
    low, above = F.lit(0x00FF00FF00FF00FF), F.lit(0x0100010001000100)
    differ = F.lit(0)
    for i in range(_SKETCH):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        for half in (x, F.shiftrightunsigned(x, 8)):
            differ = differ + F.bit_count((half.bitwiseAND(low) + low).bitwiseAND(above))
    return F.lit(COORDINATES) - differ


def _classes(docs: DataFrame, key: str, near: float) -> tuple[DataFrame, DataFrame]:
    """(text_id, key, ...) of every row with a text, and (text_id, least, class_id, chosen) of every text.

    least is the text's least key; chosen marks the text that stands for its group: that of the least key, then id.
    """
    use_checkpoints(docs.sparkSession)
    signed = stored(signatures(docs, key), "signatures")
    once = signed.groupBy("text_id").agg(F.min(key).alias("least"), *[F.first(c).alias(c) for c in ("size", "bands", "sketch")])
    texts = stored(once.drop("bands"), "texts")
    member = once.where("size > 0").select("text_id", F.posexplode("bands").alias("band", "value"))
    member = member.select("text_id", F.xxhash64("band", "value").alias("bucket"))
    full = member.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    # the text that meets most others over all its buckets stands in the middle of its group
    met = F.sum("n").over(Window.partitionBy("text_id")).alias("met")
    shared = member.join(full, "bucket").select("text_id", "bucket", met).join(texts.select("text_id", "size", "sketch"), "text_id")
    shared = stored(shared, "buckets")
    wanted = shared.select("text_id").distinct().join(texts.select("text_id", "least"), "text_id")
    sets = stored(_sets(docs, wanted, key), "sets")
    links = shared.select(F.col("text_id").alias("a"), F.col("text_id").alias("b")).limit(0)
    joined = links.select(F.col("a").alias("id"), F.col("b").alias("component"))
    kept = []
    for turn in range(ROUNDS + 1):
        inside = _spanning(shared, joined)
        found = _verified(_led(inside, turn, near), sets, near) if turn < ROUNDS else _across(inside, sets, near)
        found = stored(found, "links")
        kept.append(found)
        if not found.isEmpty():
            links = links.unionByName(found)
            joined = components(links)
    of = joined.withColumnRenamed("id", "text_id")
    of = texts.select("text_id", "least").join(of, "text_id", "left").withColumn("component", F.coalesce("component", "text_id"))
    best = F.min(F.struct(F.col("least").isNull(), "least", "text_id"))
    named = of.groupBy("component").agg(F.min("least").alias("class_id"), best["text_id"].alias("standing"))
    named = of.join(named, "component").select("text_id", "least", "class_id", (F.col("standing") == F.col("text_id")).alias("chosen"))
    classes = stored(named, "classes")
    removed(shared, sets, *kept)
    return signed, classes


def groups(docs: DataFrame, key: str = "doc_id", near: float = NEAR) -> DataFrame:
    """(key, class_id) of every row: the least key of its group of near copies."""
    signed, classes = _classes(docs, key, near)
    found = signed.select("text_id", key).join(classes.select("text_id", "class_id"), "text_id").select(key, "class_id")
    without = docs.where(F.col("text").isNull()).select(key, F.col(key).alias("class_id"))
    return found.unionByName(without)


def keep_one(docs: DataFrame, key: str = "doc_id", near: float = NEAR) -> DataFrame:
    """docs with one row of each group, as it is: the least key's; of equal rows one stays, and every row without a text."""
    _, classes = _classes(docs, key, near)
    # rows are met by text and key together, so that many copies of a text do not meet in one task
    named = F.coalesce(F.col("key").cast("string"), F.lit("\0"))
    chosen = classes.where("chosen").select("text_id", F.col("least").alias("key")).select("text_id", named.alias("key"))
    whole = F.struct(*docs.columns)
    rows = docs.where(F.col("text").isNotNull()).select(_text_id(F.col("text")).alias("text_id"), F.col(key).alias("key"), whole.alias("row"))
    rows = rows.select("text_id", named.alias("key"), "row")
    kept = rows.join(chosen, ["text_id", "key"], "left_semi").dropDuplicates(["text_id", "key"]).select("row.*")
    return kept.unionByName(docs.where(F.col("text").isNull()))
