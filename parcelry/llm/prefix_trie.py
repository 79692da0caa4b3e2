"""Prefix trie of conversations, with totals over subtrees by centroid decomposition.

Each conversation is first rebuilt (see rebuilt), then named prefix by prefix: a turn hashes its place, role and text
to 128 bits, and the name of the first d turns is the XOR of their hashes, a running sum. Equal sequences have equal names, so a
node of the trie is a group of rows, and its smallest member and depth are its key from there on.

Totals over subtrees come from a centroid decomposition of the forest of parent edges. A node weighs as many as
conversations pass through it, so that the weight of a subtree is a plain sum over its members' rows. A component is split at
its centroid, the lowest node that holds half of the weight or more: each child of the centroid becomes the top of a component, the rest
stays one, and none has more than half of the weight, so that even a chain of millions of turns takes no more
rounds than the binary logarithm of the rows. What the centroid's part adds up to goes to every node on the path from the
centroid to the component's top. Components of over LOCAL nodes are split in Spark, all of a round together: whether a node
stands below a centroid is one look-up of its smallest member's prefix at the centroid's depth. Smaller ones are
decomposed further inside tasks by the same rule, whole components a task.

Defined cases: a null role or text is empty; turns of one conversation stand in order of the turn, nulls first, ties by the MD5
of role and text, and equal rows follow each other; rows without a conv_id belong to no conversation; an empty table
has no nodes; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelry.llm.common import removed, stored

#: Conversations that share the opening of their block's first one, and the bound of its length.
BLOCK = 20
OPENING = 4
#: Nodes up to which a component is decomposed inside a task.
LOCAL = 4096
#: Turns of a conversation whose running hashes one task adds up.
CHUNK = 4096
#: Ends of a node in one row on the way to their digest.
LISTED = 1024
_WORD = r"[^\x20\x09-\x0D]+"


def _opening(conv: Column) -> Column:
    """How many turns a conversation takes from the first of its block."""
    return F.crc32(conv.cast("string").cast("binary")) % OPENING


def _numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv, a, b, words, part, within) and, for each (conv, part), how many turns stand before it.

    Rows are dealt by ranges of (conv, turn), so that a conversation of any length is numbered by many tasks; rows
    equal in all but their place in the input are dealt by that place.
    """
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    turns = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv"),
        "turn",
        digest.alias("digest"),
        F.regexp_count(text, F.lit(_WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("place"),
    )
    order = [F.col("conv"), F.col("turn").asc_nulls_first(), F.col("digest"), F.col("place")]
    turns = stored(turns.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "turns")
    inside = Window.partitionBy("conv", "part").orderBy(*order[1:])
    halves = [F.xxhash64(F.substring("digest", at, 16)).alias(name) for at, name in ((1, "a"), (17, "b"))]
    numbered = turns.select("conv", "part", "words", *halves, (F.row_number().over(inside) - 1).alias("within"))
    sizes = turns.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return numbered, sizes.withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))


def rebuilt(conversations: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(conv, depth, size, a, b, words) of every turn of the rebuilt conversations, (conv, size) of each, and the stored turns.

    A conversation c starts with the first h turns of conversation c - c % BLOCK, as many as there are, and goes on with its own
    turns after its first h; h is the CRC-32 of c's decimal text modulo OPENING.
    """
    numbered, sizes = _numbered(conversations)
    base = F.col("conv") - F.col("conv") % BLOCK
    known = sizes.groupBy("conv").agg(F.sum("size").alias("own")).select("conv", "own", base.alias("base"), _opening(F.col("conv")).alias("h"))
    bases = known.where("conv = base").select("base", F.col("own").alias("base_own"))
    known = known.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_own", F.lit(0))))
    size = F.when(F.col("conv") == F.col("base"), F.col("own")).otherwise(F.greatest(F.col("own") - F.col("h"), F.lit(0)) + F.col("taken"))
    known = known.withColumn("size", size)
    placed = sizes.join(known.select("conv", "base", "h", "taken", "size"), "conv").select(
        "conv", "part", "before", "base", "h", "taken", known["size"].alias("whole")
    )
    turn = F.col("before") + F.col("within")
    own = numbered.join(placed, ["conv", "part"]).withColumn("turn", turn)
    is_base = F.col("conv") == F.col("base")
    moved = F.when(is_base, F.col("turn")).otherwise(F.col("turn") - F.col("h") + F.col("taken"))
    kept = own.where(is_base | (F.col("turn") >= F.col("h"))).select("conv", (moved + 1).alias("depth"), F.col("whole").alias("size"), "a", "b", "words")
    heads = own.where(is_base & (F.col("turn") < OPENING - 1)).select("base", "turn", "a", "b", "words")
    takers = known.where("conv <> base and taken > 0").select("conv", "base", "taken", "size")
    opened = takers.join(heads, "base").where("turn < taken").select("conv", (F.col("turn") + 1).alias("depth"), "size", "a", "b", "words")
    return kept.unionByName(opened), known.select("conv", "size"), numbered


def _named(rows: DataFrame, chunk: int) -> DataFrame:
    """(conv, depth, size, words, a, b) with the name of the prefix in a and b; long conversations are added up chunk by chunk."""
    hashed = [F.xxhash64("depth", c).alias(c) for c in ("a", "b")]
    rows = rows.select("conv", "depth", "size", "words", *hashed, F.floor((F.col("depth") - 1) / chunk).alias("chunk"))
    running = Window.partitionBy("conv", "chunk").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    named = rows.withColumns({c: F.bit_xor(c).over(running) for c in ("a", "b")})
    before = Window.partitionBy("conv").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    ahead = rows.where(F.col("size") > chunk).groupBy("conv", "chunk").agg(*[F.bit_xor(c).alias(c) for c in ("a", "b")])
    ahead = ahead.select("conv", "chunk", *[F.bit_xor(c).over(before).alias(f"{c}_before") for c in ("a", "b")])
    whole = [F.col(c).bitwiseXOR(F.coalesce(f"{c}_before", F.lit(0))).alias(c) for c in ("a", "b")]
    return named.join(ahead, ["conv", "chunk"], "left").select("conv", "depth", "size", "words", *whole)


def _prefixes(rows: DataFrame, root: int) -> DataFrame:
    """(conv, depth, size, node, up, n_convs, weight, words): the node each conversation passes at each depth, as that node's
    smallest member, and the node above it; the root stands for depth 0 and has no row.
    """
    beneath = F.col("size") - F.col("depth") + 1
    nodes = rows.groupBy("a", "b", "depth").agg(
        F.min("conv").alias("node"), F.count(F.lit(1)).alias("n_convs"), F.sum(beneath).alias("weight"), F.max("words").alias("words")
    )
    passed = rows.select("conv", "depth", "size", "a", "b").join(nodes, ["a", "b", "depth"]).drop("a", "b")
    above = passed.select("conv", (F.col("depth") + 1).alias("depth"), F.col("node").alias("up"))
    return passed.join(above, ["conv", "depth"], "left").withColumn("up", F.coalesce("up", F.lit(root)))


def _decomposed(inside: list, values: list, gained: list, below: list, top: int, done: list) -> tuple:
    """The total of the component under `top`. Leaves in `done` each node's total over its subtree.

    inside: weight of a node's part of its component; gained: what has come up to it so far; below: children in the component.
    """
    path, at = [], top
    while True:
        heavy = next((k for k in below[at] if done[k] is None and 2 * inside[k] >= inside[top]), None)
        if heavy is None:
            break
        path.append(at)
        at = heavy
    done[at] = total = values[at]
    for k in below[at]:
        if done[k] is None:
            total = tuple(map(sum, zip(total, _decomposed(inside, values, gained, below, k, done))))
    done[at] = tuple(map(sum, zip(total, gained[at])))
    for k in path:
        inside[k] -= inside[at]
        gained[k] = tuple(map(sum, zip(gained[k], total)))
    if not path:
        return total
    return tuple(map(sum, zip(total, _decomposed(inside, values, gained, below, top, done))))


def _solved(components: DataFrame) -> DataFrame:
    """(conv, depth, n_leaves, saved_tokens) of the nodes of components, each whole in one task and at most LOCAL nodes."""

    def run(batches):
        held = []
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows = pa.Table.from_batches(held).combine_chunks()
                last = [rows.column(c)[-1].as_py() for c in ("top_conv", "top_depth")]
                tops, depths = (rows.column(c).to_numpy() for c in ("top_conv", "top_depth"))
                whole = rows.num_rows - int(((tops == last[0]) & (depths == last[1])).sum())  # the last component may go on
                if whole:
                    yield one(rows.slice(0, whole).to_pydict())
                held = rows.slice(whole).to_batches()
        if held:
            yield one(pa.Table.from_batches(held).to_pydict())

    def one(rows):
        keys = list(zip(rows["conv"], rows["depth"]))
        tops = list(zip(rows["top_conv"], rows["top_depth"]))
        number = {key: i for i, key in enumerate(keys)}
        below = [[] for _ in keys]
        for i, (up, (_, depth), top) in enumerate(zip(rows["up"], keys, tops)):
            if keys[i] != top:
                below[number[up, depth - 1]].append(i)
        values = list(zip(rows["leaf"], rows["saved"]))
        gained = list(zip(rows["more_leaves"], rows["more_saved"]))
        done: list = [None] * len(keys)
        for i, key in enumerate(keys):
            if key == tops[i]:
                _decomposed(rows["inside"], values, gained, below, i, done)
        return pa.record_batch(
            [pa.array(rows["conv"], pa.int64()), pa.array(rows["depth"], pa.int64()), pa.array([x for x, _ in done], pa.int64()), pa.array([x for _, x in done], pa.int64())],
            names=["conv", "depth", "n_leaves", "saved_tokens"],
        )

    dealt = components.repartition("top_conv", "top_depth").sortWithinPartitions("top_conv", "top_depth")
    return dealt.mapInArrow(run, "conv long, depth long, n_leaves long, saved_tokens long")


def _round(large: DataFrame, prefixes: DataFrame) -> DataFrame:
    """The nodes of components to split, each with its component's centroid and where it stands to it: at, below, above or beside.

    `part` is, for a node below, the centroid's child on the way to it.
    """
    top = ["top_conv", "top_depth"]
    half = large.where(2 * F.col("inside") >= F.col("total"))
    centroids = half.groupBy(*top).agg(F.min(F.struct("inside", "conv", "depth")).alias("c"))
    centroids = centroids.select(*top, F.col("c.conv").alias("c_conv"), F.col("c.depth").alias("c_depth"), F.col("c.inside").alias("c_inside"))
    nodes = large.join(centroids, top)
    lower = F.col("depth") > F.col("c_depth")
    nodes = nodes.withColumns({
        "at_conv": F.when(lower, F.col("conv")).otherwise(F.col("c_conv")),
        "at_depth": F.when(lower, F.col("c_depth") + 1).otherwise(F.col("depth")),
    })
    seen = prefixes.select(F.col("conv").alias("at_conv"), F.col("depth").alias("at_depth"), F.col("node").alias("part"), F.col("up").alias("part_up"))
    nodes = nodes.join(seen, ["at_conv", "at_depth"], "left").drop("at_conv", "at_depth")
    same = (F.col("conv") == F.col("c_conv")) & (F.col("depth") == F.col("c_depth"))
    above = (F.col("depth") < F.col("c_depth")) & ((F.col("depth") == 0) | (F.col("part") == F.col("conv")))
    stands = (
        F.when(same, "at")
        .when(lower & (F.col("part_up") == F.col("c_conv")), "below")
        .when(above, "above")
        .otherwise("beside")
    )
    return nodes.withColumn("stands", stands)


def _rolled_up(nodes: DataFrame, prefixes: DataFrame, local: int) -> tuple[DataFrame, list[DataFrame]]:
    """(conv, depth, n_leaves, saved_tokens) of every node, and the stored tables it reads."""
    top, kept = ["top_conv", "top_depth"], []
    columns = [*top, "conv", "depth", "up", "inside", "leaf", "saved", "more_leaves", "more_saved"]
    state, done, small = nodes.select(*columns), [], []
    while True:
        sizes = state.groupBy(*top).agg(F.count(F.lit(1)).alias("n"), F.max("inside").alias("total"))
        sized = stored(sizes, "components")
        kept.append(sized)
        small.append(state.join(sized.where(F.col("n") <= local).select(*top), top, "left_semi"))
        split = sized.where(F.col("n") > local)
        if split.isEmpty():
            break
        placed = stored(_round(state.join(split.select(*top, "total"), top), prefixes), "split")
        kept.append(placed)
        within = F.col("stands").isin("at", "below")
        totals = placed.where(within).groupBy(*top).agg(F.sum("leaf").alias("part_leaves"), F.sum("saved").alias("part_saved"))
        after = placed.join(totals, top)
        up = F.col("stands") == "above"
        more = {f"more_{c}": F.col(f"more_{c}") + F.when(up | (F.col("stands") == "at"), F.col(f"part_{c}")).otherwise(0) for c in ("leaves", "saved")}
        lower = F.col("stands") == "below"
        after = after.withColumns({
            **more,
            "inside": F.col("inside") - F.when(up, F.col("c_inside")).otherwise(0),
            "top_conv": F.when(lower, F.col("part")).otherwise(F.col("top_conv")),
            "top_depth": F.when(lower, F.col("c_depth") + 1).otherwise(F.col("top_depth")),
        })
        done.append(after.where("stands = 'at'").select("conv", "depth", F.col("more_leaves").alias("n_leaves"), F.col("more_saved").alias("saved_tokens")))
        state = after.where("stands <> 'at'").select(*columns)
    found = _solved(_union(small))
    return _union([found, *done]), kept


def _union(tables: list[DataFrame]) -> DataFrame:
    first, *rest = tables
    for df in rest:
        first = first.unionByName(df)
    return first


def _ends(ended: DataFrame) -> DataFrame:
    """(conv, depth, ends_sha256): the digest of the ids of the conversations that end at a node.

    Ids are dealt by ranges and listed in order, LISTED a row; a node's lists then go through the hash one after another.
    """
    most = LISTED

    def lists(batches):
        at, ids = None, []
        for batch in batches:
            for conv, depth, own in zip(*(batch.column(c).to_pylist() for c in ("node", "depth", "conv"))):
                if ids and ((conv, depth) != at or len(ids) == most):
                    yield listed(at, ids)
                    ids = []
                at = (conv, depth)
                ids.append(own)
        if ids:
            yield listed(at, ids)

    def listed(at, ids):
        return (at[0], at[1], ids[0], ",".join(map(str, ids)))

    def as_batches(rows):
        some = []
        for row in rows:
            some.append(row)
            if len(some) == most:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in some], schema)
                some = []
        if some:
            yield pa.RecordBatch.from_pylist([dict(zip(names, r)) for r in some], schema)

    def digests(batches):
        at, state, found = None, None, []
        for batch in batches:
            for conv, depth, text in zip(*(batch.column(c).to_pylist() for c in ("node", "depth", "ids"))):
                if (conv, depth) != at:
                    if at:
                        found.append((*at, state.hexdigest()))
                    at, state = (conv, depth), hashlib.sha256(text.encode())
                else:
                    state.update(b"," + text.encode())
            if found:
                yield digested(found)
                found = []
        if at:
            yield digested([(*at, state.hexdigest())])

    def digested(found):
        conv, depth, digest = zip(*found)
        return pa.record_batch([pa.array(conv, pa.int64()), pa.array(depth, pa.int64()), pa.array(digest)], names=["conv", "depth", "ends_sha256"])

    names = ["node", "depth", "first", "ids"]
    schema = pa.schema([("node", pa.int64()), ("depth", pa.int64()), ("first", pa.int64()), ("ids", pa.string())])
    order = ["node", "depth", "conv"]
    dealt = ended.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = dealt.mapInArrow(lambda batches: as_batches(lists(batches)), "node long, depth long, first long, ids string")
    rows = rows.repartition("node", "depth").sortWithinPartitions("node", "depth", "first")
    return rows.mapInArrow(digests, T.StructType.fromDDL("conv long, depth long, ends_sha256 string"))


def trie(conversations: DataFrame, local: int = LOCAL, chunk: int = CHUNK) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node.

    saved_tokens counts the words that a node's conversations share and that one copy of the prefix would save,
    added up over the node's subtree.
    """
    rows, convs, numbered = rebuilt(conversations)
    convs = stored(convs, "conversations")
    whole = convs.agg(F.min("conv").alias("root"), F.count(F.lit(1)).alias("n"), F.sum(F.col("size") + 1).alias("weight")).first()
    root = whole["root"] if whole["n"] else 0
    named = stored(_named(rows, chunk), "prefixes")
    prefixes = stored(_prefixes(named, root), "passed")
    top = prefixes.sparkSession.createDataFrame(
        [(root, 0, None, whole["n"], whole["weight"], 0)] if whole["n"] else [], "conv long, depth long, up long, n_convs long, weight long, words long"
    )
    nodes = prefixes.where("conv = node").select("conv", "depth", "up", "n_convs", "weight", "words").unionByName(top)
    children = prefixes.where("conv = node").groupBy(F.col("up").alias("conv"), (F.col("depth") - 1).alias("depth")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = nodes.join(children, ["conv", "depth"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = stored(nodes, "nodes")
    zero = F.lit(0).cast("long")
    start = nodes.select(
        F.lit(root).cast("long").alias("top_conv"),
        zero.alias("top_depth"),
        "conv", "depth", "up",
        F.col("weight").alias("inside"),
        (F.col("n_children") == 0).cast("long").alias("leaf"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        zero.alias("more_leaves"),
        zero.alias("more_saved"),
    )
    totals, kept = _rolled_up(start, prefixes, local)
    silent = convs.where("size = 0").select(F.lit(root).cast("long").alias("node"), zero.alias("depth"), "conv")
    ended = prefixes.where("depth = size").select("node", "depth", "conv").unionByName(silent)
    found = nodes.join(totals, ["conv", "depth"]).join(_ends(ended), ["conv", "depth"], "left")
    found = stored(
        found.select(
            F.col("conv").alias("conv_id"),
            "depth",
            F.col("up").alias("parent_conv_id"),
            "n_convs", "n_children", "n_leaves", "saved_tokens",
            F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"),
        ),
        "trie",
    )
    removed(numbered, convs, named, prefixes, nodes, *kept)
    return found
