"""The trie of conversation prefixes, and totals of every subtree by parallel tree contraction.

A node is a distinct sequence of turns. A prefix is named by two 64-bit numbers, the XOR of the
hashes of its turns with their places, so names of all prefixes are running aggregates and a parent's
name is its child's without the last turn. Orders, places and running values of long conversations
are taken in blocks first and over one row for each block afterwards; no task holds a conversation.

Totals: rounds of joins alternately *rake* (all leaves hand what they hold to their parents and go)
and *compress* (nodes with a single child go: what they hold goes to their parent, on which the child then hangs). Of a chain the
nodes whose depth has a certain bit and whose child's has not go in one round; the rounds take the bits
in turn, so a chain of any length halves in each. What a round took is written down. Going back over the rounds, each compressed node's total
is what it held plus its child's total.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.session import materialize

#: places of a conversation in one block, and ids in one piece of a node's list
SPAN, PIECE = 4096, 4096


def places(turns: DataFrame) -> DataFrame:
    """``turns`` (``conv_id``, ``turn``, ``role``, ``digest``, ``chars``) with ``place``, from 0, in the order of
    ``turn`` (NULL first); equal turns are in the order of role and digest.

    Rows are range-partitioned in that order, numbered in their partition, and shifted by what earlier partitions
    hold of the same conversation, so a conversation may fill any number of partitions.
    """
    order = ["conv_id", "turn", "role", "digest"]
    dealt = turns.repartitionByRange(*order).withColumn("bin", F.spark_partition_id())
    dealt = materialize(dealt, "turns")
    whole = Window.partitionBy("conv_id").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    sizes = dealt.groupBy("conv_id", "bin").agg(F.count("*").alias("n"))
    before = sizes.select("conv_id", "bin", F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("before"))
    inside = F.row_number().over(Window.partitionBy("conv_id", "bin").orderBy(*order[1:]))
    numbered = dealt.withColumn("inside", inside).join(before, ["conv_id", "bin"])
    return numbered.withColumn("place", F.col("before") + F.col("inside") - 1).drop("bin", "inside", "before")


def rebuilt(placed: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """Every conversation c as the first h turns of conversation c - c % ``group`` and its own turns after its
    first h, h = crc32(c) % ``heads``; new ``place``, from 0."""
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads
    ids = placed.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), h.alias("h")
    )
    first = placed.where((F.col("conv_id") % group == 0) & (F.col("place") < heads - 1))
    lent = first.select(F.col("conv_id").alias("base"), "digest", "chars", "place")
    head = ids.join(lent, "base").where("place < h").select("conv_id", "digest", "chars", "place")
    lengths = lent.groupBy("base").agg(F.count("*").alias("known"))
    own = placed.join(ids.join(lengths, "base", "left"), "conv_id").where("place >= h")
    shift = F.least(F.col("h"), F.coalesce("known", F.lit(0)))
    own = own.select("conv_id", "digest", "chars", (F.col("place") - F.col("h") + shift).alias("place"))
    return head.unionByName(own)


def _name(salt: int) -> Column:
    return F.xxhash64(F.lit(salt), "place", "digest")


def prefixes(turns: DataFrame) -> DataFrame:
    """``conv_id, depth, chars, node, parent`` for every prefix of ``turns``; names are pairs of numbers."""
    marked = turns.select("conv_id", "place", "chars", F.floor(F.col("place") / SPAN).alias("block"), _name(1).alias("x"), _name(2).alias("y"))
    marked = materialize(marked, "rebuilt")
    blocks = marked.groupBy("conv_id", "block").agg(F.bit_xor("x").alias("bx"), F.bit_xor("y").alias("by"))
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = blocks.select("conv_id", "block", *[F.coalesce(F.bit_xor(c).over(earlier), F.lit(0)).alias(c) for c in ("bx", "by")])
    upto = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    here = marked.withColumns({"px": F.bit_xor("x").over(upto), "py": F.bit_xor("y").over(upto)}).join(carried, ["conv_id", "block"])
    px, py = F.col("px").bitwiseXOR(F.col("bx")), F.col("py").bitwiseXOR(F.col("by"))
    return here.select(
        "conv_id", (F.col("place") + 1).alias("depth"), "chars", F.struct(px.alias("x"), py.alias("y")).alias("node"),
        F.struct(px.bitwiseXOR(F.col("x")).alias("x"), py.bitwiseXOR(F.col("y")).alias("y")).alias("parent"),
    )


def nodes_of(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """``node, parent, depth, conv_id, n_convs, chars``: one row for each distinct prefix, the root (no parent) included."""
    nodes = rows.groupBy("node", "parent", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.first("chars").alias("chars")
    )
    nothing = F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0").select(
        nothing.alias("node"), F.when(F.lit(False), nothing).alias("parent"), F.lit(0).cast("long").alias("depth"), "conv_id", "n_convs", F.lit(0).alias("chars")
    )
    return nodes.unionByName(root)


def subtree_totals(tree: DataFrame) -> DataFrame:
    """``node, leaves, total`` for every node of ``tree`` (``node, parent, depth, own``): the childless nodes of its
    subtree and the sum of ``own`` over it, itself included.

    ``node`` names are of any type; a root's parent is NULL. Each round reads what the one before wrote; taken nodes
    are written once and read back once.
    """
    childless = tree.join(tree.select(F.col("parent").alias("node")).where("node IS NOT NULL").distinct(), "node", "left_anti").select("node", F.lit(1).alias("leaf"))
    active = tree.join(childless, "node", "left").select("node", "parent", "depth", F.coalesce("leaf", F.lit(0)).cast("long").alias("leaves"), F.col("own").cast("long").alias("total"))
    active = materialize(active, "active")
    deepest = active.agg(F.max("depth")).first()[0] or 0
    raked, compressed = [], []
    turn = 0
    while not active.isEmpty():
        kids = active.where("parent IS NOT NULL").select(F.col("parent").alias("node")).distinct().withColumn("inner", F.lit(True))
        seen = active.join(kids, "node", "left")
        leaves = seen.where("inner IS NULL")
        raked.append(materialize(leaves.select("node", "leaves", "total"), "raked"))
        # what raked leaves hand up, and the children that stay
        stay = F.col("inner").isNotNull()
        handed = seen.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(
            F.sum(F.when(~stay, F.col("leaves")).otherwise(0)).alias("more_leaves"),
            F.sum(F.when(~stay, F.col("total")).otherwise(0)).alias("more_total"),
            F.count(F.when(stay, 1)).alias("n_kids"),
            F.max(F.when(stay, F.struct("node", "depth"))).alias("kid"),
        )
        bit = lambda c: F.shiftright(c, turn % max(1, deepest.bit_length())).bitwiseAND(1) == 1
        goes = (F.col("n_kids") == 1) & F.col("parent").isNotNull() & bit("depth") & ~bit("kid.depth")
        left = seen.where(stay).join(handed, "node").select(
            "node", "parent", "depth", (F.col("leaves") + F.col("more_leaves")).alias("leaves"), (F.col("total") + F.col("more_total")).alias("total"),
            F.when(goes, F.col("kid.node")).alias("kid"),
        )
        left = materialize(left, "raked-tree")
        gone = left.where("kid IS NOT NULL")
        if not gone.isEmpty():
            compressed.append((len(raked), gone))
        lifted = gone.select(F.col("kid").alias("node"), F.col("parent").alias("above"))
        # what a compressed node held goes to its parent, which keeps the child
        passed = gone.groupBy(F.col("parent").alias("node")).agg(F.sum("leaves").alias("more_leaves"), F.sum("total").alias("more_total"))
        active = left.where("kid IS NULL").join(lifted, "node", "left").join(passed, "node", "left").select(
            "node", F.coalesce("above", "parent").alias("parent"), "depth",
            (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"), (F.col("total") + F.coalesce("more_total", F.lit(0))).alias("total"),
        )
        active = materialize(active, "active")
        turn += 1
    # back over the rounds: a compressed node's child went later than it did
    whole, at = None, len(raked)

    def known(upto: int) -> DataFrame | None:
        """Totals of all nodes that went from round ``upto`` on."""
        nonlocal whole, at
        while at > upto:
            at -= 1
            whole = raked[at] if whole is None else whole.unionByName(raked[at])
        return whole

    for rounds, gone in reversed(compressed):
        below = known(rounds).select(F.col("node").alias("kid"), F.col("leaves").alias("kid_leaves"), F.col("total").alias("kid_total"))
        opened = gone.join(below, "kid").select("node", (F.col("leaves") + F.col("kid_leaves")).alias("leaves"), (F.col("total") + F.col("kid_total")).alias("total"))
        whole = whole.unionByName(materialize(opened, "opened"))
    out = known(0)
    return tree.select("node", F.lit(0).cast("long").alias("leaves"), F.lit(0).cast("long").alias("total")) if out is None else out


def ending_digests(ends: DataFrame) -> DataFrame:
    """``node, ends_sha256``: SHA-256 of the ascending, comma-joined ``conv_id`` of each node of ``ends``.

    Ids are joined to pieces first, in ranges of (node, id); a node's pieces are then hashed one after another.
    """
    ordered = ends.select("node.x", "node.y", "conv_id").repartitionByRange("x", "y", "conv_id").sortWithinPartitions("x", "y", "conv_id")

    def join(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def piece() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([key[0]]), pa.array([key[1]]), pa.array([held[0]]), pa.array([",".join(map(str, held))])], names=["x", "y", "first", "ids"]
            )

        key, held = None, []
        for batch in batches:
            for x, y, c in zip(*(col.to_pylist() for col in batch.columns)):
                if held and ((x, y) != key or len(held) >= PIECE):
                    yield piece()
                    held = []
                key = (x, y)
                held.append(c)
        if held:
            yield piece()

    def digest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, done = None, None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["x", "y", "ends_sha256"])

        for batch in batches:
            for x, y, _, ids in zip(*(col.to_pylist() for col in batch.columns)):
                if (x, y) == key:
                    state.update(b"," + ids.encode())
                else:
                    if key:
                        done.append((*key, state.hexdigest()))
                    key, state = (x, y), sha256(ids.encode())
            if len(done) > PIECE:
                yield out()
                done = []
        if key:
            done.append((*key, state.hexdigest()))
        if done:
            yield out()

    pieces = ordered.mapInArrow(join, "x long, y long, first long, ids string")
    hashed = pieces.repartition("x", "y").sortWithinPartitions("x", "y", "first").select("x", "y", "first", "ids")
    return hashed.mapInArrow(digest, "x long, y long, ends_sha256 string").select(F.struct("x", "y").alias("node"), "ends_sha256")


def prefix_trie(conversations: DataFrame, group: int = 100, heads: int = 6) -> DataFrame:
    """``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256`` of every node of the
    trie of the rebuilt conversations (see ``rebuilt``).

    NULL roles and texts are empty. Rows without a conv_id belong to no conversation. Turns are in the order of
    ``turn``, NULL first; rows of one conversation that share a turn are in the order of role and of their digest, and each is a
    turn of its own, repeated rows too. A conversation without turns after rebuilding counts in the root only. An empty
    table has no root and gives no rows. Extra columns are not read.
    """
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    turns = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        # the role's length keeps (role, text) apart from any other cut of the same characters
        F.sha2(F.concat_ws(":", F.length(role).cast("string"), role, text).cast("binary"), 256).alias("digest"),
        F.length(text).alias("chars"),
    )
    placed = materialize(places(turns), "placed")
    ids = placed.select("conv_id").distinct()
    rows = materialize(prefixes(rebuilt(placed, group, heads)), "prefixes")
    nodes = materialize(nodes_of(rows, ids), "nodes")
    totals = subtree_totals(nodes.select("node", "parent", "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("own")))

    last = rows.groupBy("conv_id").agg(F.max_by("node", "depth").alias("node"))
    nothing = F.struct(F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"))
    ends = ids.join(last, "conv_id", "left").select(F.coalesce("node", nothing).alias("node"), "conv_id")
    children = nodes.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    none = F.sha2(F.lit("").cast("binary"), 256)
    return (
        nodes.join(totals, "node")
        .join(children, "node", "left")
        .join(ending_digests(ends), "node", "left")
        .join(above, "parent", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
            F.col("leaves").alias("n_leaves"), F.col("total").alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256"),
        )
    )
