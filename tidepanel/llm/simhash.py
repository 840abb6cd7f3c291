"""Near-duplicate documents by SimHash fingerprints of 64 bits and vantage-point trees.

Fingerprints that differ in at most 3 bits differ in at most one bit of one of their halves. So
there are two trees, each over the Hamming distance on one half, and each searched with radius 1.
A node of a tree has a vantage point and a radius: what is as near as the radius goes inside, the
rest outside. By the triangle inequality a fingerprint whose distance is within the search radius
of the node's radius can have partners on the other side, so it is sent there too, as a visitor;
all other branches are pruned. The leaves are the shards: inside each, home members and visitors
are compared on all 64 bits, and links are confirmed by their exact distance. Nothing is
approximate: the trees decide only where two fingerprints meet.

Equal fingerprints are one class before anything is sent, and a shard emits only the links that
join two of its components, fewer than it has members, however many copies are alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from tidepanel.llm.common import with_arrow_columns
from tidepanel.llm.components import components
from tidepanel.session import materialize

WORDS, SEED = 3, 42

#: differing bits of a link
BITS = 3

#: home members of a shard that the trees aim at, and how many at most are held against others at once
SHARD_ROWS, BLOCK_ROWS = 2048, 4096

#: fingerprints the trees are fitted on, and how many of them a leaf needs; all fingerprints are indexed
SAMPLE, LEAF_SAMPLE = 65536, 16

#: shingles counted, and fingerprints sent on, at once
SLICE, ROUTED = 1 << 15, 1 << 17

HALVES = (0xFFFFFFFF, 0xFFFFFFFF << 32)


def fingerprint(text: str | None) -> int:
    """Majority of the bits of all 3-word shingles' hashes, as an unsigned number.

    A-Z are lower-cased; words are what stands between spaces and the characters 9 to 13. Fewer words
    are one shingle; no words give 0.
    """
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    k = min(WORDS, len(words))
    n = len(words) - k + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, SLICE):
        part = words[at : at + SLICE + k - 1]
        shingles = map(b" ".join, zip(*(part[j:] for j in range(k))))
        hashes = np.array([xxhash.xxh64_intdigest(s, SEED) for s in shingles], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text", out: str = "fp") -> DataFrame:
    """``df`` with the fingerprint of each text as a signed number."""

    def make():
        return lambda texts: [pa.array(np.array([fingerprint(t) for t in texts], np.uint64).view(np.int64))]

    return with_arrow_columns(df, text, [StructField(out, LongType())], make)


class Node(NamedTuple):
    """A split: what is within ``radius`` of ``point`` goes ``inside``. A leaf has only its number."""

    point: int
    radius: int
    inside: Node | int
    outside: Node | int


def distances(values: np.ndarray, point: int) -> np.ndarray:
    return np.bitwise_count(values ^ np.uint64(point)).astype(np.int64)


def grow(sample: np.ndarray, mask: int, leaves: int, reach: int) -> tuple[Node | int, int]:
    """A tree of about ``leaves`` leaves over the distance on the bits of ``mask``, and their number.

    The radius of a node is the one that sends fewest visitors for what it tells apart. A leaf is what has too
    few sampled fingerprints, or what no radius tells apart.
    """
    rng = np.random.default_rng(13)
    least = max(LEAF_SAMPLE, math.ceil(len(sample) / max(1, leaves)))
    made = 0

    def split(part: np.ndarray) -> Node | int:
        nonlocal made
        best = None
        if len(part) > least:
            for point in part[rng.integers(len(part), size=4)].tolist():
                d = distances(part, point)
                below = np.cumsum(np.bincount(d, minlength=65)) / len(part)
                for radius in range(64):
                    p = below[radius]
                    if 0.1 <= p <= 0.9:
                        told = -(p * math.log2(p) + (1 - p) * math.log2(1 - p))
                        low = below[radius - reach] if radius >= reach else 0.0
                        sent = math.log2(1 + below[min(63, radius + reach)] - low)
                        if sent < told and (best is None or sent / told < best[0]):
                            best = (sent / told, point, radius, d)
        if best is None:
            made += 1
            return made - 1
        _, point, radius, d = best
        return Node(point, radius, split(part[d <= radius]), split(part[d > radius]))

    return split(sample & np.uint64(mask)), made


def route(tree: Node | int, values: np.ndarray, reach: int) -> Iterator[tuple[int, np.ndarray, bool]]:
    """``leaf, positions, home`` of all ``values`` (cut to the tree's bits).

    Two values within ``reach`` share a leaf in which at least one is at home: of two values that a node
    parts, the inner one visits the outer one's side.
    """
    stack = [(tree, np.arange(len(values)), True)]
    while stack:
        node, at, home = stack.pop()
        if not len(at):
            continue
        if not isinstance(node, Node):
            yield node, at, home
            continue
        d = distances(values[at], node.point)
        if home:
            stack.append((node.inside, at[d <= node.radius], True))
            stack.append((node.outside, at[d > node.radius], True))
            stack.append((node.outside, at[(d <= node.radius) & (d > node.radius - reach)], False))
        else:
            stack.append((node.inside, at[d <= node.radius + reach], False))
            stack.append((node.outside, at[d > node.radius - reach], False))


def joining_links(home: np.ndarray, others: np.ndarray, label: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """Links between ``home`` and all of ``home`` and ``others`` that join components; ``label`` (one for each of both) is kept up."""
    members = np.concatenate([home, others])
    found: list[tuple[int, int]] = []
    for i, value in enumerate(home):
        near = np.flatnonzero(np.bitwise_count(members ^ value) <= bits)
        kinds, first = np.unique(label[near], return_index=True)
        if len(kinds) > 1:
            own = label[i]
            for kind, j in zip(kinds.tolist(), near[first].tolist()):
                if kind != own:
                    found.append((int(value), int(members[j])))
            label[np.isin(label, kinds)] = kinds[0]
    return found


def links(classes: DataFrame, bits: int = BITS) -> DataFrame:
    """``a, b``: links between distinct fingerprints ``fp`` with the same components as all pairs of at most ``bits``
    differing bits.

    Shards with more home members than a block are read in blocks; each visitor comes to all of them.
    """
    n = classes.count()
    reach = bits // 2
    chosen = classes.orderBy(F.xxhash64("fp", F.lit("sample")), "fp").limit(SAMPLE).collect() if n else []
    sample = np.array([r["fp"] for r in chosen], np.int64).view(np.uint64)
    trees, first = [], [0]
    for mask in HALVES:
        tree, made = grow(sample, mask, math.ceil(n / SHARD_ROWS), reach)
        trees.append(tree)
        first.append(first[-1] + made)

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(values: np.ndarray) -> Iterator[pa.RecordBatch]:
            for mask, tree, start in zip(HALVES, trees, first):
                for leaf, at, home in route(tree, values & np.uint64(mask), reach):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(len(at), start + leaf)), pa.array(np.full(len(at), home)), pa.array(values[at].view(np.int64))],
                        names=["shard", "home", "fp"],
                    )

        held, size = [], 0
        for batch in batches:
            held.append(np.asarray(batch.column(0)).view(np.uint64))
            size += len(held[-1])
            if size >= ROUTED:
                yield from sent(np.concatenate(held))
                held, size = [], 0
        if held:
            yield from sent(np.concatenate(held))

    placed = materialize(classes.select("fp").mapInArrow(send, "shard long, home boolean, fp long"), "shards")
    crowded = placed.where("home").groupBy("shard").agg(F.ceil(F.count("*") / F.lit(BLOCK_ROWS)).cast("int").alias("blocks"))
    there = placed.join(crowded, "shard")
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    # a home member is at home in its own block and visits the ones before it
    visited = F.sequence(F.lit(0), F.when(F.col("home"), own).otherwise(F.col("blocks") - 1))
    dealt = there.select("shard", F.explode(visited).alias("block"), "home", own.alias("own"), "fp")
    dealt = dealt.select("shard", "block", (~(F.col("home") & (F.col("own") == F.col("block")))).alias("visits"), "fp")
    blocks = dealt.repartition("shard", "block").sortWithinPartitions("shard", "block", "visits", "fp")

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(home: list, others: list) -> pa.RecordBatch:
            home, others = (np.concatenate(x) if x else np.empty(0, np.uint64) for x in (home, others))
            found = joining_links(home, others, np.arange(len(home) + len(others)), bits)
            a, b = (np.array([f[i] for f in found], np.uint64).view(np.int64) for i in (0, 1))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        key, home, others, size = None, [], [], 0
        for batch in batches:
            shard, block, visits = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
            values = np.asarray(batch.column(3)).view(np.uint64)
            cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (block[1:] != block[:-1])) + 1
            for at, end in zip([0, *cuts], [*cuts, len(values)]):
                if (here := (shard[at], block[at])) != key:
                    if home:
                        yield done(home, others)
                    key, home, others, size = here, [], [], 0
                mark = visits[at:end].astype(bool)
                home.append(values[at:end][~mark])
                others.append(values[at:end][mark])
                size += int(mark.sum())
                if size >= ROUTED:  # visitors of a full block are compared as they come
                    yield done(home, others)
                    others, size = [], 0
        if home:
            yield done(home, others)

    return blocks.select("shard", "block", "visits", "fp").mapInArrow(search, "a long, b long").where("a <> b").distinct()


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", bits: int = BITS) -> DataFrame:
    """``key, fp, component_id`` of every row: what links of at most ``bits`` differing bits connect, named by
    its smallest key.

    A text without words (or NULL) has fingerprint 0 and is linked like any other. A row whose key is NULL is
    linked with nothing and has no component. Of rows that repeat a key each is placed by its own text; texts
    that share their smallest key keep one name. Extra columns are not carried. Keys are whole numbers. An empty table gives an empty result.
    """
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    made = materialize(fingerprints(rows).select("id", "fp"), "fingerprints")
    classes = materialize(made.where("id IS NOT NULL").groupBy("fp").agg(F.min("id").alias("least")), "classes")
    joined = components(links(classes, bits))
    named = classes.join(joined.withColumnRenamed("id", "fp"), "fp", "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component")
    )
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    named = materialize(named.join(smallest, "component").select("fp", "component_id"), "named")
    return made.join(named, "fp", "left").select(
        F.col("id").alias(key), "fp", F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id")
    )
