"""Near-duplicate documents by min-max hashing of word shingles.

A signature keeps the least and the greatest value of a document's shingles under each of 64
permutations: 128 values from 64 hash evaluations a shingle. Bands of two permutations (four
values) put documents into buckets; documents of one bucket are compared on their full sets.

Two texts of similarity 0.8 miss all 32 bands with a chance of 5e-8. What shares a bucket is never
expanded into all pairs: each document is compared with a few leaders of its buckets first and the
links found are joined to components. What shares a bucket and is still in different components is
then held against each other inside tasks, in blocks of bounded size, by an upper bound of the
similarity (shingles are counted in 512 cells; two sets share at most the sum of the smaller
counts). Only pairs that the bound leaves open are emitted and compared on their full sets, so no
link between components is lost.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from tidepanel.llm.common import SLICE, small_batches, with_arrow_columns
from tidepanel.llm.components import components
from tidepanel.session import materialize

PERMUTATIONS, PER_BAND = 64, 2
BANDS = PERMUTATIONS // PER_BAND

#: leaders of a bucket are the least ids after these bits are flipped; a band uses one of the masks
MASKS = (0, 0x5A5A5A5A5A5A5A5A, 0x3C6EF372FE94F82B, 0x7FFFFFFFFFFFFFFF)

#: cells of the upper bound, and how many documents of a bucket meet in one block
CELLS, BLOCK_ROWS = 512, 256

#: bits of the filter for texts that take part in pairs
BITS = 1 << 24

#: shingles hashed at once
BLOCK = 1 << 12

#: words a worker keeps the hash of, about 200 bytes each
CACHE = 100_000

_random = np.random.default_rng(20240229)
MULTIPLY = _random.integers(1, 1 << 63, PERMUTATIONS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
ADD = _random.integers(0, 1 << 63, PERMUTATIONS, dtype=np.uint64)
MIX_A, MIX_B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted 64-bit hashes of the distinct word shingles of a text.

    A-Z are lower-cased; words are what stands between spaces and the characters 9 to 13. A text of
    fewer words than a shingle is one shingle, a text without words has none.
    """

    def __init__(self, words: int):
        self.words = words
        self.known: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        parts = (text or "").encode().lower().split()
        if not parts:
            return np.empty(0, np.uint64)
        if len(self.known) > CACHE:
            self.known.clear()
        known = self.known
        hashes = list(map(known.get, parts))
        if None in hashes:
            for i, h in enumerate(hashes):
                if h is None:
                    hashes[i] = known[parts[i]] = xxhash.xxh64_intdigest(parts[i])
        h = np.array(hashes, np.uint64)
        k = min(self.words, len(h))
        rolled = np.full(len(h) - k + 1, k, np.uint64)
        for j in range(k):
            rolled = _mix(rolled * MIX_A + h[j : len(h) - k + 1 + j])
        return np.unique(rolled)


def signature(shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest value under each permutation."""
    low, high = np.full(PERMUTATIONS, ~np.uint64(0)), np.zeros(PERMUTATIONS, np.uint64)
    for at in range(0, len(shingles), BLOCK):
        values = MULTIPLY[:, None] * shingles[None, at : at + BLOCK] + ADD[:, None]
        low, high = np.minimum(low, values.min(1)), np.maximum(high, values.max(1))
    return low, high


def bands(shingles: np.ndarray) -> np.ndarray:
    """One number for each band, made of its minima and maxima; different bands never share one."""
    low, high = signature(shingles)
    mixed = np.arange(BANDS, dtype=np.uint64) + MIX_B
    for values in (low, high):
        for j in range(PER_BAND):
            mixed = _mix(mixed * MIX_A + values[j::PER_BAND])
    # the number's last bits are the band's
    return (mixed & ~np.uint64(BANDS - 1)) | np.arange(BANDS, dtype=np.uint64)


def cells(shingles: np.ndarray) -> bytes:
    """How many shingles fall into each cell; nothing if a count does not fit a byte."""
    counts = np.bincount((shingles >> np.uint64(55)).astype(np.int64), minlength=CELLS)
    return counts.astype(np.uint8).tobytes() if counts.max() < 256 else b""


def sketch(df: DataFrame, text: str, words: int) -> DataFrame:
    """``n_shingles``, two digests of the set, and the bands (NULL without shingles)."""

    def make():
        shingler = Shingler(words)

        def compute(texts: list) -> list[pa.Array]:
            counts, first, second, buckets = [], [], [], []
            for t in texts:
                s = shingler(t)
                counts.append(len(s))
                first.append(int(_mix(s).sum(dtype=np.uint64).view(np.int64)))
                second.append(int(_mix(s ^ MIX_B).sum(dtype=np.uint64).view(np.int64)))
                buckets.append(bands(s).view(np.int64) if len(s) else None)
            return [
                pa.array(counts, pa.int64()),
                pa.array(first, pa.int64()),
                pa.array(second, pa.int64()),
                pa.array(buckets, pa.list_(pa.int64())),
            ]

        return compute

    added = [StructField(c, LongType()) for c in ("n_shingles", "digest", "digest2")]
    return with_arrow_columns(df, text, [*added, StructField("bands", ArrayType(LongType()))], make)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def chosen_texts(rows: DataFrame, ids: DataFrame, words: int) -> DataFrame:
    """``id, text, n, cells`` of the rows whose id is in ``ids``.

    A bitmap of fixed size keeps most other texts out of the shuffle: the ids set at most
    ``BITS`` bits, and rows whose bit is not set stop in the task that reads them. The join that
    follows decides; however full the bitmap, only the amount that is shuffled depends on it.
    """
    bit = F.pmod(F.xxhash64("id"), F.lit(BITS))
    marks = ids.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("word"))
    words_set = marks.agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit & 63 AS INT))")).alias("bits")).collect()  # BITS / 64 rows at most
    bitmap = np.zeros(BITS // 64, np.int64)
    for r in words_set:
        bitmap[r["word"]] = r["bits"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        for batch in batches:
            at = np.asarray(batch.column(2))
            hit = np.flatnonzero(bitmap[at >> 6] >> (at & 63) & 1)
            for begin in range(0, len(hit), SLICE):
                part = batch.select([0, 1]).take(pa.array(hit[begin : begin + SLICE]))
                sets = [shingler(t) for t in part.column(1).to_pylist()]
                sizes, counts = pa.array([len(x) for x in sets], pa.int64()), pa.array([cells(x) if len(x) else b"" for x in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns, sizes, counts], names=["id", "text", "n", "cells"])

    marked = small_batches(rows.where("id IS NOT NULL")).select("id", "text", bit.alias("bit"))
    found = marked.mapInArrow(run, "id long, text string, n long, cells binary")
    return found.join(ids, "id", "left_semi")


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Those of ``pairs (a, b)`` whose full sets are similar. ``texts``: ``id, text``.

    Ids with many pairs, the leaders, come in the second join, where Spark splits large partitions.
    """
    ready = pairs.join(texts.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b").join(
        texts.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a"
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(words)
        last: tuple[object, np.ndarray] = (None, np.empty(0, np.uint64))
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                keep = []
                for i, (x, y) in enumerate(zip(part.column(2).to_pylist(), part.column(3).to_pylist())):
                    if x != last[0]:
                        last = (x, shingler(x))
                    if similar(last[1], shingler(y), percent):
                        keep.append(i)
                yield part.select([0, 1]).take(pa.array(keep, pa.int64()))

    schema = StructType([StructField("a", pairs.schema["a"].dataType), StructField("b", pairs.schema["b"].dataType)])
    return small_batches(ready).select("a", "b", "text_a", "text_b").mapInArrow(run, schema)


def possible(rows: list[np.ndarray], columns: list[np.ndarray], percent: int) -> Iterator[tuple[int, int]]:
    """Pairs of different components that may be similar, as numbers of a row and a column.

    Both lists hold component, size, whether the cells are known, and cells.
    """
    (comp_a, n_a, known_a, cells_a), (comp_b, n_b, known_b, cells_b) = rows, columns
    for i in range(len(n_a)):
        fits = (comp_b != comp_a[i]) & (100 * np.minimum(n_b, n_a[i]) >= percent * np.maximum(n_b, n_a[i]))
        near = np.flatnonzero(fits)
        if len(near):
            most = np.minimum(cells_b[near], cells_a[i]).sum(1, dtype=np.int64)
            most = np.where(known_b[near] & known_a[i], most, np.minimum(n_b[near], n_a[i]))
            for j in near[100 * most >= percent * (n_b[near] + n_a[i] - most)]:
                yield i, int(j)


def open_pairs(placed: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """``a, b``: what shares a bucket, is in different components and may be similar.

    ``placed``: ``bucket, id, component``; ``texts``: ``id, n, cells``. In each bucket the members outside its largest
    component meet all members, in blocks; tasks read blocks one after another.
    """
    counts = placed.groupBy("bucket", "component").agg(F.count("*").alias("size"))
    shape = counts.groupBy("bucket").agg(
        F.sum("size").alias("members"), F.max("size").alias("most"), F.count("*").alias("kinds"), F.max(F.struct("size", "component")).alias("bulk")
    )
    blocks = lambda c: F.ceil(c / F.lit(BLOCK_ROWS)).cast("int")
    shape = shape.where("kinds > 1").select(
        "bucket", F.col("bulk.component").alias("bulk"), blocks(F.col("members")).alias("all"), blocks(F.col("members") - F.col("most")).alias("out")
    )
    there = placed.join(shape, "bucket").join(texts.select("id", "n", "cells"), "id")

    def dealt(side: int, own: str, other: str, rows: DataFrame) -> DataFrame:
        mine = F.pmod(F.xxhash64("id"), F.col(own)).cast("int")
        at = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        return rows.withColumn("mine", mine).withColumn("at", at).select(
            "bucket", *([F.col("mine").alias("r"), F.col("at").alias("c")] if side == 0 else [F.col("at").alias("r"), F.col("mine").alias("c")]),
            F.lit(side).alias("side"), "id", "n", "component", "cells",
        )

    both = dealt(0, "out", "all", there.where("component <> bulk")).unionByName(dealt(1, "all", "out", there))
    both = both.repartition("bucket", "r", "c").sortWithinPartitions("bucket", "r", "c")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def compare(block: pa.Table) -> pa.RecordBatch:
            block = block.combine_chunks()
            side, ids = np.asarray(block["side"]), np.asarray(block["id"])
            raw = block["cells"].to_pylist()
            known = np.array([len(c) == CELLS for c in raw])
            table = np.frombuffer(b"".join(c if len(c) == CELLS else bytes(CELLS) for c in raw), np.uint8).reshape(-1, CELLS)
            parts = [np.flatnonzero(side == s) for s in (0, 1)]
            values = [np.asarray(block["component"]), np.asarray(block["n"]), known, table]
            found = list(possible(*[[v[p] for v in values] for p in parts], percent))
            a, b = ids[parts[0][[i for i, _ in found]]], ids[parts[1][[j for _, j in found]]]
            return pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        for batch in batches:
            keys = np.stack([np.asarray(batch.column(i)) for i in range(3)], 1)
            cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(1)) + 1).tolist(), len(keys)]
            for begin, end in zip(cuts, cuts[1:]):
                if held and end > begin and [held[0].column(i)[0].as_py() for i in range(3)] != keys[begin].tolist():
                    yield compare(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(begin, end - begin))
        if held:
            yield compare(pa.Table.from_batches(held))

    return small_batches(both).mapInArrow(run, "a long, b long").distinct()


def near_duplicates(df: DataFrame, words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, n_shingles, component_id, kept`` of every row.

    Documents are linked if 100 * intersection >= ``percent`` * union of their sets of distinct
    ``words``-word shingles; components are what links connect; the smallest key names a component
    and is kept. A text without words (or NULL) is linked with nothing. A row whose key is NULL is
    linked with nothing, has no component and is kept. Of rows that repeat a key each is placed
    by its own text; texts that share their smallest key are one component. Extra columns are not carried. Keys are whole numbers. An empty table gives an
    empty result.
    """
    rows = df.select(F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    sketches = materialize(sketch(rows, "text", words).drop("text"), "sketches")
    part = sketches.where("n_shingles > 0 AND id IS NOT NULL")
    same = ["digest", "digest2", "n_shingles"]
    # equal sets are one class, which its smallest key stands for
    classes = materialize(part.groupBy(*same).agg(F.min("id").alias("rep")), "classes")
    nodes = part.join(classes.select(F.col("rep").alias("id"), *same), ["id", *same], "left_semi")
    mask = F.element_at(F.array(*[F.lit(m) for m in MASKS]), (F.pmod("bucket", F.lit(len(MASKS))) + 1).cast("int"))
    members = nodes.select("id", F.explode("bands").alias("bucket"))
    lead = members.groupBy("bucket").agg(F.min(F.col("id").bitwiseXOR(mask)).alias("least"), F.count("*").alias("size")).where("size > 1")
    crowded = members.join(lead.withColumn("leader", F.col("least").bitwiseXOR(mask)).select("bucket", "leader"), "bucket")
    crowded = materialize(crowded, "buckets")

    def pairs_of(x: str, y: str, found: DataFrame) -> DataFrame:
        return found.select(F.col(x).alias("a"), F.col(y).alias("b")).distinct()

    led = materialize(pairs_of("leader", "id", crowded.where("id <> leader")), "pairs")
    texts = materialize(chosen_texts(rows, crowded.select("id").distinct(), words), "texts")
    links = materialize(confirmed(led, texts, words, percent), "links")

    # documents of one bucket that the leaders did not bring together
    placed = crowded.join(components(links), "id", "left").select("bucket", "id", F.coalesce("component", "id").alias("component"))
    rest = open_pairs(materialize(placed, "placed"), texts, percent)
    asked = led.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = rest.join(asked, ["a", "b"], "left_anti")
    more = confirmed(materialize(rest, "pairs"), texts, words, percent)
    joined = components(links.unionByName(more))

    named = classes.join(joined.select(F.col("id").alias("rep"), "component"), "rep", "left")
    named = named.select(*same, F.coalesce("component", "rep").alias("component_id"))
    placed_rows = part.select("id", *same).join(named, same).select("id", "n_shingles", "component_id")
    alone = sketches.where("n_shingles = 0 OR id IS NULL").select("id", "n_shingles", F.col("id").alias("component_id"))
    return placed_rows.unionByName(alone).select(
        F.col("id").alias(key), "n_shingles", "component_id", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept")
    )
