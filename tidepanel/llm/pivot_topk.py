"""Exact top-k search by inner product with a pivot table.

The distances of every vector to some pivots are computed once. By the triangle inequality the
difference of two vectors' distances to a pivot is a lower bound of their own distance; the
largest over all pivots, with the lengths, bounds the inner product from above. Candidates are
evaluated in the order of their bounds until the next bound is below the k-th score found.

Rows lie in blocks around their nearest pivot. The k-th score of a query among some rows is a floor of its k-th score
among all, and the ranges of a block's distances bound all of its scores, so most blocks can be left out before any row is sent.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StructField

from tidepanel.llm.common import with_arrow_columns
from tidepanel.llm.vectors import QUERIES, ROWS, matrix, meet, usable
from tidepanel.session import materialize

PIVOTS = 32

#: rows that pivots are chosen from and that floors are taken over; any rows give exact results
SAMPLE = 4096

#: candidates evaluated at once
BATCH = 256

FOUND = "query_id long, vec_id long, score long, evaluated long"


def quantised(df: DataFrame, scale: int = 1024, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """Usable vectors with every component x as floor(scale * x)."""
    rows = usable(df, key, vector, zero=True)
    return rows.withColumn("v", F.transform("v", lambda x: F.floor(F.lit(scale) * x).cast("double")))


def sample_of(rows: DataFrame, n: int = SAMPLE) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of at most ``n`` rows, the first ones in the order of a hash."""
    chosen = rows.orderBy(F.xxhash64("vec_id", F.lit("pivot")), "vec_id", "v").limit(n).select("vec_id", "v").collect()
    return np.array([r["vec_id"] for r in chosen], np.int64), np.array([r["v"] for r in chosen], float)


def choose_pivots(sample: np.ndarray, n: int = PIVOTS) -> np.ndarray:
    """The origin and at most ``n`` vectors of the sample, each as far from those before it as can be.

    The origin bounds a score by the product of the two lengths.
    """
    pivots = [np.zeros(sample.shape[1])]
    away = (sample**2).sum(1)
    while len(pivots) <= n and away.max() > 0:
        pivots.append(sample[away.argmax()])
        away = np.minimum(away, ((sample - pivots[-1]) ** 2).sum(1))
    return np.array(pivots)


def with_pivot_distances(rows: DataFrame, pivots: np.ndarray) -> DataFrame:
    """``rows`` with ``distances``, one for each pivot, and ``cell``, the number of the nearest pivot but the origin."""
    def make():
        def compute(vectors: list) -> list[pa.Array]:
            v = np.array(vectors, float)
            d = np.sqrt(((v[:, None, :] - pivots[None]) ** 2).sum(2)) if len(v) else np.empty((0, len(pivots)))
            cell = d[:, 1:].argmin(1) if len(pivots) > 1 else np.zeros(len(d), int)
            return [pa.array(list(d), pa.list_(pa.float64())), pa.array(cell, pa.int32())]

        return compute

    return with_arrow_columns(rows, "v", [StructField("distances", ArrayType(DoubleType())), StructField("cell", IntegerType())], make)


def with_floors(queries: DataFrame, ids: np.ndarray, sample: np.ndarray, k: int) -> DataFrame:
    """``queries`` with ``floor``: the ``k``-th score among the sample, NULL if there are fewer."""
    def make():
        def compute(rows: list) -> list[pa.Array]:
            floors = []
            for r in rows:
                scores = products(sample[ids != r["vec_id"]], np.array(r["v"], float))
                floors.append(int(np.partition(scores, -k)[-k]) if len(scores) >= k else None)
            return [pa.array(floors, pa.int64())]

        return compute

    asked = queries.withColumn("asked", F.struct("vec_id", "v"))
    return with_arrow_columns(asked, "asked", [StructField("floor", LongType())], make).drop("asked")


def in_blocks(rows: DataFrame, name: str, size: int, shared: bool = False) -> DataFrame:
    """``rows`` with the number of their block: rows of one cell, a large cell dealt over several blocks of about ``size``.

    With ``shared`` small cells lie together, so that there are few more blocks than the rows need.
    """
    counts = {r["cell"]: r["count"] for r in rows.groupBy("cell").count().collect()}  # one row for each pivot
    first, parts, blocks, free = [], [], 0, 0
    for cell in range(max(counts, default=0) + 1):
        n = counts.get(cell, 0)
        if shared and n <= free:
            first.append(blocks - 1)
            parts.append(1)
            free -= n
        else:
            first.append(blocks)
            parts.append(max(1, -(-n // size)))
            blocks += parts[-1]
            free = size - n
    at = F.col("cell") + 1
    spread = F.pmod(F.xxhash64("vec_id", F.lit(name)), F.element_at(F.array(*map(F.lit, parts)), at))
    return rows.withColumn(name, (F.element_at(F.array(*map(F.lit, first)), at) + spread).cast("long"))


def summaries(rows: DataFrame, n: int) -> DataFrame:
    """One row for each block: ``vec_id`` (the block), least and greatest distance to each of ``n`` pivots."""
    d = [F.col("distances")[i] for i in range(n)]
    return rows.groupBy(F.col("block").alias("vec_id")).agg(
        F.array(*map(F.min, d)).alias("nearest"), F.array(*map(F.max, d)).alias("farthest")
    )


def products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exactly; raises if a score doesn't fit 64 bits."""
    most = float(np.abs(rows).max(initial=0)) * float(np.abs(query).max(initial=0)) * len(query)
    if most < 2**53:
        return (rows @ query).astype(np.int64)
    if most >= 2**63 or max(np.abs(rows).max(), np.abs(query).max()) >= 2**53:
        raise OverflowError("an inner product does not fit 64 bits")
    return rows.astype(np.int64) @ query.astype(np.int64)


def upper_bounds(query: np.ndarray, from_pivots: np.ndarray, squares: np.ndarray, distances: np.ndarray) -> np.ndarray:
    """No inner product of the query with a row is above the row's bound."""
    apart = np.abs(distances - from_pivots).max(1)
    square = float(query @ query)
    bound = (square + squares - apart**2) / 2
    # distances are rounded; the slack is far above their error and costs a few candidates at most
    return bound + 1e-9 * (square + squares) + 1e-6


def block_bounds(query: np.ndarray, from_pivots: np.ndarray, nearest: np.ndarray, farthest: np.ndarray) -> np.ndarray:
    """No inner product of the query with a row of a block is above the block's bound; the first pivot is the origin."""
    apart = np.maximum(nearest - from_pivots, from_pivots - farthest).clip(0).max(1)
    square, squares = float(query @ query), farthest[:, 0] ** 2
    # a row of a block is no longer than the longest, and its distance from the query no shorter than ``apart``
    return (square + squares - apart**2) / 2 + 1e-9 * (square + squares) + 1e-6


def best_of_block(
    ids: np.ndarray, rows: np.ndarray, squares: np.ndarray, distances: np.ndarray, query_id: int, query: np.ndarray, from_pivots: np.ndarray, k: int,
    floor: float = -np.inf,
) -> tuple[np.ndarray, np.ndarray, int]:
    """The ``k`` best of a block with their scores, and how many candidates were evaluated. What is surely below ``floor`` may be missing."""
    bounds = upper_bounds(query, from_pivots, squares, distances)
    order = np.argsort(-bounds, kind="stable")
    order = order[ids[order] != query_id]
    kept_ids, kept = np.empty(0, np.int64), np.empty(0, np.int64)
    done = 0
    while done < len(order) and not bounds[order[done]] < max(floor, kept[-1] if len(kept) == k else -np.inf):
        batch = order[done : done + BATCH]
        done += len(batch)
        all_ids, scores = np.concatenate([kept_ids, ids[batch]]), np.concatenate([kept, products(rows[batch], query)])
        best = np.lexsort((all_ids, -scores))[:k]
        kept_ids, kept = all_ids[best], scores[best]
    return kept_ids, kept, done


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, n_pivots: int = PIVOTS, counts: bool = False, rows_per_block: int = ROWS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` highest inner products of each query, exactly.

    ``vectors`` and ``queries`` hold whole numbers in ``v`` (see ``quantised``). Candidates are all
    rows but those with the query's own id; if there are fewer than ``k``, all are returned. Ties go
    to the smaller id. Rows that repeat an id are candidates each; queries that repeat one are one
    query, with the smallest of their vectors. Empty tables give an empty result. A score beyond 64
    bits is an error. With ``counts`` there is a column ``evaluated``: how many inner products the query took, without
    those of its floor.

    A block of rows goes to the blocks of queries that have a query open for it, and to no other.
    """
    ids, sample = sample_of(vectors)
    if not len(ids):
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long" + ", evaluated long" * counts)
    pivots = choose_pivots(sample, n_pivots)
    rows = in_blocks(materialize(with_pivot_distances(vectors, pivots), "pivot-table"), "block", rows_per_block)
    asked = with_pivot_distances(queries.groupBy("vec_id").agg(F.min("v").alias("v")), pivots)
    asked = in_blocks(materialize(with_floors(asked, ids, sample, k), "pivot-queries"), "query_block", QUERIES, shared=True)

    def reach(blocks: pa.Table, wanted: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if blocks.num_rows and wanted.num_rows:
            numbers, nearest, farthest = np.asarray(blocks["vec_id"]), matrix(blocks["nearest"]), matrix(blocks["farthest"])
            questions = zip(*(wanted[c].to_pylist() for c in ("vec_id", "own_block", "floor")), matrix(wanted["v"]), matrix(wanted["distances"]))
            for query_id, own, floor, q, from_pivots in questions:
                near = numbers if floor is None else numbers[block_bounds(q, from_pivots, nearest, farthest) >= floor]
                found.append((np.full(len(near), query_id), np.full(len(near), own), near))
        columns = [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 3
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "query_block", "block"])

    wide = asked.withColumnRenamed("query_block", "own_block")
    open_pairs = materialize(meet(summaries(rows, len(pivots)), wide, reach, "query_id long, query_block long, block long"), "open-blocks")

    def search(block: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple[np.ndarray, ...]] = []
        if block.num_rows and wanted.num_rows:
            ids, v, d = np.asarray(block["vec_id"]), matrix(block["v"]), matrix(block["distances"])
            squares = (v * v).sum(1)
            questions = zip(wanted["vec_id"].to_pylist(), wanted["floor"].to_pylist(), matrix(wanted["v"]), matrix(wanted["distances"]))
            for query_id, floor, q, from_pivots in questions:
                floor = -np.inf if floor is None else floor
                found, scores, seen = best_of_block(ids, v, squares, d, query_id, q, from_pivots, k, floor)
                out.append((np.full(len(found), query_id), found, scores, np.where(np.arange(len(found)) == 0, seen, 0)))
        columns = [np.concatenate(c) for c in zip(*out)] if out else [np.empty(0, np.int64)] * 4
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score", "evaluated"])

    left = rows.join(open_pairs.select("block", "query_block").distinct(), "block")
    wanted_in = open_pairs.select(F.col("query_id").alias("vec_id"), F.col("query_block").alias("query_block"), F.col("block").alias("block"))
    right = asked.drop("query_block").join(wanted_in, "vec_id")
    keys = ["block", "query_block"]
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranks = found.withColumns({"rank": F.row_number().over(order), "evaluated": F.sum("evaluated").over(Window.partitionBy("query_id"))})
    return ranks.where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score", *["evaluated"] * counts)
