"""Shared parts of the vector searches: usable rows, blocks of rows against blocks of queries, merging."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: rows and queries that meet in one group
ROWS, QUERIES = 4096, 1024


def usable(df: DataFrame, key: str, vector: str, zero: bool) -> DataFrame:
    """``vec_id, v`` (doubles) of the rows that take part.

    Left out are NULL keys, NULL or empty vectors, NULL or non-finite components, with ``zero``
    False vectors of zeros only, and vectors whose length isn't the commonest (of equally common
    ones the longest).
    """
    v = F.col(f"`{vector}`").cast("array<double>")
    good: Column = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)
    good = good & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    if not zero:
        good = good & F.exists("v", lambda x: x != 0)
    rows = df.select(F.col(f"`{key}`").cast("long").alias("vec_id"), v.alias("v")).where(good)
    sizes = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).limit(1).collect()
    return rows.where(F.size("v") == sizes[0]["dim"]) if sizes else rows


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column as a matrix of doubles."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = np.asarray(flat.flatten(), float)
    return values.reshape(len(flat), -1) if len(flat) else values.reshape(0, 0)


def meet(rows: DataFrame, queries: DataFrame, search: Callable[[pa.Table, pa.Table], pa.Table], schema: str) -> DataFrame:
    """``search(rows, queries)`` for every block of rows and block of queries.

    Both tables have an id in ``vec_id`` and are dealt by its hash, so a block's size follows the
    two limits whatever the ids or vectors are. Rows are sent once for each block of queries and
    queries once for each block of rows.
    """
    row_blocks = max(1, math.ceil(rows.count() / ROWS))
    query_blocks = max(1, math.ceil(queries.count() / QUERIES))
    left = rows.withColumns(
        {
            "row_block": F.pmod(F.xxhash64("vec_id", F.lit("row")), F.lit(row_blocks)).cast("int"),
            "query_block": F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))),
        }
    )
    right = queries.withColumns(
        {
            "query_block": F.pmod(F.xxhash64("vec_id", F.lit("query")), F.lit(query_blocks)).cast("int"),
            "row_block": F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))),
        }
    )
    keys = ["row_block", "query_block"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(search, schema)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of each query over all blocks: highest score first, ties to the smaller id."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
