"""Ordered operators over one entity without one task per entity.

A window over ``partitionBy(entity)`` puts a whole entity in one task. Here a series
is cut into blocks of its position. Rows near an edge are copied to the neighbouring
block (the halo), a window runs over ``(entity, block)``, and the copies are dropped.
A task then never holds more than ``span + back + ahead`` positions of a series.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

SPAN = 4096

WindowColumn = Callable[[WindowSpec], Column]


def blocked_window(
    df: DataFrame,
    keys: Sequence[str],
    pos: str,
    columns: dict[str, WindowColumn],
    back: int,
    ahead: int = 0,
    span: int = SPAN,
) -> DataFrame:
    """Add window columns that read at most ``back`` positions behind and ``ahead`` in front.

    ``pos`` is an integer position along the series. Row frames are exact when positions
    are gap-free; range frames over ``pos`` are exact with gaps too.
    """
    span = max(span, back + ahead, 1)
    p = F.col(pos)
    copies = df.withColumn("_own", F.floor(p / span)).withColumn(
        "_block",
        F.explode(F.sequence(F.floor((p - ahead) / span), F.floor((p + back) / span))),
    )
    w = Window.partitionBy(*keys, "_block").orderBy(pos)
    added = [make(w).alias(name) for name, make in columns.items()]
    return (
        copies.select("*", *added)
        .filter(F.col("_block") == F.col("_own"))
        .drop("_own", "_block")
    )


def block_of(pos: Column, span: int = SPAN) -> Column:
    return F.floor(pos / span)


def ordinal(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str | Column],
    bucket: Column,
    name: str = "ordinal",
    total: str = "n_rows",
) -> DataFrame:
    """Zero-based rank within ``keys`` and the row count of ``keys``.

    ``bucket`` must rise with ``order``. Ranks are taken inside a bucket and shifted by
    the sizes of the buckets before it, so that no task sorts a whole key.
    """
    b = df.withColumn("_bucket", bucket)
    along = Window.partitionBy(*keys).orderBy("_bucket")
    sizes = (
        b.groupBy(*keys, "_bucket")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(
            *keys,
            "_bucket",
            (F.sum("_size").over(along) - F.col("_size")).alias("_before"),
            F.sum("_size").over(Window.partitionBy(*keys)).alias(total),
        )
    )
    inside = F.row_number().over(Window.partitionBy(*keys, "_bucket").orderBy(*order))
    return (
        b.withColumn("_inside", inside)
        .join(sizes, [*keys, "_bucket"])
        .withColumn(name, F.col("_before") + F.col("_inside") - 1)
        .drop("_bucket", "_inside", "_before")
    )


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: dict[str, str],
    bucket: Column,
) -> DataFrame:
    """For every row the last non-NULL value of a column at or before it.

    ``columns`` maps a source column to the name of its carried copy. The last value of
    each bucket is taken first; buckets then hand it on to later buckets.
    """
    b = df.withColumn("_bucket", bucket)
    rank = F.struct(*order)
    last_in = b.groupBy(*keys, "_bucket").agg(
        *[
            F.max_by(c, F.when(F.col(c).isNotNull(), rank)).alias(f"_last_{i}")
            for i, c in enumerate(columns)
        ]
    )
    earlier = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    handed = last_in.select(
        *keys,
        "_bucket",
        *[
            F.last(f"_last_{i}", ignorenulls=True).over(earlier).alias(f"_handed_{i}")
            for i in range(len(columns))
        ],
    )
    upto = (
        Window.partitionBy(*keys, "_bucket")
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    inside = b.select(
        "*",
        *[
            F.last(c, ignorenulls=True).over(upto).alias(f"_seen_{i}")
            for i, c in enumerate(columns)
        ],
    )
    joined = inside.join(handed, [*keys, "_bucket"], "left")
    return joined.select(
        *df.columns,
        *[
            F.coalesce(f"_seen_{i}", f"_handed_{i}").alias(name)
            for i, name in enumerate(columns.values())
        ],
    )
