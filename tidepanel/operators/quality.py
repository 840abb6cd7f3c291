"""Data quality checks as DataFrames."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidepanel.operators.panel import STEPS


def missing_columns(df: DataFrame, required: Sequence[str]) -> list[str]:
    """Schema check; no job."""
    return [c for c in required if c not in df.columns]


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Extra copies of fully equal rows. Copies are counted before they are shuffled."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("n_duplicates"),
    )


def coverage(df: DataFrame, time: str, keys: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(time).alias("first"), F.max(time).alias("last")
    )


def null_counts(df: DataFrame) -> DataFrame:
    """Columns with NULLs and how many, in one scan."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("column"), F.count(F.when(F.col(c).isNull(), 1)).alias("n_nulls"))
            for c in df.columns
        ]
    )
    return df.agg(cells.alias("_c")).select(F.inline("_c")).filter("n_nulls > 0")


def unknown_keys(df: DataFrame, key: str, reference: DataFrame, ref_key: str) -> DataFrame:
    """Key values without a row in the reference table, with their row counts."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.join(reference, F.col(key) == F.col(ref_key), "left_anti")


def checked(
    df: DataFrame, required: Sequence[str], keys: Sequence[str] = (), time: str | None = None, step: str | None = None
) -> DataFrame:
    """One row with ``rows``, ``duplicates``, ``missing_columns``, ``nulls`` (cells of all columns) and, with ``step``,
    ``missing_steps``, all from one scan.

    Equal rows are counted first; all else adds up these counts. Steps are counted on the grid that starts at the first time of
    a key: times of one offset from the grid are counted apart, and the offset with the least time is the grid itself. Rows
    without a time count as rows only.
    """
    counted = {"_rows": F.col("_n"), "_extra": F.col("_n") - 1}
    counted["_nulls"] = sum((F.col(f"`{c}`").isNull().cast("long") for c in df.columns), F.lit(0)) * F.col("_n")
    sums = [F.sum(c).alias(c) for c in counted]
    part = df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("_n")).withColumns(counted)
    cells = {
        "rows": F.sum("_rows"), "duplicates": F.sum("_extra"), "missing_columns": F.lit(len(missing_columns(df, required))), "nulls": F.sum("_nulls"),
    }
    if step is not None:
        date = dict(df.dtypes)[time] == "date"
        unit = STEPS[step] // 86400 if date else STEPS[step] * 1_000_000
        at = F.unix_date(time).cast("long") if date else F.unix_micros(F.col(time).cast("timestamp"))
        part = part.withColumn("_at", at).groupBy(*keys, "_at").agg(*sums)
        part = part.groupBy(*keys, F.pmod("_at", F.lit(unit)).alias("_offset")).agg(
            *sums, F.count("_at").alias("_steps"), F.min("_at").alias("_lo"), F.max("_at").alias("_hi")
        )
        span = F.expr(f"(max(_hi) - min(_lo)) div {unit} + 1")
        part = part.groupBy(*keys).agg(*sums, (span - F.min_by("_steps", "_lo")).alias("_missing"))
        cells["missing_steps"] = F.sum("_missing")
    return part.agg(*[F.coalesce(v, F.lit(0)).cast("long").alias(c) for c, v in cells.items()])


def report(sources: dict[str, dict]) -> DataFrame:
    """All checks over all sources as ``(source, check, value)``, and how many of them found something.

    A source is ``{"df", "required", "time", "keys", "step"}``; ``time`` and ``step`` are optional. Each source is scanned once.
    """
    parts: list[DataFrame] = []
    for name, s in sources.items():
        found = checked(s["df"], s["required"], s.get("keys", ()), s.get("time"), s.get("step"))
        lines = F.array(*[F.struct(F.lit(c).alias("check"), F.col(c).alias("value")) for c in found.columns])
        parts.append(found.select(F.lit(name).alias("source"), F.inline(lines)))
    out = reduce(DataFrame.unionByName, parts)
    issues = F.count_if((F.col("check") != "rows") & (F.col("value") > 0))
    both = out.withColumn("_check", F.col("check")).groupingSets([["source", "_check"], []], "source", "_check").agg(
        F.when(F.grouping("source") == 1, issues).otherwise(F.max("value")).alias("value"), F.grouping("source").alias("_all")
    )
    return both.select(
        F.when(F.col("_all") == 1, "all").otherwise(F.col("source")).alias("source"),
        F.when(F.col("_all") == 1, "issues").otherwise(F.col("_check")).alias("check"),
        "value",
    )


def checked_load(
    df: DataFrame,
    write: Callable[[DataFrame], None],
    source: str,
    required: Sequence[str],
    time: str | None = None,
    rules: dict[str, Column] | None = None,
) -> DataFrame:
    """``write(df)``, with checks counted in the pass that writes: ``(source, check, column, value)``.

    Checks are ``rows``, ``missing_column`` (a line for each), ``nulls`` of each column, ``first`` and ``last`` day of ``time`` (days since 1970; NULL without
    rows) and for each of ``rules`` the rows for which it isn't true, an unknown outcome included. The counts are taken in the tasks that
    write, which count once each even if one is repeated, so ``write`` must not shuffle before it writes, or a lost executor might
    count rows twice. Nothing is read again, and the driver gets one row of counts.
    """
    seen = Observation(f"load-{source}-{uuid.uuid4().hex}")
    metrics = {("rows", ""): F.count(F.lit(1))}
    metrics |= {("nulls", c): F.count_if(F.col(f"`{c}`").isNull()) for c in df.columns}
    if time is not None:
        metrics |= {("first", time): F.unix_date(F.to_date(F.min(time))), ("last", time): F.unix_date(F.to_date(F.max(time)))}
    metrics |= {(rule, ""): F.count_if(~F.coalesce(holds, F.lit(False))) for rule, holds in (rules or {}).items()}
    write(df.observe(seen, *[m.cast("long").alias(f"m{i}") for i, m in enumerate(metrics.values())]))
    got = seen.get
    lines = [(source, check, column, got[f"m{i}"]) for i, (check, column) in enumerate(metrics)]
    lines += [(source, "missing_column", c, 1) for c in missing_columns(df, required)]
    return df.sparkSession.createDataFrame(lines, "source string, check string, column string, value long")
