"""From flight-level rows to a gap-free panel ``(entity, time, counts)``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STEPS = {"hour": 3600, "day": 86400}


def hourly_counts(df: DataFrame, keys: Sequence[str], time: Column, label: str) -> DataFrame:
    """Rows per hour. NULL times are not counted."""
    return (
        df.select(*keys, F.date_trunc("hour", time).alias("ts_hour"))
        .filter(F.col("ts_hour").isNotNull())
        .groupBy(*keys, "ts_hour")
        .agg(F.count(F.lit(1)).alias(label))
    )


def combine_counts(arrivals: DataFrame, departures: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Full outer union of two count tables on ``keys``; what is missing counts 0.

    Both sides are stacked and summed in one exchange instead of joined."""
    both = arrivals.select(*keys, "arrivals", F.lit(0).cast("long").alias("departures")).unionByName(
        departures.select(*keys, F.lit(0).cast("long").alias("arrivals"), "departures")
    )
    return (
        both.groupBy(*keys)
        .agg(F.sum("arrivals").alias("arrivals"), F.sum("departures").alias("departures"))
        .withColumn("total_movements", F.col("arrivals") + F.col("departures"))
    )


def outer_join_counts(arrivals: DataFrame, departures: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The same result as a full outer join, for count tables already laid out by ``keys``."""
    return (
        arrivals.join(departures, list(keys), "full_outer")
        .fillna(0, ["arrivals", "departures"])
        .withColumn("total_movements", F.col("arrivals") + F.col("departures"))
    )


#: steps of a series that one row of the first level stands for
SPINE_BLOCK = 4096


def time_spine(df: DataFrame, keys: Sequence[str], time: str, step: str) -> DataFrame:
    """Every step between the first and last time of each key, with its position
    ``pos`` and the number of steps ``n_steps``.

    In two levels: a key's range becomes blocks of ``SPINE_BLOCK`` steps first, which are dealt over all tasks, and
    each block becomes its steps there. A range of a million years is some rows for each task, never one array of all steps.
    """
    if dict(df.dtypes)[time] == "date":
        number, unit = "CAST(unix_date({}) AS BIGINT)", STEPS[step] // 86400
        at = lambda n: F.date_from_unix_date(n.cast("int"))
    else:
        number, unit = "unix_micros({})", STEPS[step] * 1_000_000
        at = F.timestamp_micros
    first, last = number.format("_first"), number.format("_last")
    bounds = df.groupBy(*keys).agg(F.min(time).alias("_first"), F.max(time).alias("_last")).where("_first IS NOT NULL")
    ranges = bounds.select(*keys, F.expr(first).alias("_first"), F.expr(f"({last} - {first}) div {unit} + 1").alias("n_steps"))
    blocks = ranges.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_steps") - 1) / SPINE_BLOCK))).alias("_block"))
    dealt = blocks.repartition(*keys, "_block").withColumn("_from", F.col("_block") * SPINE_BLOCK)
    upto = F.least(F.col("_from") + SPINE_BLOCK, F.col("n_steps")) - 1
    return dealt.select(*keys, "n_steps", "_first", F.explode(F.sequence(F.col("_from"), upto)).alias("pos")).select(
        *keys, "n_steps", "pos", at(F.col("_first") + F.col("pos") * unit).alias(time)
    )


def fill_gaps(counts: DataFrame, keys: Sequence[str], time: str, step: str) -> DataFrame:
    """Complete the range of every key; missing steps count 0."""
    spine = time_spine(counts, keys, time, step)
    return (
        spine.join(counts.select(*keys, time, "arrivals", "departures"), [*keys, time], "left")
        .fillna(0, ["arrivals", "departures"])
        .withColumn("total_movements", F.col("arrivals") + F.col("departures"))
    )


def missing_steps(counts: DataFrame, keys: Sequence[str], time: str, step: str) -> DataFrame:
    """Steps of the range that have no row."""
    spine = time_spine(counts, keys, time, step)
    return spine.join(counts.select(*keys, time), [*keys, time], "left_anti").select(*keys, time)


def imbalance(arrivals: Column, departures: Column) -> Column:
    return (arrivals - departures) / F.greatest(F.lit(1), arrivals + departures)
