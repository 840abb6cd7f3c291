"""Streams that correct what they said before: the latest state of a flight, and revised hours.

Both write through ``foreachBatch`` into a folder with one partition for each micro-batch. A batch that is
replayed after a failure overwrites its own partition and nothing else, so it changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType, TimestampType


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """Writes a micro-batch as the partition ``batch`` of ``path``, in place of what an earlier try left there."""

    def write(rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return write


def run_batches(stream: DataFrame, path: str, checkpoint: str, mode: str) -> None:
    """Take all that is available, batch by batch, and stop."""
    (
        stream.writeStream.foreachBatch(batch_writer(path))
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def batches(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """All partitions of ``path``, with ``batch``."""
    return spark.read.schema(StructType([*schema.fields, StructField("batch", LongType())])).parquet(path)


def hourly_changes(events: DataFrame) -> DataFrame:
    """What each event adds to its hour. Rows of any age count: an hour is never closed."""
    arriving = F.col("event_type").isin("view", "click").cast("long")
    leaving = F.col("event_type").isin("purchase", "signup").cast("long")
    return events.where("ts IS NOT NULL").select(
        (F.col("user_id") % 5).alias("entity"), F.date_trunc("hour", "ts").alias("ts_hour"), arriving.alias("arrivals"), leaving.alias("departures")
    )


def write_hours(path: str) -> Callable[[DataFrame, int], None]:
    """Writes what a micro-batch adds to each hour; rows are added up before they are written."""
    write = batch_writer(path)

    def add(rows: DataFrame, batch: int) -> None:
        write(rows.groupBy("entity", "ts_hour").agg(F.sum("arrivals").alias("arrivals"), F.sum("departures").alias("departures")), batch)

    return add


def revise_hours(events: DataFrame, path: str, checkpoint: str) -> None:
    """Take all available events into the stored hours, late ones into the hours they belong to."""
    (
        hourly_changes(events)
        .writeStream.foreachBatch(write_hours(path))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def revised_hours(spark: SparkSession, path: str) -> DataFrame:
    """The hours as all batches together have them."""
    stored = spark.read.schema("entity long, ts_hour timestamp, arrivals long, departures long, batch long").parquet(path)
    return stored.groupBy("entity", "ts_hour").agg(
        F.sum("arrivals").alias("arrivals"), F.sum("departures").alias("departures"),
        (F.sum("arrivals") + F.sum("departures")).alias("total_movements"),
    )


def compact(spark: SparkSession, path: str, into: str) -> None:
    """Write the hours as one batch of a new folder, for a table of many small batches."""
    revised_hours(spark, path).select("entity", "ts_hour", "arrivals", "departures").write.mode("overwrite").parquet(f"{into}/batch=-1")


def latest_states(polls: DataFrame, key: str, time: str, order: str, columns: list[str], delay: str, quiet_ms: int) -> DataFrame:
    """The latest state of each key over repeated polls: ``key, time, order``, ``columns``, ``n_polls`` and ``n_changes``.

    A poll replaces the state if its (``time``, ``order``) is greater; an older one, which came late, is counted and changes
    nothing else. ``n_changes`` counts polls that changed one of ``columns`` when they came. A row is sent whenever a batch holds polls of the
    key. State is dropped when a key has been quiet for ``quiet_ms`` beyond the watermark; polls later than ``delay`` are lost.
    """
    fields = {f.name: f for f in polls.schema.fields}
    kept = StructType([fields[time], fields[order], *(fields[c] for c in columns), StructField("n_polls", LongType()), StructField("n_changes", LongType())])
    out = StructType([fields[key], *kept.fields])
    names = [time, order, *columns]

    def update(k: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        held: tuple[Any, ...] | None = tuple(state.get) if state.exists else None
        for part in parts:
            for row in part.sort_values([time, order])[names].astype(object).where(lambda d: d.notna(), None).itertuples(index=False):
                row = tuple(row)
                if held is None:
                    held = (*row, 1, 0)
                else:
                    *old, polls_seen, changes = held
                    newer = (pd.Timestamp(row[0]), row[1]) > (pd.Timestamp(old[0]), old[1])
                    changed = newer and list(row[2:]) != list(old[2:])
                    held = (*(row if newer else old), polls_seen + 1, changes + int(changed))
        if held is not None:
            state.update((pd.Timestamp(held[0]).to_pydatetime(), *held[1:]))
            state.setTimeoutTimestamp(max(int(pd.Timestamp(held[0]).timestamp() * 1000), state.getCurrentWatermarkMs()) + quiet_ms)
            yield pd.DataFrame([(*k, *held)], columns=out.names)

    assert isinstance(fields[time].dataType, TimestampType)
    return polls.withWatermark(time, delay).groupBy(key).applyInPandasWithState(update, out, kept, "update", GroupStateTimeout.EventTimeTimeout)


def current(states: DataFrame, key: str) -> DataFrame:
    """The last row that was sent for each key: the one that has seen most polls."""
    columns = [c for c in states.columns if c not in (key, "batch")]
    return states.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct("batch", "n_polls")).alias("s")).select(key, "s.*")
