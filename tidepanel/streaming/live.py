"""Live counts with Structured Streaming.

Sources are files or any stream with the same columns. Each run reads what is available
and stops; progress is kept in the checkpoint, so the next run takes new files only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidepanel.config import DEFAULTS, Settings
from tidepanel.functions.spatial import density_columns, with_band
from tidepanel.operators.target import percentile_class

DELAY = "1 hour"


def file_stream(
    spark: SparkSession, path: str, schema: StructType | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Stream over landed parquet files; without ``schema`` it is that of the files, of which there
    must be one then. ``files_per_batch`` bounds what one micro-batch takes of a backlog.

    The stream source takes a plain path for a folder, so the path is given as a pattern
    that matches just itself; a single file and a folder then both work."""
    path = path.rstrip("/")
    pattern = f"{path[:-1]}[{path[-1]}]"
    reader = spark.readStream.schema(schema or spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(pattern)


def event_stream(
    spark: SparkSession, path: str, schema: StructType | None = None, files_per_batch: int | None = None
) -> DataFrame:
    """Event times as real timestamps, which watermarks need."""
    return file_stream(spark, path, schema, files_per_batch).withColumn("ts", F.col("ts").cast("timestamp"))


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Append all available input to a parquet table and stop."""
    (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )


def hourly_movements(events: DataFrame, delay: str = DELAY) -> DataFrame:
    """Arrivals and departures per entity and hour, sent once the hour is closed."""
    def among(*kinds: str):
        return F.sum(F.when(F.col("event_type").isin(*kinds), 1).otherwise(0))

    return (
        events.withWatermark("ts", delay)
        .groupBy((F.col("user_id") % 5).alias("entity"), F.window("ts", "1 hour").alias("w"))
        .agg(among("view", "click").alias("arrivals"), among("purchase", "signup").alias("departures"))
        .select(
            "entity", F.col("w.start").alias("ts_hour"), "arrivals", "departures",
            (F.col("arrivals") + F.col("departures")).alias("total_movements"),
        )
    )


def density(reports: DataFrame, delay: str = DELAY, s: Settings = DEFAULTS) -> DataFrame:
    """Aircraft per hour and band; bands are conditional aggregates, known beforehand."""
    return (
        with_band(reports.withWatermark("ts", delay), s)
        .groupBy(F.window("ts", "1 hour").alias("w"))
        .agg(*density_columns(s))
        .withColumn("snapshot_ts", F.col("w.start"))
        .drop("w")
    )


def first_seen(events: DataFrame, key: str, delay: str = DELAY) -> DataFrame:
    """The first row of each key; later copies within the delay are dropped."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark([key])


def classify(hourly: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Closed hours against stored cuts of their entity (stream-static join)."""
    return hourly.join(thresholds, "entity", "left").withColumn(
        "live_class", percentile_class(F.col("total_movements"), F.col("p60"), F.col("p85"))
    )
