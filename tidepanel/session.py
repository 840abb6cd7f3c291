"""Session set-up and the shared folder for tables that cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: str = "8", partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the benchmark."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidepanel")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", _own_folder())
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> None:
    """All hours and dates are UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_folder(spark: SparkSession) -> str:
    """Folder all executors can reach: ``spark.checkpoint.dir`` of the session.

    Only a session in one process, started elsewhere than in ``local_session``, may lack it.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if spark.sparkContext.master.split("[")[0] == "local":
        return _own_folder()
    raise ValueError("set spark.checkpoint.dir to a folder that all executors share")


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="tidepanel-")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once and read it back, so that later passes (iterative fits)
    start from files and survive lost executors."""
    path = new_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
