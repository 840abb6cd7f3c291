"""File sources and sinks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Other names a column may arrive under.
ALIASES = {"timestamp": "timestamp_hour", "movements": "total_movements"}


def read_parquet(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Parquet scan. A missing path is an error of Spark's own (PATH_NOT_FOUND)."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def read_json(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """One document per file, as a poller or an archive leaves them."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def parse_json(df: DataFrame, column: str, schema: str) -> DataFrame:
    """JSON text with one document per row."""
    return df.select(F.from_json(column, schema).alias("_doc")).select("_doc.*")


def reference_row(df: DataFrame, key: str, value, columns: Sequence[str]) -> DataFrame:
    """The row of one key with the columns that exist; an error if there is none."""
    kept = [c for c in columns if c in df.columns]
    found = df.filter(F.col(key) == F.lit(value)).select(*kept)
    if found.isEmpty():
        raise LookupError(f"{value!r} not found in {key}")
    return found


def union_chunks(chunks: Sequence[DataFrame]) -> DataFrame:
    """Stack chunks whose columns may differ."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), chunks)


def not_landed(incoming: DataFrame, landed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key has not landed yet."""
    return incoming.join(landed.select(*keys), list(keys), "left_anti")


def normalize_columns(df: DataFrame, aliases: dict[str, str] = ALIASES) -> DataFrame:
    """Rename a column that came under an alias, unless the proper one is there."""
    renames = {a: c for a, c in aliases.items() if a in df.columns and c not in df.columns}
    return df.withColumnsRenamed(renames)


def traffic_scan(df: DataFrame, renames: dict[str, str], date: str, columns: Sequence[str]) -> DataFrame:
    """Daily traffic of all entities: rename, cast the date, project."""
    named = df.withColumnsRenamed(renames)
    return named.withColumn(date, F.to_date(date)).select(*columns)


def write_splits(df: DataFrame, path: str) -> None:
    """The full table laid out by split, so that reading one split reads its files only."""
    df.write.mode("overwrite").partitionBy("split").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)
