"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

#: rows of a batch that goes to Python, so that neither side holds many texts at once
BATCH_ROWS = 512

#: rows handled at once inside a task, so that memory follows a few texts and not a whole batch
SLICE = 256


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True for the rows whose labels are never learnt from."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def small_batches(df: DataFrame) -> DataFrame:
    """``df`` in a session whose Arrow batches have at most ``BATCH_ROWS`` rows."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(name, "0")) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))
    return df


def with_arrow_columns(
    df: DataFrame,
    source: str,
    added: list[StructField],
    make: Callable[[], Callable[[list], list[pa.Array]]],
) -> DataFrame:
    """``df`` with columns computed from ``source`` in Arrow batches.

    ``make`` runs once in each task and returns the function that maps a list of values to
    the new columns. A column of the same name that ``df`` already has is replaced.
    """
    names = {f.name.lower() for f in added}
    kept = [f for f in df.schema.fields if f.name.lower() not in names]
    if source.lower() in names:
        raise ValueError(f"{source} is read and can't be replaced")
    schema = StructType([*kept, *added])
    df = df.select([F.col(f"`{f.name}`") for f in kept])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                new = compute(part.column(part.schema.get_field_index(source)).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *new], names=[*part.schema.names, *(f.name for f in added)]
                )

    return small_batches(df).mapInArrow(run, schema)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> tuple[DataFrame, dict[int, int]]:
    """``doc_id, text, label`` of at most ``per_class`` labelled ids of each class, and how many
    labelled ids there are of each class.

    Held-out rows, NULL ids and labels other than 0 and 1 are left out; an id with both labels counts
    as 1. The sample is the first ids in the order of a hash, so it is the same on every run. Its
    ids are bounded by the two limits, which is why they may be broadcast.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
    )
    counts = {0: 0, 1: 0} | {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
    parts = [known.where(F.col("label") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for c in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))
    return docs.select("doc_id", "text").join(chosen, "doc_id"), counts


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> Callable[[np.ndarray], np.ndarray]:
    """Weighted logistic regression on standardised columns by Newton's method; gives the function
    from rows to probabilities."""
    mean, scale = x.mean(0), x.std(0)
    scale = np.where(scale > 0, scale, 1.0)
    w = np.zeros(x.shape[1] + 1)

    def design(rows: np.ndarray) -> np.ndarray:
        return np.c_[np.ones(len(rows)), (rows - mean) / scale]

    def chance(rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(design(rows) @ w, -30, 30)))

    a, weight = design(x), weight / weight.mean()
    for _ in range(30):
        p = chance(x)
        slope = a.T @ (weight * (p - y)) + ridge * len(x) * w
        curve = (a * (weight * np.maximum(p * (1 - p), 1e-9))[:, None]).T @ a + ridge * len(x) * np.eye(len(w))
        step = np.linalg.solve(curve, slope)
        w = w - step / max(1.0, np.abs(step).max() / 4)
    return chance
