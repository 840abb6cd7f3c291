"""A daily feature table that is kept up to date from landed chunks.

Three stored tables, all laid out by ``block`` (days of the calendar) and ``bucket`` (hash of the entity):

* ``counts`` keeps every chunk as its own partition; the row of the highest chunk counts for an entity and day.
* ``bounds`` keeps the first and last day of each entity in each chunk.
* ``features`` holds the result, one partition for each block and bucket.

A chunk touches the blocks of its days, those a window column reads them from later, and those between an old end
of a series and the new one. Only these are computed again, from their own counts and a halo before them. Everything a
chunk writes is an overwrite of partitions, computed from all stored chunks, so landing a chunk again changes nothing.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.config import DEFAULTS, Settings
from tidepanel.operators import target, windows
from tidepanel.session import materialize

#: days of a block; a task holds the days of one block and its halo at most
BLOCK_DAYS = 512
BUCKETS = 16

COUNTS = "entity int, dt date, arrivals long, departures long, chunk long, block int, bucket int"
BOUNDS = "entity int, first int, last int, chunk long, bucket int"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("entity"), F.lit(buckets)).cast("int")


class FeatureTable:
    """The stored tables under ``path``. ``block_days`` and ``buckets`` belong to the layout and must stay the same."""

    def __init__(self, spark: SparkSession, path: str, settings: Settings = DEFAULTS, block_days: int = BLOCK_DAYS, buckets: int = BUCKETS):
        self.spark, self.path, self.settings, self.block_days, self.buckets = spark, path, settings, block_days, buckets
        self.columns, self.halo = windows.daily_window_columns(settings)

    def create(self, model: DataFrame) -> None:
        """Empty tables with the score's ``model`` (see ``target.score_model``). Another model needs a new table, as every score changes with it."""
        model.write.mode("errorifexists").parquet(f"{self.path}/model")
        for name, schema, by in (("counts", COUNTS, ("chunk", "block", "bucket")), ("bounds", BOUNDS, ("chunk", "bucket"))):
            self.spark.createDataFrame([], schema).write.partitionBy(*by).parquet(f"{self.path}/{name}")
        none = self.spark.createDataFrame([], "entity int, block int, first int, last int, bucket int")
        self._features_of(none, self._read("counts", COUNTS)).write.partitionBy("block", "bucket").parquet(f"{self.path}/features")

    def _read(self, name: str, schema: str) -> DataFrame:
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}")

    def _schema(self) -> str:
        none = self.spark.createDataFrame([], "entity int, block int, first int, last int, bucket int")
        return ", ".join(f"`{c}` {t}" for c, t in self._features_of(none, self.spark.createDataFrame([], COUNTS)).dtypes)

    def features(self) -> DataFrame:
        return self._read("features", self._schema())

    def _day(self) -> Column:
        return F.unix_date("dt")

    def _block(self, day: Column) -> Column:
        return F.floor(day / F.lit(self.block_days)).cast("int")

    def touched(self, chunk: int) -> DataFrame:
        """``entity, block, bucket, first, last`` of all blocks that the stored chunk changes, with the bounds of the whole series."""
        own = self._read("counts", COUNTS).where(F.col("chunk") == chunk)
        buckets = [r["bucket"] for r in own.select("bucket").distinct().collect()]  # at most the number of buckets
        bounds = self._read("bounds", BOUNDS).where(F.col("bucket").isin(buckets))
        before = F.col("chunk") < chunk
        ends = bounds.groupBy("entity", "bucket").agg(
            F.min("first").alias("first"), F.max("last").alias("last"),
            F.min(F.when(before, F.col("first"))).alias("first_before"), F.max(F.when(before, F.col("last"))).alias("last_before"),
            F.max((F.col("chunk") == chunk).cast("int")).alias("landed"),
        ).where("landed = 1")
        # a new first day turns unknown values into counts for a halo; a new last day brings the days since the old one
        days = own.select("entity", self._day().alias("lo"), (self._day() + self.halo).alias("hi"))
        early = ends.where("first < first_before").select("entity", F.col("first").alias("lo"), (F.col("first_before") + self.halo).alias("hi"))
        late = ends.where("last > last_before").select("entity", (F.col("last_before") + 1).alias("lo"), F.col("last").alias("hi"))
        begun = ends.where("first_before IS NULL").select("entity", F.col("first").alias("lo"), F.col("last").alias("hi"))
        spans = days.unionByName(early).unionByName(late).unionByName(begun)
        pieces = spans.select("entity", self._block(F.col("lo")).alias("from"), self._block(F.col("hi")).alias("to")).distinct()
        blocks = pieces.select("entity", F.explode(F.sequence("from", "to")).alias("block")).distinct()
        inside = (F.col("block") >= self._block(F.col("first"))) & (F.col("block") <= self._block(F.col("last")))
        return blocks.join(ends.select("entity", "bucket", "first", "last"), "entity").where(inside)

    def _partitions(self, pairs: DataFrame) -> Column:
        """A filter on ``block`` and ``bucket`` that the reader settles while listing files. ``pairs`` is bounded by the calendar."""
        found = pairs.groupBy("block").agg(F.sort_array(F.collect_set("bucket")).alias("buckets")).collect()
        tests = [(F.col("block") == r["block"]) & F.col("bucket").isin(r["buckets"]) for r in found]
        return reduce(lambda a, b: a | b, tests, F.lit(False))

    def halo_partitions(self, touched: DataFrame) -> Column:
        reach = -(-self.halo // self.block_days)
        return self._partitions(touched.select("bucket", F.explode(F.sequence(F.col("block") - reach, "block")).alias("block")).distinct())

    def _features_of(self, touched: DataFrame, counts: DataFrame) -> DataFrame:
        """The features of all days of the ``touched`` blocks."""
        start, size = F.col("block") * self.block_days, self.block_days
        lo, hi = F.greatest(F.col("first"), start - self.halo), F.least(F.col("last"), start + (size - 1))
        spine = touched.select("entity", "block", "bucket", F.explode(F.sequence(lo, hi)).alias("day")).withColumn("dt", F.date_from_unix_date("day"))
        latest = counts.groupBy("entity", "dt").agg(F.max_by(F.struct("arrivals", "departures"), "chunk").alias("c"))
        panel = spine.join(latest.select("entity", "dt", "c.*"), ["entity", "dt"], "left").fillna(0, ["arrivals", "departures"])
        panel = target.with_phase(panel.withColumn("total_movements", F.col("arrivals") + F.col("departures")), "dt")
        model = self.spark.read.parquet(f"{self.path}/model")
        scored = target.score_by(panel, model, target.DAILY_PHASE, settings=self.settings)
        w = Window.partitionBy("entity", "block").orderBy("day")
        added = [make(w).alias(name) for name, make in self.columns.items()]
        kept = scored.select("*", *added).where(F.col("day") >= F.col("block") * F.lit(size))
        return kept.select("entity", "dt", "arrivals", "departures", "total_movements", "acps", *self.columns, "block", "bucket")

    def land(self, rows: DataFrame, chunk: int) -> None:
        """Take in ``entity, dt, arrivals, departures`` as chunk number ``chunk`` (from 1, rising).

        Its rows replace those of lower chunks for the same entity and day. Rows that repeat an entity and day are added up; rows
        without one of them are left out; an empty chunk changes nothing. NULL counts are 0. Land chunks one after another; a
        chunk that failed on the way must land again before the next one.
        """
        named = rows.where("entity IS NOT NULL AND dt IS NOT NULL").groupBy(F.col("entity").cast("int").alias("entity"), "dt").agg(
            F.coalesce(F.sum("arrivals"), F.lit(0)).alias("arrivals"), F.coalesce(F.sum("departures"), F.lit(0)).alias("departures")
        )
        placed = named.withColumns({"block": self._block(self._day()), "bucket": _bucket(self.buckets)})
        self._overwrite(placed.withColumn("chunk", F.lit(chunk)), f"counts/chunk={chunk}", ("block", "bucket"))
        own = self._read("counts", COUNTS).where(F.col("chunk") == chunk)
        ends = own.groupBy("entity", "bucket").agg(F.min(self._day()).alias("first"), F.max(self._day()).alias("last"))
        self._overwrite(ends, f"bounds/chunk={chunk}", ("bucket",))

        touched = materialize(self.touched(chunk), "touched")
        stored = self._partitions(touched.select("block", "bucket").distinct())
        counts = self._read("counts", COUNTS).where(self.halo_partitions(touched))
        others = self.features().where(stored).join(touched.select("entity", "block"), ["entity", "block"], "left_anti")
        fresh = self._features_of(touched, counts)
        staged = materialize(others.select(*fresh.columns).unionByName(fresh), "features")  # a partition can't be read while it is replaced
        staged.repartition("block", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("block", "bucket").parquet(
            f"{self.path}/features"
        )

    def _overwrite(self, rows: DataFrame, name: str, by: tuple[str, ...]) -> None:
        rows.drop("chunk").write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*by).parquet(f"{self.path}/{name}")
