"""Shards by fixed virtual slots.

Records are hashed into thousands of slots, bytes are summed for each slot, and a small
versioned table says which shard each slot belongs to. Rebalancing edits that table: only the
slots it moves change their shard, and no record is hashed anew.

DataFrame functions only; nothing leaves the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A slot's rows meet in one sort, so raise this with the table; a slot must stay under a task's memory.
SLOTS = 8192


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text (NULL: none) and 8 for the key."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(8)


def slot_of(keys: list[Column], slots: int = SLOTS) -> Column:
    """The slot of a record. NULL keys have a slot like any other value."""
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def slot_weights(records: DataFrame, slots: int = SLOTS) -> DataFrame:
    """``vslot, bytes, n`` of all slots; those without records have zeros."""
    sums = records.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))
    every = records.sparkSession.range(slots).select(F.col("id").cast("int").alias("vslot"))
    return every.join(sums, "vslot", "left").select("vslot", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("bytes", "n")])


def _deal(slots: DataFrame, loads: Column, carried: DataFrame | None = None) -> DataFrame:
    """Heaviest slot first to the shard with the least load. ``loads``: the shards' loads at the
    start, as ``array<struct<load, shard>>``. Works on one row per slot, so its size is fixed."""
    row = slots.agg(F.reverse(F.array_sort(F.collect_list(F.struct("bytes", "n", "vslot")))).alias("todo"))
    row = row.crossJoin(carried) if carried is not None else row  # one row each
    start = F.struct(loads.alias("loads"), F.expr("cast(array() as array<int>)").alias("picks"))

    def step(acc: Column, slot: Column) -> Column:
        least = F.array_min(acc["loads"])
        moved = F.transform(
            acc["loads"],
            lambda x: F.when(x["shard"] == least["shard"], F.struct((x["load"] + slot["bytes"]).alias("load"), x["shard"].alias("shard"))).otherwise(x),
        )
        return F.struct(moved.alias("loads"), F.concat(acc["picks"], F.array(least["shard"])).alias("picks"))

    picks = F.aggregate("todo", start, step)["picks"]
    return row.select(F.explode(F.arrays_zip(F.col("todo").alias("slot"), picks.alias("shard"))).alias("x")).select(
        F.col("x.slot.vslot").alias("vslot"), F.col("x.shard").alias("shard"), F.col("x.slot.bytes").alias("bytes"), F.col("x.slot.n").alias("n")
    )


def _empty_loads(shards: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(shards - 1)), lambda i: F.struct(F.lit(0).cast("long").alias("load"), i.alias("shard")))


def first_map(weights: DataFrame, shards: int) -> DataFrame:
    """Version 1 of the map: ``version, vslot, shard, bytes, n``."""
    return _deal(weights, _empty_loads(shards)).select(F.lit(1).alias("version"), "vslot", "shard", "bytes", "n")


def rebalance(old: DataFrame, weights: DataFrame, shards: int) -> DataFrame:
    """The next version of the map for ``shards`` shards, which may be more or fewer than before.

    Each shard keeps its first slots up to an even share; only the rest, heavy and light ones
    alike, and the slots of shards that are gone, are dealt again.
    """
    now = old.select("version", "vslot", "shard").join(weights, "vslot")
    run = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, 0)
    share = now.agg(F.ceil(F.sum("bytes") / shards).alias("share"))
    marked = now.withColumn("upto", F.sum("bytes").over(run)).crossJoin(share).withColumn("stays", (F.col("shard") < shards) & (F.col("upto") <= F.col("share")))
    stay = marked.where("stays").select((F.col("version") + 1).alias("version"), "vslot", "shard", "bytes", "n")
    kept = stay.groupBy("shard").agg(F.sum("bytes").alias("load")).agg(F.map_from_entries(F.collect_list(F.struct("shard", "load"))).alias("kept"))
    loads = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda i: F.struct(F.coalesce(F.col("kept")[i], F.lit(0).cast("long")).alias("load"), i.alias("shard")),
    )
    version = now.agg((F.max("version") + 1).alias("version"))
    moved = _deal(marked.where("not stays"), loads, kept).crossJoin(version).select("version", "vslot", "shard", "bytes", "n")
    return stay.unionByName(moved)


def save_map(slot_map: DataFrame, path: str) -> None:
    """Adds a version to the stored map; earlier versions stay readable."""
    slot_map.write.mode("append").partitionBy("version").parquet(path)


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The stored map of a version, or the newest one."""
    df = spark.read.parquet(path)
    version = df.agg(F.max("version")).first()[0] if version is None else version
    return df.where(F.col("version") == version).select("version", "vslot", "shard", "bytes", "n")


def place(records: DataFrame, slot_map: DataFrame, order: list[str]) -> DataFrame:
    """Records with ``shard`` and ``slot``, their gapless position in it.

    A shard's positions follow its virtual slots; inside one they follow ``order``. Rows meet by
    virtual slot only, never by shard, so a shard of any size is numbered in parallel.
    """
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = slot_map.select("vslot", "shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inside = F.row_number().over(Window.partitionBy("vslot").orderBy(*order))
    return records.withColumn("inside", inside).join(offsets, "vslot").withColumn("slot", F.col("base") + F.col("inside") - 1).drop("base", "inside")


def shard_records(
    df: DataFrame, shards: int, map_path: str, key: str = "doc_id", text: str = "text", slots: int = SLOTS
) -> DataFrame:
    """``key, size, text_crc32, vslot, shard, slot`` of every row, and a stored map.

    Law ``bytes``: the shards' bytes are as near to equal as the slots allow. A NULL key or text
    is a value like any other (a NULL text has no checksum); repeated rows keep one line each;
    the slot depends on the key and the text's checksum, so that a key which holds many
    different texts is spread. Extra columns of ``df`` are not carried. An empty table gives an
    empty result and a map of empty slots.
    """
    crc = F.crc32(F.col(f"`{text}`").cast("binary"))
    records = df.select(F.col(f"`{key}`").alias(key), record_size(F.col(f"`{text}`")).alias("size"), crc.alias("text_crc32"))
    records = records.withColumn("vslot", slot_of([F.col(f"`{key}`"), F.col("text_crc32")], slots))
    records_path = f"{map_path}-records"
    records.write.parquet(records_path)
    records = df.sparkSession.read.parquet(records_path)
    save_map(first_map(slot_weights(records, slots), shards), map_path)
    return place(records, load_map(df.sparkSession, map_path), [f"`{key}`", "text_crc32", "size"])
