"""Sharding by fixed virtual slots.

A record's key hashes into one of some thousand slots, for good. Which shard holds a slot
stands in a versioned map; growing or rebalancing edits the map and moves whole slots.
Only DataFrame operations, and what is per slot is bounded by the number of slots.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from millrace.operators.numbering import number_rows
from millrace.session import materialise
from millrace.sources.writers import overwrite

SLOTS = 4096


def slot_of(key: Column | str, slots: int = SLOTS) -> Column:
    """The slot of a key: by the first 32 bits of an MD5 of its text. NULL has a slot too."""
    digest = F.md5(F.coalesce(F.col(key).cast("string") if isinstance(key, str) else key.cast("string"), F.lit("")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % slots).cast("int")


def first_map(spark: SparkSession, shards: int, slots: int = SLOTS) -> DataFrame:
    """Version 1: slots dealt to the shards in turn."""
    if not 1 <= shards <= slots:
        raise ValueError("between one shard and as many as there are slots")
    return spark.range(slots).select(
        F.lit(1).alias("version"), F.col("id").cast("int").alias("virtual_slot"), (F.col("id") % shards).cast("int").alias("shard")
    )


def grow(slot_map: DataFrame, shards: int) -> DataFrame:
    """The next version, with one more shard than ``shards``.

    Every shard keeps its even share of the slots and gives the rest to the new one;
    nothing moves between the old ones. Slots and shard counts alone decide.
    """
    mine = Window.partitionBy("shard").orderBy(F.md5(F.col("virtual_slot").cast("string")), "virtual_slot")
    share = F.ceil(F.count(F.lit(1)).over(Window.partitionBy(F.lit(0))) / (shards + 1))  # all slots: a bounded number
    stays = F.row_number().over(mine) <= share
    return slot_map.select(
        (F.col("version") + 1).alias("version"), "virtual_slot", F.when(stays, F.col("shard")).otherwise(shards).alias("shard")
    )


def load_of(records: DataFrame, size: str = "size") -> DataFrame:
    """Bytes and rows of every slot in use: one row per slot and task is shuffled."""
    return records.groupBy("virtual_slot").agg(F.sum(size).alias("slot_bytes"), F.count(F.lit(1)).alias("slot_rows"))


def rebalance(slot_map: DataFrame, load: DataFrame) -> DataFrame:
    """The next version, with bytes more even: what a shard holds beyond the mean is moved
    to shards that hold less, slot by slot, in the order of their room.

    Both sides are laid out on one line of bytes: released slots by what is released
    before them, shards with room by the room before them. A slot goes to the shard in
    whose stretch its middle lies. A slot is never cut, so a slot above the mean stays whole.
    """
    everywhere = Window.partitionBy(F.lit(0))  # slots or shards: a bounded number
    sized = slot_map.join(load, "virtual_slot", "left").withColumn("slot_bytes", F.coalesce("slot_bytes", F.lit(0)))
    shards = slot_map.agg(F.count_distinct("shard")).scalar()
    sized = sized.withColumn("mean", F.sum("slot_bytes").over(everywhere) / shards)
    inside = Window.partitionBy("shard").orderBy(F.col("slot_bytes").desc(), "virtual_slot")
    sized = sized.withColumn("upto", F.sum("slot_bytes").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    sized = sized.withColumn("released", (F.col("upto") > F.col("mean")) & (F.row_number().over(inside) > 1))

    line = Window.partitionBy(F.lit(0)).orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1)
    released = sized.filter("released").select(
        "virtual_slot", (F.coalesce(F.sum("slot_bytes").over(line), F.lit(0)) + F.col("slot_bytes") / 2).alias("at"), F.lit(1).alias("kind")
    )
    room = sized.groupBy("shard", "mean").agg(F.sum(F.when(~F.col("released"), F.col("slot_bytes")).otherwise(0)).alias("held"))
    room = room.select("shard", F.greatest(F.col("mean") - F.col("held"), F.lit(0.0)).alias("room")).filter("room > 0")
    before = Window.partitionBy(F.lit(0)).orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = room.select("shard", F.coalesce(F.sum("room").over(before), F.lit(0.0)).alias("at"), F.lit(0).alias("kind"))
    upto = Window.partitionBy(F.lit(0)).orderBy("at", "kind", "shard").rowsBetween(Window.unboundedPreceding, 0)
    moved = (
        starts.unionByName(released, allowMissingColumns=True)
        .withColumn("to", F.last("shard", ignorenulls=True).over(upto))
        .filter("kind = 1")
        .select("virtual_slot", "to")
    )
    return slot_map.join(moved, "virtual_slot", "left").select(
        (F.col("version") + 1).alias("version"), "virtual_slot", F.coalesce("to", "shard").alias("shard")
    )


def shard_documents(docs: DataFrame, shards: int = 16, slots: int = SLOTS, map_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Documents with their shard, and the stored map.

    First: doc_id, size, text_crc32, law, shard, slot (the place in the shard, from 0
    without gaps), grown_shard (with one shard more), virtual_slot. The law is ``key``:
    doc_id and the number of shards decide. A null text has size 1 and checksum 0; a null
    doc_id has a slot like any other key; repeated rows lie in one shard, each at a place
    of its own. Other columns are left out, whatever their names.

    Second: one row per version and slot with its shard, bytes and rows, written to
    ``map_path``, where a later edit finds it; without a path it lives as long as the
    shared folder.
    """
    spark = docs.sparkSession
    # Sizes only, written once: the texts are read one time and never shuffled.
    sized = materialise(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1).alias("size"),
            F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
            slot_of("doc_id", slots).alias("virtual_slot"),
        ),
        "sized",
        few_files=True,
    )
    now = first_map(spark, shards, slots)
    versions = now.unionByName(grow(now, shards)).join(load_of(sized), "virtual_slot", "left")
    versions = versions.fillna(0, ["slot_bytes", "slot_rows"])
    if map_path:
        overwrite(versions, map_path)
    stored = spark.read.schema(versions.schema).parquet(map_path) if map_path else materialise(versions, "slot-map")
    at = {v: stored.filter(F.col("version") == v).select("virtual_slot", "shard") for v in (1, 2)}
    placed = sized.join(F.broadcast(at[1]), "virtual_slot").join(  # as many rows as there are slots
        F.broadcast(at[2].withColumnRenamed("shard", "grown_shard")), "virtual_slot"
    )
    numbered = number_rows(placed, "virtual_slot", "slot", start=0, within=["shard"])
    result = numbered.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "virtual_slot"
    )
    return result, stored
