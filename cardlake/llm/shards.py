"""Sharding through fixed virtual slots, in DataFrame operations.

A record's id is hashed into one of ``SLOTS`` virtual slots, for good. Bytes
are added up by slot (a partial sum in each task), and a slot map says which
shard holds each slot. The map has ``SLOTS`` rows whatever the data's size, so
it is broadcast, and it is a versioned table: a rebalancing writes a new
version that moves few slots, and no record is hashed again.

The first version deals slots out by size: from the largest on, each goes to
the shard with the least bytes so far. So the law is ``bytes``: shards' sizes
are near equal. Growing to more shards moves from each old shard just the
slots that exceed the new mean, and only into the new shards.

Records are stored before they are placed, with a number for each row. A
record whose id is its own is hashed by that id alone. Ids that several rows
have, or none, would put all of them into one slot, however many; such rows
are hashed by id, text and row number, so they spread over all slots like
others. Their slot is fixed with the stored record.

Defined cases: NULL and repeated ids as above, repeated rows included (equal
texts need not share a shard: the law is about sizes); NULL texts have no
bytes; a very long text counts as it is, so it may alone exceed a shard's mean;
a slot's rows are numbered by id, checksum, size and row number; extra columns
are ignored; an empty table has a map (every slot empty) and no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cardlake.llm.common import stored

SLOTS, SHARDS, OVERHEAD = 8192, 40, 16


def records(docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """doc_id, size (UTF-8 bytes and ``OVERHEAD``), crc32 of the text, row number and virtual slot of every document (stored)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    recs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("h"), F.monotonically_increasing_id().alias("nr"))
    recs = stored(recs, "shard-records")
    own, spread = F.xxhash64(F.col("doc_id").cast("string")), F.xxhash64("doc_id", "h", "nr")
    repeated = recs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id", F.lit(True).alias("repeated"))
    named = recs.where("doc_id is not null").join(repeated, "doc_id", "left").withColumn("hash", F.when(F.col("repeated"), spread).otherwise(own))
    every = named.drop("repeated").unionByName(recs.where("doc_id is null").withColumn("hash", spread))
    placed = every.select("doc_id", "size", "text_crc32", "nr", F.pmod("hash", F.lit(slots)).cast("int").alias("virtual_slot"))
    return stored(placed, "shard-slots-of")


def slot_sizes(recs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """virtual_slot, bytes, rows of every slot, empty ones included."""
    used = recs.groupBy("virtual_slot").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    every = recs.sparkSession.range(slots).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(used, "virtual_slot", "left").na.fill(0, ["bytes", "rows"])


def first_map(sizes: DataFrame, shards: int = SHARDS) -> DataFrame:
    """virtual_slot, shard: the largest slot first, each to the least loaded shard (one row of ``SLOTS`` slots is folded)."""
    listed = sizes.agg(F.sort_array(F.collect_list(F.struct(F.col("bytes"), F.col("virtual_slot"))), asc=False).alias("slots"))
    folded = F.expr(f"""
        aggregate(slots,
            named_struct('load', array_repeat(0L, {shards}), 'shard', cast(array() as array<int>)),
            (a, s) -> transform(array(cast(array_position(a.load, array_min(a.load)) - 1 as int)),
                p -> named_struct('load', transform(a.load, (x, i) -> if(i = p, x + s.bytes, x)),
                                  'shard', concat(a.shard, array(p))))[0]).shard""")
    return listed.select(F.explode(F.arrays_zip(F.col("slots.virtual_slot").alias("virtual_slot"), folded.alias("shard"))).alias("x")) \
        .select("x.virtual_slot", "x.shard")


def grown_map(slot_map: DataFrame, sizes: DataFrame, shards: int, more: int = 1) -> DataFrame:
    """The map for ``more`` more shards: each old shard gives slots worth what it has over the new mean, to the new ones in turn."""
    loaded = slot_map.join(sizes, "virtual_slot")
    mean = sizes.agg((F.sum("bytes") / F.lit(shards + more)).alias("mean"))
    by_size = Window.partitionBy("shard").orderBy(F.desc("bytes"), "virtual_slot")
    given = loaded.crossJoin(mean) \
        .withColumn("excess", F.sum("bytes").over(Window.partitionBy("shard")) - F.col("mean")) \
        .withColumn("rank", F.row_number().over(by_size)) \
        .withColumn("upto", F.sum("bytes").over(by_size.rowsBetween(Window.unboundedPreceding, 0))) \
        .withColumn("moves", (F.col("upto") <= F.col("excess")) & (F.col("bytes") > 0))
    target = (F.lit(shards) + F.pmod(F.col("rank") + F.col("shard"), F.lit(more))).cast("int")
    return given.select("virtual_slot", F.when(F.col("moves"), target).otherwise(F.col("shard")).alias("shard"))


def write_map(slot_map: DataFrame, path: str, version: int) -> None:
    """Store one version of the map; a version is written once and never changed."""
    slot_map.write.mode("error").parquet(f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """virtual_slot, shard, version of the given or the latest version."""
    every = spark.read.schema("virtual_slot int, shard int, version int").parquet(path)
    if version is None:
        version = every.agg(F.max("version")).first()[0]
    return every.where(F.col("version") == version)


def placed(recs: DataFrame, sizes: DataFrame, slot_map: DataFrame) -> DataFrame:
    """Records with their shard and their place in it: ``slot`` counts a shard's rows from 0 without gaps.

    A virtual slot's rows are numbered on their own; the slots of a shard
    follow one another, so no window is as large as a shard.
    """
    before = F.sum("rows").over(Window.partitionBy("shard").orderBy("virtual_slot").rowsBetween(Window.unboundedPreceding, -1))
    offsets = slot_map.join(sizes, "virtual_slot").withColumn("before", F.coalesce(before, F.lit(0)))
    own = F.row_number().over(Window.partitionBy("virtual_slot").orderBy("doc_id", "text_crc32", "size", "nr"))
    return recs.withColumn("own", own).join(F.broadcast(offsets.drop("bytes", "rows")), "virtual_slot") \
        .withColumn("slot", (F.col("before") + F.col("own") - 1).cast("long")).drop("own", "before", "nr")


def shard(docs: DataFrame, map_path: str, shards: int = SHARDS, slots: int = SLOTS) -> DataFrame:
    """Place every document; writes version 1 of the map to ``map_path`` and returns records with shard, slot and version."""
    recs = records(docs, slots)
    sizes = stored(slot_sizes(recs, slots), "shard-slots")
    write_map(first_map(sizes, shards), map_path, 1)
    return placed(recs, sizes, read_map(docs.sparkSession, map_path))
