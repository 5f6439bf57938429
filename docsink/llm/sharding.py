"""Shards by fixed virtual slots.

A record is hashed into one of SLOTS slots; bytes are summed by slot; a map, stored in versions, says in which shard each
slot is. The first map deals the slots out evenly by number; a rebalancing is an edit of it: shards over their fair
share release slots, and those go, largest first, to the shard with the least bytes. A record's slot never changes, only the
map does. The law that holds for the result is `bytes`: the shards' sizes are near equal.

A slot of more than HEAVY times the mean (one key may hold a third of all rows) is parted: its rows are dealt to as many
parts as bring a part to the mean, and the parts are placed like slots. There are at most twice SLOTS parts, so the map is
bounded whatever the table is.

DataFrame functions only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import shared_dir, table, written

SHARDS = 40
SLOTS = 4096
#: A slot of more than so many times the mean slot's bytes is parted.
HEAVY = 4
#: Bytes that a record takes besides its text.
OVERHEAD = 16


def _all():
    """All rows of a table of slots, of which there are at most twice SLOTS."""
    return Window.partitionBy(F.lit(0))


def records(spark: SparkSession, docs: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Written (doc_id, size, text_crc32, slot, part, row, block): each row's slot and part of it, a number of its own, and the block of input it is in."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(OVERHEAD)).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.pmod(F.xxhash64("doc_id"), F.lit(slots)).cast("int").alias("slot"),
        F.monotonically_increasing_id().alias("row"),
        F.spark_partition_id().alias("block"),
    )
    rows = written(spark, rows, "records")
    sums = rows.groupBy("slot").agg(F.sum("size").alias("bytes"))
    parts = sums.withColumn("mean", F.greatest(F.sum("bytes").over(_all()) / F.lit(slots), F.lit(1))).where(F.col("bytes") > HEAVY * F.col("mean")).select("slot", F.ceil(F.col("bytes") / F.col("mean")).cast("int").alias("parts"))
    return rows.join(F.broadcast(parts), "slot", "left").withColumn("part", F.when(F.col("parts").isNull(), 0).otherwise(F.pmod(F.xxhash64("row"), "parts").cast("int"))).drop("parts")


def slot_sizes(rows: DataFrame) -> DataFrame:
    """(slot, part, bytes, n): at most twice SLOTS rows."""
    return rows.groupBy("slot", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"))


def first_map(sizes: DataFrame, shards: int, slots: int = SLOTS) -> DataFrame:
    """(slot, part, shard): the slots in order, as many to each shard."""
    return sizes.select("slot", "part", F.floor(F.col("slot") * F.lit(shards) / F.lit(slots)).cast("int").alias("shard"))


def _dealt(items: Column, loads: Column, shards: Column) -> Column:
    """Each of `items` (bytes, slot, part), in order, goes to the one of `shards` with the least load: array of (slot, part, shard)."""
    start = F.struct(loads.alias("loads"), F.array().cast("array<struct<slot:int,part:int,shard:int>>").alias("out"))

    def step(state: Column, item: Column) -> Column:
        k = F.array_position(state["loads"], F.array_min(state["loads"])).cast("int")
        more = F.transform(state["loads"], lambda load, i: F.when(i == k - 1, load + item["bytes"]).otherwise(load))
        placed = F.struct(item["slot"].alias("slot"), item["part"].alias("part"), F.element_at(shards, k).alias("shard"))
        return F.struct(more.alias("loads"), F.concat(state["out"], F.array(placed)).alias("out"))

    return F.aggregate(items, start, step, lambda state: state["out"])


def rebalanced(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """slot_map edited for the given sizes (slot, part, bytes): shards over the fair share release their last slots (the largest stay), and
    these, with slots that the map doesn't have and those of shards that are no more, go to the shard with the least bytes, largest first."""
    placed = sizes.join(slot_map, ["slot", "part"], "left").select("slot", "part", "bytes", F.when(F.col("shard") < shards, F.col("shard")).alias("shard"))
    before = Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot", "part")
    fair = F.sum("bytes").over(_all()) / F.lit(shards)
    held = placed.withColumn("stays", F.col("shard").isNotNull() & (F.sum("bytes").over(before) <= fair))
    return _moved(held, F.sequence(F.lit(0), F.lit(shards - 1)))


def grown(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """slot_map of `shards` shards edited for one more: slots go from the old shards, each down to the new fair share, to the new one and nowhere else."""
    placed = sizes.join(slot_map, ["slot", "part"])
    before = Window.partitionBy("shard").orderBy(F.desc("bytes"), "slot", "part")
    fair = F.sum("bytes").over(_all()) / F.lit(shards + 1)
    over = placed.withColumn("fair", fair).withColumn("over", F.sum("bytes").over(before) > F.col("fair"))
    taken = over.withColumn("new", F.sum(F.when(F.col("over"), F.col("bytes")).otherwise(0)).over(_all().orderBy(F.desc("over"), F.desc("bytes"), "slot", "part")))
    return taken.select("slot", "part", F.when(F.col("over") & (F.col("new") <= F.col("fair")), F.lit(shards)).otherwise(F.col("shard")).alias("shard"))


def _moved(held: DataFrame, shards: Column) -> DataFrame:
    """held (slot, part, bytes, shard, stays) as a map: what doesn't stay is dealt out."""
    one = held.agg(
        F.reverse(F.array_sort(F.collect_list(F.when(~F.col("stays"), F.struct("bytes", F.col("slot").cast("int").alias("slot"), "part"))))).alias("items"),
        F.collect_list(F.when(F.col("stays"), F.struct("shard", "bytes"))).alias("kept"),
    )
    # At most twice SLOTS slots in one row.
    loads = F.transform(shards, lambda k: F.aggregate(F.filter("kept", lambda x: x["shard"] == k), F.lit(0).cast("long"), lambda a, x: a + x["bytes"]))
    moved = one.select(F.inline(_dealt(F.col("items"), loads, shards)))
    return held.where("stays").select(F.col("slot").cast("int").alias("slot"), "part", "shard").unionByName(moved)


def write_map(slot_map: DataFrame, path: str, version: int) -> None:
    """slot_map as a version of the map at `path`; a version that is there is never changed."""
    slot_map.coalesce(1).write.mode("errorifexists").parquet(f"{path}/version={version}")


def read_map(spark: SparkSession, path: str, version: int) -> DataFrame:
    """(slot, part, shard) of a version of the map at `path`."""
    return spark.read.schema("slot int, part int, shard int").parquet(f"{path}/version={version}")


def in_shards(rows: DataFrame, slot_map: DataFrame, law: str = "bytes") -> DataFrame:
    """rows of `records` with law, shard, slot (the place in the shard, gapless from 0) and grown_shard (null under this law).

    Places are counted within (shard, block), and blocks begin after what the ones before them have in the shard.
    """
    placed = rows.join(F.broadcast(slot_map), ["slot", "part"]).select("doc_id", "size", "text_crc32", "row", "block", "shard")
    counts = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))
    begins = counts.select("shard", "block", (F.sum("n").over(Window.partitionBy("shard").orderBy("block")) - F.col("n")).alias("begin"))
    place = F.row_number().over(Window.partitionBy("shard", "block").orderBy("row")) - 1
    out = placed.withColumn("place", place).join(begins, ["shard", "block"])
    return out.select("doc_id", "size", "text_crc32", F.lit(law).alias("law"), "shard", (F.col("begin") + F.col("place")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def shard_documents(spark: SparkSession, docs: DataFrame, shards: int = SHARDS, slots: int = SLOTS, path: str | None = None) -> DataFrame:
    """Each document's size, text_crc32, law, shard, slot and grown_shard; the map is stored at `path` as version 0 (even) and 1 (rebalanced).

    A null text has 16 bytes. Rows without a doc_id share a slot, as do those that repeat one; where that makes a slot heavy,
    its rows are dealt out. Each row has a row; no rows give none; other columns stay out.
    """
    path = path or f"{shared_dir(spark)}/slots-{uuid.uuid4().hex}"
    rows = records(spark, docs, slots)
    sizes = written(spark, slot_sizes(rows), "slot-sizes")
    write_map(first_map(sizes, shards, slots), path, 0)
    write_map(rebalanced(read_map(spark, path, 0), sizes, shards), path, 1)
    return in_shards(rows, read_map(spark, path, 1))


def op12_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(spark, table(spark, sf_dir, "documents"))
