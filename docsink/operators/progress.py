"""Offsets that are safe to commit."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART = ["topic", "partition"]


def merge_replays(records: DataFrame, committed: DataFrame | None = None) -> DataFrame:
    """One row for each offset, processed if it ever was; what lies at or below a committed offset is left out."""
    if committed is not None:
        records = records.join(committed.select(*PART, "commit_offset"), PART, "left").where("commit_offset is null or offset >= commit_offset").drop("commit_offset")
    return records.groupBy(*PART, "offset").agg(F.bool_or("processed").alias("processed"))


def safe_offsets(records: DataFrame) -> DataFrame:
    """(topic, partition, commit_offset): after the last processed offset below the first open one; no row if there is none.

    Two aggregates and a join with their few rows, so that no log partition is sorted or held in one task.
    """
    first_open = records.where("not processed").groupBy(*PART).agg(F.min("offset").alias("first_open"))
    done = records.where("processed").join(first_open, PART, "left").where("first_open is null or offset < first_open")
    return done.groupBy(*PART).agg((F.max("offset") + 1).alias("commit_offset"))


def safe_of_runs(done: DataFrame) -> DataFrame:
    """(topic, partition, commit_offset) of the runs of offsets (first, last) that finished micro-batches have published; what such a batch read is done as a whole."""
    return done.where("topic is not null").groupBy(*PART).agg((F.max("last") + 1).alias("commit_offset"))


def all_or_none_offsets(records: DataFrame) -> DataFrame:
    """After the last offset where all is processed; else no row."""
    return records.groupBy(*PART).agg((F.max("offset") + 1).alias("commit_offset"), F.bool_and("processed").alias("all")).where("all").drop("all")


def backlog(records: DataFrame, pause_at: int | None = None) -> DataFrame:
    """(topic, partition, pending): offsets not yet cleared, and with pause_at whether intake would be paused."""
    safe = safe_offsets(records)
    found = records.join(safe, PART, "left").groupBy(*PART).agg(F.count(F.when(F.col("commit_offset").isNull() | (F.col("offset") >= F.col("commit_offset")), 1)).alias("pending"))
    return found if pause_at is None else found.withColumn("paused", F.col("pending") > pause_at)


def hand_over(progress: DataFrame, closed: DataFrame) -> DataFrame:
    """progress without the partitions that were handed over."""
    return progress.join(closed.select(*PART), PART, "left_anti")
