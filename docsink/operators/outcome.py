"""Outcomes of bulk writes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Names by which a target says that a document is malformed, and that a version conflicts.
MALFORMED = ("mapper_parsing_exception", "illegal_argument_exception", "action_request_validation_exception", "document_parsing_exception", "strict_dynamic_mapping_exception")
CONFLICT = "version_conflict_engine_exception"

ITEM = "map<string, struct<_index: string, _id: string, _version: bigint, status: int, error: struct<type: string, reason: string>>>"


def response_items(responses: DataFrame, text: str = "response") -> DataFrame:
    """One row for each item of each bulk response: its place, operation, status and error."""
    items = F.from_json(text, f"items array<{ITEM}>")["items"]
    own = F.map_values("item")[0]
    return (
        responses.select("*", F.posexplode(items).alias("pos", "item"))
        .select(*responses.columns, "pos", F.map_keys("item")[0].alias("op"), own["_id"].alias("id"), own["status"].alias("status"), F.concat_ws(": ", own["error"]["type"], own["error"]["reason"]).alias("message"), own["error"].isNotNull().alias("failed"))
        .drop(text)
    )


def error_class(failed: Column, message: Column) -> Column:
    """ok, malformed, conflict or other, in this order of the names."""
    named = F.lit(False)
    for name in MALFORMED:
        named = named | message.contains(name)
    return F.when(~failed, "ok").when(named, "malformed").when(message.contains(CONFLICT), "conflict").otherwise("other")


def classify(items: DataFrame, malformed_policy: str = "fail", external: Column | None = None, is_stream: bool = False) -> DataFrame:
    """items (failed, message) with error_class, processed, reported, fatal. external: whether the write had its own version."""
    own = external if external is not None else F.lit(False)
    kind = F.col("error_class")
    return (
        items.withColumn("error_class", error_class(F.col("failed"), F.col("message")))
        .withColumn("processed", kind.isin("ok", "conflict") | ((kind == "malformed") & F.lit(malformed_policy != "fail")))
        .withColumn("reported", (kind == "malformed") | (kind == "other") | ((kind == "conflict") & ~own & F.lit(not is_stream)))
        .withColumn("fatal", (kind == "other") | ((kind == "malformed") & F.lit(malformed_policy == "fail")))
    )


def pair(items: DataFrame, batches: DataFrame) -> DataFrame:
    """Response items with the rows of their batch, by place: both have (batch_id, pos)."""
    return items.join(batches, ["batch_id", "pos"])
