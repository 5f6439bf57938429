"""Tables and streams as change records.

The envelope: topic string, partition int, offset long, timestamp timestamp, key, value, headers array<struct<key, value binary>>.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEADERS = "array<struct<key: string, value: binary>>"


def as_changes(df: DataFrame, *, topic, partition, offset, key, value, timestamp=None, headers=None) -> DataFrame:
    """df (batch or stream) as the envelope. Each argument is a Column or a column's name; topic may be plain text in F.lit."""

    def column(x, default: str) -> Column:
        return F.lit(None).cast(default) if x is None else F.col(x) if isinstance(x, str) else x

    return df.select(
        column(topic, "string").cast("string").alias("topic"),
        column(partition, "int").cast("int").alias("partition"),
        column(offset, "long").cast("long").alias("offset"),
        column(timestamp, "timestamp").cast("timestamp").alias("timestamp"),
        column(key, "string").alias("key"),
        column(value, "string").alias("value"),
        column(headers, HEADERS).cast(HEADERS).alias("headers"),
    )


def kafka_changes(spark: SparkSession, servers: str, topics: str, **options: str) -> DataFrame:
    """The envelope of a log, key and value as text. The log's connector is deployed with Spark, not with this package."""
    read = spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers).option("subscribe", topics).option("includeHeaders", "true").options(**options).load()
    return as_changes(read, topic="topic", partition="partition", offset="offset", timestamp="timestamp", key=F.col("key").cast("string"), value=F.col("value").cast("string"), headers="headers")


def file_changes(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int = 1) -> DataFrame:
    """A stream of parquet files as they come into a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def decode_json(changes: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The value from JSON text; what does not parse is null fields, as from_json has it."""
    return changes.withColumn("value", F.from_json("value", schema))


def decode_variant(changes: DataFrame) -> DataFrame:
    """The value from JSON text without a schema; null where it is no JSON."""
    return changes.withColumn("value", F.try_parse_json("value"))


def decode_text(changes: DataFrame) -> DataFrame:
    """The value as plain text: no document, so object checks reject it."""
    return changes.withColumn("value", F.col("value").cast("string"))
