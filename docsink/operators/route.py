"""Where a change goes: an index name, a data stream name, or an explicit resource."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAME_LENGTH, NAMESPACE_LENGTH, MAX_MAPPINGS = 255, 100, 15


def route_index(topic: Column) -> Column:
    """Lower case, cut, without one leading '-' or '_'; '.' and '..' spelled out."""
    name = F.regexp_replace(F.substring(F.lower(topic), 1, NAME_LENGTH), "^[-_]", "")
    return F.when(name.isin(".", ".."), F.replace(name, F.lit("."), F.lit("dot"))).otherwise(name)


def route_stream(topic: Column, stream_type: str, dataset: str, namespace: str = "${topic}") -> Column:
    own = F.substring(F.replace(F.lit(namespace), F.lit("${topic}"), F.lower(topic)), 1, NAMESPACE_LENGTH)
    return F.concat_ws("-", F.lit(stream_type.lower()), F.lit(dataset), own)


def route_by_time(topic: Column, timestamp: Column, template: str, pattern: str) -> Column:
    """A template of ${topic} and ${timestamp}, then named as an index."""
    filled = F.replace(F.replace(F.lit(template), F.lit("${topic}"), topic), F.lit("${timestamp}"), F.date_format(timestamp, pattern))
    return route_index(filled)


def route_map(changes: DataFrame, mapping: dict[str, str], most: int = MAX_MAPPINGS) -> DataFrame:
    """changes with the resource that the mapping (at most `most` topics) gives its topic; null where it has none."""
    if len(mapping) > most:
        raise ValueError(f"at most {most} topics can be mapped")
    known = changes.sparkSession.createDataFrame(sorted(mapping.items()), "topic string, resource string")
    return changes.join(F.broadcast(known), "topic", "left")


def route(changes: DataFrame, options) -> DataFrame:
    """changes with `resource` by the one rule that the options choose."""
    if options.use_external_resources:
        return route_map(changes, options.topic_resources, options.max_mappings)
    if options.is_stream:
        return changes.withColumn("resource", route_stream(F.col("topic"), options.stream_type, options.stream_dataset, options.stream_namespace))
    return changes.withColumn("resource", route_index(F.col("topic")))


def targets(actions: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Each resource that the actions need, once, without those known already."""
    needed = actions.select("resource").distinct()
    return needed if known is None else needed.join(known.select("resource"), "resource", "left_anti")


def unexpected_topics(changes: DataFrame, assigned: DataFrame) -> DataFrame:
    """Changes of a (topic, partition) that is not assigned to this job."""
    return changes.join(assigned.select("topic", "partition"), ["topic", "partition"], "left_anti")
