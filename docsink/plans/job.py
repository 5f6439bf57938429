"""Change records to actions, by the options."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import checks, project, resolve, route
from ..options import Options


def _version(options: Options) -> Column:
    keyed = F.lit(not options.key_ignore and not options.is_stream and options.write_method == "insert")
    if options.topic_key_ignore:
        keyed = keyed & ~F.col("topic").isin(*options.topic_key_ignore)
    if options.version_header and not options.is_stream:
        return F.when(keyed, project.version_from_header(F.col("headers"), options.version_header))
    return project.version_from_offset(keyed)


def tagged(changes: DataFrame, options: Options) -> DataFrame:
    """Routed changes with a reason where they can't be written."""
    out = checks.tag(route.route(changes, options), options)
    reason = F.coalesce("reason", F.when(F.col("resource").isNull(), checks.NO_RESOURCE))
    if options.version_header and not options.key_ignore and not options.is_stream:
        reason = F.coalesce(reason, F.when(project.version_from_header(F.col("headers"), options.version_header).isNull(), checks.BAD_VERSION))
    return out.withColumn("reason", reason)


def actions(accepted: DataFrame, options: Options) -> DataFrame:
    """One action for each accepted change: resource, id, op, version, doc, doc_json and the position.

    The columns `reason` and `stops` stay, if there are any. doc_json is what is written: of a topic whose schema is ignored the value as it came, else its normalised form, and for
    data streams with @timestamp, also where the value is JSON text.
    """
    kind = accepted.schema["value"].dataType
    text_kind = isinstance(kind, T.StringType)
    timed = options.is_stream and isinstance(kind, T.StructType)

    def with_time(doc: Column) -> Column:
        if not timed:
            return doc
        return project.event_time_from_field(doc, kind, options.timestamp_fields) if options.timestamp_fields else project.event_time_from_record(doc, F.col("timestamp"))

    raw = F.col("value")
    if options.is_stream and text_kind:
        raw = project.event_time_in_json(raw, F.col("timestamp"), options.timestamp_fields)
    doc = with_time(raw if options.schema_ignore or text_kind else project.normalise(raw, kind, options.compact_map_entries))
    text = F.col("doc") if text_kind else project.to_document(F.col("doc"))
    if options.topic_schema_ignore and not text_kind:
        text = F.when(F.col("topic").isin(*options.topic_schema_ignore), project.to_document(with_time(F.col("value")))).otherwise(text)
    own = ["resource", project.doc_id(options).alias("id"), project.write_op(F.col("value"), options).alias("op"), _version(options).alias("version"), doc.alias("doc"), "topic", "partition", "offset", "timestamp"]
    own += [c for c in ("reason", "stops") if c in accepted.columns]
    return (
        accepted.select(*own, "value")
        .withColumn("version_type", F.when(F.col("version").isNotNull(), "external").otherwise("internal"))
        .withColumn("doc_json", F.when(F.col("op") != "delete", text))
        .drop("value")
    )


def resolver(options: Options):
    """How actions become state under these options: a function of the actions and the columns of their arrival."""
    if options.is_stream:
        return resolve.first_create_wins
    if options.write_method == "upsert":
        return resolve.upserts
    if options.key_ignore:
        return resolve.keep_one
    return resolve.latest_wins


def split_malformed(fresh: DataFrame, options: Options) -> tuple[DataFrame, DataFrame | None]:
    """(to write, malformed) by the declared fields of the target, as it would answer; deletes carry no document."""
    if not options.declared_fields:
        return fresh, None
    checked = checks.conforms(fresh, options.declared_fields, "doc_json", strict=options.declared_strict)
    written, reported = checks.malformed(checked.where("op <> 'delete'"), options.malformed_policy)
    return written.select(fresh.columns).unionByName(fresh.where("op = 'delete'")), reported
