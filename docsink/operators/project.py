"""From key, value, headers and position to id, document, version and operation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import json_fields, json_put


def doc_id_from_key(key: Column) -> Column:
    return key.cast("string")


def doc_id_from_position(topic: Column | str = "topic", partition: Column | str = "partition", offset: Column | str = "offset") -> Column:
    return F.concat_ws("+", *(F.col(x).cast("string") if isinstance(x, str) else x.cast("string") for x in (topic, partition, offset)))


def doc_id(options, key: str = "key") -> Column:
    """The key's text, or the position where keys are ignored; null where the target is to choose."""
    if options.generated_ids and options.write_method == "insert" and options.key_ignore:
        return F.lit(None).cast("string")
    if options.key_ignore:
        return doc_id_from_position()
    own = doc_id_from_key(F.col(key))
    return F.when(F.col("topic").isin(*options.topic_key_ignore), doc_id_from_position()).otherwise(own) if options.topic_key_ignore else own


def doc_id_generated() -> Column:
    """A new id for each row and run; for state that is written here instead of at a target."""
    return F.uuid()


def _default(field: T.StructField):
    return (field.metadata or {}).get("default")


def normalise(col: Column, kind: T.DataType, compact: bool = True, default=None) -> Column:
    """The value in the form that documents have, at any depth.

    Nulls with a declared default take it first; decimals become doubles, times numbers (milliseconds), maps with keys
    that are no text, or all maps without `compact`, arrays of {key, value}. A null struct stays null.
    """
    if default is not None:
        col = F.coalesce(col, F.lit(default).cast(kind))
    if isinstance(kind, T.DecimalType):
        return col.cast("double")
    if isinstance(kind, (T.DateType, T.TimestampNTZType)):
        return F.unix_millis(col.cast("timestamp"))
    if isinstance(kind, T.TimestampType):
        return F.unix_millis(col)
    if isinstance(kind, getattr(T, "TimeType", ())):
        return (col.cast("decimal(14,6)") * 1000).cast("long")
    if isinstance(kind, T.ArrayType):
        return F.transform(col, lambda x: normalise(x, kind.elementType, compact))
    if isinstance(kind, T.MapType):
        if compact and isinstance(kind.keyType, T.StringType):
            return F.transform_values(col, lambda _, v: normalise(v, kind.valueType, compact))
        return F.transform(F.map_entries(col), lambda e: F.struct(normalise(e["key"], kind.keyType, compact).alias("key"), normalise(e["value"], kind.valueType, compact).alias("value")))
    if isinstance(kind, T.StructType):
        own = F.struct(*(normalise(col[f.name], f.dataType, compact, _default(f)).alias(f.name) for f in kind.fields))
        return F.when(col.isNotNull(), own)
    if isinstance(kind, (T.NullType, T.VariantType, T.DayTimeIntervalType, T.YearMonthIntervalType)):
        raise ValueError(f"{kind.simpleString()} can't be part of a document")
    return col


def to_document(col: Column) -> Column:
    """JSON text; nulls are written."""
    return F.to_json(col, {"ignoreNullFields": "false"})


def event_time_from_record(doc: Column, timestamp: Column) -> Column:
    """The document with @timestamp set to the record's time in milliseconds."""
    return doc.withField("`@timestamp`", F.unix_millis(timestamp.cast("timestamp")))


def event_time_from_field(doc: Column, kind: T.StructType, fields: Sequence[str]) -> Column:
    """The document with @timestamp as the text of the first listed field that it has and that is not null; without any listed field it stays as it is."""
    names = [f for f in fields if f in kind.fieldNames()]
    return doc.withField("`@timestamp`", F.coalesce(*(doc[f].cast("string") for f in names))) if names else doc


def event_time_of_json(text: Column, fields: Sequence[str]) -> Column:
    """The same for documents as JSON text: the first listed top-level field that is present and not null, or null. A name is a whole name, dots and all."""
    own = json_fields(text)
    return F.coalesce(*(F.try_variant_get(F.try_element_at(own, F.lit(f)), "$", "string") for f in fields))


def event_time_in_json(text: Column, timestamp: Column, fields: Sequence[str]) -> Column:
    """The JSON object with @timestamp from the listed fields, or if none are listed from the record's time."""
    return json_put(text, "@timestamp", event_time_of_json(text, fields) if fields else F.unix_millis(timestamp.cast("timestamp")))


def version_from_offset(keyed: Column, offset: Column | str = "offset") -> Column:
    return F.when(keyed, F.col(offset) if isinstance(offset, str) else offset)


def version_from_header(headers: Column, name: str) -> Column:
    """The last header of this name as a number; null where there is none or it is no number: a fatal reason."""
    own = F.filter(headers, lambda h: h["key"] == name)
    return F.try_element_at(own, F.lit(-1))["value"].cast("string").try_cast("bigint")


def write_op(value: Column, options) -> Column:
    other = "update" if options.write_method == "upsert" else "create" if options.is_stream else "index"
    return F.when(value.isNull(), "delete").otherwise(other)


# Fixed value: how messages name a record.
POSITION = "record from topic=%s partition=%s offset=%s"


def record_position() -> Column:
    """What messages name a record by: never its contents."""
    return F.format_string(POSITION, "topic", "partition", "offset")
