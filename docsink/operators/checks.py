"""Checks add to one `reason` column; a policy turns reasons into rejects or a failure."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import OBJECT
from .project import record_position

KEY_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType)
NULL_VALUE, NULL_KEY, EMPTY_KEY, NO_OBJECT, MISSING, NO_RESOURCE, BAD_VERSION = "null value", "null key", "empty key", "not an object", "null in a required field", "topic without resource", "bad version"
MALFORMED = "malformed document"


class InvalidRecords(ValueError):
    """Rows that the options do not allow to skip."""


def ignore_nulls(changes: DataFrame) -> DataFrame:
    return changes.where("value is not null")


def drop_keyless_tombstones(changes: DataFrame) -> DataFrame:
    return changes.where("not (value is null and key is null)")


def fail_on_nulls(value: Column) -> Column:
    """The value, or the end of the job where it is null."""
    return F.when(value.isNull(), F.raise_error(F.concat(F.lit("null value: "), record_position()))).otherwise(value)


def check_key_type(kind: T.DataType) -> None:
    if not isinstance(kind, KEY_TYPES):
        raise ValueError(f"{kind.simpleString()} can't be a document id")


def key_reason(key: Column) -> Column:
    return F.when(key.isNull(), NULL_KEY).when(key.cast("string") == "", EMPTY_KEY)


def object_reason(value: Column) -> Column:
    """For JSON text: what is no object."""
    kind = F.schema_of_variant(F.try_parse_json(value))
    return F.when(value.isNotNull() & ~F.coalesce(kind.startswith("OBJECT"), F.lit(False)), NO_OBJECT)


def require_object(kind: T.DataType, compact: bool = True) -> None:
    if not (isinstance(kind, T.StructType) or (isinstance(kind, T.MapType) and compact and isinstance(kind.keyType, T.StringType))):
        raise ValueError(f"a data stream needs objects, not {kind.simpleString()}")


def missing_required(col: Column, kind: T.DataType) -> Column:
    """True where a field that is required (metadata `required`) and has no default is null, at any depth."""
    found = F.lit(False)
    if isinstance(kind, T.StructType):
        for f in kind.fields:
            meta = f.metadata or {}
            if meta.get("required") and meta.get("default") is None:
                found = found | col[f.name].isNull()
            if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)):
                found = found | missing_required(col[f.name], f.dataType)
    elif isinstance(kind, T.ArrayType) and isinstance(kind.elementType, (T.StructType, T.ArrayType, T.MapType)):
        found = F.exists(col, lambda x: missing_required(x, kind.elementType))
    elif isinstance(kind, T.MapType) and isinstance(kind.valueType, (T.StructType, T.ArrayType, T.MapType)):
        found = F.exists(F.map_values(col), lambda x: missing_required(x, kind.valueType))
    return col.isNotNull() & F.coalesce(found, F.lit(False))


def tag(changes: DataFrame, options) -> DataFrame:
    """changes (topic, partition, offset, key, value) with `reason`, null where a row is fine.

    Null values are rejected when they are ignored; with `delete` they need no reason. Keys are checked where they
    make the id. Tombstones without a key are left out when nulls delete: there is nothing to delete.
    """
    if options.null_policy == "delete":
        changes = drop_keyless_tombstones(changes)
    reason = F.lit(None).cast("string")
    if options.null_policy != "delete":
        reason = F.when(F.col("value").isNull(), NULL_VALUE)
    if not options.key_ignore:
        check_key_type(changes.schema["key"].dataType)
        own = key_reason(F.col("key"))
        if options.topic_key_ignore:
            own = F.when(~F.col("topic").isin(*options.topic_key_ignore), own)
        reason = F.coalesce(reason, own)
    kind = changes.schema["value"].dataType
    if options.is_stream and isinstance(kind, T.StringType):
        reason = F.coalesce(reason, object_reason(F.col("value")))
    elif options.is_stream:
        require_object(kind, options.compact_map_entries)
    if isinstance(kind, T.StructType) and not options.schema_ignore:
        missing = missing_required(F.col("value"), kind)
        if options.topic_schema_ignore:
            missing = missing & ~F.col("topic").isin(*options.topic_schema_ignore)
        reason = F.coalesce(reason, F.when(missing, MISSING))
    return changes.withColumn("reason", reason)


def rejects(tagged: DataFrame) -> DataFrame:
    return tagged.where("reason is not null").withColumn("position", record_position())


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.where("reason is null").drop("reason")


def fatal(options) -> Column:
    """Whether a row's reason must stop the job under these options."""
    reason = F.col("reason")
    allowed = F.lit(False)
    if options.null_policy == "ignore":
        allowed = allowed | (reason == NULL_VALUE)
    if options.drop_invalid:
        allowed = allowed | (reason != NULL_VALUE if options.null_policy == "fail" else F.lit(True))
    return reason.isNotNull() & ~allowed


def stop_if_invalid(tagged: DataFrame, options) -> None:
    """Raises unless the options allow what was rejected. Call it after the rejects are written."""
    first = tagged.where(fatal(options)).select("reason", record_position().alias("position")).first()
    if first:
        raise InvalidRecords(f"{first['reason']}: {first['position']}")


def stop_if_malformed(bad: DataFrame, options) -> None:
    """Raises on the first malformed document if the policy is to fail. Call it after they are written."""
    first = bad.select(record_position().alias("position")).first() if options.malformed_policy == "fail" else None
    if first:
        raise InvalidRecords(f"{MALFORMED}: {first['position']}")


def _against(node: Column, declared: dict, strict: bool, prefix: str = "") -> tuple[Column, Column]:
    """(unknown, bad): the paths below a VARIANT object that the declared tree doesn't have, and those whose values don't fit it."""
    none = F.array().cast("array<string>")
    fields = F.try_variant_get(node, "$", OBJECT)
    unknown, bad = [none], [none]
    if strict:
        others = F.filter(F.map_keys(fields), lambda k: ~k.isin(*declared)) if declared else F.map_keys(fields)
        unknown.append(F.transform(others, lambda k: F.concat(F.lit(prefix), k)))
    for name, kind in declared.items():
        child = F.try_element_at(fields, F.lit(name))
        values = F.filter(F.coalesce(F.try_variant_get(child, "$", "array<variant>"), F.array(child)), lambda x: x.isNotNull() & ~F.is_variant_null(x))
        if isinstance(kind, dict):
            found = F.transform(values, _fields_against(kind, strict, f"{prefix}{name}."))
            unknown.append(F.flatten(F.transform(found, lambda x: x["unknown"])))
            bad.append(F.flatten(F.transform(found, lambda x: x["bad"])))
        bad.append(F.when(F.exists(values, _unfit(kind)), F.array(F.lit(prefix + name))).otherwise(none))
    return tuple(F.array_distinct(F.concat(*(F.coalesce(x, none) for x in own))) for own in (unknown, bad))


def _fields_against(declared: dict, strict: bool, prefix: str):
    def of(node: Column) -> Column:
        unknown, bad = _against(node, declared, strict, prefix)
        return F.struct(unknown.alias("unknown"), bad.alias("bad"))

    return of


def _unfit(kind: str | dict):
    """Whether a value is no object where one is declared, or one where a type is, or can't be of that type."""

    def of(node: Column) -> Column:
        is_object = F.try_variant_get(node, "$", OBJECT).isNotNull()
        return ~is_object if isinstance(kind, dict) else is_object | F.try_variant_get(node, "$", "string").try_cast(kind).isNull()

    return of


def conforms(docs: DataFrame, declared: dict, text: str = "doc", strict: bool = True) -> DataFrame:
    """docs with `unknown_fields` and `bad_fields`, by declared field -> Spark SQL type, or a dict of the fields of an object; JSON text in column `text`.

    Objects are walked at every depth, arrays count as each of their elements, nulls fit all. Names are whole names, dots and
    all; paths in the result are joined by dots. Where the text is null or no JSON object, `unknown_fields` is null.
    """
    parsed = F.try_parse_json(text)
    unknown, bad = _against(parsed, declared, strict)
    return docs.withColumn("unknown_fields", F.when(F.try_variant_get(parsed, "$", OBJECT).isNotNull(), unknown)).withColumn("bad_fields", bad)


def malformed(docs: DataFrame, policy: str) -> tuple[DataFrame, DataFrame]:
    """(written, reported) of rows with unknown_fields and bad_fields; with `fail` any reported row must stop the job.

    Every row is in one of them: a text that is no JSON object, whose unknown_fields are null, is reported.
    """
    wrong = F.col("unknown_fields").isNull() | (F.size("unknown_fields") > 0) | F.coalesce(F.size("bad_fields") > 0, F.lit(True))
    return docs.where(~wrong), docs.where(wrong).withColumn("processed", F.lit(policy != "fail")).withColumn("reported", F.lit(True)).withColumn("fatal", F.lit(policy == "fail"))
