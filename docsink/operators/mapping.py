"""Field mappings from schemas."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tree

# The target's name of each type, and the length up to which a text is a keyword.
TYPES = {
    T.BooleanType: "boolean",
    T.ByteType: "byte",
    T.ShortType: "short",
    T.IntegerType: "integer",
    T.LongType: "long",
    T.FloatType: "float",
    T.DoubleType: "double",
    T.StringType: "text",
    T.BinaryType: "binary",
    T.DecimalType: "double",
    T.DateType: "date",
    T.TimestampType: "date",
    T.TimestampNTZType: "date",
}
KEYWORD_LENGTH = 256
ROWS = "path string, type string, keyword_ignore_above int, null_value string"


def target_type(kind: T.DataType) -> str:
    if isinstance(kind, getattr(T, "TimeType", ())):
        return "date"
    for own, name in TYPES.items():
        if isinstance(kind, own):
            return name
    raise ValueError(f"invalid type {kind.simpleString()}")


def _null_value(name: str, default):
    if default is None or name in ("text", "binary"):
        return None
    if name == "date" and isinstance(default, str):
        return int(dt.datetime.fromisoformat(default).replace(tzinfo=dt.timezone.utc).timestamp() * 1000)
    return float(default) if name in ("double", "float") else default


def field_mapping(kind: T.DataType, compact: bool = True, default=None) -> dict:
    """The mapping of one type as nested objects. Arrays map as their element; a compact map is an open object."""
    if isinstance(kind, T.ArrayType):
        return field_mapping(kind.elementType, compact)
    if isinstance(kind, T.MapType):
        if compact and isinstance(kind.keyType, T.StringType):
            return {"type": "object"}
        return {"properties": {"key": field_mapping(kind.keyType, compact), "value": field_mapping(kind.valueType, compact)}}
    if isinstance(kind, T.StructType):
        return {"properties": {f.name: field_mapping(f.dataType, compact, (f.metadata or {}).get("default")) for f in kind.fields}}
    name = target_type(kind)
    out: dict = {"type": name}
    if name == "text":
        out["fields"] = {"keyword": {"type": "keyword", "ignore_above": KEYWORD_LENGTH}}
    null_value = _null_value(name, default)
    return out if null_value is None else out | {"null_value": null_value}


def mapping_json(schema: T.StructType, compact: bool = True) -> str:
    return json.dumps(field_mapping(schema, compact))


def mapping_rows(schema: T.StructType, compact: bool = True) -> list[tuple]:
    rows: list[tuple] = []

    def walk(own: dict, path: str) -> None:
        if path:
            null_value = own.get("null_value")
            keyword = own.get("fields", {}).get("keyword", {}).get("ignore_above")
            rows.append((path, own.get("type", "object"), keyword, None if null_value is None else json.dumps(null_value)))
        for name, inner in own.get("properties", {}).items():
            walk(inner, f"{path}.{name}" if path else name)

    walk(field_mapping(schema, compact), "")
    return rows


def mapping_table(spark: SparkSession, schema: T.StructType, compact: bool = True) -> DataFrame:
    """(path, type, keyword_ignore_above, null_value), one row for each field, objects before their fields."""
    return spark.createDataFrame(mapping_rows(schema, compact), ROWS)


def mappings_of(targets: DataFrame, schema: T.StructType, compact: bool = True) -> DataFrame:
    """The rows of mapping_table for each resource."""
    names = [x.split()[0] for x in ROWS.split(", ")]
    rows = [F.struct(*(F.lit(v).cast(k.split()[1]).alias(n) for v, k, n in zip(r, ROWS.split(", "), names, strict=True))) for r in mapping_rows(schema, compact)]
    return targets.select("resource", F.explode(F.array(*rows)).alias("m")).select("resource", "m.*")


def unmapped(targets: DataFrame, mapped: DataFrame) -> DataFrame:
    """Resources that have no mapping yet: each gets one, once."""
    return targets.select("resource").distinct().join(mapped.select("resource"), "resource", "left_anti")


def infer_fields(docs: DataFrame, text: str = "doc") -> DataFrame:
    """(resource, field, n, type): the fields that the JSON documents of each resource have, and their common type."""
    fields = docs.select("resource", F.explode(F.expr(f"cast(try_parse_json({text}) as map<string, variant>)")).alias("field", "v"))
    return fields.groupBy("resource", "field").agg(F.count("*").alias("n"), F.schema_of_variant_agg("v").alias("type"))


#: Kinds of JSON values, as bits that are joined.
KINDS = {"boolean": 1, "bigint": 2, "double": 4, "string": 8, "object": 16}


def infer_tree(docs: DataFrame, text: str = "doc") -> DataFrame:
    """(resource, path, n, type, conflict): the fields at every depth that the JSON documents of each resource have.

    path is an array of names; arrays count as each of their elements. Whole numbers and others are double together; of other kinds that
    don't go together type is null and conflict true; a field that is null throughout is `null`. n counts values. A path's kinds are
    bits, joined in each task before the shuffle.
    """
    rows = docs.select("resource", F.col(text).alias("text"))
    found = tree.nodes(rows, F.col("text"), tree.levels_of(rows, "text", arrays=True), arrays=True).where(F.size(tree.PATH) > 0)
    name = F.schema_of_variant(F.try_parse_json(tree.VALUE))
    kind = F.when(F.col(tree.OBJECT), KINDS["object"]).when(name == "BOOLEAN", KINDS["boolean"]).when(name == "BIGINT", KINDS["bigint"]).when(name.rlike("^(DOUBLE|DECIMAL|FLOAT)"), KINDS["double"]).when(name == "STRING", KINDS["string"]).otherwise(0)
    merged = found.select("resource", tree.PATH, kind.alias("kind")).groupBy("resource", tree.PATH).agg(F.count("*").alias("n"), F.bit_or("kind").alias("kinds"))
    both = KINDS["bigint"] | KINDS["double"]
    made = F.when(F.col("kinds") == 0, "null").when(F.col("kinds") == both, "double")
    for own, bit in KINDS.items():
        made = made.when(F.col("kinds") == bit, own)
    return merged.select("resource", tree.PATH, "n", made.alias("type")).withColumn("conflict", F.col("type").isNull())
