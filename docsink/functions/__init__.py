"""Column functions on documents as JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

OBJECT = "map<string, variant>"


def json_fields(text: Column) -> Column:
    """The top-level fields of a JSON object; null where the text is none."""
    return F.when(F.schema_of_variant(F.try_parse_json(text)).startswith("OBJECT"), F.try_parse_json(text)).cast(OBJECT)


def json_put(text: Column, name: str, value: Column) -> Column:
    """The JSON object with one field set, other fields as they are. Where value is null, or the text is no object, the text as it is."""
    others = F.map_filter(json_fields(text), lambda k, _: k != name)
    return F.coalesce(F.when(value.isNotNull(), F.to_json(F.map_concat(others, F.create_map(F.lit(name), value.cast("variant"))))), text)
