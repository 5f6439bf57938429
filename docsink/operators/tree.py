"""JSON documents as rows, one for each node, and back.

A node is an object, or a leaf: a scalar, null or array. Its path is the array of names that lead to it; the root's is empty.
Documents are opened level by level, in one pass with as many generators as the deepest document has levels.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Columns of a node; `object` is false for leaves.
PATH, VALUE, OBJECT = "path", "leaf", "object"


def depth_of(text: Column, arrays: bool = False) -> Column:
    """How deep objects, with `arrays` objects and arrays, are nested in JSON text, also within arrays; names and strings don't count."""
    bare = F.regexp_replace(F.regexp_replace(text, r"\\.", ""), '"[^"]*"', "")
    kept = F.translate(bare, "[]", "{}") if arrays else bare
    braces = F.split(F.regexp_replace(kept, "[^{}]", ""), "")
    zero = F.struct(F.lit(0).alias("now"), F.lit(0).alias("most"))

    def step(s: Column, c: Column) -> Column:
        now = s["now"] + F.when(c == "{", 1).when(c == "}", -1).otherwise(0)
        return F.struct(now.alias("now"), F.greatest(s["most"], now).alias("most"))

    return F.coalesce(F.aggregate(braces, zero, step)["most"], F.lit(0))


def levels_of(docs: DataFrame, text: str, arrays: bool = False) -> int:
    """Levels of the deepest document: a pass over the texts."""
    return docs.agg(F.max(depth_of(F.col(text), arrays))).first()[0] or 0


def nodes(docs: DataFrame, text: Column, levels: int, once: list[str] = (), arrays: bool = False) -> DataFrame:
    """docs without `text`, a row for each node of the text, with path, leaf (JSON text, null for objects) and object.

    A text that is null or no JSON object is a root alone, with object false and no leaf. The columns `once` are on the root's row alone.
    With `arrays` an array is not a leaf: each of its elements is a node of the array's path.
    """
    parsed = F.try_parse_json(text)
    root = F.try_variant_get(parsed, "$", "map<string, variant>")
    kept = [c for c in docs.columns if c not in once]
    open_node = lambda path, v, o: F.struct(path.alias(PATH), v.alias("v"), F.lit(True).alias("opened"), o.alias(OBJECT), *(F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in once))
    rows = docs.select(*kept, F.array().cast("array<string>").alias(PATH), F.when(root.isNotNull(), parsed).alias("v"), F.lit(True).alias("opened"), F.lit(False).alias(OBJECT), *once)
    for _ in range(levels):
        inner = F.try_variant_get("v", "$", "map<string, variant>")
        own = F.struct(PATH, F.lit(None).cast("variant").alias("v"), F.lit(False).alias("opened"), F.lit(True).alias(OBJECT), *once)
        children = F.transform(F.map_entries(inner), lambda e: open_node(F.concat(F.col(PATH), F.array(e["key"])), e["value"], F.lit(False)))
        same = F.struct(PATH, "v", F.lit(False).alias("opened"), OBJECT, *once)
        made = F.when(F.col("opened") & inner.isNotNull(), F.concat(F.array(own), children))
        if arrays:
            elements = F.try_variant_get("v", "$", "array<variant>")
            made = made.when(F.col("opened") & elements.isNotNull(), F.transform(elements, lambda v: open_node(F.col(PATH), v, F.lit(False))))
        rows = rows.select(*kept, F.explode(made.otherwise(F.array(same))).alias("node")).select(*kept, "node.*")
    return rows.select(*kept, *once, PATH, F.to_json("v").alias(VALUE), OBJECT)


def leaves(docs: DataFrame, text: str) -> DataFrame:
    """docs without `text`, a row for each leaf below the root, with path and leaf. Objects without fields have none."""
    rest = [c for c in docs.columns if c != text]
    found = nodes(docs, F.col(text), levels_of(docs, text))
    return found.where(~F.col(OBJECT) & (F.size(PATH) > 0)).select(*rest, PATH, VALUE)


def written(entries: Column, cut: Column) -> Column:
    """The JSON text of a tree from its nodes, an array of (path, last, opened, leaf) sorted by path, the root left out.

    last: when the node was last written as a leaf, with that leaf; opened: when last as an object. A node counts as what it was
    written as last, if none above it became a leaf after that; `cut` is when all was last cleared, or null.
    """
    later = lambda a, b: a.isNotNull() & (b.isNull() | (a > b))
    start = F.struct(F.array().cast("array<string>").alias("pieces"), F.lit(0).alias("open"), F.lit(True).alias("fresh"), F.array(cut).alias("cuts"))

    def step(s: Column, e: Column) -> Column:
        n = F.size(e[PATH])
        above = F.element_at(s["cuts"], n)
        is_object = later(e["opened"], e["last"]) & later(e["opened"], above)
        is_leaf = ~later(e["opened"], e["last"]) & later(e["last"], above)
        closing = s["open"] - (n - 1)
        name = F.to_json(F.array(F.element_at(e[PATH], -1)))
        piece = F.concat(
            F.repeat(F.lit("}"), closing), F.when(s["fresh"] & (closing == 0), "").otherwise(","), F.substr(name, F.lit(2), F.length(name) - 2), F.lit(":"), F.when(is_object, "{").otherwise(e[VALUE])
        )
        shown = is_object | is_leaf
        return F.struct(
            F.when(shown, F.concat(s["pieces"], F.array(piece))).otherwise(s["pieces"]).alias("pieces"),
            F.when(shown, n - 1 + is_object.cast("int")).otherwise(s["open"]).alias("open"),
            F.when(shown, is_object).otherwise(s["fresh"]).alias("fresh"),
            F.concat(F.slice(s["cuts"], 1, n), F.array(F.when(later(e["last"], above), e["last"]).otherwise(above))).alias("cuts"),
        )

    return F.aggregate(entries, start, step, lambda s: F.concat(F.lit("{"), F.array_join(s["pieces"], ""), F.repeat(F.lit("}"), s["open"] + 1)))
