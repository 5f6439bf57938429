"""Many writes to one document become its state.

Arrival is (topic, partition, offset). All winners are found by min_by and max_by, which combine before the
shuffle: an id with very many writes is one row from each task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import order, tree

ID = ["resource", "id"]
ARRIVAL = ("topic", "partition", "offset")


def _rest(actions: DataFrame) -> list[str]:
    return [c for c in actions.columns if c not in ID]


def latest_wins(actions: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """For each id the write of the greatest version; of equal versions the first to arrive. Deletes are kept as tombstones."""
    won = F.min_by(F.struct(*_rest(actions)), F.struct((-F.col("version")).alias("v"), *arrival)).alias("won")
    return actions.groupBy(*ID).agg(won).select(*ID, "won.*")


def live(state: DataFrame) -> DataFrame:
    """The state without tombstones. They must stay in what is stored, or an older write would bring the document back."""
    return state.where("op <> 'delete'")


def merge_partial(actions: DataFrame, fields: Sequence[str], arrival: Sequence[str] = ARRIVAL, present: dict[str, Column] | None = None) -> DataFrame:
    """For each id the last value of each field after its last delete. A field counts where `present` says so (else always).

    The columns named in `fields` are top-level; nested ones are to be flattened before. All is one aggregate, so an id with
    very many writes is one row from each task.
    """
    at, write = F.struct(*arrival), F.col("op") != "delete"
    last = [F.max_by(F.struct(at.alias("at"), F.col(f).alias("v")), F.when(write & (present or {}).get(f, F.lit(True)), at)).alias(f) for f in fields]
    found = actions.groupBy(*ID).agg(F.max(F.when(~write, at)).alias("deleted"), F.max(F.when(write, at)).alias("written"), *last)
    after = lambda x: F.col("deleted").isNull() | (x > F.col("deleted"))
    return found.where(F.col("written").isNotNull() & after(F.col("written"))).select(*ID, *(F.when(after(F.col(f)["at"]), F.col(f)["v"]).alias(f) for f in fields))


def _merged_json(actions: DataFrame, text: str, arrival: Sequence[str], rest: Sequence[str] = ()) -> DataFrame:
    """By id: written and deleted (its last write and delete), row (the columns `rest` of the last of both), merged JSON text.

    Objects merge at every depth; a scalar, null or array takes the place of all below it. A write is an object at the root, a
    delete a leaf there. By path the last to arrive are found by one aggregate; only nodes, with their time of arrival, are gathered.
    """
    at = F.struct(*arrival)
    write = F.col("op") != "delete"
    rows = actions.select(*ID, at.alias("at"), write.alias("write"), F.when(write, F.col(text)).alias("text"), F.struct(F.lit(0).alias("none"), *rest).alias("row"))
    found = tree.nodes(rows, F.col("text"), max(1, tree.levels_of(rows, "text")), once=["row"])
    root = F.size(tree.PATH) == 0
    opened = F.when(F.when(root, F.col("write")).otherwise(F.col(tree.OBJECT)), F.col("at"))
    last = F.when(~F.when(root, F.col("write")).otherwise(F.col(tree.OBJECT)), F.col("at"))
    by_path = found.groupBy(*ID, tree.PATH).agg(F.max(last).alias("last"), F.max(opened).alias("opened"), F.max_by(tree.VALUE, last).alias(tree.VALUE), F.max_by("row", F.when(root, F.col("at"))).alias("row"))
    entry = F.struct(tree.PATH, "last", "opened", tree.VALUE)
    # The nodes of one document; the root comes first.
    by_id = by_path.groupBy(*ID).agg(F.sort_array(F.collect_list(entry)).alias("entries"), F.max_by("row", F.when(root, 1)).alias("row"))
    top = F.element_at("entries", 1)
    below = F.slice("entries", 2, F.size("entries"))
    return by_id.select(*ID, "row", top["last"].alias("deleted"), top["opened"].alias("written"), tree.written(below, top["last"]).alias("merged"))


def merge_partial_json(actions: DataFrame, text: str = "doc", arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """The same for free-form JSON objects, at every depth: explicit nulls overwrite, absent fields do not. An id that has only {} stays, as {}."""
    found = _merged_json(actions, text, arrival).where("written is not null and (deleted is null or written > deleted)")
    return found.select(*ID, F.col("merged").alias(text))


def upserts(actions: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """State of partial writes: the actions' columns, doc_json being merged and doc read from it. A last delete stays as a tombstone."""
    rest = [c for c in _rest(actions) if c not in ("doc", "doc_json")]
    found = _merged_json(actions, "doc_json", arrival, rest)
    alive = F.col("written").isNotNull() & (F.col("deleted").isNull() | (F.col("written") > F.col("deleted")))
    kind = actions.schema["doc"].dataType
    doc = F.col("merged") if isinstance(kind, T.StringType) else F.from_json("merged", kind)
    own = {"doc_json": F.when(alive, F.col("merged")), "doc": F.when(alive, doc)}
    return found.select(*ID, *(own[c].alias(c) if c in own else F.col("row")[c].alias(c) for c in _rest(actions) if c not in arrival or c in ARRIVAL))


def first_create_wins(actions: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    won = F.min_by(F.struct(*_rest(actions)), F.struct(*arrival)).alias("won")
    return actions.groupBy(*ID).agg(won).select(*ID, "won.*")


def keep_one(actions: DataFrame, arrival: Sequence[str] = ARRIVAL) -> DataFrame:
    """Ids that name a position: what comes again is the same."""
    return actions.dropDuplicates(ID)


def append(state: DataFrame | None, actions: DataFrame) -> DataFrame:
    """Each write its own document; positional ids make replays harmless."""
    return (actions if state is None else state.unionByName(actions)).dropDuplicates(ID)


def stale_report(actions: DataFrame) -> DataFrame:
    """(resource, n_stale): writes that are not the state's. Ids are counted before the shuffle."""
    by_id = actions.groupBy(*ID).agg(F.count("*").alias("n"))
    return by_id.groupBy("resource").agg(F.sum(F.col("n") - 1).alias("n_stale"))


def refused(actions: DataFrame, arrival: Sequence[str] = ARRIVAL, block: int = order.BLOCK) -> DataFrame:
    """Writes that a target refuses as they arrive: of a version no greater than one before. Maxima are scanned by blocks of offsets, so a hot id is no single task."""
    found = order.scanned(actions, ID, arrival, {"version_before": (F.max, F.greatest, "version")}, block)
    return found.where("version <= version_before").select(*actions.columns)


def apply_batch(state: DataFrame, actions: DataFrame, resolve=latest_wins) -> DataFrame:
    """state and new actions to the new state; documents that the batch does not touch are not resolved again.

    What is in the state arrived before what is new.
    """
    touched = actions.select(*ID).distinct().withColumn("touched", F.lit(True))
    marked = state.join(touched, ID, "left")
    again = marked.where("touched").drop("touched").withColumn("turn", F.lit(0)).unionByName(actions.withColumn("turn", F.lit(1)))
    return marked.where("touched is null").drop("touched").unionByName(resolve(again, ("turn", *ARRIVAL)).select(state.columns))
