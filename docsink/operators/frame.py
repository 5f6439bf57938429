"""Bulk batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import order


def frame_by_count(actions: DataFrame, size: int, block: int = order.BLOCK) -> DataFrame:
    """actions with `batch`: each `size` of a log partition, in order. Places are counted by blocks of offsets, so a log partition is no single task."""
    placed = order.placed(actions, ["topic", "partition"], "offset", "frame_place", block)
    return placed.withColumn("batch", F.floor(F.col("frame_place") / size).cast("long")).select(*actions.columns, "batch")


def action_line(op: str = "op", resource: str = "resource", doc_id: str = "id", version: str | None = None):
    """The JSON line that names an action and its document."""
    inner = [F.col(resource).alias("_index"), F.col(doc_id).alias("_id")]
    if version:
        inner += [F.col(version).alias("version"), F.when(F.col(version).isNotNull(), F.lit("external")).alias("version_type")]
    made = F.to_json(F.struct(*inner))
    return F.concat(F.lit('{"'), F.col(op), F.lit('":'), made, F.lit("}"))


def bulk_lines(actions: DataFrame, doc: str = "doc_json", version: str | None = None) -> DataFrame:
    """(topic, partition, offset, line_no, line): an action line, and a document line unless it is a delete."""
    body = F.when(F.col("op") == "update", F.concat(F.lit('{"doc":'), F.col(doc), F.lit(',"doc_as_upsert":true}'))).otherwise(F.col(doc))
    lines = F.filter(F.array(action_line(version=version), F.when(F.col("op") != "delete", body)), lambda x: x.isNotNull())
    return actions.select("topic", "partition", "offset", F.posexplode(lines).alias("line_no", "line"))


def _numbers(sizes: np.ndarray, most_bytes: int, most_rows: int | None, held: int, rows: int) -> tuple[np.ndarray, int, int]:
    """Of rows in order, how many batches were closed before each; and what the open one holds then. Jumps from end to end."""
    total, closed, at = np.cumsum(sizes), [], 0
    while at < len(sizes):
        before = total[at - 1] if at else 0
        by_bytes = int(np.searchsorted(total, before + most_bytes - held)) if most_bytes != -1 else len(sizes)
        end = min(max(by_bytes, at), at + most_rows - rows - 1 if most_rows else len(sizes))
        if end >= len(sizes):
            held, rows = held + int(total[-1] - before), rows + len(sizes) - at
            break
        closed.append(end)
        at, held, rows = end + 1, 0, 0
    return np.searchsorted(np.array(closed, np.int64), np.arange(len(sizes))), held, rows


#: The columns by which a part of a log partition is told apart.
PART = ["topic", "partition", "frame_part"]
_TRANSITIONS = "topic string, partition int, frame_part long, entry long, entry_bytes long, exit long, closes long"


def _last_start(close: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For a batch that begins at each row of a part: where the batch that is open at the part's end began (the row count if none is), and how many closed.

    close: the row at which each would close. Pointers to the next batch are composed with themselves until all have come to the end.
    """
    n = len(close)
    there = np.append(np.where(close < n, close + 1, np.arange(n)), n)
    closed = np.append((close < n).astype(np.int64), 0)
    while True:
        further = there[there]
        if (further == there).all():
            return there, closed
        closed = closed + closed[there]
        there = further


def _transitions(most_bytes: int, most_rows: int | None):
    """Per part of a log partition, for each batch that may be open where it begins (and for none): the batch open at its end, and how many close in it."""

    def part(key: tuple, tail: np.ndarray, place: np.ndarray, before: np.ndarray, sizes: np.ndarray) -> pa.RecordBatch:
        own = ~tail
        n, first = int(own.sum()), int(place[own][0]) if own.any() else 0
        ends = before[own] + sizes[own]
        entries = np.append(place[tail], first) if n else np.zeros(0, np.int64)
        entry_bytes = np.append(before[tail], before[own][:1]) if n else np.zeros(0, np.int64)

        def closing(starts: np.ndarray, held: np.ndarray) -> np.ndarray:
            by_bytes = np.searchsorted(ends, held + most_bytes) if most_bytes != -1 else np.full(len(starts), n)
            at = np.maximum(by_bytes, starts - first)
            return np.maximum(np.minimum(at, starts - first + most_rows - 1) if most_rows else at, 0)

        last, closed = _last_start(closing(place[own], before[own]))
        at = closing(entries, entry_bytes)
        then = np.minimum(at + 1, n)
        exits = np.where(at < n, first + last[then], entries)
        columns = [pa.array([x] * len(entries), t) for x, t in zip(key, (pa.string(), pa.int32(), pa.int64()))]
        columns += [pa.array(x, pa.int64()) for x in (entries, entry_bytes, exits, np.where(at < n, 1 + closed[then], 0))]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in _TRANSITIONS.split(", ")])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, columns in _by_part(batches, ["frame_tail", "frame_place", "frame_bytes", "frame_size"]):
            yield part(key, *columns)

    return made


def _by_part(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[tuple, list[np.ndarray]]]:
    """The columns of each part, whose rows come one after the other."""
    key, held = None, []
    for batch in batches:
        keys = list(zip(*(batch.column(c).to_pylist() for c in PART)))
        cuts = [0, *(k for k in range(1, len(keys)) if keys[k] != keys[k - 1]), len(keys)]
        for i, j in zip(cuts, cuts[1:]):
            if i == j:
                continue
            if keys[i] != key:
                if held:
                    yield key, [np.concatenate(x) for x in zip(*held)]
                key, held = keys[i], []
            held.append([batch.column(c).slice(i, j - i).to_numpy(zero_copy_only=False) for c in names])
    if held:
        yield key, [np.concatenate(x) for x in zip(*held)]


def _chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each part's transitions the one that comes true, with the number of the batch that is open where the part begins."""
    key, at, number, done = None, 0, 0, None
    for batch in batches:
        out = []
        for k, (topic, partition, part, entry, _, then, closes) in enumerate(zip(*(c.to_pylist() for c in batch.columns))):
            if (topic, partition) != key:
                key, at, number, done = (topic, partition), 0, 0, None
            if entry == at and part != done:
                out.append((k, number))
                at, number, done = then, number + closes, part
        rows = batch.take(pa.array([k for k, _ in out], pa.int64()))
        yield pa.RecordBatch.from_arrays([*rows.columns[:5], pa.array([n for _, n in out], pa.int64())], names=[*PART, "entry", "entry_bytes", "first_batch"])


def frame_by_bytes(actions: DataFrame, size: str, most_bytes: int, most_rows: int | None = None, batches_of_part: int = 512, block: int = order.BLOCK) -> DataFrame:
    """actions with `batch`: a batch closes once its sizes reach most_bytes (-1: never) or it has most_rows.

    All rows of a log partition depend on those before, but only by where the open batch began. Running sums cut it into parts of about
    `batches_of_part` batches. Each part says, for every batch that may be open where it begins, which one is open at its end; these
    few rows are composed in order, and then all parts number their rows at once.
    """
    keys = ["topic", "partition"]
    if most_bytes == -1 and not most_rows:
        return actions.withColumn("batch", F.lit(0).cast("long"))
    weight, limit = ("frame_place", most_rows) if most_rows else ("frame_bytes", most_bytes)
    span = limit * batches_of_part
    sized = actions.withColumn("frame_size", F.coalesce(F.col(size).cast("long"), F.lit(0)))
    rows = order.scanned(sized, keys, ["offset"], {"frame_place": (F.count, order.added, F.lit(1)), "frame_bytes": (F.sum, order.added, "frame_size")}, block)
    rows = rows.withColumn("frame_part", F.floor(F.col(weight) / span))
    light = rows.select(*PART, F.lit(False).alias("frame_tail"), "frame_place", "frame_bytes", "frame_size")
    # A batch that is open at a part's end began in its last rows.
    tails = light.where(F.col(weight) >= (F.col("frame_part") + 1) * span - limit).withColumns({"frame_part": F.col("frame_part") + 1, "frame_tail": F.lit(True)})
    both = light.unionByName(tails).repartition(*PART).sortWithinPartitions(*PART, F.desc("frame_tail"), "frame_place")
    found = both.mapInArrow(_transitions(most_bytes, most_rows), _TRANSITIONS)
    chosen = found.repartition(*keys).sortWithinPartitions(*PART, "entry").mapInArrow(_chosen, "topic string, partition int, frame_part long, entry long, entry_bytes long, first_batch long")
    names = actions.columns

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, number, held, rows = None, 0, 0, 0
        for own in batches:
            parts = list(zip(*(own.column(c).to_pylist() for c in PART)))
            sizes = own.column("frame_size").to_numpy(zero_copy_only=False)
            cuts = [0, *(k for k in range(1, len(parts)) if parts[k] != parts[k - 1]), len(parts)]
            out = np.empty(len(parts), np.int64)
            for i, j in zip(cuts, cuts[1:]):
                if i == j:
                    continue
                if parts[i] != key:
                    key, (place, before, entry, entry_bytes, number) = parts[i], (own.column(c)[i].as_py() for c in ("frame_place", "frame_bytes", "entry", "entry_bytes", "first_batch"))
                    held, rows = before - entry_bytes, place - entry
                closed, held, rows = _numbers(sizes[i:j], most_bytes, most_rows, held, rows)
                out[i:j] = number + closed
                number += int(closed[-1] + (rows == 0))
            yield pa.RecordBatch.from_arrays([*(own.column(c) for c in names), pa.array(out)], names=[*names, "batch"])

    schema = T.StructType([*actions.schema.fields, T.StructField("batch", T.LongType())])
    return rows.join(chosen, PART).repartition(*PART).sortWithinPartitions(*PART, "frame_place").mapInArrow(framed, schema)
