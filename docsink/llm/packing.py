"""Best-fit packing of documents into sequences by patterns of lengths.

Only the histogram of piece lengths (at most `capacity` rows, whatever the corpus) comes to the driver. There,
patterns of up to three lengths that fill a sequence exactly, of which one may be repeated, get repeat counts by non-negative
least squares against the histogram; the counts are rounded, and what is left over is packed best-fit-decreasing by length. Of
several shares of the counts the largest that needs the fewest sequences is taken: patterns may use up the short pieces that single
long ones need. Full pieces are sequences by themselves; the others find their places by their rank among the pieces of their length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table, texts_of, written
from .tokens import _text_blocks, ids_of, pieces_of_worker, vocabulary_path

CAPACITY = 2048
#: A length's ranks are made in parts of about SALTED pieces, so that a very common length is no single task; of at most MOST_SALTS parts, which bounds what is broadcast.
SALTED, MOST_SALTS = 20_000, 1024
#: Steps of the least-squares fit, and the shares of its counts that are tried.
STEPS, SHARES = 150, (1.0, 0.9, 0.75, 0.5, 0.25, 0.0)
END_OF_DOCUMENT = b"\0\0\0\0"
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def _piecer(path: str, capacity: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of_worker(path, ids=True)
        for doc_ids, texts, _ in _text_blocks(batches):
            out: tuple[list, ...] = ([], [], [], [], [])
            for doc_id, ids in zip(doc_ids.to_pylist(), ids_of(texts, pieces), strict=True):
                ids += END_OF_DOCUMENT
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    for column, x in zip(out, (doc_id, k, at // 4, len(own) // 4, zlib.crc32(own)), strict=True):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return cut


def pieces_of(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Each document's ids and an end id 0, cut into pieces of `capacity` where they are longer."""
    return texts_of(docs).mapInArrow(_piecer(path or vocabulary_path(), capacity), PIECES)


def patterns(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(lengths, times), each of three columns and 0-filled: patterns that fill `capacity` exactly.

    Either up to three pieces, or one length as often as it fits, three times at least, and one other.
    """
    there = np.zeros(capacity + 1, bool)
    there[lengths] = True
    a, b = np.meshgrid(lengths, np.append(lengths, 0), indexing="ij")
    c = capacity - a - b
    own = (a >= b) & (b >= c) & (c >= 0) & ((c == 0) | there[np.maximum(c, 0)])
    few = np.stack((a[own], b[own], c[own]), axis=1)
    times = (capacity - b) // a
    own = (a != b) & (times >= 3) & (times * a + b == capacity)
    many = np.stack((a[own], b[own], np.zeros(int(own.sum()), np.int64)), axis=1)
    return np.concatenate((few, many)), np.concatenate(((few > 0).astype(np.int64), np.stack((times[own], b[own] > 0, 0 * a[own]), axis=1)))


def fit(rows: np.ndarray, times: np.ndarray, histogram: np.ndarray, steps: int = STEPS) -> np.ndarray:
    """Repeat counts x >= 0 of the patterns that least-squares fit the histogram, by accelerated projected gradient."""
    size = len(histogram)

    def covered(x: np.ndarray) -> np.ndarray:
        return sum(np.bincount(rows[:, j], x * times[:, j], size) for j in range(3))

    # Each pattern's own step: its curvature is at most the sum over its lengths of all pieces that patterns have of them.
    degree = covered(times.sum(axis=1).astype(float))
    step = 1 / np.maximum(1, sum(times[:, j] * degree[rows[:, j]] for j in range(3)))
    x = y = np.zeros(len(rows))
    t = 1.0
    for _ in range(steps):
        off = covered(y) - histogram
        new = np.maximum(0, y - step * sum(off[rows[:, j]] * times[:, j] for j in range(3)))
        t, before = (1 + (1 + 4 * t * t) ** 0.5) / 2, t
        y = new + (before - 1) / t * (new - x)
        x = new
    return x


def rounded(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Whole counts; within the patterns of one longest length, fractions are carried on so that the total stays."""
    order = np.argsort(by, kind="stable")
    total = np.cumsum(x[order])
    first = np.flatnonzero(np.diff(by[order], prepend=-1))
    before = np.repeat(np.append(0, total)[first], np.diff(np.append(first, len(x))))
    whole = np.floor(total - before + 1e-9)
    whole[1:] -= np.where(np.diff(by[order]) == 0, whole[:-1], 0)
    out = np.zeros(len(x), np.int64)
    out[order] = whole
    return out


def best_fit(histogram: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """Best-fit-decreasing by counts: (lengths, repeats). Its work depends on distinct lengths, not on pieces."""
    by_space: dict[int, list[tuple[tuple[int, ...], int]]] = defaultdict(list)
    for length in np.flatnonzero(histogram)[::-1].tolist():
        left = int(histogram[length])
        while left:
            space = next((s for s in range(length, capacity) if by_space[s]), capacity)
            # A sequence that gets one piece of this length is then the tightest fit for the next.
            pattern, n = by_space[space].pop() if space < capacity else ((), left)
            each = min(space // length, left)
            take = min(n, left // each)
            if space < capacity and take < n:
                by_space[space].append((pattern, n - take))
            by_space[space - each * length].append((pattern + (length,) * each, take))
            left -= each * take
    return [x for found in by_space.values() for x in found]


def _with_share(rows: np.ndarray, times: np.ndarray, counts: np.ndarray, histogram: np.ndarray, capacity: int) -> dict[tuple[int, ...], int]:
    """Patterns by these counts as far as there are pieces, and best-fit of what is left."""
    left = histogram.copy()
    out: dict[tuple[int, ...], int] = defaultdict(int)
    for k in np.argsort(-counts, kind="stable")[: int((counts > 0).sum())].tolist():
        pattern = tuple(x for x, n in zip(rows[k].tolist(), times[k].tolist(), strict=True) for _ in range(n))
        n = min(int(counts[k]), *(int(left[x]) // pattern.count(x) for x in set(pattern)))
        if n > 0:
            out[pattern] += n
            for x in pattern:
                left[x] -= n
    for pattern, n in best_fit(left, capacity):
        out[pattern] += n
    return out


def plan(histogram: dict[int, int], capacity: int = CAPACITY, shares: tuple[float, ...] = SHARES) -> list[tuple[tuple[int, ...], int]]:
    """Patterns of lengths and how many sequences are made of each; together they hold every piece once. Full pieces stay out."""
    left = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        left[length] = n
    left[capacity] = 0
    rows, times = patterns(np.flatnonzero(left), capacity)
    found = fit(rows, times, left.astype(float)) if len(rows) else np.zeros(0)
    made = [_with_share(rows, times, rounded(share * found, rows[:, 0]), left, capacity) for share in (shares if len(rows) else shares[:1])]
    return sorted(min(made, key=lambda x: sum(x.values())).items())


def _placer(made: list[tuple[tuple[int, ...], int]]):
    """Ranks to places: for each length, the patterns that have it take its pieces in turn."""
    keys, bases, offsets = [], [], []
    used: dict[int, int] = defaultdict(int)
    sequences = 0
    for pattern, n in made:
        at = 0
        for length in pattern:
            keys.append((length << 44) + used[length])
            bases.append(sequences - used[length])
            offsets.append(at)
            used[length] += n
            at += length
        sequences += n
    order = np.argsort(np.array(keys, np.int64), kind="stable")
    keys, bases, offsets = (np.array(x, np.int64)[order] for x in (keys, bases, offsets))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rank, length = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("rank", "length"))
            k = np.searchsorted(keys, (length << 44) + rank, "right") - 1
            yield pa.RecordBatch.from_arrays([*(batch.column(f.split()[0]) for f in PIECES.split(", ")), pa.array(bases[k] + rank), pa.array(offsets[k])], names=[*(f.split()[0] for f in PIECES.split(", ")), "sequence_id", "offset"])

    return place


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset; a full piece's sequence has a number below 0. `pieces` is read four times: give a written table."""
    columns = [f.split()[0] for f in PIECES.split(", ")]
    full = pieces.where(F.col("length") == capacity).select(*columns, (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    part = pieces.where(F.col("length") < capacity)
    histogram = {r["length"]: r["n"] for r in part.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if not histogram:
        return full
    salts = min(MOST_SALTS, 1 + max(histogram.values()) // SALTED)
    salted = part.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "salt").count()  # at most capacity x MOST_SALTS rows
    before = counts.withColumn("base", F.sum("count").over(W.partitionBy("length").orderBy("salt").rowsBetween(W.unboundedPreceding, -1)))
    local = F.row_number().over(W.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = salted.withColumn("local", local).join(F.broadcast(before), ["length", "salt"]).withColumn("rank", F.coalesce("base", F.lit(0)) + F.col("local") - 1)
    placed = ranked.select(*columns, "rank").mapInArrow(_placer(plan(histogram, capacity)), f"{PIECES}, sequence_id long, offset long")
    return placed.unionByName(full)


def pack_documents(spark: SparkSession, docs: DataFrame, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Per piece of each document: where it goes.

    A null or empty text is one piece of one id; repeated rows, and rows without a doc_id, are packed each; no rows give none; other columns stay out.
    """
    return pack(written(spark, pieces_of(docs, path, capacity), "pieces"), capacity)


def op10_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(spark, table(spark, sf_dir, "documents"))
