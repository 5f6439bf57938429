"""Benchmark decontamination by a distributed positional inverted index.

The training documents are indexed in segments of a bounded number of bytes: for each segment one row with
its sorted term hashes and, for each term, the positions of its occurrences (delta-coded). Documents lie whole
in a segment, so intersecting position lists needs no shuffle: each segment answers all phrases on its own,
beginning with the phrase's rarest term there. The windows of the test items are a written table of blocks of a bounded
number of windows; each block is broadcast, and the index is read once for each.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SpanHash, blocks, table, texts_of, utf8, written

#: Bytes of text in a segment, about; a longer document is a segment by itself.
SEGMENT_BYTES = 2 << 20
#: Windows of test items that are broadcast at a time, a few MB; more windows are more passes over the index.
BLOCK_WINDOWS = 1 << 17
#: Bytes of test items whose windows are made in one task, about; of a longer item all windows are made there, block by block.
ITEM_BYTES = 4 << 20
#: Windows in a batch of rows.
ROWS = 1 << 14
WINDOW = 10

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_WORD = np.zeros(256, bool)
IS_WORD[48:58] = IS_WORD[65:91] = IS_WORD[97:123] = IS_WORD[128:] = True

INDEX = "doc_ids binary, no_ids binary, word_at binary, terms binary, term_at binary, places binary"
WINDOWS = "terms binary, numbers binary, lengths binary, item_at binary, item_of binary, ids array<string>"
FOUND = "segment long, place int, doc_id long, n_words long, spans array<int>, items array<string>"


def word_hashes(data: np.ndarray, at: np.ndarray, hasher: SpanHash) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of the rows, in order, and where each row's words begin (one entry more)."""
    is_word = IS_WORD[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[at] = True
    first, last = is_word.copy(), is_word.copy()
    first[1:] &= ~is_word[:-1] | edge[1:-1]
    last[:-1] &= ~is_word[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    lowered = LOWER[data]
    hashes = hasher.spans(hasher.prefix(lowered), starts, ends)
    for k in np.flatnonzero(ends - starts > hasher.SHORT).tolist():
        hashes[k] = xxhash.xxh3_64_intdigest(lowered[starts[k] : ends[k]].tobytes())
    return hashes, np.searchsorted(starts, at)


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = SpanHash(SEGMENT_BYTES)
    for batch in batches:
        no_ids = batch.column("doc_id").is_null().to_numpy(zero_copy_only=False)
        ids = batch.column("doc_id").fill_null(0).to_numpy()
        data, at = utf8(batch.column("text"))
        for i, j in blocks(at, SEGMENT_BYTES):
            words, word_at = word_hashes(data[at[i] : at[j]], at[i : j + 1] - at[i], hasher)
            order = np.argsort(words, kind="stable").astype(np.uint32)
            ranked = words[order]
            new = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1]))) if len(ranked) else np.zeros(0, np.int64)
            row = (ids[i:j], no_ids[i:j], word_at.astype(np.uint32), ranked[new], np.append(new, len(ranked)).astype(np.uint32), np.diff(order, prepend=np.uint32(0)))
            yield pa.RecordBatch.from_arrays([pa.array([x.tobytes()], pa.binary()) for x in row], names=["doc_ids", "no_ids", "word_at", "terms", "term_at", "places"])


def build_index(docs: DataFrame) -> DataFrame:
    """One row for each segment of `docs` (doc_id, text): its documents and its posting lists."""
    return texts_of(docs).mapInArrow(_build, INDEX).withColumn("segment", F.monotonically_increasing_id())


class Segment:
    """A row of the index, opened."""

    def __init__(self, doc_ids: bytes, no_ids: bytes, word_at: bytes, terms: bytes, term_at: bytes, places: bytes):
        self.doc_ids, self.no_ids = np.frombuffer(doc_ids, np.int64), np.frombuffer(no_ids, bool)
        self.word_at = np.frombuffer(word_at, np.uint32).astype(np.int64)
        self.terms, self.term_at = np.frombuffer(terms, np.uint64), np.frombuffer(term_at, np.uint32).astype(np.int64)
        self.order = np.cumsum(np.frombuffer(places, np.uint32), dtype=np.uint32)
        self.opened: dict[int, np.ndarray] = {}

    def look_up(self, wanted: np.ndarray) -> np.ndarray:
        """Each wanted term's number here, or -1."""
        if not len(self.terms):
            return np.full(len(wanted), -1)
        k = np.minimum(np.searchsorted(self.terms, wanted), len(self.terms) - 1)
        return np.where(self.terms[k] == wanted, k, -1)

    def list_of(self, k: int) -> np.ndarray:
        """The places of term number k, ascending; a place counts words from the segment's begin."""
        if k not in self.opened:
            self.opened[k] = self.order[self.term_at[k] : self.term_at[k + 1]].astype(np.int64)
        return self.opened[k]

    def in_one_doc(self, starts: np.ndarray, length: int) -> np.ndarray:
        starts = starts[(starts >= 0) & (starts + length <= self.word_at[-1])]
        d = np.searchsorted(self.word_at, starts, "right")
        return starts[starts + length <= self.word_at[np.minimum(d, len(self.word_at) - 1)]]

    def phrase(self, numbers: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Where the terms of these numbers stand one after the other: offset-adjusted lists, rarest first, are intersected."""
        rarest = np.argsort(counts, kind="stable")
        left = self.list_of(numbers[rarest[0]]) - rarest[0]
        for offset in rarest[1:]:
            other = self.list_of(numbers[offset])
            k = np.searchsorted(other, left + offset)
            left = left[(k < len(other)) & (other[np.minimum(k, len(other) - 1)] == left + offset)]
            if not len(left):
                return left
        return self.in_one_doc(left, len(numbers))

    def near(self, numbers: np.ndarray, counts: np.ndarray, width: int) -> np.ndarray:
        """Starts of stretches of `width` words of a document that hold all these terms; stretches begin at one of the terms."""
        rarest = self.list_of(numbers[np.argmin(counts)])
        starts = np.unique(np.concatenate([x[(x <= p) & (x > p - width)] for x in map(self.list_of, set(numbers.tolist())) for p in rarest] or [np.zeros(0, np.int64)]))
        doc_end = self.word_at[np.minimum(np.searchsorted(self.word_at, starts, "right"), len(self.word_at) - 1)]
        stop = np.minimum(starts + width, doc_end)
        for k in set(numbers.tolist()):
            x = self.list_of(k)
            i = np.searchsorted(x, starts)
            ok = (i < len(x)) & (x[np.minimum(i, len(x) - 1)] < stop)
            starts, stop = starts[ok], stop[ok]
        return starts


def _block(found: dict[bytes, tuple[np.ndarray, list[str]]]) -> pa.RecordBatch:
    """A row of WINDOWS: distinct terms, each window as numbers of them, and the items that have it."""
    windows, held = [w for w, _ in found.values()], [x for _, x in found.values()]
    terms, numbers = np.unique(np.concatenate([np.zeros(0, np.uint64), *windows]), return_inverse=True)
    ids = sorted({x for own in held for x in own})
    at = {x: k for k, x in enumerate(ids)}
    columns = (terms, numbers.astype(np.int32), np.array([len(w) for w in windows], np.int32), np.cumsum([0, *map(len, held)]).astype(np.int32), np.array([at[x] for own in held for x in own], np.int32))
    return pa.RecordBatch.from_arrays([*(pa.array([x.tobytes()], pa.binary()) for x in columns), pa.array([ids], pa.list_(pa.string()))], names=[x.split()[0] for x in WINDOWS.split(", ")])


def _windows(window: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHash()
        for batch in batches:
            words, word_at = word_hashes(*utf8(batch.column("text")), hasher)
            for item, a, b in zip(batch.column("item_id").to_pylist(), word_at[:-1].tolist(), word_at[1:].tolist(), strict=True):
                starts = range(a, max(a + 1, b - window + 1) if b > a else a)
                for k in range(0, len(starts), ROWS):
                    own = [words[i : min(b, i + window)].tobytes() for i in starts[k : k + ROWS]]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(own), pa.string()), pa.array(own, pa.binary())], names=["item_id", "words"])

    return made


def _blocks_of_windows(most: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[bytes, tuple[np.ndarray, list[str]]] = {}
        for batch in batches:
            for item, words in zip(batch.column("item_id").to_pylist(), batch.column("words").to_pylist(), strict=True):
                held = found.setdefault(xxhash.xxh3_128_digest(words), (np.frombuffer(words, np.uint64), []))[1]
                if not held or held[-1] != item:
                    held.append(item)
                if len(found) >= most:
                    yield _block(found)
                    found.clear()
        if found:
            yield _block(found)

    return made


def item_windows(spark: SparkSession, items: DataFrame, window: int = WINDOW, most: int = BLOCK_WINDOWS) -> DataFrame:
    """The distinct windows of items (item_id, text) in blocks of at most `most`; a window that is in two blocks is found by both.

    How many blocks there are depends on the windows alone, not on how the items lie in partitions: each is a pass over the index.
    """
    texts = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")).where("text is not null")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    windows = written(spark, texts.repartition(1 + size // ITEM_BYTES, "item_id").mapInArrow(_windows(window), "item_id string, words binary"), "windows")
    return written(spark, windows.coalesce(1 + windows.count() // most).mapInArrow(_blocks_of_windows(most), WINDOWS), "blocks")


def _finder(block, slop: int | None):
    """block: a broadcast row of WINDOWS, or None where there are no windows."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = block.value if block else {"terms": b"", "numbers": b"", "lengths": b"", "item_at": b"", "item_of": b"", "ids": []}
        terms, ids = np.frombuffer(row["terms"], np.uint64), row["ids"]
        numbers, lengths, item_at, item_of = (np.frombuffer(row[c], np.int32) for c in ("numbers", "lengths", "item_at", "item_of"))
        begins = np.cumsum(lengths) - lengths
        grids = {n: (numbers[begins[own][:, None] + np.arange(n)], own) for n in np.unique(lengths).tolist() for own in [np.flatnonzero(lengths == n)]}
        for batch in batches:
            for segment, *packed in zip(batch.column("segment").to_pylist(), *(batch.column(c.split()[0]) for c in INDEX.split(", ")), strict=True):
                s = Segment(*(x.as_buffer() for x in packed))
                here = s.look_up(terms)
                counts = np.where(here >= 0, s.term_at[np.maximum(here, 0) + 1] - s.term_at[np.maximum(here, 0)], 0) if len(s.terms) else np.zeros(len(terms), np.int64)
                spans: dict[int, list[int]] = {}
                held: dict[int, set[str]] = {}
                for length, (grid, which) in grids.items():
                    width = length + (slop or 0)
                    for k in np.flatnonzero((counts[grid] > 0).all(axis=1)):
                        w = here[grid[k]]
                        starts = s.phrase(w, counts[grid[k]]) if slop is None else s.near(w, counts[grid[k]], width)
                        own = [ids[x] for x in item_of[item_at[which[k]] : item_at[which[k] + 1]]] if len(starts) else []
                        for d, p in zip((np.searchsorted(s.word_at, starts, "right") - 1).tolist(), starts.tolist(), strict=True):
                            spans.setdefault(d, []).extend((p - int(s.word_at[d]), p - int(s.word_at[d]) + width))
                            held.setdefault(d, set()).update(own)
                n = len(s.doc_ids)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(n, segment)),
                        pa.array(np.arange(n, dtype=np.int32)),
                        pa.array(s.doc_ids, mask=s.no_ids),
                        pa.array(np.diff(s.word_at)),
                        pa.array([spans.get(d, []) for d in range(n)], pa.list_(pa.int32())),
                        pa.array([sorted(held.get(d, ())) for d in range(n)], pa.list_(pa.string())),
                    ],
                    names=[x.split()[0] for x in FOUND.split(", ")],
                )

    return find


def _covered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hits = []
        for x, n in zip(batch.column("spans").to_pylist(), batch.column("n_words").to_pylist(), strict=True):
            if not x:
                hits.append(0)
                continue
            at = np.minimum(np.array(x, np.int64), n)
            step = np.bincount(at[::2], minlength=n + 1) - np.bincount(at[1::2], minlength=n + 1)
            hits.append(int((np.cumsum(step[:n]) > 0).sum()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("n_words"), pa.array(hits, pa.int64()), batch.column("items")], names=["doc_id", "n_words", "n_hit", "items"])


def search(spark: SparkSession, index: DataFrame, items: DataFrame, window: int = WINDOW, slop: int | None = None, most: int = BLOCK_WINDOWS) -> DataFrame:
    """Per indexed document: doc_id, n_words, n_hit, items (ids with an occurring window, sorted).

    index: a written table. items: (item_id, text); each `most` windows of them, a bounded broadcast, are one pass over the index.
    slop None: exact phrases; else windows whose words all stand, in any order, within window + slop words.
    Repeated items and windows count once; null, empty and wordless items have no window; no items: no hits.
    Each row of a repeated doc_id, or without one, is a document of its own.
    """
    blocks_made = [spark.sparkContext.broadcast(r.asDict()) for r in item_windows(spark, items, window, most).toLocalIterator()] or [None]
    covered = "doc_id long, n_words long, n_hit long, items array<string>"
    if len(blocks_made) == 1:
        find = _finder(blocks_made[0], slop)
        return index.mapInArrow(lambda batches: _covered(find(batches)), covered)  # one worker to a task
    found = None
    for block in blocks_made:
        one = index.mapInArrow(_finder(block, slop), FOUND)
        found = one if found is None else found.unionByName(one)
    ids = F.array_sort(F.array_distinct(F.flatten(F.collect_list("items"))))
    found = found.groupBy("segment", "place").agg(F.first("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), ids.alias("items"))
    return found.select("doc_id", "n_words", "spans", "items").mapInArrow(_covered, covered)


def report(found: DataFrame) -> DataFrame:
    ids = F.array_sort("items")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = written(spark, build_index(table(spark, sf_dir, "documents")), "index")
    return report(search(spark, index, table(spark, sf_dir, "benchmark")))


OP5_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, w[i : i + 9] AS win FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)
), lens AS (SELECT DISTINCT len(win) AS n FROM bw),
dw AS (
  SELECT doc_id, i, n, w[i : i + n - 1] AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)
), hit AS (SELECT doc_id, i, n, item_id FROM dw JOIN bw USING (win)),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
