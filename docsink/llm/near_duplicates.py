"""Near duplicates by order MinHash, verified by banded alignment.

A document's k-mers are its shingles of five words, each labelled with its number of occurrence. For each of
SKETCHES orders, the ORDERED least labelled shingles, put back in text order, are one sketch: documents that share
a sketch share several shingles in the same order. Candidates are verified by aligning their labelled shingles
within the band of diagonals that the threshold allows; the similarity is aligned / (all of both - aligned).

Copies (the same words in order) are one text from the start. In a bucket of texts with equal sketches all are first
compared with the least one. Where that leaves a bucket's texts in several components, they meet in a task that
counts their common shingles and aligns the pairs that may be similar, so no pair of a bucket is left out but those that are
connected already, and pairs are no rows.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SpanHash, blocks, remove, splitmix, table, texts_of, utf8, written
from .components import components
from .decontaminate import word_hashes

SHINGLE = 5
SIMILARITY = 0.8
#: At 0.8, two texts miss each of SKETCHES sketches with probability 1 - 0.8^ORDERED: all with under 1e-5.
SKETCHES, ORDERED = 24, 4
BLOCK_BYTES = 1 << 18
#: Texts of a bucket that meet in one task, about, and as many again from another part; a larger bucket is dealt out in pairs of parts.
TOGETHER = 2000
#: Texts of a star that are compared with its lead in one task, about.
SALTED = 4096
#: Copies of one text are broadcast as common where they are one in so many rows, or more.
HOT_KEYS = 1000
#: Numbers in one table of orders by shingles, about.
TABLE = 1 << 18
SEEDS = splitmix(np.arange(SKETCHES, dtype=np.uint64) + np.uint64(77))[:, None]


def shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of each five words in a row, with the number of the occurrence mixed in."""
    n = len(words) - SHINGLE + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    x = np.zeros(n, np.uint64)
    for k in range(SHINGLE):
        x = (x ^ words[k : k + n].astype(np.uint64)) * np.uint64(0x9FB21C651E98DF25)
        x ^= x >> np.uint64(29)
    order = np.argsort(x, kind="stable")
    ranked = x[order]
    first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
    if len(first) < n:
        number = np.empty(n, np.uint64)
        number[order] = np.arange(n) - np.repeat(first, np.diff(np.append(first, n)))
        x = np.where(number > 0, splitmix(x + number * np.uint64(0xD6E8FEB86659FD93)), x)
    return x


def sketches(x: np.ndarray) -> np.ndarray:
    """One number for each order: the hash of its least shingles in text order."""
    n, out = len(x), []
    ell = min(ORDERED, n)
    each = max(1, TABLE // n)
    for k in range(0, SKETCHES, each):
        own = (x[None, :] ^ SEEDS[k : k + each]) * np.uint64(0x9E3779B97F4A7C15)
        own ^= own >> np.uint64(32)
        own *= np.uint64(0xD6E8FEB86659FD93)
        least = np.sort(np.argpartition(own, ell - 1, axis=1)[:, :ell] if ell < n else np.tile(np.arange(n), (len(own), 1)), axis=1)
        made = SEEDS[k : k + each, 0].copy()
        for j in range(ell):
            made = splitmix(made ^ x[least[:, j]])
        out.append(made)
    return np.concatenate(out).view(np.int64)


def copy_key(words: np.ndarray, data: np.ndarray) -> bytes:
    """Copies have the same words in order; wordless texts the same bytes."""
    return xxhash.xxh3_128_digest(words.tobytes() if len(words) else b"-" + data.tobytes())


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = SpanHash(2 * BLOCK_BYTES)
    for batch in batches:
        data, at = utf8(batch.column("text"))
        for i, j in blocks(at, BLOCK_BYTES):
            words, word_at = word_hashes(data[at[i] : at[j]], at[i : j + 1] - at[i], hasher)
            keys, made = [], []
            for r in range(j - i):
                own = words[word_at[r] : word_at[r + 1]]
                keys.append(copy_key(own, data[at[i + r] : at[i + r + 1]]))
                x = shingles(own.astype(np.uint32))
                made.append(sketches(x) if len(x) else None)
            yield pa.RecordBatch.from_arrays([batch.column("row").slice(i, j - i), batch.column("doc_id").slice(i, j - i), pa.array(keys, pa.binary()), pa.array(made, pa.list_(pa.int64()))], names=["row", "doc_id", "copy_key", "sketches"])


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = SpanHash(2 * BLOCK_BYTES)
    for batch in batches:
        data, at = utf8(batch.column("text"))
        for i, j in blocks(at, BLOCK_BYTES):
            words, word_at = word_hashes(data[at[i] : at[j]], at[i : j + 1] - at[i], hasher)
            own = [words[a:b] for a, b in zip(word_at[:-1], word_at[1:], strict=True)]
            keys = [copy_key(x, data[at[i + r] : at[i + r + 1]]) for r, x in enumerate(own)]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array([x.astype(np.uint32).tobytes() for x in own], pa.binary())], names=["copy_key", "words"])


def aligned(x: np.ndarray, y: np.ndarray, band: int) -> int:
    """The longest chain of equal labelled shingles, ascending in both texts, no more than `band` off the diagonal."""
    order = np.argsort(y)
    k = np.minimum(np.searchsorted(y, x, sorter=order), len(y) - 1)
    there = order[k]
    ok = (y[there] == x) & (np.abs(there - np.arange(len(x))) <= band)
    places = there[ok]
    if len(places) < 2 or (np.diff(places) > 0).all():
        return len(places)
    tails: list[int] = []
    for p in places.tolist():
        i = bisect.bisect_left(tails, p)
        if i == len(tails):
            tails.append(p)
        else:
            tails[i] = p
    return len(tails)


def similar(x: np.ndarray, y: np.ndarray, least: float = SIMILARITY) -> bool:
    """Whether aligned / (len(x) + len(y) - aligned) >= least, for labelled shingles x and y."""
    total = len(x) + len(y)
    if not total or min(len(x), len(y)) < least * max(len(x), len(y)):
        return False
    # At the threshold so many shingles of both texts are left unaligned; a chain can't leave the diagonal further.
    band = int(total * (1 - least) / (1 + least)) + 1
    found = aligned(x, y, band)
    return found >= least * (total - found) - 1e-9


def _verifier(least: float):
    """From texts sorted by lead, salt and side, the lead (side 0) before the others: links (a, b) of the lead and similar ones."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead, own = None, None
        for batch in batches:
            found: list[tuple[int, int]] = []
            words = batch.column("words")
            for r, (a, side, doc) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "side", "doc")), strict=True)):
                x = shingles(np.frombuffer(words[r].as_buffer(), np.uint32))
                if side == 0:
                    lead, own = a, x
                elif a == lead and similar(own, x, least):
                    found.append((a, doc))
            yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    return verify


def links_among(docs: list[int], roots: list[int], own: list[np.ndarray], least: float = SIMILARITY) -> list[tuple[int, int]]:
    """Links that join texts of different roots, until no two similar texts are apart. own: their labelled shingles.

    How many labelled shingles a text has in common with each of the others comes from lists of the texts by shingle; it
    bounds what can be aligned, so only pairs that may be similar and are still apart are aligned.
    """
    sizes = np.array([len(x) for x in own])
    numbers = np.unique(np.concatenate(own), return_inverse=True)[1]
    owner = np.repeat(np.arange(len(own)), sizes)
    order = np.argsort(numbers, kind="stable")
    by_shingle, at = owner[order], np.searchsorted(numbers[order], np.arange(numbers.max() + 2))
    first = np.append(0, np.cumsum(sizes))
    parent = {r: r for r in roots}

    def find(r: int) -> int:
        while parent[r] != r:
            parent[r] = r = parent[parent[r]]
        return r

    out = []
    for x in range(1, len(own)):
        mine = numbers[first[x] : first[x + 1]]
        starts, n = at[mine], at[mine + 1] - at[mine]
        listed = np.repeat(starts - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        common = np.bincount(by_shingle[listed], minlength=len(own))[:x]
        for y in np.flatnonzero(common >= least * (sizes[:x] + sizes[x] - common) - 1e-9).tolist():
            a, b = find(roots[x]), find(roots[y])
            if a != b and similar(own[x], own[y], least):
                parent[max(a, b)] = min(a, b)
                out.append((docs[x], docs[y]))
    return out


def _linker(least: float):
    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, docs, roots, own = None, [], [], []

        def close() -> pa.RecordBatch:
            found = links_among(docs, roots, own, least) if len(docs) > 1 else []
            return pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

        for batch in batches:
            for *k, doc, root, words in zip(*(batch.column(c).to_pylist() for c in ("bucket", "low", "high", "doc", "root", "words")), strict=True):
                if k != key:
                    if key:
                        yield close()
                    key, docs, roots, own = k, [], [], []
                docs.append(doc)
                roots.append(root)
                own.append(shingles(np.frombuffer(words, np.uint32)))
        if key:
            yield close()

    return linked


def verified(stars: DataFrame, words: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The similar ones of stars (a, b), each text b with its lead a. words: (doc, words).

    A lead's words go once to each SALTED of its star, so that a lead of very many texts is no single task.
    """
    parts = int(stars.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    salts = stars.groupBy("a").agg((F.floor(F.count("*") / SALTED) + 1).cast("int").alias("salts"))
    dealt = stars.join(salts, "a").select("a", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"), F.lit(1).alias("side"), F.col("b").alias("doc"))
    leads = salts.select("a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("side"), F.col("a").alias("doc"))
    both = dealt.unionByName(leads).join(words, "doc")
    return both.repartition(parts, "a", "salt").sortWithinPartitions("a", "salt", "side", "doc").select("a", "side", "doc", "words").mapInArrow(_verifier(least), "a long, b long")


def _texts_of_rows(signed: DataFrame, copies: DataFrame) -> DataFrame:
    """signed (doc_id, copy_key) with the class_id of its copies.

    Keys of a thousandth of all rows or more, of which there are a thousand at most, are broadcast: their rows stay where they are.
    """
    rows = signed.count()
    hot = F.broadcast(copies.where(F.col("n") * HOT_KEYS >= rows).select("copy_key", "class_id"))
    common = signed.join(hot, "copy_key").select("doc_id", "class_id")
    return common.unionByName(signed.join(hot, "copy_key", "left_anti").join(copies, "copy_key").select("doc_id", "class_id"))


def near_duplicates(spark: SparkSession, docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """Per document: doc_id, class_id, which is the least doc_id of its class.

    Classes are the connected components of links between texts of similarity `least` or more, and of copies. Texts
    under five words, and wordless ones by their bytes, only have copies; null and empty texts are copies of each
    other. Rows that repeat a doc_id, or have none, each are a text of their own; a class without any doc_id has the class_id null; no rows
    give none; other columns stay out. docs is read twice, and must give the same rows, as a table does.
    """
    texts = texts_of(docs).withColumn("row", F.monotonically_increasing_id())
    signed = written(spark, texts.mapInArrow(_sign, "row long, doc_id long, copy_key binary, sketches array<long>"), "signed")
    copies = written(spark, signed.groupBy("copy_key").agg(F.min("row").alias("text_id"), F.min_by("doc_id", "row").alias("of"), F.min("doc_id").alias("doc_id"), F.count("*").alias("n")), "copies")
    # One row for each distinct text with sketches.
    own = signed.where("sketches is not null").join(copies.select("text_id"), F.col("row") == F.col("text_id"), "left_semi")
    bucketed = own.select(F.col("row").alias("doc"), F.posexplode("sketches")).select(F.xxhash64("pos", "col").alias("bucket"), "doc").distinct()
    leads = bucketed.groupBy("bucket").agg(F.min("doc").alias("lead"), F.count("*").alias("n")).where("n > 1").select("bucket", "lead")
    members = written(spark, bucketed.join(leads, "bucket"), "members")

    stars = written(spark, members.where("doc <> lead").select(F.col("lead").alias("a"), F.col("doc").alias("b")).distinct(), "stars")
    met = written(spark, members.select(F.col("doc").alias("text_id")).distinct().join(copies.select("text_id", "copy_key", "of"), "text_id"), "met")
    # Rows of the doc_ids of the texts that meet; of those that share one, or have none, the key tells which are such a text.
    named = texts.where("doc_id is not null").join(met.select(F.col("of").alias("doc_id")), "doc_id", "left_semi")
    those = named.unionByName(texts.where("doc_id is null")) if met.where("of is null").limit(1).count() else named
    found = those.select("text").mapInArrow(_words, "copy_key binary, words binary").dropDuplicates(["copy_key"])
    words = written(spark, found.join(met.select("copy_key", F.col("text_id").alias("doc")), "copy_key").select("doc", "words"), "words")
    linked = written(spark, verified(stars, words, least), "linked")
    roots = first_roots = written(spark, components(spark, linked), "roots")

    # Buckets whose texts are in several components, each set of texts once: there all of them meet, in the tasks.
    placed = members.select("bucket", "doc").join(roots.select(F.col("node").alias("doc"), "root"), "doc", "left").withColumn("root", F.coalesce("root", "doc"))
    mixed = placed.groupBy("bucket").agg(F.count("*").alias("n"), F.min("root").alias("least"), F.max("root").alias("most"), F.bit_xor(F.xxhash64("doc")).alias("texts")).where("least <> most")
    mixed = mixed.groupBy("n", "texts").agg(F.min("bucket").alias("bucket")).select("bucket", F.ceil(F.col("n") / TOGETHER).cast("int").alias("parts"))
    dealt = placed.join(mixed, "bucket").withColumn("own", F.pmod(F.xxhash64("doc"), "parts").cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("bucket", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "doc", "root").join(words, "doc")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    linking = dealt.repartition(parts, "bucket", "low", "high").sortWithinPartitions("bucket", "low", "high", "doc").select("bucket", "low", "high", "doc", "root", "words").mapInArrow(_linker(least), "a long, b long")
    more = written(spark, linking, "linked")
    if more.limit(1).count():
        roots = components(spark, roots.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    # A text with very many copies has a root for each of its rows: the roots go to texts first, then texts to rows.
    rooted = copies.join(roots.select(F.col("node").alias("text_id"), "root"), "text_id", "left").select("copy_key", "doc_id", "n", F.coalesce("root", "text_id").alias("root"))
    least_of = rooted.groupBy("root").agg(F.min("doc_id").alias("class_id"))
    classes = written(spark, rooted.join(least_of, "root").select("copy_key", "n", "class_id"), "classes")
    remove(spark, copies, members, stars, met, words, linked, more, first_roots)
    return _texts_of_rows(signed.select("doc_id", "copy_key"), classes)


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"))
