"""Removal of repeated byte strings, by a collection Burrows-Wheeler transform that is built column by column.

Where a 100-byte string can start earlier at all is found by content: each 100-byte window is keyed by the
least hash of its 24-byte grams, so equal windows have equal keys, and neighbouring windows with their leftmost such gram at
one place are one fragment of the text. Only fragments whose key comes twice go on, dealt out by key. There a collection of
fragments gets its Burrows-Wheeler transform and longest common prefixes by inserting, round after round, one symbol of each
string, from its last to its first. A symbol is ten bytes, and a fragment's strings are its readings from its first ten bytes on, so
that there are a tenth of the rounds. Suffixes of ten symbols or more are the windows; neighbours with a common prefix
of ten are equal, and all but the earliest of them are marked. Equal fragments are one string of the collection, whose
later places are marked whole. A collection is bounded, so its columns stay in memory and no external files are needed: the fragments
of a key that comes more than HOT times are dealt out once more, window by window, under the windows' own 128-bit hashes, and read in a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import SpanHash, blocks, splitmix, table, texts_of, utf8

LENGTH = 100
GRAM = 24
#: Windows in a fragment at most; together they are LENGTH + MOST - 1 bytes.
MOST = LENGTH - GRAM + 1
#: Bytes of a symbol of the transform.
WIDE = 10
#: Bits of a place in the transform.
PLACE, PLACES = 32, (1 << 32) - 1
BLOCK_BYTES = 1 << 20
#: Fragments that are transformed together, about; a key with more than HOT is dealt out by whole windows.
COLLECTION, HOT = 1_000, 10_000
#: A task goes through the runs of its keys in so many slices, one in memory at a time.
SLICES = 16
#: A run's byte for its number of windows says with this bit that its key is hot.
SINGLY = 128
#: `spot` is a document's tag, which tells rows of one doc_id apart, above the place in the text.
RUN = np.dtype([("key", "<u8"), ("doc", "<i8"), ("spot", "<i8"), ("n", "<u1")])


def sliding(x: np.ndarray, width: int, least=np.minimum) -> np.ndarray:
    """Least (or with np.maximum greatest) of each `width` neighbours."""
    own, have = x, 1
    while 2 * have <= width:
        own, have = least(own[:-have], own[have:]), 2 * have
    return least(own[: len(x) - width + 1], own[width - have :]) if have < width else own


def runs_of(data: np.ndarray, at: np.ndarray, ids: np.ndarray, tags: np.ndarray, hasher: SpanHash) -> np.ndarray:
    """RUN records: neighbouring windows of a text (a row of data) whose leftmost gram of least hash is at one place.

    Windows of one run are never equal: equal windows have that gram at equal places within them.
    """
    if len(data) < LENGTH:
        return np.zeros(0, RUN)
    sums = hasher.prefix(data)
    places = np.arange(len(data) - GRAM + 1)
    hashed = splitmix((sums[GRAM:] - sums[:-GRAM]) * hasher.down[places])
    least = sliding(hashed, MOST)
    row = np.repeat(np.arange(len(ids)), np.diff(at))[: len(least)]
    own = np.flatnonzero(np.arange(len(least)) + LENGTH <= at[row + 1])
    if not len(own):
        return np.zeros(0, RUN)
    key, row = least[own], row[own]
    first = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (row[1:] != row[:-1]) | (hashed[own[1:] - 1] == key[1:])))
    out = np.zeros(len(first), RUN)
    out["key"], out["doc"], out["n"] = key[first], ids[row[first]], np.diff(np.append(first, len(own)))
    out["spot"] = (tags[row[first]] << 32) + own[first] - at[row[first]]
    return out


def planes(x: np.ndarray) -> bytes:
    """Numbers by bytes of one significance after the other, which compresses well."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.dtype.itemsize).T).tobytes()


def unplaned(own: bytes, dtype: str) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(own, np.uint8).reshape(size, -1).T).reshape(-1).view(dtype)


def even_numbers(spark: SparkSession, parts: int) -> np.ndarray:
    """A number for each of `parts` partitions that repartition(parts, number) deals to that one."""
    dealt = F.pmod(F.hash(F.col("id").cast("int")), F.lit(parts))
    rows = spark.range(32 * parts + 200).groupBy(dealt.alias("p")).agg(F.min("id").alias("id")).collect()
    return np.array([r["id"] for r in rows], np.int32)


def _keyed(numbers: np.ndarray):
    """For each part and slice that keys are dealt to, the runs of a batch, sorted by key, as differences."""
    parts = len(numbers)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = SpanHash(2 * BLOCK_BYTES)
        for batch in batches:
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("doc_id", "tag"))
            data, at = utf8(batch.column("text"))
            runs = np.concatenate([np.zeros(0, RUN), *(runs_of(data[at[i] : at[j]], at[i : j + 1] - at[i], ids[i:j], tags[i:j], hasher) for i, j in blocks(at, BLOCK_BYTES))])
            part = ((runs["key"] >> np.uint64(16)) % np.uint64(parts * SLICES)).astype(np.int64)
            runs = runs[np.lexsort((runs["key"], part))]
            part = np.sort(part)
            first = np.flatnonzero(np.append(True, part[1:] != part[:-1])) if len(part) else np.zeros(0, np.int64)
            cut = [runs[a:b] for a, b in zip(first, np.append(first[1:], len(runs)), strict=True)]
            columns = [pa.array(numbers[part[first] // SLICES]), pa.array((part[first] % SLICES).astype(np.int32))]
            columns += [pa.array([planes(f(x)) for x in cut], pa.binary()) for f in (lambda x: np.diff(x["key"], prepend=np.uint64(0)), lambda x: x["doc"].copy(), lambda x: x["spot"].copy(), lambda x: x["n"].copy())]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "slice", "keys", "docs", "spots", "n"])

    return keyed


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All runs whose key comes in two runs (all runs of a key are in one slice); those of hot keys get SINGLY."""
    got: tuple[list[np.ndarray], ...] = ([], [], [], [])

    def close() -> Iterator[pa.RecordBatch]:
        key, doc, spot, n = (np.concatenate(x) for x in got)
        for x in got:
            x.clear()
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        first = np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1]))
        times = np.repeat(np.diff(np.append(first, len(ranked))), np.diff(np.append(first, len(ranked))))
        n[order[times > HOT]] += SINGLY
        order = order[times > 1]
        order = order[np.argsort(doc[order], kind="stable")]
        for k in range(0, len(order), 50_000):
            o = order[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(doc[o]), pa.array((spot[o] >> 32).astype(np.int32)), pa.array(key[o].view(np.int64)), pa.array((spot[o] & 0xFFFFFFFF).astype(np.int32)), pa.array(n[o].astype(np.int32))], names=["doc_id", "tag", "key", "at", "n"])

    now = None
    for batch in batches:
        for slice_, *own in zip(batch.column("slice").to_pylist(), *(batch.column(c) for c in ("keys", "docs", "spots", "n")), strict=True):
            if slice_ != now and got[0]:
                yield from close()
            now = slice_
            for v, kind, to in zip(own, ("<u8", "<i8", "<i8", "<u1"), got, strict=True):
                x = unplaned(v.as_buffer(), kind)
                to.append(np.cumsum(x, dtype=np.uint64) if to is got[0] else x.copy())
    if got[0]:
        yield from close()


FRAGMENTS = "key long, fragment binary, doc long, spot long, places binary"


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fragments of the texts; equal ones of a batch are one row, with the earliest place and the others.

    Of a hot key's fragments each window is a row of its own, by its hash.
    """
    for batch in batches:
        found: dict[tuple[int, bytes], set[tuple[int, int]]] = {}
        ids, tags = batch.column("doc_id").to_pylist(), batch.column("tag").to_pylist()
        data, begin = utf8(batch.column("text"))
        runs = batch.column("runs")
        flat = runs.flatten()
        ends = np.append(0, np.cumsum(runs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)))
        keys, ats, ns = (flat.field(k).to_pylist() for k in ("key", "at", "n"))
        for r, doc in enumerate(ids):
            own, tag = data[begin[r] : begin[r + 1]].tobytes(), tags[r] << 32
            for k in range(ends[r], ends[r + 1]):
                at, n = ats[k], ns[k]
                if n < SINGLY:
                    found.setdefault((keys[k], own[at : at + n + LENGTH - 1]), set()).add((doc, tag + at))
                    continue
                for o in range(at, at + n - SINGLY):
                    digest = xxhash.xxh3_128_digest(own[o : o + LENGTH])
                    found.setdefault((int.from_bytes(digest[:8], "little", signed=True), digest), set()).add((doc, tag + o))
        placed = [sorted(x) for x in found.values()]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([k for k, _ in found], pa.int64()),
                pa.array([f for _, f in found], pa.binary()),
                pa.array([p[0][0] for p in placed], pa.int64()),
                pa.array([p[0][1] for p in placed], pa.int64()),
                pa.array([np.array(p[1:], np.int64).tobytes() for p in placed], pa.binary()),
            ],
            names=["key", "fragment", "doc", "spot", "places"],
        )


def transform(text: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all suffixes of the strings in order: the string, the suffix's length, the common prefix with the one before.

    text: the strings' symbols, from 1 on, one string after the other. An end is less than all symbols, and ends are in
    the strings' order. Round t inserts the suffixes of length t: a symbol c of the transform that stands before suffix X is
    the place of cX, by the number of smaller symbols and of c's before it; its common prefixes are 1 more than
    those of the suffixes at the neighbouring c's.
    """
    m, ends = len(sizes), np.cumsum(sizes)
    active = np.flatnonzero(sizes > 0)
    symbol, head = text[ends[active] - 1].astype(np.int64), np.zeros(len(active), np.int64)
    # The transform: symbols with their places below them, sorted. `turn` is where an active string's last symbol is there.
    fresh = np.zeros(m, np.int64)
    fresh[active] = symbol
    keys = np.sort((fresh << PLACE) + np.arange(m))
    turn, at = np.searchsorted(keys, (symbol << PLACE) + active), active
    prefixes, heads = np.zeros(m, np.uint8), np.zeros(int(text.max(initial=0)) + 1, np.int64)
    t = 0
    while len(active):
        t += 1
        n, k = len(keys), len(active)
        new = m + turn - np.searchsorted(keys, 1 << PLACE)
        # The suffixes at the neighbours with the same symbol have a common prefix where their first symbols are equal.
        first = np.cumsum(heads)
        both = []
        for other, side in ((turn - 1, 0), (turn + 1, 1)):
            near = keys[np.clip(other, 0, n - 1)]
            has = (other >= 0) & (other < n) & (near >> PLACE == symbol)
            near &= PLACES
            common = has.astype(np.uint8)
            own = np.flatnonzero(has & (head > 0) & (np.searchsorted(first, near - m, "right") == head))
            if len(own):
                low, high = (near[own], at[own]) if side == 0 else (at[own], near[own])
                down = np.argsort(-low, kind="stable")  # descending, so that what reduceat takes between two ranges is one number
                common[own[down]] += np.minimum.reduceat(np.append(prefixes, np.uint8(0)), np.stack((low[down] + 1, high[down] + 1), axis=1).ravel())[::2]
            both.append((has, common))
        heads += np.bincount(symbol, minlength=len(heads))
        old = np.ones(n + k, bool)
        old[new] = False
        grown = np.empty(n + k, np.uint8)
        grown[old], grown[new] = prefixes, both[0][1]
        follows = np.flatnonzero(both[1][0])
        follows = follows[old[np.minimum(new[follows] + 1, n + k - 1)]]
        grown[new[follows] + 1] = both[1][1][follows]
        prefixes = grown
        # Places after an insertion move on; then the inserted symbols are put in.
        ranked = np.sort(new)
        keys += np.repeat(np.arange(k + 1), np.diff(np.concatenate(([0], ranked - np.arange(k), [n]))))[keys & PLACES]
        left = sizes[active] > t
        fresh = np.where(left, text[np.maximum(ends[active] - t - 1, 0)], 0).astype(np.int64)
        made = (fresh << PLACE) + new
        rank = np.argsort(made)
        turns = np.searchsorted(keys, made[rank]) + np.arange(k)
        kept = np.ones(n + k, bool)
        kept[turns] = False
        merged = np.empty(n + k, np.int64)
        merged[kept], merged[turns] = keys, made[rank]
        keys, turn = merged, np.empty(k, np.int64)
        turn[rank] = turns
        active, at, turn, head, symbol = active[left], new[left], turn[left], symbol[left], fresh[left]
    return *suffixes_of(keys, sizes), prefixes


def suffixes_of(keys: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of a transform its suffix's string and length, by going through all strings at once from their ends."""
    m, rank = len(sizes), np.empty(len(keys), np.int64)
    rank[keys & PLACES] = np.arange(len(keys))
    begun = np.searchsorted(keys, 1 << PLACE)
    owner, length = np.empty(len(keys), np.int32), np.zeros(len(keys), np.uint8)
    owner[:m] = np.arange(m)
    place = active = np.flatnonzero(sizes > 0)
    t = 0
    while len(active):
        t += 1
        place = m + rank[place] - begun
        owner[place], length[place] = active, t
        on = sizes[active] > t
        active, place = active[on], place[on]
    return owner, length


def symbols_of(flat: np.ndarray) -> np.ndarray:
    """A number from 1 on for the WIDE bytes from each place on, in their order; `flat` has WIDE bytes more at its end."""
    n = len(flat) - WIDE
    eight = np.empty(n + 8, np.uint64)
    for k in range(8):
        own = flat[k : k + (n + 8 - k) // 8 * 8].view(">u8")
        eight[k : k + 8 * len(own) : 8] = own
    two = flat[8 : n + 8].astype(np.int64) << 8 | flat[9 : n + 9]
    return np.unique(np.unique(eight[:n], return_inverse=True)[1] << 16 | two, return_inverse=True)[1] + 1


def marked(fragments: list[bytes], docs: np.ndarray, spots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fragment, offset) of each window that also starts earlier; fragments[i]'s earliest place is docs[i], spots[i].

    Symbols are WIDE bytes: a fragment is read in up to WIDE phases, each a string of the collection, so that every window is a
    row of LENGTH / WIDE symbols of one of them.
    """
    lengths = np.array([len(x) for x in fragments])
    begins = np.cumsum(lengths) - lengths
    code = symbols_of(np.frombuffer(b"".join([*fragments, bytes(WIDE)]), np.uint8))
    phases = np.clip(lengths - LENGTH + 1, 0, WIDE)
    fragment = np.repeat(np.arange(len(fragments)), phases)
    phase = np.arange(len(fragment)) - np.repeat(np.cumsum(phases) - phases, phases)
    sizes = (lengths[fragment] - phase) // WIDE
    within = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    owner, length, lcp = transform(code[np.repeat(begins[fragment] + phase, sizes) + WIDE * within], sizes)
    window = np.flatnonzero(length >= LENGTH // WIDE)
    # Between two windows there is no shorter suffix that begins with both if they are equal: the prefix of
    # a skipped suffix is the least of all up to the next window.
    least = np.minimum.reduceat(lcp[: window[-1] + 1], np.append(0, window[:-1] + 1)) if len(window) else np.zeros(0, np.uint8)
    own = owner[window]
    string, offset = fragment[own], phase[own] + WIDE * (sizes[own] - length[window])
    group = np.cumsum(np.append(0, least[1:] < LENGTH // WIDE)) if len(window) else np.zeros(0, np.int64)
    start = spots[string] + offset
    order = np.lexsort((start, docs[string], group))
    later = np.append(False, group[order][1:] == group[order][:-1])
    return string[order][later], offset[order][later]


def _stretches(docs: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows: document, first start, how many."""
    order = np.lexsort((starts, docs))
    docs, starts = docs[order], starts[order]
    first = np.flatnonzero(np.append(True, (docs[1:] != docs[:-1]) | (starts[1:] != starts[:-1] + 1))) if len(docs) else np.zeros(0, np.int64)
    return docs[first], starts[first], np.diff(np.append(first, len(docs)))


def _mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From fragments sorted by key, fragment and place: stretches of windows that also start earlier."""
    whole: list[np.ndarray] = []
    waiting: list[tuple[bytes, int, int]] = []
    group: list[tuple[bytes, int, int]] = []
    key, held = None, 0

    def out(docs, spots, ns) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(docs, pa.int64()), pa.array((spots >> 32).astype(np.int32)), pa.array((spots & 0xFFFFFFFF).astype(np.int32)), pa.array(ns, pa.int32())], names=["doc_id", "tag", "at", "n"])

    def transformed() -> pa.RecordBatch:
        docs, spots = np.array([x[1] for x in waiting], np.int64), np.array([x[2] for x in waiting], np.int64)
        string, offset = marked([x[0] for x in waiting], docs, spots)
        waiting.clear()
        return out(*_stretches(docs[string], spots[string] + offset))

    def flushed() -> pa.RecordBatch:
        made = np.concatenate(whole)
        whole.clear()
        return out(*made.T)

    for batch in batches:
        for k, fragment, doc, spot, places in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if k != key:
                if len(group) > 1:
                    waiting += group
                group.clear()
                key = k
                if len(waiting) >= COLLECTION:
                    yield transformed()
            if not group or group[-1][0] != fragment:
                group.append((fragment, doc, spot))
            if places or (doc, spot) != group[-1][1:]:
                own = np.append(np.array([doc, spot]), np.frombuffer(places, np.int64)).reshape(-1, 2)
                own = own[(own[:, 0] != group[-1][1]) | (own[:, 1] != group[-1][2])]
                if len(own):
                    whole.append(np.column_stack((own, np.full(len(own), max(1, len(fragment) - LENGTH + 1)))))
                    held += len(own)
            if held > 100_000:
                yield flushed()
                held = 0
    if len(group) > 1:
        waiting += group
    if waiting:
        yield transformed()
    if whole:
        yield flushed()


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, begin = utf8(batch.column("text"))
        stretches = batch.column("stretches")
        removed, spans, hashes = [], [], []
        for r, own in enumerate(stretches.to_pylist()):
            text = data[begin[r] : begin[r + 1]]
            if not own:
                removed.append(0)
                spans.append(0)
                hashes.append(hashlib.sha256(text).hexdigest())
                continue
            step = np.zeros(len(text) + 1, np.int64)
            np.add.at(step, [x["at"] for x in own], 1)
            np.add.at(step, [x["at"] + x["n"] + LENGTH - 1 for x in own], -1)
            gone = np.cumsum(step[:-1]) > 0
            removed.append(int(gone.sum()))
            spans.append(int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()))
            hashes.append(hashlib.sha256(text[~gone].tobytes()).hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(begin)), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(hashes)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def tagged(docs: DataFrame) -> DataFrame:
    """(doc_id, tag, text); where any doc_id is repeated the tag is of the text, so it tells rows of one doc_id apart, else 0."""
    texts = texts_of(docs)
    again = texts.groupBy("doc_id").count().where("count > 1").limit(1).count()
    none = F.coalesce(F.pmod("doc_id", F.lit(1)), F.lit(0))  # no literal, which would part the tag from the keys of the joins
    return texts.withColumn("tag", (F.hash("text") if again else none).cast("int")).select("doc_id", "tag", "text")


def repeated_strings(spark: SparkSession, texts: DataFrame) -> DataFrame:
    """(doc_id, tag, at, n): n neighbouring 100-byte windows of a text (doc_id, tag, text), from byte `at`, that also start earlier."""
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = texts.where((F.octet_length("text") >= LENGTH) & F.col("doc_id").isNotNull()).mapInArrow(_keyed(even_numbers(spark, parts)), "part int, slice int, keys binary, docs binary, spots binary, n binary")
    runs = keyed.repartition(parts, "part").sortWithinPartitions("slice").mapInArrow(_repeated, "doc_id long, tag int, key long, at int, n int")
    by_doc = runs.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("key", "at", "n")).alias("runs"))  # a document's own runs
    # A left join, and a condition that keeps it one, so that dedup()'s join reuses the same exchange of the texts.
    with_runs = texts.join(by_doc, ["doc_id", "tag"], "left").where("runs is not null or doc_id is null").select("doc_id", "tag", "text", "runs")
    fragments = with_runs.mapInArrow(_cut, FRAGMENTS)
    return fragments.repartition(parts, "key").sortWithinPartitions("key", "fragment", "doc", "spot").mapInArrow(_mark, "doc_id long, tag int, at int, n int")


def dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    A null or empty text and texts under 100 bytes lose nothing; no rows give none; other columns stay out. Rows of one doc_id
    with different texts are documents in the order of their texts' hashes; rows that repeat one wholly are one document, and all lose
    the same. A null doc_id loses nothing, and what only it has is no earlier place.
    """
    texts = tagged(docs)
    stretches = repeated_strings(spark, texts).groupBy("doc_id", "tag").agg(F.collect_list(F.struct("at", "n")).alias("stretches"))
    return texts.join(stretches, ["doc_id", "tag"], "left").select("doc_id", "text", "stretches").mapInArrow(_remove, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(spark, table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 200) AS s FROM (SELECT doc_id, h, unnest(range(0, CAST(length(h) / 2 - 99 AS BIGINT))) AS i FROM d WHERE length(h) >= 200)),
late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS n FROM w) WHERE n > 1),
gone AS (SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(range(i, i + 100)) AS p FROM late)),
runs AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE before IS NULL OR before < p - 1) AS n_spans FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM gone) GROUP BY doc_id),
kept AS (
  SELECT doc_id, string_agg(substr(h, 2 * q + 1, 2), '' ORDER BY q) AS k
  FROM (SELECT d.doc_id, h, unnest(range(0, CAST(length(h) / 2 AS BIGINT))) AS q FROM d JOIN runs USING (doc_id)) ANTI JOIN (SELECT doc_id, p AS q FROM gone) USING (doc_id, q) GROUP BY doc_id
)
SELECT doc_id, CAST(length(h) / 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(CASE WHEN n_removed IS NULL THEN h ELSE coalesce(k, '') END)) AS kept_sha256
FROM d LEFT JOIN runs USING (doc_id) LEFT JOIN kept USING (doc_id)
"""
