"""Stored state, mappings and rejects: parquet folders in a folder that all executors share.

State is written as what is new, and read as what that makes of the rest. A batch adds one run: its own rows, sorted by
the hash of (resource, id). Runs of one level are merged once there are FAN of them, so there are few. Settled
rows lie in buckets by the low bits of the hash; a bucket takes up its rows of the runs once those are many against its
own, and one that grows over SPLIT rows is parted in two by the next bit while the others stay: the hashing is
extendible. So what a batch writes follows the batch, whatever the state holds.

Reading merges buckets and runs by the rule that the state was written with; rows of a run that a bucket has taken up
don't count any more. A batch's folders and its manifest are written whole before a pointer file names the batch, and
a batch that comes again overwrites its own, so a replay after a failure changes nothing.
"""

from __future__ import annotations

import json
import math
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import resolve

#: Runs of one level that are merged into one of the next.
FAN = 8
#: Rows in runs from which a bucket takes them up, and their share of the bucket's own rows.
FEW, SHARE = 100_000, 0.25
#: Rows of a bucket at most, about; one task writes a bucket.
SPLIT = 1_000_000
#: A batch takes up rows into buckets of so many rows for each of its own, and into one bucket at least if that is due.
EFFORT = 8

HASH, TURN = "state_hash", "state_turn"


@dataclass
class Bucket:
    """Rows whose hash ends in the `depth` bits of `low`: written by the batch `base`, with all rows of runs up to the batch `through`; `pending` rows of runs came after."""

    low: int = 0
    depth: int = 0
    base: int | None = None
    rows: int = 0
    through: int = -1
    pending: int = 0


@dataclass
class Run:
    name: str
    level: int
    last: int


@dataclass
class Manifest:
    rule: str
    schema: str
    buckets: list[Bucket] = field(default_factory=lambda: [Bucket()])
    runs: list[Run] = field(default_factory=list)

    @property
    def depth(self) -> int:
        return max(b.depth for b in self.buckets)

    def by_slot(self) -> list[Bucket]:
        """The bucket of each value of the low bits of the hash."""
        out: list = [None] * (1 << self.depth)
        for b in self.buckets:
            for slot in range(b.low, len(out), 1 << b.depth):
                out[slot] = b
        return out

    def of(self, values: Callable[[Bucket], object], kind: str, hashed: Column | None = None) -> Column:
        """For a row, a value of its bucket."""
        slot = (F.col(HASH) if hashed is None else hashed).bitwiseAND(F.lit((1 << self.depth) - 1)).cast("int")
        return F.element_at(F.lit([values(b) for b in self.by_slot()]).cast(f"array<{kind}>"), slot + 1)


def _files(spark: SparkSession, where: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(where)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, where: str) -> list[str]:
    path, fs = _files(spark, where)
    return sorted(x.getPath().getName() for x in fs.listStatus(path)) if fs.exists(path) else []


def _put(spark: SparkSession, where: str, text: str) -> None:
    path, fs = _files(spark, where)
    out = fs.create(path, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def _finished(spark: SparkSession, root: str) -> list[int]:
    """The batches that were finished, by the pointer files (one for each)."""
    return sorted(int(n.removeprefix("batch=")) for n in names(spark, f"{root}/pointers") if n.startswith("batch="))


def manifest_of(spark: SparkSession, root: str, batch: int) -> Manifest:
    path, fs = _files(spark, f"{root}/manifests/batch={batch}.json")
    stream = fs.open(path)
    try:
        found = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()
    return Manifest(found["rule"], found["schema"], [Bucket(**b) for b in found["buckets"]], [Run(**r) for r in found["runs"]])


def _last(spark: SparkSession, root: str, before: int | None) -> Manifest | None:
    found = [b for b in _finished(spark, root) if before is None or b < before]
    return manifest_of(spark, root, found[-1]) if found else None


def _schema(manifest: Manifest, *more: str) -> T.StructType:
    return T.StructType([*T.StructType.fromJson(json.loads(manifest.schema)).fields, *(T.StructField(c, T.LongType()) for c in more)])


def _bases(spark: SparkSession, root: str, manifest: Manifest, buckets: list[Bucket]) -> DataFrame:
    paths = [f"{root}/buckets/batch={b.base}/bucket={b.low}-{b.depth}" for b in buckets if b.base is not None]
    schema = _schema(manifest)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _pending(spark: SparkSession, root: str, manifest: Manifest, runs: list[Run]) -> DataFrame:
    """Rows of runs that their buckets have not taken up, with hash and turn."""
    rows = spark.read.schema(_schema(manifest, HASH, TURN)).parquet(*(f"{root}/runs/{r.name}" for r in runs))
    return rows.where(F.col(TURN) > manifest.of(lambda b: b.through, "long"))


def _rule(name: str) -> Callable:
    return getattr(resolve, name)


def _in_turn(rule: Callable, rows: DataFrame) -> DataFrame:
    return rule(rows, (TURN, *resolve.ARRIVAL))


def _merged(base: DataFrame, pending: DataFrame, rule: Callable) -> DataFrame:
    """base with the pending rows settled into it; ids that have none are not resolved again. What is in the base came first."""
    touched = pending.select(*resolve.ID).distinct()
    again = base.join(touched, resolve.ID, "left_semi").withColumn(TURN, F.lit(-1).cast("long")).unionByName(pending.drop(HASH))
    return base.join(touched, resolve.ID, "left_anti").unionByName(_in_turn(rule, again).select(base.columns))


def read_state(spark: SparkSession, root: str, before: int | None = None) -> DataFrame | None:
    """The state after the last finished batch (below `before`), or None."""
    manifest = _last(spark, root, before)
    if manifest is None:
        return None
    base = _bases(spark, root, manifest, manifest.buckets)
    if not any(b.pending for b in manifest.buckets):
        return base
    return _merged(base, _pending(spark, root, manifest, manifest.runs), _rule(manifest.rule))


def _write_run(rows: DataFrame, root: str, name: str) -> None:
    rows.hint("rebalance").sortWithinPartitions(HASH).write.mode("overwrite").parquet(f"{root}/runs/{name}")


def _add_run(spark: SparkSession, fresh: DataFrame, root: str, batch: int, manifest: Manifest) -> int:
    """The batch's rows as a run, and runs that are due merged; how many rows the batch has."""
    rule = _rule(manifest.rule)
    # Partial writes must be told apart until they meet what came before; of others the batch's winners are enough.
    own = fresh if rule is resolve.upserts else rule(fresh)
    own = own.select(_schema(manifest).fieldNames()).withColumn(HASH, F.xxhash64(*resolve.ID)).withColumn(TURN, F.lit(batch).cast("long"))
    _write_run(own, root, f"batch={batch}-0")
    slots, n = manifest.by_slot(), 0
    counts = spark.read.parquet(f"{root}/runs/batch={batch}-0").groupBy(F.col(HASH).bitwiseAND(F.lit(len(slots) - 1)).alias("slot")).count()
    for r in counts.collect():  # as many as there are slots
        slots[r["slot"]].pending += r["count"]
        n += r["count"]
    if n:
        manifest.runs.append(Run(f"batch={batch}-0", 0, batch))
    while len(manifest.runs) >= FAN and len({r.level for r in manifest.runs[-FAN:]}) == 1:
        several, level = manifest.runs[-FAN:], manifest.runs[-1].level + 1
        rows = _pending(spark, root, manifest, several)
        _write_run(rows if rule is resolve.upserts else _in_turn(rule, rows).select(*_schema(manifest, HASH, TURN).fieldNames()), root, f"batch={batch}-{level}")
        manifest.runs[-FAN:] = [Run(f"batch={batch}-{level}", level, several[-1].last)]
    return n


def _take_up(spark: SparkSession, root: str, batch: int, manifest: Manifest, due: list[Bucket]) -> None:
    """The due buckets anew, with their rows of the runs; those that may be over SPLIT rows in parts."""
    rows = _pending(spark, root, manifest, manifest.runs).where(manifest.of(lambda b: b in due, "boolean"))
    settled = _merged(_bases(spark, root, manifest, due), rows, _rule(manifest.rule))
    parts = []
    for b in due:
        more = max(0, math.ceil(math.log2(max(1, b.rows + b.pending) / SPLIT)))
        parts += [Bucket(b.low + (k << b.depth), b.depth + more, batch, 0, batch) for k in range(1 << more)]
    manifest.buckets = [b for b in manifest.buckets if b not in due] + parts
    name = manifest.of(lambda b: f"{b.low}-{b.depth}", "string", F.xxhash64(*resolve.ID))
    path = f"{root}/buckets/batch={batch}"
    settled.withColumn("bucket", name).repartition(len(parts), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
    found = {r["bucket"]: r["count"] for r in spark.read.schema("bucket string").parquet(path).groupBy("bucket").count().collect()} if any(n.startswith("bucket=") for n in names(spark, path)) else {}
    for b in parts:
        b.rows = found.get(f"{b.low}-{b.depth}", 0)
        b.base = batch if b.rows else None
    oldest = min(b.through for b in manifest.buckets)
    manifest.runs = [r for r in manifest.runs if r.last > oldest]


def update_state(fresh: DataFrame, root: str, batch: int, settle: Callable = resolve.latest_wins) -> None:
    """The state with a batch of actions. settle: the rule of the state, one of resolve's; it stays that of the first batch."""
    spark = fresh.sparkSession
    manifest = _last(spark, root, before=batch) or Manifest(settle.__name__, fresh.schema.json())
    n = _add_run(spark, fresh, root, batch, manifest)
    effort, due = EFFORT * n, []
    for b in sorted(manifest.buckets, key=lambda b: -b.pending / (b.rows + 1)):
        if b.pending > FEW and b.pending > SHARE * b.rows and (not due or effort >= b.rows + b.pending):
            due.append(b)
            effort -= b.rows + b.pending
    if due:
        _take_up(spark, root, batch, manifest, due)
    _put(spark, f"{root}/manifests/batch={batch}.json", json.dumps(asdict(manifest)))
    _put(spark, f"{root}/pointers/batch={batch}", "")


def remove_old(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Deletes what none of the last `keep` finished batches needs; how many folders. A batch that may be replayed needs the one before."""
    done = _finished(spark, root)
    kept = [manifest_of(spark, root, b) for b in done[-keep:]]
    needed = {f"runs/{r.name}" for m in kept for r in m.runs} | {f"buckets/batch={b.base}/bucket={b.low}-{b.depth}" for m in kept for b in m.buckets}
    there = [f"runs/{n}" for n in names(spark, f"{root}/runs")]
    there += [f"buckets/{b}/{n}" for b in names(spark, f"{root}/buckets") for n in names(spark, f"{root}/buckets/{b}") if n.startswith("bucket=")]
    # What a batch after the last finished one has begun to write is not old.
    gone = [x for x in there if x not in needed and int(x.split("batch=")[1].split("-")[0].split("/")[0]) <= (done[-1] if done else -1)]
    for b in done[:-keep]:
        gone += [f"pointers/batch={b}", f"manifests/batch={b}.json"]
    for x in gone:
        path, fs = _files(spark, f"{root}/{x}")
        fs.delete(path, True)
    return sum(x.startswith(("runs/", "buckets/")) for x in gone)


def write_rejects(rejected: DataFrame, root: str, batch: int, stage: str = "convert") -> None:
    """Position, key, value as text and reason; the values are for whoever may read them, messages have positions only."""
    text = lambda c: F.to_json(c) if dict(rejected.dtypes)[c].startswith(("struct", "map", "array")) else F.col(c).cast("string")
    rejected.select("topic", "partition", "offset", text("key").alias("key"), text("value").alias("value"), "reason").write.mode("overwrite").parquet(f"{root}/rejects/stage={stage}/batch={batch}")


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/rejects")


def mapped(spark: SparkSession, root: str, before: int) -> DataFrame:
    """(resource): those that got a mapping in a batch below `before`."""
    path, fs = _files(spark, f"{root}/mappings")
    if not fs.exists(path):
        return spark.createDataFrame([], "resource string")
    return spark.read.parquet(f"{root}/mappings").where(F.col("batch") < before).select("resource").distinct()


def doc_counts(state: DataFrame) -> DataFrame:
    return state.groupBy("resource").agg(F.count("*").alias("n_docs"))
