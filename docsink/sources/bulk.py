"""A bulk HTTP sink, for batches and streams: spark_df.write.format("docsink_bulk"), or `sent`, which gives each row's outcome.

Rows: action string, body string (null for deletes), as frame.action_line and the document make them. Each task sends
its rows in batches by count and bytes; a whole call is tried again on any failure. Rows are sent in the partition's order.
A task has one call in flight, so `bulk_rows` and `sent` deal rows to no more tasks than calls may be in flight.

A stream with the option `outcomes`, a folder that all share, keeps what became of its rows in two phases. Tasks stage
files of rejects and of the offsets that are done; the commit of a micro-batch takes the place of whatever an
earlier try of it had published, and only then marks the batch as done; an abort drops what was staged. So a replayed batch neither
loses nor doubles a reject. After a fatal outcome its task raises a flag in the folder, which all look at before each call: nothing
more is sent, the query fails, and the next start begins without the flag.
"""

from __future__ import annotations

import gzip
import json
import random
import time
import urllib.request
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import islice

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, WriterCommitMessage

from ..operators import frame
from ..operators.outcome import CONFLICT, MALFORMED, classify
from ..operators.project import POSITION
from ..options import Options
from . import state

LONGEST_WAIT_MS = 24 * 3600 * 1000


def with_retries(call: Callable[[], object], retries: int, backoff_ms: int, sleep=time.sleep, uniform=random.uniform, most_ms: float = float("inf"), clock=time.monotonic):
    """call(), again after any exception up to `retries` times, if that begins within `most_ms`; waits are uniform below backoff * 2^attempt."""
    began = clock()
    for attempt in range(retries + 1):
        try:
            return call()
        except Exception:
            wait = uniform(0, min(LONGEST_WAIT_MS, backoff_ms * 2**attempt)) / 1000
            if attempt == retries or (clock() - began + wait) * 1000 > most_ms:
                raise
            sleep(wait)


def frames(rows: Iterator[tuple], most_rows: int, most_bytes: int) -> Iterator[list[tuple]]:
    """Rows (action, body, ...) in batches, closed by count or bytes."""
    batch: list[tuple] = []
    held = 0
    for row in rows:
        batch.append(row)
        held += len(row[0].encode()) + len((row[1] or "").encode()) + 2
        if len(batch) >= most_rows or (most_bytes != -1 and held >= most_bytes):
            yield batch
            batch, held = [], 0
    if batch:
        yield batch


def error_kind(error: str) -> str:
    """As outcome.error_class has it."""
    if not error:
        return "ok"
    return "malformed" if any(name in error for name in MALFORMED) else "conflict" if CONFLICT in error else "other"


def error_text(error: dict | str | None) -> str:
    if not error:
        return ""
    return (": ".join(filter(None, (error.get("type"), error.get("reason")))) if isinstance(error, dict) else str(error)) or "unknown error"


class _Folder:
    """A folder that driver and executors share, from Python."""

    def __init__(self, where: str):
        self.fs, self.path = pafs.FileSystem.from_uri(where)

    def exists(self, name: str) -> bool:
        return self.fs.get_file_info(f"{self.path}/{name}").type != pafs.FileType.NotFound

    def touch(self, name: str) -> None:
        self.fs.create_dir(f"{self.path}/{name}".rpartition("/")[0])
        self.fs.open_output_stream(f"{self.path}/{name}").close()

    def write(self, name: str, rows: pa.Table) -> str:
        self.fs.create_dir(f"{self.path}/{name}".rpartition("/")[0])
        pq.write_table(rows, f"{self.path}/{name}", filesystem=self.fs)
        return name

    def move(self, name: str, to: str) -> None:
        self.fs.create_dir(f"{self.path}/{to}".rpartition("/")[0])
        self.fs.move(f"{self.path}/{name}", f"{self.path}/{to}")

    def remove(self, name: str) -> None:
        if self.exists(name):
            path = f"{self.path}/{name}"
            (self.fs.delete_dir if self.fs.get_file_info(path).type == pafs.FileType.Directory else self.fs.delete_file)(path)


@dataclass
class Sent(WriterCommitMessage):
    calls: int
    written: int
    conflicts: int
    malformed: int
    #: Names of staged files of rejects and of progress.
    staged: tuple[str, ...] = ()


#: What is kept of a stream's rows.
REJECTS = pa.schema([("topic", pa.string()), ("partition", pa.int32()), ("offset", pa.int64()), ("error_class", pa.string()), ("message", pa.string())])
DONE = pa.schema([("topic", pa.string()), ("partition", pa.int32()), ("first", pa.int64()), ("last", pa.int64())])


def intervals(offsets: dict[tuple, list[int]]) -> list[tuple]:
    """(topic, partition, first, last) of the runs of offsets."""
    out = []
    for key, own in offsets.items():
        own = sorted(set(own))
        cuts = [0, *(k for k in range(1, len(own)) if own[k] != own[k - 1] + 1), len(own)]
        out += [(*key, own[i], own[j - 1]) for i, j in zip(cuts, cuts[1:])]
    return out


class _Writer:
    def __init__(self, options: dict[str, str], schema: T.StructType | None = None):
        self.url = options["url"].rstrip("/") + "/_bulk"
        self.rows, self.bytes = int(options.get("batch_size", 2000)), int(options.get("bulk_bytes", 5 << 20))
        self.retries, self.backoff = int(options.get("max_retries", 5)), int(options.get("backoff_ms", 100))
        self.flush_timeout = float(options.get("flush_timeout_ms", 180_000))
        self.timeout, self.gzip = float(options.get("timeout_s", 3)), options.get("gzip", "false").lower() == "true"
        self.malformed = options.get("malformed_policy", "fail")
        self.streams = options.get("is_stream", "false").lower() == "true"
        self.where, self.run = options.get("outcomes"), options.get("run") or uuid.uuid4().hex
        self.names = schema.fieldNames() if schema is not None else ["action", "body"]
        self.stopped, self.calls = False, 0

    def send(self, batch: list[tuple]) -> dict:
        body = "".join(f"{row[0]}\n" + (f"{row[1]}\n" if row[1] is not None else "") for row in batch).encode()
        headers = {"Content-Type": "application/x-ndjson"}
        if self.gzip:
            body, headers["Content-Encoding"] = gzip.compress(body), "gzip"
        with urllib.request.urlopen(urllib.request.Request(self.url, body, headers, method="POST"), timeout=self.timeout) as answer:
            return json.loads(answer.read())

    def fatal(self, error: str) -> bool:
        kind = error_kind(error)
        return kind == "other" or (kind == "malformed" and self.malformed == "fail")

    def outcomes(self, rows: Iterator[tuple]) -> Iterator[tuple[tuple, str | None]]:
        """Each row (action, body, ...) with the error of its answer, '' where it was written, None where it was not sent: after a fatal one none is."""
        folder = _Folder(self.where) if self.where else None
        for batch in frames(rows, self.rows, self.bytes):
            self.stopped = self.stopped or (folder is not None and folder.exists(f"staging/{self.run}/stop"))
            if self.stopped:
                yield from ((row, None) for row in batch)
                continue
            items = with_retries(lambda b=batch: self.send(b), self.retries, self.backoff, most_ms=self.flush_timeout).get("items", [])
            self.calls += 1
            errors = [error_text(next(iter(x.values())).get("error")) for x in items] + ["no answer"] * (len(batch) - len(items))
            yield from zip(batch, errors[: len(batch)])
            if any(map(self.fatal, errors)):
                self.stopped = True
                if folder is not None:
                    folder.touch(f"staging/{self.run}/stop")

    def write(self, rows: Iterator) -> Sent:
        """Sends a task's rows, and stages what became of them; raises if any outcome is fatal, or nothing may be sent any more."""
        at = {name: k for k, name in enumerate(self.names)}
        place = [at.get(c) for c in ("topic", "partition", "offset")]
        held, refused, done, rejects, offsets = [], None, Sent(0, 0, 0, 0), [], {}

        def position(row: tuple) -> tuple:
            return tuple(row[k] if k is not None else None for k in place)

        def to_send() -> Iterator[tuple]:
            nonlocal refused
            for row in rows:
                reason = row[at["reason"]] if "reason" in at else None
                if reason is None:
                    yield (row[at["action"]], row[at["body"]], row)
                    continue
                held.append((*position(row), "invalid", reason))
                if "stops" in at and row[at["stops"]]:
                    refused = refused or f"{reason}: {POSITION % position(row)}"
                    self.stopped = True  # the whole micro-batch comes again
                else:
                    offsets.setdefault(position(row)[:2], []).append(position(row)[2])

        for (_, _, row), error in self.outcomes(to_send()):
            if error is None:
                continue
            kind = error_kind(error)
            done.written += kind == "ok"
            done.conflicts += kind == "conflict"
            done.malformed += kind == "malformed"
            if self.fatal(error):
                refused = refused or ("a malformed document was refused" if kind == "malformed" else "a write failed; see the target's answer")
                continue
            external = bool(row[at["external"]]) if "external" in at else False
            if kind == "malformed" or (kind == "conflict" and not external and not self.streams):
                rejects.append((*position(row), kind, error))
            offsets.setdefault(position(row)[:2], []).append(position(row)[2])
        done.calls = self.calls
        if refused and self.where:
            _Folder(self.where).touch(f"staging/{self.run}/stop")
        if refused or self.stopped:
            raise RuntimeError(refused or "another task's write was fatal; nothing more is sent")
        if self.where:
            done.staged = tuple(self.stage(held + rejects, intervals(offsets) if None not in place else []))
        return done

    def stage(self, rejects: list[tuple], finished: list[tuple]) -> Iterator[str]:
        folder, task = _Folder(self.where), uuid.uuid4().hex
        for kind, rows, schema in (("rejects", rejects, REJECTS), ("done", finished, DONE)):
            if rows:
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), schema.types)]
                yield folder.write(f"staging/{self.run}/{kind}/{task}.parquet", pa.Table.from_arrays(columns, schema=schema))


class _Batch(_Writer, DataSourceWriter):
    pass


class _Stream(_Writer, DataSourceStreamWriter):
    def commit(self, messages, batchId) -> None:
        if not self.where:
            return
        folder = _Folder(self.where)
        folder.remove(f"finished/batch={batchId}")
        for kind in ("rejects", "done"):
            folder.remove(f"{kind}/batch={batchId}")
        for k, name in enumerate(x for m in messages if m for x in m.staged):
            folder.move(name, f"{name.split('/')[2]}/batch={batchId}/part-{k}.parquet")
        folder.touch(f"finished/batch={batchId}")
        folder.remove("staging")

    def abort(self, messages, batchId) -> None:
        if self.where:
            for name in (x for m in messages if m for x in m.staged):
                _Folder(self.where).remove(name)


class BulkSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "docsink_bulk"

    def writer(self, schema, overwrite: bool) -> DataSourceWriter:
        return _Batch(dict(self.options), schema)

    def streamWriter(self, schema, overwrite: bool) -> DataSourceStreamWriter:
        return _Stream(dict(self.options), schema)


def sink_options(options: Options, url: str, **more: str) -> dict[str, str]:
    """A job's options as those of this sink."""
    own = {"batch_size": options.batch_size, "bulk_bytes": options.bulk_bytes, "max_retries": options.max_retries, "backoff_ms": options.backoff_ms, "malformed_policy": options.malformed_policy, "flush_timeout_ms": options.flush_timeout_ms, "is_stream": str(options.is_stream).lower()}
    return {"url": url, **{k: str(v) for k, v in own.items()}, **more}


def _finished_of(spark: SparkSession, root: str, kind: str, schema: str) -> DataFrame:
    batches = [int(n.removeprefix("batch=")) for n in state.names(spark, f"{root}/finished") if n.startswith("batch=")]
    there = set(state.names(spark, f"{root}/{kind}"))
    paths = [f"{root}/{kind}/batch={b}" for b in sorted(batches) if f"batch={b}" in there]
    return spark.read.schema(schema).option("basePath", f"{root}/{kind}").parquet(*paths) if paths else spark.createDataFrame([], f"{schema}, batch long")


def read_rejects(spark: SparkSession, root: str) -> DataFrame:
    """(topic, partition, offset, error_class, message, batch) of a stream's finished batches."""
    return _finished_of(spark, root, "rejects", "topic string, partition int, offset long, error_class string, message string")


def read_done(spark: SparkSession, root: str) -> DataFrame:
    """(topic, partition, first, last, batch): the runs of offsets that are done; progress.safe_of_runs says what may be committed."""
    return _finished_of(spark, root, "done", "topic string, partition int, first long, last long")


def bulk_rows(actions: DataFrame, tasks: int) -> DataFrame:
    """actions (topic, partition, offset, op, version, doc_json, ...) as rows of this sink, a log partition in one of `tasks` tasks."""
    lines = frame.action_line(version="version")
    body = F.when(F.col("op") == "update", F.concat(F.lit('{"doc":'), "doc_json", F.lit(',"doc_as_upsert":true}'))).when(F.col("op") != "delete", F.col("doc_json"))
    rest = [c for c in ("reason", "stops") if c in actions.columns]
    return actions.repartition(tasks, "topic", "partition").select(lines.alias("action"), body.alias("body"), "topic", "partition", "offset", F.col("version").isNotNull().alias("external"), *rest)


def sent(actions: DataFrame, options: Options, url: str, root: str | None = None, **more: str) -> DataFrame:
    """Sends actions (topic, partition, offset, op, version, doc_json, ...) and gives each one's position and outcome, as outcome.classify has it.

    Write the result, once: each run sends. Its `reported` rows are the rejects; the job is to stop if any is `fatal`. After a fatal
    outcome its task sends nothing more, and with `root`, a shared folder, no task does; what was not sent has the error_class `unsent`.
    Rows go in the order of their log partition, batches over Arrow's; a task that is tried again sends again, which versions and ids make harmless.
    """
    settings = sink_options(options, url, **more, **({"outcomes": root, "run": uuid.uuid4().hex} if root else {}))
    rows = bulk_rows(actions, options.max_in_flight).sortWithinPartitions("topic", "partition", "offset")
    columns = ["topic", "partition", "offset", "external"]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for own in batches:
                yield from zip(*(own.column(c).to_pylist() for c in ("action", "body", *columns)), strict=True)

        writer = _Writer(settings)
        answers = writer.outcomes(each())
        while several := list(islice(answers, writer.rows)):
            kept = [pa.array([row[k + 2] for row, _ in several], t) for k, t in enumerate((pa.string(), pa.int32(), pa.int64(), pa.bool_()))]
            errors = [e for _, e in several]
            yield pa.RecordBatch.from_arrays([*kept, pa.array([e != "" for e in errors]), pa.array(errors, pa.string())], names=[*columns, "failed", "message"])

    items = rows.mapInArrow(send, "topic string, partition int, offset long, external boolean, failed boolean, message string")
    items = items.withColumn("unsent", F.col("message").isNull()).withColumn("message", F.coalesce("message", F.lit("")))
    told = classify(items, options.malformed_policy, F.col("external"), options.is_stream)
    flags = {c: F.col(c) & ~F.col("unsent") for c in ("processed", "reported", "fatal")}
    return told.withColumns({"error_class": F.when(F.col("unsent"), "unsent").otherwise(F.col("error_class")), **flags}).drop("unsent")


def register(spark: SparkSession) -> None:
    spark.dataSource.register(BulkSink)
