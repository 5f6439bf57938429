import json
import random
import threading
import time
from http.server import BaseHTTPRequestHandler, HTTPServer, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from docsink.operators import checks, frame, progress, resolve
from docsink.options import Options
from docsink.plans import job
from docsink.sources import bulk, state
from docsink.sources import changes as source
from docsink.streaming import bulk_sink, offsets, state_sink


@pytest.fixture
def target():
    """A bulk endpoint whose answers are set by a list of (status, item error); then it accepts all."""
    seen, answers = [], []

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            body = self.rfile.read(int(self.headers["Content-Length"]))
            status, error = answers.pop(0) if answers else (200, None)
            lines = [json.loads(x) for x in body.decode().splitlines()] if status == 200 else []
            items = [{next(iter(x)): {"_id": "i", "status": 200} | ({"error": {"type": error, "reason": ""}} if error else {})} for x in lines if next(iter(x)) in ("index", "create", "update", "delete")]
            seen.append((status, lines))
            self.send_response(status)
            self.end_headers()
            self.wfile.write(json.dumps({"items": items}).encode())

        def log_message(self, *args):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}", seen, answers
    server.shutdown()


def lines(spark, n):
    rows = spark.range(n).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit("r").alias("resource"), F.col("id").cast("string").alias("id"), F.lit("index").alias("op"), F.lit('{"x":1}').alias("doc_json"))
    return rows.coalesce(1).select(frame.action_line().alias("action"), F.col("doc_json").alias("body"))


def send(df, url, **options):
    df.write.format("docsink_bulk").option("url", url).options(max_retries="2", backoff_ms="1", **options).mode("append").save()


def test_bulk_writes_and_retries(spark, target):
    url, seen, answers = target
    bulk.register(spark)
    answers += [(429, None), (503, None)]
    send(lines(spark, 5), url, batch_size="2")
    assert [s for s, _ in seen] == [429, 503, 200, 200, 200]
    assert [len(x) for s, x in seen if s == 200] == [4, 4, 2]
    answers += [(200, bulk.CONFLICT), (200, "mapper_parsing_exception")]
    send(lines(spark, 2), url, batch_size="1", malformed_policy="warn")
    answers += [(200, "mapper_parsing_exception")]
    with pytest.raises(Exception, match="malformed"):
        send(lines(spark, 1), url)


def test_outcomes_of_sent_rows_have_positions(spark, target):
    url, seen, answers = target
    answers += [(429, None), (200, None), (200, bulk.CONFLICT), (200, "mapper_parsing_exception"), (200, bulk.CONFLICT)]
    rows = spark.range(4).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit("r").alias("resource"), F.col("id").cast("string").alias("id"), F.lit("index").alias("op"), F.when(F.col("id") == 3, F.col("id")).alias("version"), F.lit('{"x":1}').alias("doc_json"))
    found = bulk.sent(rows, Options(batch_size=1, max_retries=1, backoff_ms=1, malformed_policy="warn"), url).collect()
    found.sort(key=lambda r: r["offset"])
    assert [(r["offset"], r["error_class"], r["processed"], r["reported"], r["fatal"]) for r in found] == [(0, "ok", True, False, False), (1, "conflict", True, True, False), (2, "malformed", True, True, False), (3, "conflict", True, False, False)]
    assert [s for s, _ in seen] == [429, 200, 200, 200, 200]


def test_nothing_is_sent_after_a_fatal_outcome(spark, target, tmp_path):
    url, seen, answers = target
    answers += [(200, None), (200, "boom")]
    rows = spark.range(6).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit("r").alias("resource"), F.col("id").cast("string").alias("id"), F.lit("index").alias("op"), F.lit(None).cast("long").alias("version"), F.lit('{"x":1}').alias("doc_json"))
    found = bulk.sent(rows, Options(batch_size=1, max_in_flight=1, malformed_policy="warn"), url, str(tmp_path)).collect()
    found.sort(key=lambda r: r["offset"])
    assert [(r["error_class"], r["processed"], r["fatal"]) for r in found] == [("ok", True, False), ("other", False, True)] + [("unsent", False, False)] * 4
    assert len(seen) == 2
    # Another task of the same run sees the flag; one of the next run does not.
    other = {"url": url, "outcomes": str(tmp_path), "run": next((tmp_path / "staging").iterdir()).name}
    assert [e for _, e in bulk._Writer(other).outcomes(iter([("{}", None)]))] == [None] and len(seen) == 2
    assert [e for _, e in bulk._Writer(other | {"run": "next"}).outcomes(iter([('{"index":{}}', '{"x":1}')]))] == [""]


def test_calls_in_flight_are_limited(spark):
    lock, now, most = threading.Lock(), [0], [0]

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            with lock:
                now[0] += 1
                most[0] = max(most[0], now[0])
            time.sleep(0.05)
            self.rfile.read(int(self.headers["Content-Length"]))
            with lock:
                now[0] -= 1
            self.send_response(200)
            self.end_headers()
            self.wfile.write(b'{"items":[{"index":{"_id":"i"}}]}')

        def log_message(self, *args):
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    rows = spark.range(48).select(F.lit("t").alias("topic"), (F.col("id") % 16).cast("int").alias("partition"), F.col("id").alias("offset"), F.lit("r").alias("resource"), F.col("id").cast("string").alias("id"), F.lit("index").alias("op"), F.lit(None).cast("long").alias("version"), F.lit('{"x":1}').alias("doc_json"))
    try:
        found = bulk.sent(rows, Options(batch_size=1, max_in_flight=3), f"http://127.0.0.1:{server.server_port}").collect()
    finally:
        server.shutdown()
    assert len(found) == 48 and {r["error_class"] for r in found} == {"ok"} and 1 < most[0] <= 3


def test_frames_go_over_arrow_batches(spark, target):
    url, seen, _ = target
    rows = spark.range(50).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"), F.lit("r").alias("resource"), F.col("id").cast("string").alias("id"), F.lit("index").alias("op"), F.lit(None).cast("long").alias("version"), F.lit('{"x":1}').alias("doc_json"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert bulk.sent(rows, Options(batch_size=20), url).where("processed").count() == 50
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [len(x) // 2 for _, x in seen] == [20, 20, 10]


def test_a_streams_outcomes_are_published_once(spark, target, tmp_path):
    """A micro-batch that failed after it had sent rows comes again: its rejects are there once, and its progress."""
    url, seen, answers = target
    for k, own in enumerate(([(0, 1, "a"), (1, 2, "b")], [(2, None, "c"), (3, 3, "d"), (4, 4, "e")])):
        spark.createDataFrame(own, SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in" / f"file-{k}"))
    options = Options(batch_size=1, max_in_flight=1, malformed_policy="warn", drop_invalid=True)
    rows = lambda: source.as_changes(spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in")), topic=F.lit("Events"), partition=F.lit(0), offset="o", key="k", value=F.struct("v"))
    run = lambda: bulk_sink.send_changes(rows(), url, str(tmp_path / "out"), options, str(tmp_path / "checkpoint")).awaitTermination()
    malformed = "mapper_parsing_exception"
    answers += [(200, malformed), (200, None), (200, malformed), (200, "boom")]
    with pytest.raises(Exception, match="see the target's answer"):
        run()
    assert len(seen) == 4
    assert sorted((r["offset"], r["error_class"], r["batch"]) for r in bulk.read_rejects(spark, str(tmp_path / "out")).collect()) == [(0, "malformed", 0)]
    answers += [(200, malformed), (200, None)]
    run()
    want = [(0, "malformed", 0), (2, "invalid", 1), (3, "malformed", 1)]
    assert sorted((r["offset"], r["error_class"], r["batch"]) for r in bulk.read_rejects(spark, str(tmp_path / "out")).collect()) == want
    assert sorted((r["first"], r["last"], r["batch"]) for r in bulk.read_done(spark, str(tmp_path / "out")).collect()) == [(0, 1, 0), (2, 4, 1)]
    assert [tuple(r) for r in progress.safe_of_runs(bulk.read_done(spark, str(tmp_path / "out"))).collect()] == [("Events", 0, 5)]
    # A commit that comes again takes the place of the one before; what an aborted try staged goes.
    writer = bulk._Stream({"url": url, "outcomes": str(tmp_path / "out")})
    again = bulk.Sent(0, 0, 0, 0, tuple(writer.stage([("Events", 0, 3, "malformed", "again")], [("Events", 0, 2, 4)])))
    writer.commit([again, None], 1)
    dropped = bulk.Sent(0, 0, 0, 0, tuple(writer.stage([("Events", 0, 9, "malformed", "x")], [])))
    writer.abort([None, dropped], 2)
    assert sorted((r["offset"], r["message"]) for r in bulk.read_rejects(spark, str(tmp_path / "out")).where("batch = 1").collect()) == [(3, "again")]
    assert bulk.read_rejects(spark, str(tmp_path / "out")).count() == 2 and not list((tmp_path / "out").glob("staging/*/*/*.parquet"))


def test_invalid_records_stop_a_sending_stream(spark, target, tmp_path):
    url, seen, _ = target
    spark.createDataFrame([(0, 1, "a"), (1, None, "b")], SCHEMA).coalesce(1).write.parquet(str(tmp_path / "in"))
    rows = source.as_changes(source.file_changes(spark, str(tmp_path / "in"), SCHEMA), topic=F.lit("Events"), partition=F.lit(0), offset="o", key="k", value=F.struct("v"))
    with pytest.raises(Exception, match="null key"):
        bulk_sink.send_changes(rows, url, str(tmp_path / "out"), Options(), str(tmp_path / "checkpoint")).awaitTermination()
    assert bulk.read_rejects(spark, str(tmp_path / "out")).count() == 0


def test_retry_waits():
    waits, calls = [], []

    def fail():
        calls.append(1)
        raise OSError("down")

    with pytest.raises(OSError):
        bulk.with_retries(fail, 3, 100, waits.append, lambda a, b: b)
    assert len(calls) == 4 and waits == [0.1, 0.2, 0.4]
    bulk.with_retries(lambda: 1, 0, 0)
    now = iter([0, 0.05, 0.1, 0.35])  # seconds at the begin and after each failure: no new try begins after 600 ms
    calls.clear()
    with pytest.raises(OSError):
        bulk.with_retries(fail, 9, 100, waits.append, lambda a, b: b, most_ms=600, clock=lambda: next(now))
    assert len(calls) == 3
    assert bulk.with_retries(lambda: 7, 5, 0) == 7


def test_frames_by_rows_and_bytes():
    rows = [("a" * 10, "b" * 10)] * 5
    assert [len(x) for x in bulk.frames(iter(rows), 2, -1)] == [2, 2, 1]
    assert [len(x) for x in bulk.frames(iter(rows), 100, 40)] == [2, 2, 1]


def events(n):
    return [(i, i % 7, None if i % 5 == 4 else f"v{i}") for i in range(n)]


SCHEMA = "o long, k long, v string"


def envelope(df):
    return source.as_changes(df, topic=F.lit("Events"), partition=F.pmod("k", F.lit(2)), offset="o", key="k", value=F.when(F.col("v").isNotNull(), F.struct("v")))


def settled(df):
    return sorted((r["id"], r["version"], r["op"], r["doc"]["v"] if r["doc"] else None) for r in df.collect())


@pytest.mark.parametrize("files", [1, 3, 7])
def test_a_stream_is_its_batch(spark, tmp_path, files):
    options = Options(null_policy="delete")
    data = spark.createDataFrame(events(70), SCHEMA)
    data.repartition(files).write.parquet(str(tmp_path / "in"))
    stream = envelope(source.file_changes(spark, str(tmp_path / "in"), data.schema))
    state_sink.keep_state(stream, str(tmp_path / "out"), options, str(tmp_path / "checkpoint")).awaitTermination()
    batch = resolve.latest_wins(job.actions(checks.accepted(job.tagged(envelope(data), options)), options))
    kept = state.read_state(spark, str(tmp_path / "out"))
    assert settled(kept) == settled(batch)
    assert {r["resource"]: r["n_docs"] for r in state.doc_counts(kept).collect()} == {"events": 7}


def test_a_lingering_stream(spark, tmp_path):
    """With linger micro-batches wait that long for more; what comes while the query runs is taken up."""
    data = spark.createDataFrame(events(70), SCHEMA)
    data.where("o < 40").coalesce(1).write.parquet(str(tmp_path / "in"))
    options = Options(null_policy="delete", linger_ms=200)
    running = state_sink.keep_state(envelope(source.file_changes(spark, str(tmp_path / "in"), data.schema)), str(tmp_path / "out"), options, str(tmp_path / "checkpoint"), linger=True)
    try:
        running.processAllAvailable()
        data.where("o >= 40").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        running.processAllAvailable()
    finally:
        running.stop()
    assert settled(state.read_state(spark, str(tmp_path / "out"))) == settled(resolve.latest_wins(job.actions(checks.accepted(job.tagged(envelope(data), options)), options)))


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    root, options = str(tmp_path), Options(null_policy="delete")
    a, b = (envelope(spark.createDataFrame(x, SCHEMA)) for x in (events(70)[:40], events(70)[40:]))
    state_sink.apply_changes(a, root, 0, options)
    state_sink.apply_changes(b, root, 1, options)
    once = settled(state.read_state(spark, root))
    state_sink.apply_changes(b, root, 1, options)
    assert settled(state.read_state(spark, root)) == once


def test_rejects_are_written_before_the_job_stops(spark, tmp_path):
    rows = envelope(spark.createDataFrame([(0, 1, "x"), (1, None, "y"), (2, 2, None)], SCHEMA))
    with pytest.raises(checks.InvalidRecords):
        state_sink.apply_changes(rows, str(tmp_path), 0, Options(null_policy="ignore"))
    assert {r["reason"] for r in state.read_rejects(spark, str(tmp_path)).collect()} == {"null key", "null value"}
    assert state.read_state(spark, str(tmp_path)) is None
    state_sink.apply_changes(rows, str(tmp_path), 0, Options(null_policy="ignore", drop_invalid=True))
    assert state.read_state(spark, str(tmp_path)).count() == 1


def test_a_batch_writes_its_own_rows(spark, tmp_path, monkeypatch):
    """Bytes written follow the batch, not the state; buckets that are not due, and folders of earlier batches, stay as they are."""
    monkeypatch.setattr(state, "FEW", 500)
    monkeypatch.setattr(state, "SPLIT", 1600)
    root, options = str(tmp_path), Options(null_policy="delete")
    want = {}

    def add(batch, rows):
        state_sink.apply_changes(envelope(spark.createDataFrame(rows, SCHEMA)), root, batch, options)
        for o, k, v in rows:
            want[str(k)] = v

    def sizes():
        return {p: p.stat().st_size for p in tmp_path.glob("*/*/**/*.parquet") if "rejects" not in str(p) and "mappings" not in str(p)}

    def kept():
        return {r["id"]: r["doc"]["v"] for r in resolve.live(state.read_state(spark, root)).collect()}

    add(0, [(i, i, f"a{i}" * 20) for i in range(10_000)])
    first = sizes()
    made = state.manifest_of(spark, root, 0)
    assert len(made.buckets) == 8 and sum(b.rows for b in made.buckets) == 10_000 and {b.depth for b in made.buckets} == {3} and not made.runs
    for batch in range(1, 10):
        before = sizes()
        add(batch, [(10_000 + 10 * batch + i, (37 * batch + i) % 10_000, f"b{batch}") for i in range(10)])
        new = {p: n for p, n in sizes().items() if p not in before}
        assert sum(new.values()) < 0.06 * sum(first.values()) and before.items() <= sizes().items()
    assert kept() == want
    last = state.manifest_of(spark, root, 9)
    assert len(last.runs) < 8 and max(r.level for r in last.runs) == 1, "runs of one level are merged"
    # New ids make buckets grow: only those that are due are written, and parted alone.
    for batch in range(10, 14):
        add(batch, [(20_000 + 1200 * batch + i, 50_000 + 1200 * batch + i, "c") for i in range(1200)])
    grown = state.manifest_of(spark, root, 13)
    assert {b.depth for b in grown.buckets} == {3, 4} and len(grown.by_slot()) == 16 and all(grown.by_slot())
    assert any(b.base == 0 for b in grown.buckets) and any(b.base > 9 for b in grown.buckets)
    assert kept() == want
    assert state.remove_old(spark, root, keep=1) > 3 and kept() == want
    state_sink.apply_changes(envelope(spark.createDataFrame([(99_000, 3, "last"), (99_001, 4, None)], SCHEMA)), root, 14, options)
    assert kept() == {k: v for k, v in (want | {"3": "last"}).items() if k != "4"}


@pytest.mark.parametrize("method", ["insert", "upsert"])
def test_many_batches_are_one(spark, tmp_path, monkeypatch, method):
    """Deletes, partial writes and repeated ids over runs, merged runs and buckets are as in one batch."""
    monkeypatch.setattr(state, "FEW", 20)
    monkeypatch.setattr(state, "SPLIT", 16)
    monkeypatch.setattr(state, "FAN", 3)
    options = Options(write_method=method, null_policy="delete")
    data = [(i, f"k{(i * i) % 41}", None if i % 7 == 3 else json.dumps({f"f{i % 3}": i, "n": {f"g{i % 2}": i}})) for i in range(400)]

    def add(root, batch, rows):
        made = source.as_changes(spark.createDataFrame(rows, "o long, k string, v string"), topic=F.lit("t"), partition=F.lit(0), offset="o", key="k", value="v")
        state_sink.apply_changes(made, str(root), batch, options)

    def kept(root):
        return {r["id"]: json.loads(r["doc_json"]) for r in resolve.live(state.read_state(spark, str(root))).collect()}

    add(tmp_path / "one", 0, data)
    for batch in range(16):
        add(tmp_path / "many", batch, data[25 * batch : 25 * batch + 25])
        if batch == 9:
            add(tmp_path / "many", batch, data[25 * batch : 25 * batch + 25])  # again
    assert kept(tmp_path / "one") == kept(tmp_path / "many") != {}
    assert max(b.depth for b in state.manifest_of(spark, str(tmp_path / "many"), 15).buckets) > 0


@pytest.mark.parametrize("cuts", [1, 2, 4])
def test_upserts_merge_across_batches(spark, tmp_path, cuts):
    options = Options(write_method="upsert", null_policy="delete")
    rows = [("k", '{"a":1}'), ("k", '{"b":2}'), ("q", '{"x":1}'), ("q", None), ("q", '{"y":null}'), ("k", '{"a":null}'), ("z", '{"v":1}'), ("z", None)]
    data = [(i, k, v) for i, (k, v) in enumerate(rows)]
    for batch in range(cuts):
        own = data[batch * len(data) // cuts : (batch + 1) * len(data) // cuts]
        made = source.as_changes(spark.createDataFrame(own, "o long, k string, v string"), topic=F.lit("t"), partition=F.lit(0), offset="o", key="k", value="v")
        state_sink.apply_changes(made, str(tmp_path), batch, options)
    kept = {r["id"]: json.loads(r["doc_json"]) for r in resolve.live(state.read_state(spark, str(tmp_path))).collect()}
    assert kept == {"k": {"a": None, "b": 2}, "q": {"y": None}}


def test_malformed_documents_stop_a_job(spark, tmp_path):
    rows = source.as_changes(spark.createDataFrame([(0, '{"a":1}'), (1, '{"a":"x"}')], "o long, v string"), topic=F.lit("t"), partition=F.lit(0), offset="o", key="o", value="v")
    with pytest.raises(checks.InvalidRecords, match="offset=1"):
        state_sink.apply_changes(rows, str(tmp_path / "fail"), 0, Options(declared_fields={"a": "int"}))
    assert state.read_rejects(spark, str(tmp_path / "fail")).where("stage = 'write'").count() == 1
    state_sink.apply_changes(rows, str(tmp_path / "ignore"), 0, Options(declared_fields={"a": "int"}, malformed_policy="ignore"))
    assert state.read_state(spark, str(tmp_path / "ignore")).count() == 1 and state.read_rejects(spark, str(tmp_path / "ignore")).where("stage = 'write'").count() == 1


def test_json_in_data_streams_is_timed(spark):
    rows = source.as_changes(spark.createDataFrame([(1, '{"a":1,"@timestamp":5}'), (2, '{"t":"x","u":"y"}')], "o long, v string").withColumn("at", F.timestamp_millis(F.lit(7000))), topic=F.lit("t"), partition=F.lit(0), offset="o", timestamp="at", key="o", value="v")
    for fields, want in (((), [{"a": 1, "@timestamp": 7000}, {"t": "x", "u": "y", "@timestamp": 7000}]), (("s", "u"), [{"a": 1, "@timestamp": 5}, {"t": "x", "u": "y", "@timestamp": "y"}])):
        options = Options(stream_type="logs", stream_dataset="app", timestamp_fields=fields)
        assert [json.loads(r["doc_json"]) for r in job.actions(checks.accepted(job.tagged(rows, options)), options).orderBy("offset").collect()] == want


def test_decoding(spark):
    rows = source.as_changes(spark.createDataFrame([(1, '{"a":1}'), (2, "no json")], "o long, v string"), topic=F.lit("t"), partition=F.lit(0), offset="o", key="o", value="v")
    assert [r["value"]["a"] for r in source.decode_json(rows, "a int").orderBy("offset").collect()] == [1, None]
    assert [r["n"] for r in source.decode_variant(rows).orderBy("offset").select(F.col("value").isNull().alias("n")).collect()] == [False, True]
    assert source.decode_text(rows).schema["value"].dataType.simpleString() == "string"


def test_runs_of_offsets():
    r = random.Random(5)
    for _ in range(300):
        a, b = ({r.randint(0, 30) for _ in range(r.randint(0, 15))} for _ in range(2))
        runs = [offsets.runs_of(list(x)) for x in (a, b)]
        flat = lambda x: {k for f, e in x for k in range(f, e + 1)}
        assert flat(runs[0]) == a and flat(offsets.union(*runs)) == a | b and flat(offsets.without(*runs)) == a - b
        assert offsets.union(*runs) == offsets.runs_of(list(a | b))


@pytest.mark.parametrize("batches", [1, 3, 7])
def test_safe_offsets_across_batches(spark, tmp_path, batches):
    """Records come in order and are done out of order, some never, some twice; offsets have gaps."""
    r = random.Random(batches)
    events = []
    for p in range(3):
        seen = [o for o in range(10 * p, 400) if o % 11 != 4]
        for o in seen:
            events.append((o, p, o, False))
            if o % 97 != 50 + p:
                events.append((o + r.randint(1, 60), p, o, True))
            if o % 13 == 0:
                events.append((o + r.randint(61, 90), p, o, False))  # told again as open
    events.sort(key=lambda x: x[0])
    frame_of = lambda rows: spark.createDataFrame([("t", p, o, d) for _, p, o, d in rows], "topic string, partition int, offset long, processed boolean")
    cuts = [len(events) * k // batches for k in range(batches + 1)]
    for k, (i, j) in enumerate(zip(cuts, cuts[1:])):
        frame_of(events[i:j]).coalesce(1).write.parquet(str(tmp_path / "in" / f"{k:02d}"))
        time.sleep(0.01)
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.shuffle.partitions", "2")
    records = own.readStream.schema("topic string, partition int, offset long, processed boolean").option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    got, runs = {}, []

    def one(batch, number):
        for x in batch.collect():
            assert x["commit_offset"] > got.get(x["partition"], -1)
            got[x["partition"]] = x["commit_offset"]
            runs.append(x["n_runs"])

    offsets.stream_safe_offsets(records).writeStream.outputMode("update").foreachBatch(one).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert got == {x["partition"]: x["commit_offset"] for x in progress.safe_offsets(progress.merge_replays(frame_of(events))).collect()}
    assert max(runs) < 60, "as many runs as gaps"


def test_handed_over_partitions_are_forgotten(spark, tmp_path):
    rows = [[("t", 0, o, True, False) for o in range(5)] + [("t", 1, 0, True, False)], [("t", 0, None, None, True), ("t", 0, 2, True, False), ("t", 0, 3, False, False)], [("t", 0, 3, True, False)]]
    schema = "topic string, partition int, offset long, processed boolean, closed boolean"
    for k, own in enumerate(rows):
        spark.createDataFrame(own, schema).coalesce(1).write.parquet(str(tmp_path / "in" / str(k)))
        time.sleep(0.01)
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    own.conf.set("spark.sql.shuffle.partitions", "2")
    records = own.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    got = []
    offsets.stream_safe_offsets(records).writeStream.outputMode("update").foreachBatch(lambda b, k: got.extend((k, x["partition"], x["commit_offset"]) for x in b.collect())).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    assert sorted(got) == [(0, 0, 5), (0, 1, 1), (1, 0, 3), (2, 0, 4)]


class _Held:
    """A keyed state in memory, for a processor without a stream."""

    def __init__(self):
        self.rows = {}

    def state(self, *_):
        return _Held()

    getValueState = getListState = getMapState = state

    def exists(self):
        return bool(self.rows)

    def get(self):
        return self.rows[""]

    def update(self, row):
        self.rows[""] = row

    put = update

    def clear(self):
        self.rows = {}

    def containsKey(self, key):
        return key in self.rows

    def getValue(self, key):
        return self.rows[key]

    def updateValue(self, key, row):
        self.rows[key] = row

    def removeKey(self, key):
        del self.rows[key]

    def keys(self):
        return iter(list(self.rows))

    def iterator(self):
        return iter(list(self.rows.items()))


def _told(processor, frames):
    return [tuple(x) for out in processor.handleInputRows(("t", 0), iter(frames), None) for x in out[["commit_offset", "n_runs"]].itertuples(index=False)]


def test_offsets_of_blocks_by_brute_force(monkeypatch):
    """Few and small blocks, hand-overs in any frame, offsets told in any order and again."""
    import pandas as pd

    monkeypatch.setattr(offsets, "BLOCK", 8, raising=False)
    monkeypatch.setattr(offsets, "HELD", 2, raising=False)
    r = random.Random(9)
    for _ in range(60):
        processor = offsets._Progress()
        processor.init(_Held())
        done, opened, committed = set(), set(), None
        for batch in range(6):
            rows = [(r.randint(-20, 20 + 15 * batch) * r.choice((1, 1, 3)), r.random() < 0.8, False) for _ in range(r.randint(0, 40))]
            if r.random() < 0.2:
                rows.insert(r.randint(0, len(rows)), (None, False, True))
                done, opened, committed = set(), set(), None
            before = committed
            own = [(o, d) for o, d, c in rows if not c and (committed is None or o >= committed)]
            done |= {o for o, d in own if d}
            opened = (opened | {o for o, d in own if not d}) - done
            first = min(opened, default=None)
            safe = [o for o in done if first is None or o < first]
            committed = max([*(o + 1 for o in safe), *([] if committed is None else [committed])], default=None)
            done = {o for o in done if first is not None and o > first}
            frames = [pd.DataFrame(rows[k : k + 7], columns=["offset", "processed", "closed"]).astype({"processed": bool, "closed": bool}) for k in range(0, len(rows), 7)]
            want = [(committed, len(offsets.runs_of(sorted(done))) + len(offsets.runs_of(sorted(opened))))] if committed is not None and committed != before else []
            assert _told(processor, frames) == want


def test_a_run_for_each_offset_takes_little_memory():
    """Every fourth offset of a log, behind an open one: the sets are held by blocks, not as runs."""
    import tracemalloc

    import numpy as np
    import pandas as pd

    processor, n = offsets._Progress(), 200_000
    processor.init(_Held())
    frames = (pd.DataFrame({"offset": 4 * np.arange(k, k + 10_000), "processed": np.arange(k, k + 10_000) != 1, "closed": False}) for k in range(0, n, 10_000))
    tracemalloc.start()
    assert _told(processor, frames) == [(1, n - 1)]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 << 20, peak
