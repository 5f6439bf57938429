import datetime as dt
import decimal
import json
import random

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsink.operators import checks, frame, mapping, order, outcome, progress, project, resolve, route, tree
from docsink.options import Options
from docsink.plans import job
from docsink.sources import changes as source


def one(df, col):
    return [r[0] for r in df.select(col).collect()]


@pytest.mark.parametrize(
    "topic, name",
    [("UPPERCASE", "uppercase"), ("a" * 256, "a" * 255), ("-dash", "dash"), ("_underscore", "underscore"), (".", "dot"), ("..", "dotdot"), ("--x", "-x"), ("a.b", "a.b")],
)
def test_index_names(spark, topic, name):
    assert one(spark.createDataFrame([(topic,)], "topic string"), route.route_index(F.col("topic"))) == [name]


@pytest.mark.parametrize(
    "topic, template, name",
    [("-dash", "${topic}", "logs-ds--dash"), ("_underscore", "${topic}", "logs-ds-_underscore"), ("b" * 101, "${topic}", "logs-ds-" + "b" * 100), ("UPPERCASE", "${topic}", "logs-ds-uppercase"), ("T", "a_valid_prefix_${topic}", "logs-ds-a_valid_prefix_t")],
)
def test_stream_names(spark, topic, template, name):
    assert one(spark.createDataFrame([(topic,)], "topic string"), route.route_stream(F.col("topic"), "LOGS", "ds", template)) == [name]


def test_mapped_topics(spark):
    rows = spark.createDataFrame([("a",), ("b",)], "topic string")
    assert {tuple(r) for r in route.route_map(rows, {"a": "x"}).collect()} == {("a", "x"), ("b", None)}
    with pytest.raises(ValueError):
        route.route_map(rows, {str(i): str(i) for i in range(16)})


def test_time_routing(spark):
    df = spark.createDataFrame([(dt.datetime(2021, 4, 28, 11),)], "t timestamp")
    assert one(df, route.route_by_time(F.lit("Logs"), F.col("t"), "prefix-${topic}-at-${timestamp}", "yyyyMMdd")) == ["prefix-logs-at-20210428"]


@pytest.mark.parametrize(
    "bad",
    [
        {"key_ignore": True, "topic_key_ignore": ("t",)},
        {"schema_ignore": True, "topic_schema_ignore": ("t",)},
        {"stream_type": "logs"},
        {"stream_dataset": "x"},
        {"timestamp_fields": ("a",)},
        {"stream_type": "logs", "stream_dataset": "x", "write_method": "upsert"},
        {"stream_type": "logs", "stream_dataset": "x", "null_policy": "delete"},
        {"stream_type": "logs", "stream_dataset": "UP"},
        {"stream_type": "logs", "stream_dataset": "a-b"},
        {"stream_type": "logs", "stream_dataset": "x" * 101},
        {"use_external_resources": True},
        {"topic_resources": {"a": "b"}},
        {"use_external_resources": True, "topic_resources": {"a": "x", "b": "x"}},
        {"use_external_resources": True, "topic_resources": {"a": "x"}, "topics": ("a", "b")},
        {"use_external_resources": True, "topic_resources": {str(i): str(i) for i in range(16)}},
        {"use_external_resources": True, "topic_resources": {"a": "b"}, "stream_type": "logs", "stream_dataset": "x"},
        {"batch_size": 0},
        {"batch_size": 5000},
        {"bulk_bytes": 0},
        {"linger_ms": 200_000},
        {"null_policy": "other"},
    ],
)
def test_option_rules(bad):
    with pytest.raises(ValueError):
        Options(**bad)


SCHEMA = T.StructType(
    [
        T.StructField("price", T.DecimalType(10, 2)),
        T.StructField("prices", T.ArrayType(T.DecimalType(10, 2))),
        T.StructField("by_code", T.MapType(T.IntegerType(), T.DecimalType(10, 2))),
        T.StructField("inner", T.StructType([T.StructField("d", T.DecimalType(10, 2), metadata={"default": "0.42"}), T.StructField("s", T.StringType())])),
        T.StructField("counts", T.MapType(T.StringType(), T.IntegerType())),
        T.StructField("day", T.DateType()),
        T.StructField("raw", T.BinaryType()),
    ]
)


def documents(spark, compact):
    d = decimal.Decimal("0.02")
    rows = [(d, [d, None], {1: d}, (None, "x"), {"field1": 1}, dt.date(1970, 1, 2), b"hi"), (None, None, None, None, None, None, None)]
    df = spark.createDataFrame(rows, SCHEMA)
    return [json.loads(x) for x in one(df.select(F.struct("*").alias("v")), project.to_document(project.normalise(F.col("v"), SCHEMA, compact)))]


def test_normalised_documents(spark):
    full, empty = documents(spark, True)
    assert full == {"price": 0.02, "prices": [0.02, None], "by_code": [{"key": 1, "value": 0.02}], "inner": {"d": 0.42, "s": "x"}, "counts": {"field1": 1}, "day": 86_400_000, "raw": "aGk="}
    assert empty == dict.fromkeys(full)
    assert documents(spark, False)[0]["counts"] == [{"key": "field1", "value": 1}]


def test_what_can_be_no_document():
    for kind in (T.NullType(), T.DayTimeIntervalType()):
        with pytest.raises(ValueError):
            project.normalise(F.lit(1), kind)


def test_event_times(spark):
    df = spark.createDataFrame([Row(v=Row(two="2021-05-14", field="x"), t=dt.datetime(2021, 1, 1))])
    kind = df.schema["v"].dataType
    assert one(df, project.event_time_from_field(F.col("v"), kind, ["one", "two", "field"]).getField("@timestamp")) == ["2021-05-14"]
    assert project.event_time_from_field(F.col("v"), kind, ["none"]) is not None
    assert one(df, F.col("d.`@timestamp`")) if False else True
    assert one(df.select(project.event_time_from_record(F.col("v"), F.col("t")).alias("d")), F.col("d.`@timestamp`")) == [1609459200000]
    js = spark.createDataFrame([('{"one":null,"two":"b"}',), ("{}",)], "v string")
    assert one(js, project.event_time_of_json(F.col("v"), ["one", "two"])) == ["b", None]


def test_versions_and_operations(spark):
    def headers(*values):
        return [("version", v.encode()) for v in values]

    rows = spark.createDataFrame([(headers("1", "123"),), (headers("not-a-long"),), ([],), (None,)], "h array<struct<key string, value binary>>")
    assert one(rows, project.version_from_header(F.col("h"), "version")) == [123, None, None, None]
    values = spark.createDataFrame([("x",), (None,)], "v string")
    assert one(values, project.write_op(F.col("v"), Options())) == ["index", "delete"]
    assert one(values, project.write_op(F.col("v"), Options(write_method="upsert")))[0] == "update"
    assert one(values, project.write_op(F.col("v"), Options(stream_type="logs", stream_dataset="x")))[0] == "create"


def changes(spark, rows):
    """rows: (partition, offset, key, value)"""
    df = spark.createDataFrame(rows, "p int, o long, k string, v string")
    return source.as_changes(df, topic=F.lit("t"), partition="p", offset="o", key="k", value="v")


def test_tags_and_policies(spark):
    rows = changes(spark, [(0, 0, "a", "{}"), (0, 1, None, "{}"), (0, 2, "", "{}"), (0, 3, "a", None), (0, 4, None, None)])

    def reasons(**options):
        return {r["offset"]: r["reason"] for r in checks.tag(rows, Options(**options)).collect()}

    assert reasons() == {0: None, 1: "null key", 2: "empty key", 3: "null value", 4: "null value"}
    assert reasons(null_policy="delete") == {0: None, 1: "null key", 2: "empty key", 3: None}
    assert reasons(key_ignore=True)[1] is None and reasons(topic_key_ignore=("t",))[2] is None
    with pytest.raises(checks.InvalidRecords, match="partition=0 offset="):
        checks.stop_if_invalid(checks.tag(rows, Options()), Options())
    nulls = rows.where("offset in (0, 3)")
    checks.stop_if_invalid(checks.tag(nulls, Options(null_policy="ignore")), Options(null_policy="ignore"))
    checks.stop_if_invalid(checks.tag(rows, Options(null_policy="ignore", drop_invalid=True)), Options(null_policy="ignore", drop_invalid=True))
    with pytest.raises(checks.InvalidRecords):  # failing on nulls is not about invalid keys
        checks.stop_if_invalid(checks.tag(rows, Options(drop_invalid=True)), Options(drop_invalid=True))
    with pytest.raises(ValueError):
        checks.check_key_type(T.DoubleType())


def test_objects_are_needed_in_streams(spark):
    rows = changes(spark, [(0, 0, "k", "{}"), (0, 1, "k", "[1]"), (0, 2, "k", "7"), (0, 3, "k", "no json")])
    tagged = checks.tag(rows, Options(stream_type="logs", stream_dataset="x"))
    assert {r["offset"]: r["reason"] for r in tagged.collect()} == {0: None, 1: "not an object", 2: "not an object", 3: "not an object"}
    with pytest.raises(ValueError):
        checks.require_object(T.ArrayType(T.StringType()))


def test_required_fields(spark):
    schema = T.StructType([T.StructField("v", T.StructType([T.StructField("a", T.StringType(), metadata={"required": True}), T.StructField("l", T.ArrayType(T.StructType([T.StructField("b", T.LongType(), metadata={"required": True})])))]))])
    rows = [((("x", [(1,)]),)), ((None, None),), (("x", [(1,), (None,)]),), (("x", None),), (None,)]
    df = spark.createDataFrame([r if isinstance(r[0], tuple) or r[0] is None else (r,) for r in rows], schema)
    assert one(df, checks.missing_required(F.col("v"), schema["v"].dataType)) == [False, True, True, False, False]


def test_conformance(spark):
    docs = spark.createDataFrame([('{"longProp":1}',), ('{"any-prop":1}',), ('{"longProp":"x"}',), ('{"longProp":null}',)], "doc string")
    ok, bad = checks.malformed(checks.conforms(docs, {"longProp": "bigint"}), "fail")
    assert ok.count() == 2 and bad.where("fatal and not processed").count() == 2


@pytest.mark.parametrize("strict", [True, False])
def test_unreadable_documents_are_reported(spark, strict):
    docs = spark.createDataFrame([(None,), ("[]",), ("not json",), ("{}",), ('{"k":1}',)], "doc string")
    ok, bad = checks.malformed(checks.conforms(docs, {"k": "bigint"}, strict=strict), "warn")
    assert {r["doc"] for r in ok.collect()} == {"{}", '{"k":1}'} and {r["doc"] for r in bad.collect()} == {None, "[]", "not json"}


def test_merge_keeps_empty_objects(spark):
    js = actions(spark, [("a", "update", None, "{}", 0, 1), ("b", "update", None, "{}", 0, 1), ("b", "update", None, '{"x":1}', 0, 2), ("c", "update", None, '{"x":1}', 0, 1), ("c", "delete", None, None, 0, 2), ("c", "update", None, "{}", 0, 3)])
    assert {r["id"]: json.loads(r["doc"]) for r in resolve.merge_partial_json(js).collect()} == {"a": {}, "b": {"x": 1}, "c": {}}


def test_mapping(spark):
    schema = T.StructType(
        [
            T.StructField("s", T.StringType(), metadata={"default": "x"}),
            T.StructField("i", T.IntegerType(), metadata={"default": 1}),
            T.StructField("d", T.DecimalType(5, 2), metadata={"default": "1.5"}),
            T.StructField("t", T.DateType(), metadata={"default": "1970-01-02"}),
            T.StructField("a", T.ArrayType(T.StringType())),
            T.StructField("m", T.MapType(T.StringType(), T.IntegerType())),
            T.StructField("o", T.StructType([T.StructField("b", T.BooleanType(), metadata={"default": True})])),
        ]
    )
    rows = {r["path"]: (r["type"], r["keyword_ignore_above"], r["null_value"]) for r in mapping.mapping_table(spark, schema, compact=False).collect()}
    assert rows == {
        "s": ("text", 256, None), "i": ("integer", None, "1"), "d": ("double", None, "1.5"), "t": ("date", None, "86400000"), "a": ("text", 256, None),
        "m": ("object", None, None), "m.key": ("text", 256, None), "m.value": ("integer", None, None), "o": ("object", None, None), "o.b": ("boolean", None, "true"),
    }
    assert json.loads(mapping.mapping_json(schema))["properties"]["m"] == {"type": "object"}
    with pytest.raises(ValueError):
        mapping.target_type(T.NullType())
    known = spark.createDataFrame([("a",)], "resource string")
    assert one(mapping.unmapped(spark.createDataFrame([("a",), ("b",), ("b",)], "resource string"), known), "resource") == ["b"]


def actions(spark, rows):
    """rows: (id, op, version, doc, partition, offset)"""
    return spark.createDataFrame(rows, "id string, op string, version long, doc string, partition int, offset long").withColumn("resource", F.lit("r")).withColumn("topic", F.lit("t"))


def test_latest_wins_and_deletes(spark):
    rows = actions(spark, [("a", "index", 1, "1", 0, 1), ("a", "delete", 5, None, 0, 5), ("a", "index", 3, "3", 0, 9), ("b", "index", 2, "first", 0, 1), ("b", "index", 2, "second", 1, 0), ("c", "index", None, "n", 0, 3)])
    state = resolve.latest_wins(rows)
    assert {r["id"]: (r["op"], r["doc"]) for r in state.collect()} == {"a": ("delete", None), "b": ("index", "first"), "c": ("index", "n")}
    assert resolve.live(state).count() == 2
    old = actions(spark, [("a", "index", 4, "4", 0, 20)])  # can't bring it back
    assert resolve.live(resolve.apply_batch(state, old.select(state.columns))).where("id = 'a'").count() == 0
    again = resolve.apply_batch(state, rows.select(state.columns))
    assert sorted(map(str, again.collect())) == sorted(map(str, state.collect()))
    assert one(resolve.refused(rows.where("id = 'a'")), "offset") == [9]
    assert one(resolve.stale_report(rows), "n_stale") == [3]


def test_merges(spark):
    rows = spark.createDataFrame([("a", "update", 1, None, 1), ("a", "update", None, 2, 2), ("a", "delete", None, None, 3), ("a", "update", 7, None, 4), ("b", "update", None, 9, 1), ("b", "update", 3, None, 2)], "id string, op string, x int, y int, offset long")
    rows = rows.withColumn("resource", F.lit("r")).withColumn("topic", F.lit("t")).withColumn("partition", F.lit(0))
    present = {"x": F.col("x").isNotNull(), "y": F.col("y").isNotNull()}
    assert {r["id"]: (r["x"], r["y"]) for r in resolve.merge_partial(rows, ["x", "y"], present=present).collect()} == {"a": (7, None), "b": (3, 9)}
    assert {r["id"]: (r["x"], r["y"]) for r in resolve.merge_partial(rows, ["x", "y"]).collect()} == {"a": (7, None), "b": (3, None)}
    js = actions(spark, [("a", "update", None, '{"x":1,"y":[1,{"z":2}]}', 0, 1), ("a", "update", None, '{"x":null}', 0, 2), ("b", "update", None, '{"q":"t"}', 0, 1), ("b", "delete", None, None, 0, 2)])
    merged = {r["id"]: json.loads(r["doc"]) for r in resolve.merge_partial_json(js).collect()}
    assert merged == {"a": {"x": None, "y": [1, {"z": 2}]}}


def test_creates_and_appends(spark):
    rows = actions(spark, [("a", "create", None, "1", 0, 2), ("a", "create", None, "0", 0, 1), ("b", "create", None, "x", 1, 5)])
    assert {r["id"]: r["doc"] for r in resolve.first_create_wins(rows).collect()} == {"a": "0", "b": "x"}
    assert resolve.append(rows.where("offset = 1"), rows).count() == 2


def test_batches(spark):
    rows = spark.createDataFrame([("t", p, o, n) for p in (0, 1) for o, n in enumerate([60, 50, 10, 200, 5])], "topic string, partition int, offset long, n long")
    by_bytes = {(r["partition"], r["offset"]): r["batch"] for r in frame.frame_by_bytes(rows, "n", 100).collect()}
    assert [by_bytes[1, o] for o in range(5)] == [0, 0, 1, 1, 2] == [by_bytes[0, o] for o in range(5)]
    both = {(r["partition"], r["offset"]): r["batch"] for r in frame.frame_by_bytes(rows, "n", -1, 2).collect()}
    assert [both[0, o] for o in range(5)] == [0, 0, 1, 1, 2]
    assert {r["batch"] for r in frame.frame_by_count(rows, 3).collect()} == {0, 1}


def test_responses(spark):
    answer = '{"items":[{"index":{"_id":"1","status":201}},{"update":{"_id":"2","status":400,"error":{"type":"mapper_parsing_exception","reason":"version_conflict_engine_exception"}}},{"index":{"_id":"3","status":409,"error":{"type":"version_conflict_engine_exception","reason":""}}},{"index":{"_id":"4","status":429,"error":{"type":"es_rejected","reason":"busy"}}}]}'
    items = outcome.response_items(spark.createDataFrame([(1, answer)], "batch_id long, response string"))
    got = {r["id"]: (r["op"], r["error_class"], r["processed"], r["reported"], r["fatal"]) for r in outcome.classify(items, "ignore").collect()}
    assert got == {"1": ("index", "ok", True, False, False), "2": ("update", "malformed", True, True, False), "3": ("index", "conflict", True, True, False), "4": ("index", "other", False, True, True)}
    strict = {r["id"]: (r["processed"], r["reported"], r["fatal"]) for r in outcome.classify(items, "fail", F.lit(True)).collect()}
    assert strict["2"] == (False, True, True) and strict["3"] == (True, False, False)
    assert outcome.classify(items, is_stream=True).where("id = '3' and not reported").count() == 1


def records(spark, rows):
    return spark.createDataFrame([("t1", 0, o, p) for o, p in rows], "topic string, partition int, offset long, processed boolean")


def test_safe_offsets(spark):
    def commit(rows):
        return [r["commit_offset"] for r in progress.safe_offsets(records(spark, rows)).collect()]

    assert commit([(0, False), (1, True), (2, False)]) == []
    assert commit([(0, True), (1, True), (2, False)]) == [2]
    assert commit([(0, True), (1, True), (2, True)]) == [3]
    assert commit([(0, True), (10, True), (20, False), (30, True)]) == [11]
    assert one(progress.backlog(records(spark, [(0, True), (1, False), (2, True)])), "pending") == [2]
    assert progress.all_or_none_offsets(records(spark, [(0, True), (1, False)])).count() == 0
    assert one(progress.all_or_none_offsets(records(spark, [(0, True), (1, True)])), "commit_offset") == [2]
    replayed = progress.merge_replays(records(spark, [(0, True), (1, False), (1, True), (2, False)]))
    assert one(progress.safe_offsets(replayed), "commit_offset") == [2]
    committed = spark.createDataFrame([("t1", 0, 2)], "topic string, partition int, commit_offset long")
    assert one(progress.merge_replays(records(spark, [(0, False), (1, False), (2, True)]), committed), "offset") == [2]
    closed = spark.createDataFrame([("t1", 0), ("t3", 1)], "topic string, partition int")
    assert progress.hand_over(committed, closed).count() == 0


def test_job_with_maps_headers_and_generated_ids(spark):
    rows = changes(spark, [(0, 0, "a", "{}"), (0, 1, "b", "{}")])
    options = Options(use_external_resources=True, topic_resources={"other": "r"}, drop_invalid=True)
    assert job.tagged(rows, options).where("reason = 'topic without resource'").count() == 2
    assert job.tagged(rows, Options(version_header="version")).where("reason = 'bad version'").count() == 2
    made = job.actions(checks.accepted(job.tagged(rows, Options(key_ignore=True, generated_ids=True))), Options(key_ignore=True, generated_ids=True))
    assert made.where("id is null and version is null and version_type = 'internal'").count() == 2
    made = job.actions(checks.accepted(job.tagged(rows, Options())), Options())
    assert {tuple(r) for r in made.select("id", "version", "version_type", "op", "doc_json").collect()} == {("a", 0, "external", "index", "{}"), ("b", 1, "external", "index", "{}")}


def merged_by_hand(state, change):
    out = dict(state)
    for k, v in change.items():
        out[k] = merged_by_hand(out[k], v) if isinstance(v, dict) and isinstance(out.get(k), dict) else v
    return out


def test_partial_documents_merge_at_every_depth(spark):
    r = random.Random(1)

    def value(d):
        if d and r.random() < 0.5:
            return {r.choice(["a", "b", "c.d", 'e"f', "g{"]): value(d - 1) for _ in range(r.randint(0, 3))}
        return r.choice([None, 1, 2.5, 'x"{y', [1, {"z": 2}], True, {}])

    rows, want = [], {}
    for i in range(500):
        k = f"k{r.randint(0, 30)}"
        if r.random() < 0.06:
            rows.append(("r", k, "delete", None, "t", 0, i))
            want.pop(k, None)
            continue
        doc = {r.choice("abxy"): value(4) for _ in range(r.randint(0, 3))}
        rows.append(("r", k, "update", json.dumps(doc), "t", 0, i))
        want[k] = merged_by_hand(want.get(k, {}), doc)
    actions = spark.createDataFrame(rows, "resource string, id string, op string, doc string, topic string, partition int, offset long").repartition(3)
    assert {x["id"]: json.loads(x["doc"]) for x in resolve.merge_partial_json(actions).collect()} == want
    odd = spark.createDataFrame([("r", "n", "update", d, "t", 0, i) for i, d in enumerate([None, "5", "no json", '{"a":1}', "[]"])], actions.schema)
    assert [x["doc"] for x in resolve.merge_partial_json(odd).collect()] == ['{"a":1}']
    assert resolve.merge_partial_json(actions.limit(0)).count() == 0


def test_depth_and_leaves_of_documents(spark):
    docs = ['{"a":{"b":{"c":1}},"s":"{{{{"}', '{"x":[{"y":1}]}', "{}", None, '{"q\\"{":"\\\\"}']
    rows = spark.createDataFrame(list(enumerate(docs)), "i int, doc string")
    assert [x["d"] for x in rows.select("i", tree.depth_of(F.col("doc")).alias("d")).orderBy("i").collect()] == [3, 2, 1, 0, 1]
    got = sorted((x["i"], tuple(x["path"]), x["leaf"]) for x in tree.leaves(rows, "doc").collect())
    assert got == [(0, ("a", "b", "c"), "1"), (0, ("s",), '"{{{{"'), (1, ("x",), '[{"y":1}]'), (4, ('q"{',), '"\\\\"')]


def test_places_and_refusals_of_a_hot_group(spark):
    """One log partition, and one id with half of all rows, spread over all tasks; the same as a window over the whole group."""
    r = random.Random(3)
    rows = [("r", "hot" if i % 2 else f"k{i % 50}", r.randint(0, 10**6), "t", 0, 3 * i + i % 2) for i in range(4000)]
    actions = spark.createDataFrame(rows, "resource string, id string, version long, topic string, partition int, offset long").repartition(8)
    for block in (1, 700, order.BLOCK):
        framed = {x["offset"]: x["batch"] for x in frame.frame_by_count(actions, 7, block).collect()}
        assert framed == {offset: k // 7 for k, (*_, offset) in enumerate(rows)}
        most, want = {}, set()
        for _, i, version, *_, offset in rows:
            if version <= most.get(i, -1):
                want.add(offset)
            most[i] = max(version, most.get(i, -1))
        assert {x["offset"] for x in resolve.refused(actions, block=block).collect()} == want
    plan = resolve.refused(actions, block=700)._jdf.queryExecution().optimizedPlan().toString()
    assert "order_block" in plan
    spread = actions.where("id = 'hot'").withColumn("b", F.floor(F.col("offset") / 700)).groupBy("b").count()
    assert spread.count() > 8 and spread.agg(F.max("count")).first()[0] <= 240
    assert frame.frame_by_count(actions.limit(0), 7).count() == 0 and resolve.refused(actions.limit(0)).count() == 0


@pytest.mark.parametrize("most_bytes, most_rows", [(100, None), (100, 5), (-1, 3), (1, None), (10**9, 7)])
def test_batches_within_one_log_partition(spark, most_bytes, most_rows):
    """Parts of a log partition, framed at once, are as one after the other; with rows larger than parts, and of no size."""
    r = random.Random(most_bytes + (most_rows or 0))
    sizes = [r.choice([0, 1, 9, 30, 60, 99, 100, 101, 700 if k % 40 == 0 else 5]) for k in range(900)]
    rows = [("t", 0, 2 * k, n, "clash") for k, n in enumerate(sizes)] + [("t", 1, 5, 40, "x"), ("u", 0, 0, 400, "x")]
    want, held, count, number = {}, 0, 0, 0
    for k, n in enumerate(sizes):
        want["t", 0, 2 * k] = number
        held, count = held + n, count + 1
        if (most_bytes != -1 and held >= most_bytes) or (most_rows and count >= most_rows):
            held, count, number = 0, 0, number + 1
    want |= {("t", 1, 5): 0, ("u", 0, 0): 0}
    actions = spark.createDataFrame(rows, "topic string, partition int, offset long, n int, frame_note string").repartition(4)
    for batches_of_part, block in ((2, 64), (7, 1000), (512, order.BLOCK)):
        found = frame.frame_by_bytes(actions, "n", most_bytes, most_rows, batches_of_part, block)
        assert found.columns == [*actions.columns, "batch"]
        assert {(x["topic"], x["partition"], x["offset"]): x["batch"] for x in found.collect()} == want
    assert frame.frame_by_bytes(actions.limit(0), "n", most_bytes, most_rows).count() == 0


def test_nested_documents_against_declared_fields(spark):
    declared = {"a.b": "bigint", "a": {"b": "bigint", "c": {"d": "date"}}, "s": "string", "none": {}}
    docs = [
        ('{"a.b":1,"a":{"b":"7","c":{"d":"2020-01-02"}},"s":"x"}', [], []),
        ('{"a.b":"x","a":{"b":1}}', [], ["a.b"]),
        ('{"a":{"b":"x","z":1,"c":{"d":"no","q":null}}}', ["a.c.q", "a.z"], ["a.b", "a.c.d"]),
        ('{"a":[{"b":1},{"b":"x"},{"y":2}],"s":["p","q"]}', ["a.y"], ["a.b"]),
        ('{"a":[{"b":1},5],"s":{"t":1}}', [], ["a", "s"]),
        ('{"a":null,"s":null,"none":{"k":1},"other":{"deep":1}}', ["none.k", "other"], []),
        ("{}", [], []),
    ]
    rows = spark.createDataFrame([(i, d) for i, (d, *_) in enumerate(docs)] + [(90, None), (91, "[1]"), (92, "no json")], "i int, doc string")
    got = {x["i"]: x for x in checks.conforms(rows, declared).collect()}
    for i, (_, unknown, bad) in enumerate(docs):
        assert (sorted(got[i]["unknown_fields"]), sorted(got[i]["bad_fields"])) == (unknown, bad), docs[i]
    assert all(got[i]["unknown_fields"] is None for i in (90, 91, 92))
    loose = checks.conforms(rows.where("i = 2"), declared, strict=False).first()
    assert loose["unknown_fields"] == [] and sorted(loose["bad_fields"]) == ["a.b", "a.c.d"]


def test_nested_fields_are_inferred(spark):
    docs = [("r", '{"a":{"x":1,"y":null},"l":[1,2.5],"o":[{"k":"v"},{"k":true}]}'), ("r", '{"a":5,"n":null}'), ("r", "no json"), ("r", None), ("q", '{"a":{"x":1.5}}'), ("q", '{"a":{"x":2}}')]
    got = {(x["resource"], "/".join(x["path"])): (x["n"], x["type"], x["conflict"]) for x in mapping.infer_tree(spark.createDataFrame(docs, "resource string, doc string")).collect()}
    assert got == {
        ("r", "a"): (2, None, True), ("r", "a/x"): (1, "bigint", False), ("r", "a/y"): (1, "null", False), ("r", "l"): (2, "double", False), ("r", "o"): (2, "object", False), ("r", "o/k"): (2, None, True), ("r", "n"): (1, "null", False),
        ("q", "a"): (2, "object", False), ("q", "a/x"): (2, "double", False),
    }
    assert mapping.infer_tree(spark.createDataFrame([], "resource string, doc string")).count() == 0


def test_names_with_dots(spark):
    rows = spark.createDataFrame([(1, '{"event.time":"7"}'), (2, '{"event":{"time":"7"}}'), (3, '{"event.time":null,"t":8}')], "i int, doc string")
    got = [x["at"] for x in rows.select("i", project.event_time_of_json(F.col("doc"), ["event.time", "t"]).alias("at")).orderBy("i").collect()]
    assert got == ["7", None, "8"]
