"""The registered queries and their SQL.

Each takes (spark, sf_dir), reads the given tables and returns its whole result.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import checks, frame, mapping, outcome, progress, project, resolve, route, tree
from ..options import Options
from ..sources import changes as source
from ..sources import state
from ..streaming import latest, offsets, state_sink
from . import job

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared(spark: SparkSession, tag: str) -> str:
    """A new folder's path under the cluster's shared one, or on one machine a temporary one where none is set."""
    root = spark.conf.get("spark.checkpoint.dir", "")
    if not root and not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    root = root or tempfile.mkdtemp(prefix="spark-")
    return f"{root.rstrip('/')}/{tag}-{uuid.uuid4().hex}"


MIXED_TOPIC = "case event_type when 'view' then 'VIEW' when 'click' then '-Click' when 'error' then '_Errors' when 'purchase' then 'shop.Purchase' else '..' end"


def event_changes(events: DataFrame, topic: Column | None = None) -> DataFrame:
    """Events by user; an error is a null value."""
    value = F.when(F.col("event_type") != "error", F.struct("event_type", "value", "props"))
    return source.as_changes(events, topic=F.lit("events") if topic is None else topic, partition=F.pmod("user_id", F.lit(4)), offset="event_id", timestamp="ts", key="user_id", value=value)


def event_actions(changes: DataFrame) -> DataFrame:
    options = Options(null_policy="delete")
    return job.actions(checks.accepted(job.tagged(changes, options)), options)


# Routing


@query(f"""
SELECT resource, count(*) AS n FROM (
  SELECT CASE WHEN r IN ('.', '..') THEN replace(r, '.', 'dot') ELSE r END AS resource
  FROM (SELECT regexp_replace(left(lower({MIXED_TOPIC}), 255), '^[-_]', '') AS r FROM events)) GROUP BY resource""")
def route_index_names(spark, sf_dir):
    events = event_changes(table(spark, sf_dir, "events"), F.expr(MIXED_TOPIC))
    return route.route(events, Options(null_policy="delete")).groupBy("resource").agg(F.count("*").alias("n"))


@query(f"SELECT DISTINCT CASE WHEN r IN ('.', '..') THEN replace(r, '.', 'dot') ELSE r END AS resource FROM (SELECT regexp_replace(left(lower({MIXED_TOPIC}), 255), '^[-_]', '') AS r FROM events) WHERE r <> 'view'")
def targets_needed(spark, sf_dir):
    events = route.route(event_changes(table(spark, sf_dir, "events"), F.expr(MIXED_TOPIC)), Options())
    return route.targets(events, events.where("resource = 'view'").select("resource").distinct())


@query(f"SELECT concat('logs-app-', left(lower({MIXED_TOPIC}), 100)) AS resource, count(*) AS n FROM events GROUP BY 1")
def route_stream_names(spark, sf_dir):
    events = event_changes(table(spark, sf_dir, "events"), F.expr(MIXED_TOPIC))
    return route.route(events, Options(stream_type="logs", stream_dataset="app")).groupBy("resource").agg(F.count("*").alias("n"))


@query("""
SELECT resource, count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS sum_key FROM orders LEFT JOIN (VALUES ('O', 'open-orders'), ('F', 'done-orders')) m(status, resource) ON status = o_orderstatus GROUP BY resource""")
def route_explicit_map(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("topic"), "o_orderkey")
    return route.route_map(orders, {"O": "open-orders", "F": "done-orders"}).groupBy("resource").agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("sum_key"))


@query("SELECT o_orderstatus AS topic, CAST(o_custkey % 4 AS INTEGER) AS partition, count(*) AS n FROM orders WHERE NOT (o_orderstatus IN ('O', 'F') AND o_custkey % 4 < 3) GROUP BY ALL")
def unexpected_topic_counts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("topic"), F.pmod("o_custkey", F.lit(4)).cast("int").alias("partition"))
    assigned = spark.createDataFrame([(t, p) for t in "OF" for p in range(3)], "topic string, partition int")
    return route.unexpected_topics(orders, assigned).groupBy("topic", "partition").agg(F.count("*").alias("n"))


@query("SELECT 'parts-lineitem-at-' || strftime(l_shipdate, '%Y%m') AS resource, count(*) AS n FROM lineitem GROUP BY 1")
def route_by_month(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").withColumn("resource", route.route_by_time(F.lit("LineItem"), F.col("l_shipdate").cast("timestamp"), "parts-${topic}-at-${timestamp}", "yyyyMM"))
    return lines.groupBy("resource").agg(F.count("*").alias("n"))


# Checks


@query("""
SELECT policy, reason, count(*) AS n FROM (
  SELECT 'ignore' AS policy, CASE WHEN event_type = 'error' THEN 'null value' WHEN user_id % 7 = 0 THEN 'null key' END AS reason FROM events
  UNION ALL SELECT 'delete', CASE WHEN user_id % 7 = 0 THEN 'null key' END FROM events WHERE NOT (event_type = 'error' AND user_id % 7 = 0)
) GROUP BY ALL""")
def null_policy_counts(spark, sf_dir):
    events = event_changes(table(spark, sf_dir, "events")).withColumn("key", F.when(F.col("key") % 7 != 0, F.col("key")))
    parts = [checks.tag(events, Options(null_policy=p)).select(F.lit(p).alias("policy"), "reason") for p in ("ignore", "delete")]
    return parts[0].unionByName(parts[1]).groupBy("policy", "reason").agg(F.count("*").alias("n"))


@query("""
SELECT CASE WHEN k IS NULL THEN 'null key' WHEN k = '' THEN 'empty key' END AS reason, count(*) AS n
FROM (SELECT CASE WHEN c_mktsegment = 'MACHINERY' THEN '' ELSE nullif(c_mktsegment, 'BUILDING') END AS k FROM customer) GROUP BY 1""")
def key_checks(spark, sf_dir):
    key = F.when(F.col("c_mktsegment") == "MACHINERY", "").otherwise(F.nullif("c_mktsegment", F.lit("BUILDING")))
    rows = source.as_changes(table(spark, sf_dir, "customer"), topic=F.lit("customer"), partition=F.lit(0), offset="c_custkey", key=key, value="c_name")
    return checks.tag(rows, Options()).groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN event_type IN ('error', 'view') THEN 'not an object' END AS reason, count(*) AS n FROM events GROUP BY 1")
def object_checks(spark, sf_dir):
    value = F.when(F.col("event_type") == "error", "not json").when(F.col("event_type") == "view", '["a","b"]').otherwise(F.col("props"))
    rows = source.as_changes(table(spark, sf_dir, "events"), topic=F.lit("events"), partition=F.lit(0), offset="event_id", key="user_id", value=value)
    return checks.tag(rows, Options(stream_type="logs", stream_dataset="app")).groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT CASE WHEN value < 10 THEN 'null in a required field' END AS reason, count(*) AS n FROM events GROUP BY 1")
def required_fields(spark, sf_dir):
    amount = F.when(~(F.col("value") < 10), F.col("value")).alias("amount", metadata={"required": True})
    rows = source.as_changes(table(spark, sf_dir, "events"), topic=F.lit("events"), partition=F.lit(0), offset="event_id", key="user_id", value=F.struct(amount, "event_type"))
    return checks.tag(rows, Options()).groupBy("reason").agg(F.count("*").alias("n"))


@query("SELECT 'record from topic=events partition=' || user_id % 4 || ' offset=' || event_id AS position, 'null value' AS reason FROM events WHERE event_type = 'error'")
def rejected_records(spark, sf_dir):
    return checks.rejects(checks.tag(event_changes(table(spark, sf_dir, "events")), Options(null_policy="ignore"))).select("position", "reason")


@query("SELECT true AS processed, true AS reported, false AS fatal, count(*) AS n FROM events WHERE event_type IN ('error', 'view')")
def conformance_split(spark, sf_dir):
    doc = F.when(F.col("event_type") == "error", '{"k":"text"}').when(F.col("event_type") == "view", '{"other":1}').otherwise(F.col("props"))
    _, reported = checks.malformed(checks.conforms(table(spark, sf_dir, "events").select(doc.alias("doc")), {"k": "bigint"}), "warn")
    return reported.groupBy("processed", "reported", "fatal").agg(F.count("*").alias("n"))


@query("SELECT 'k' AS field, count(*) AS n FROM events WHERE json_type(props, '$.k') IS NOT NULL")
def unknown_fields(spark, sf_dir):
    docs = table(spark, sf_dir, "events").select(F.col("props").alias("doc"))
    return checks.conforms(docs, {"other": "string"}).select(F.explode("unknown_fields").alias("field")).groupBy("field").agg(F.count("*").alias("n"))


@query("""
SELECT reason, count(*) AS n, min("offset") AS first_offset FROM (
  SELECT CASE WHEN event_type = 'error' THEN 'null value' WHEN user_id % 7 = 0 THEN 'null key' WHEN event_type = 'view' THEN 'topic without resource' ELSE 'written' END AS reason, event_id AS "offset" FROM events)
GROUP BY reason""")
def accepted_and_rejected(spark, sf_dir):
    """All checks of a job that drops what is invalid: what is written, and what becomes a reject for which reason."""
    events = event_changes(table(spark, sf_dir, "events"), F.col("event_type")).withColumn("key", F.when(F.col("key") % 7 != 0, F.col("key")))
    options = Options(null_policy="ignore", drop_invalid=True, use_external_resources=True, topic_resources={t: f"r-{t}" for t in ("signup", "purchase", "click", "error")})
    tagged = job.tagged(events, options)
    both = checks.rejects(tagged).select("reason", "offset").unionByName(job.actions(checks.accepted(tagged), options).select(F.lit("written").alias("reason"), "offset"))
    return both.groupBy("reason").agg(F.count("*").alias("n"), F.min("offset").alias("first_offset"))


# Projections


@query("SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY 1")
def decoded_json(spark, sf_dir):
    rows = source.as_changes(table(spark, sf_dir, "events"), topic=F.lit("events"), partition=F.lit(0), offset="event_id", key="user_id", value="props")
    return source.decode_json(rows, "k bigint").groupBy("value.k").agg(F.count("*").alias("n"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, c_name FROM customer")
def ids_from_key(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(project.doc_id_from_key(F.col("c_custkey")).alias("id"), "c_name")


@query("SELECT concat_ws('+', 'events', user_id % 4, event_id) AS id, user_id FROM events")
def ids_from_position(spark, sf_dir):
    return event_changes(table(spark, sf_dir, "events")).select(project.doc_id(Options(key_ignore=True)).alias("id"), F.col("key").alias("user_id"))


@query("SELECT count(*) AS n, count(*) AS n_ids, 36 AS longest FROM events")
def ids_generated(spark, sf_dir):
    ids = event_changes(table(spark, sf_dir, "events")).select(project.doc_id_generated().alias("id"))
    return ids.agg(F.count("*").alias("n"), F.countDistinct("id").alias("n_ids"), F.max(F.length("id")).alias("longest"))


@query("""
SELECT event_id, CASE WHEN event_type = 'error' THEN 'failed' ELSE event_type END AS event_type FROM events""")
def nulls_allowed_to_stop_a_job(spark, sf_dir):
    """Values that may not be null: the job would end at the first null; here all are filled before."""
    events = table(spark, sf_dir, "events").withColumn("value", F.coalesce(F.nullif("event_type", F.lit("error")), F.lit("failed")))
    rows = source.as_changes(events, topic=F.lit("events"), partition=F.lit(0), offset="event_id", key="user_id", value="value")
    return rows.select(F.col("offset").alias("event_id"), checks.fail_on_nulls(F.col("value")).alias("event_type"))


@query("""SELECT o_orderkey, '{"prices":[' || CASE WHEN p < 10000000 THEN CAST(CAST(p AS DOUBLE) AS VARCHAR)
  ELSE left(digits, 1) || '.' || coalesce(nullif(rtrim(substr(digits, 2), '0'), ''), '0') || 'E' || (length(digits) - 3) END || ',null],"days":[' || epoch_ms(CAST(o_orderdate AS DATE)) || '],"at":' || epoch_ms(CAST(o_orderdate AS TIMESTAMP)) || '}' AS doc
FROM (SELECT *, CAST(o_totalprice AS DECIMAL(12, 2)) AS p, replace(CAST(CAST(o_totalprice AS DECIMAL(12, 2)) AS VARCHAR), '.', '') AS digits FROM orders)""")
def arrays_and_times(spark, sf_dir):
    price = F.col("o_totalprice").cast("decimal(12,2)")
    value = F.struct(F.array(price, F.lit(None).cast("decimal(12,2)")).alias("prices"), F.array(F.col("o_orderdate").cast("date")).alias("days"), F.col("o_orderdate").cast("timestamp_ntz").alias("at"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", value.alias("value"))
    return orders.select("o_orderkey", project.to_document(project.normalise(F.col("value"), orders.schema["value"].dataType)).alias("doc"))


@query("SELECT event_type, n FROM (SELECT event_type, count(*) AS n FROM events GROUP BY 1)")
def decoded_text(spark, sf_dir):
    """Plain text values: what a data stream would reject, an index of texts takes."""
    rows = source.as_changes(table(spark, sf_dir, "events"), topic=F.lit("events"), partition=F.lit(0), offset="event_id", key="user_id", value="event_type")
    return source.decode_text(rows).groupBy(F.col("value").alias("event_type")).agg(F.count("*").alias("n"))


@query("""
SELECT event_id, json_extract_string(props, '$.k') AS k, CAST(epoch_us(ts) // 1000 AS BIGINT) AS at FROM events""")
def timestamped_json(spark, sf_dir):
    """JSON text in a data stream gets @timestamp from its record."""
    options = Options(stream_type="logs", stream_dataset="app", null_policy="ignore")
    rows = source.as_changes(table(spark, sf_dir, "events"), topic=F.lit("events"), partition=F.lit(0), offset="event_id", timestamp="ts", key="user_id", value="props")
    made = job.actions(checks.accepted(job.tagged(rows, options)), options)
    return made.select(F.col("offset").alias("event_id"), F.get_json_object("doc_json", "$.k").alias("k"), F.get_json_object("doc_json", "$['@timestamp']").cast("long").alias("at"))


@query("SELECT p_partkey, p_partkey % 2 = 0 AS ignored, p_partkey % 2 = 0 AS null_kept FROM part")
def topic_schema_ignored(spark, sf_dir):
    """Of a topic whose schema is ignored the value is written as it came: defaults aren't filled in."""
    options = Options(topic_schema_ignore=("raw",))
    size = F.lit(None).cast("int").alias("size", metadata={"default": 5})
    part = table(spark, sf_dir, "part")
    rows = source.as_changes(part, topic=F.when(F.col("p_partkey") % 2 == 0, "raw").otherwise("typed"), partition=F.lit(0), offset="p_partkey", key="p_partkey", value=F.struct(size, "p_name"))
    made = job.actions(checks.accepted(job.tagged(rows, options)), options)
    return made.select(F.col("offset").alias("p_partkey"), (F.col("topic") == "raw").alias("ignored"), F.get_json_object("doc_json", "$.size").isNull().alias("null_kept"))


@query("SELECT p_partkey, CAST(CAST(p_retailprice AS DECIMAL(12, 2)) AS DOUBLE) AS price, p_size AS size FROM part")
def normalised_decimals(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.struct(F.col("p_retailprice").cast("decimal(12,2)").alias("price"), F.struct(F.col("p_size").alias("size")).alias("dims")).alias("value"))
    made = project.normalise(F.col("value"), part.schema["value"].dataType)
    return part.select("p_partkey", made.alias("v")).select("p_partkey", "v.price", "v.dims.size")


@query("SELECT o_orderkey, unnest(['status', 'priority']) AS key, unnest([o_orderstatus, o_orderpriority]) AS value FROM orders")
def map_entries_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.create_map(F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority").alias("m"))
    return orders.select("o_orderkey", F.explode(project.normalise(F.col("m"), orders.schema["m"].dataType, compact=False)).alias("e")).select("o_orderkey", "e.key", "e.value")


@query("""SELECT o_orderkey, '{"status":"' || o_orderstatus || '","priority":"' || o_orderpriority || '"}' AS doc FROM orders""")
def compact_map_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.create_map(F.lit("status"), "o_orderstatus", F.lit("priority"), "o_orderpriority").alias("m"))
    return orders.select("o_orderkey", project.to_document(project.normalise(F.col("m"), orders.schema["m"].dataType)).alias("doc"))


@query("SELECT event_id, coalesce(nullif(event_type, 'view'), 'seen') AS event_type, user_id FROM events")
def defaults_filled(spark, sf_dir):
    own = F.nullif("event_type", F.lit("view")).alias("event_type", metadata={"default": "seen"})
    events = table(spark, sf_dir, "events").select("event_id", F.struct(own, "user_id").alias("value"))
    return events.select("event_id", project.normalise(F.col("value"), events.schema["value"].dataType).alias("v")).select("event_id", "v.*")


@query("""
SELECT event_id, '{"user_id":' || user_id || ',"event_type":' || CASE WHEN event_type = 'view' THEN 'null' ELSE '"' || event_type || '"' END || ',"day":' || epoch_ms(CAST(ts AS DATE)) || '}' AS doc FROM events""")
def documents_json(spark, sf_dir):
    value = F.struct("user_id", F.nullif("event_type", F.lit("view")).alias("event_type"), F.col("ts").cast("date").alias("day"))
    events = table(spark, sf_dir, "events").select("event_id", value.alias("value"))
    return events.select("event_id", project.to_document(project.normalise(F.col("value"), events.schema["value"].dataType)).alias("doc"))


@query("SELECT event_id, CAST(epoch_us(ts) // 1000 AS BIGINT) AS at FROM events")
def timestamp_from_record(spark, sf_dir):
    events = event_changes(table(spark, sf_dir, "events").withColumn("event_type", F.lit("any")))
    doc = project.event_time_from_record(F.col("value"), F.col("timestamp"))
    return events.select(F.col("offset").alias("event_id"), doc.alias("d")).select("event_id", F.col("d.`@timestamp`").alias("at"))


@query("SELECT event_type AS at, count(*) AS n FROM events GROUP BY 1")
def timestamp_from_field(spark, sf_dir):
    events = table(spark, sf_dir, "events").select(F.struct("event_type", "user_id").alias("value"))
    doc = project.event_time_from_field(F.col("value"), events.schema["value"].dataType, ["absent", "event_type", "user_id"])
    return events.select(doc.alias("d")).groupBy(F.col("d.`@timestamp`").alias("at")).agg(F.count("*").alias("n"))


@query("SELECT json_extract_string(props, '$.k') AS at, count(*) AS n FROM events GROUP BY 1")
def timestamp_from_json_field(spark, sf_dir):
    return table(spark, sf_dir, "events").groupBy(project.event_time_of_json(F.col("props"), ["absent", "k"]).alias("at")).agg(F.count("*").alias("n"))


@query("SELECT event_id, CASE WHEN event_id % 5 = 0 THEN NULL ELSE event_id * 10 END AS version FROM events")
def version_from_header(spark, sf_dir):
    header = lambda name, value: F.struct(F.lit(name).alias("key"), value.cast("string").cast("binary").alias("value"))
    last = F.when(F.col("event_id") % 5 == 0, "none").otherwise((F.col("event_id") * 10).cast("string"))
    headers = F.array(header("version", F.lit(1)), header("other", F.lit(2)), header("version", last))
    return table(spark, sf_dir, "events").select("event_id", project.version_from_header(headers, "version").alias("version"))


@query("SELECT op, count(*) AS n, count(version) AS versioned FROM (SELECT CASE WHEN event_type = 'error' THEN 'delete' ELSE 'index' END AS op, event_id AS version FROM events) GROUP BY op")
def write_ops(spark, sf_dir):
    return event_actions(event_changes(table(spark, sf_dir, "events"))).groupBy("op").agg(F.count("*").alias("n"), F.count("version").alias("versioned"))


# Resolution

LATEST = """
SELECT CAST(user_id AS VARCHAR) AS id, event_id AS version, event_type, value, props
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1 AND event_type <> 'error'"""


def _documents(live: DataFrame) -> DataFrame:
    return live.select("id", "version", "doc.event_type", "doc.value", "doc.props")


@query(LATEST)
def latest_documents(spark, sf_dir):
    """The flagship: the current document of each user, deletes applied."""
    return _documents(resolve.live(resolve.latest_wins(event_actions(event_changes(table(spark, sf_dir, "events"))))))


@query("SELECT CAST(o_custkey AS VARCHAR) AS id, o_orderkey AS version, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def latest_order_by_customer(spark, sf_dir):
    rows = source.as_changes(table(spark, sf_dir, "orders"), topic=F.lit("orders"), partition=F.pmod("o_custkey", F.lit(4)), offset="o_orderkey", timestamp="o_orderdate", key="o_custkey", value=F.struct("o_totalprice"))
    options = Options()
    return resolve.latest_wins(job.actions(checks.accepted(job.tagged(rows, options)), options)).select("id", "version", "doc.o_totalprice")


def _order_writes(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    op = F.when(F.col("o_orderstatus") == "P", "delete").otherwise("update")
    return orders.select(
        F.lit("orders").alias("resource"), F.col("o_custkey").cast("string").alias("id"), op.alias("op"), "o_orderstatus", F.col("o_totalprice").alias("open_price"), F.col("o_totalprice").alias("done_price"), F.lit("orders").alias("topic"), F.lit(0).alias("partition"), F.col("o_orderkey").alias("offset")
    )


MERGED = """
WITH d AS (SELECT o_custkey, max(o_orderkey) AS deleted FROM orders WHERE o_orderstatus = 'P' GROUP BY 1),
k AS (SELECT o.* FROM orders o LEFT JOIN d USING (o_custkey) WHERE o_orderstatus <> 'P' AND (deleted IS NULL OR o_orderkey > deleted))
SELECT CAST(o_custkey AS VARCHAR) AS id, {open} AS {a}, {done} AS {b} FROM k GROUP BY o_custkey"""


@query(MERGED.format(open="arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'O')", done="arg_max(o_totalprice, o_orderkey) FILTER (WHERE o_orderstatus = 'F')", a="open_price", b="done_price"))
def merged_orders(spark, sf_dir):
    present = {"open_price": F.col("o_orderstatus") == "O", "done_price": F.col("o_orderstatus") == "F"}
    return resolve.merge_partial(_order_writes(spark, sf_dir), ["open_price", "done_price"], present=present).drop("resource")


@query(MERGED.format(open="max(o_orderkey) FILTER (WHERE o_orderstatus = 'O')", done="max(o_orderkey) FILTER (WHERE o_orderstatus = 'F')", a="open_key", b="done_key"))
def merged_orders_json(spark, sf_dir):
    rows = _order_writes(spark, sf_dir).withColumn("doc", F.when(F.col("o_orderstatus") == "O", F.to_json(F.struct(F.col("offset").alias("open_key")))).otherwise(F.to_json(F.struct(F.col("offset").alias("done_key")))))
    merged = resolve.merge_partial_json(rows)
    return merged.select("id", *(F.get_json_object("doc", f"$.{f}").cast("long").alias(f) for f in ("open_key", "done_key")))


#: A partial document of an order: fields at three depths, and values that take the place of objects; none is a delete.
NESTED = """CASE WHEN o_orderkey % 11 = 0 THEN NULL
  WHEN o_orderkey % 7 = 0 THEN '{"done":[' || o_orderkey || '],"open":{}}'
  WHEN o_orderstatus = 'P' THEN '{"open":null,"n":{"p":' || o_orderkey || '}}'
  WHEN o_orderstatus = 'O' THEN '{"open":{"key":' || o_orderkey || ',"by":{"' || o_orderpriority || '":' || o_orderkey || '}}}'
  ELSE '{"done":{"key":' || o_orderkey || ',"by":{"' || o_orderpriority || '":"' || o_orderkey || '"}}}' END"""


@query(f"""
WITH RECURSIVE w AS (SELECT o_custkey AS c, o_orderkey AS t, CAST({NESTED} AS JSON) AS j FROM orders),
gone AS (SELECT c, max(t) AS t FROM w WHERE j IS NULL GROUP BY c),
nodes(c, t, path, v) AS (
  SELECT c, t, [k], json_extract(j, '$."' || k || '"') FROM (SELECT w.c, w.t, j, unnest(json_keys(j)) AS k FROM w LEFT JOIN gone USING (c) WHERE j IS NOT NULL AND (gone.t IS NULL OR w.t > gone.t))
  UNION ALL SELECT c, t, list_append(path, k), json_extract(v, '$."' || k || '"') FROM (SELECT *, unnest(json_keys(v)) AS k FROM nodes WHERE json_type(v) = 'OBJECT'))
SELECT CAST(c AS VARCHAR) AS id, array_to_string(path, '/') AS path, CAST(v AS VARCHAR) AS leaf FROM nodes n
WHERE json_type(v) <> 'OBJECT' AND NOT EXISTS (SELECT 1 FROM nodes m WHERE m.c = n.c AND m.t > n.t
  AND (m.path = n.path OR (json_type(m.v) <> 'OBJECT' AND len(m.path) < len(n.path) AND n.path[1 : len(m.path)] = m.path)))""")
def merged_nested_orders(spark, sf_dir):
    """Partial documents merge at every depth; a value that is no object takes the place of all below it."""
    orders = table(spark, sf_dir, "orders")
    doc = F.expr(NESTED)
    writes = orders.select(F.lit("customers").alias("resource"), F.col("o_custkey").cast("string").alias("id"), F.when(doc.isNull(), "delete").otherwise("update").alias("op"), doc.alias("doc"), F.lit("orders").alias("topic"), F.lit(0).alias("partition"), F.col("o_orderkey").alias("offset"))
    return tree.leaves(resolve.merge_partial_json(writes).select("id", "doc"), "doc").select("id", F.array_join("path", "/").alias("path"), "leaf")


@query("SELECT CAST(doc_id AS VARCHAR) AS id, lang, n_chars, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)")
def document_label_upsert(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", F.lit("documents").alias("topic"), "lang", "n_chars", F.lit(None).cast("int").alias("quality"), F.lit(None).cast("int").alias("toxic"))
    labels = table(spark, sf_dir, "labels").select("doc_id", F.lit("labels").alias("topic"), F.lit(None).cast("string").alias("lang"), F.lit(None).cast("long").alias("n_chars"), "quality", "toxic")
    rows = route.route_map(docs.unionByName(labels), {"documents": "documents", "labels": "documents"})
    rows = rows.select("resource", F.col("doc_id").cast("string").alias("id"), F.lit("update").alias("op"), "lang", "n_chars", "quality", "toxic", "topic", F.lit(0).alias("partition"), F.col("doc_id").alias("offset"))
    present = {f: F.col("topic") == t for t, own in (("documents", ("lang", "n_chars")), ("labels", ("quality", "toxic"))) for f in own}
    return resolve.merge_partial(rows, ["lang", "n_chars", "quality", "toxic"], present=present).drop("resource")


FIRST_TURN = "SELECT CAST(conv_id AS VARCHAR) AS id, role, text FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn FROM conversations) WHERE rn = 1"


def _conversation_actions(rows: DataFrame) -> DataFrame:
    return rows.select(F.lit("logs-chat-conversations").alias("resource"), F.col("conv_id").cast("string").alias("id"), F.lit("create").alias("op"), F.struct("role", "text").alias("doc"), F.lit("conversations").alias("topic"), F.pmod("conv_id", F.lit(4)).cast("int").alias("partition"), F.col("turn").alias("offset"))


@query(FIRST_TURN)
def first_create(spark, sf_dir):
    return resolve.first_create_wins(_conversation_actions(table(spark, sf_dir, "conversations"))).select("id", "doc.*")


@query("SELECT concat_ws('+', 'events', user_id % 4, event_id) AS id, event_type FROM events")
def appended_documents(spark, sf_dir):
    options = Options(key_ignore=True, null_policy="delete")
    events = event_changes(table(spark, sf_dir, "events").withColumn("kind", F.col("event_type")).withColumn("event_type", F.lit("any")).withColumn("props", F.col("kind")))
    rows = job.actions(checks.accepted(job.tagged(events, options)), options)
    return resolve.append(rows, rows.where(F.col("offset") % 2 == 0)).select("id", F.col("doc.props").alias("event_type"))


@query("SELECT 'events' AS resource, count(*) - count(DISTINCT user_id) AS n_stale FROM events")
def stale_writes(spark, sf_dir):
    return resolve.stale_report(event_actions(event_changes(table(spark, sf_dir, "events"))))


@query("""
SELECT user_id % 10 AS bucket, count(*) AS n FROM (
  SELECT user_id, event_id * 7919 % 10007 AS v, max(event_id * 7919 % 10007) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM events) WHERE v <= before GROUP BY 1""")
def refused_writes(spark, sf_dir):
    rows = event_actions(event_changes(table(spark, sf_dir, "events"))).withColumn("version", F.col("offset") * 7919 % 10007)
    return resolve.refused(rows).groupBy((F.col("id").cast("long") % 10).alias("bucket")).agg(F.count("*").alias("n"))


@query(LATEST)
def incremental_state(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    odd = F.col("event_id") % 2 == 1
    before = resolve.latest_wins(event_actions(event_changes(events.where(odd))))
    return _documents(resolve.live(resolve.apply_batch(before, event_actions(event_changes(events.where(~odd))).select(before.columns))))


@query("SELECT 'events' AS resource, count(*) AS n_docs FROM (SELECT user_id, arg_max(event_type, event_id) AS t FROM events GROUP BY 1) WHERE t <> 'error'")
def doc_counts(spark, sf_dir):
    return state.doc_counts(resolve.live(resolve.latest_wins(event_actions(event_changes(table(spark, sf_dir, "events"))))))


# Mapping


@query("""
SELECT path, type, keyword_ignore_above, null_value FROM (VALUES
  ('key', 'long', NULL, NULL), ('at', 'date', NULL, NULL), ('lines', 'object', NULL, NULL), ('lines.price', 'double', NULL, '1.5'), ('lines.flag', 'boolean', NULL, NULL),
  ('lines.note', 'text', 256, NULL), ('tags', 'object', NULL, NULL), ('size', 'integer', NULL, '7'), ('day', 'date', NULL, '0'), ('raw', 'binary', NULL, NULL), ('small', 'short', NULL, NULL), ('tiny', 'byte', NULL, NULL), ('ratio', 'float', NULL, NULL)
) m(path, type, keyword_ignore_above, null_value) WHERE (SELECT count(*) FROM orders) > 0""")
def mapping_of_nested_orders(spark, sf_dir):
    """All kinds of fields, with defaults, made of the orders and mapped once for the one resource that they go to."""
    line = F.struct(F.col("o_totalprice").cast("decimal(12,2)").alias("price", metadata={"default": "1.5"}), F.lit(True).alias("flag"), F.col("o_orderpriority").alias("note", metadata={"default": "none"}))
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("long").alias("key"), F.col("o_orderdate").cast("timestamp").alias("at"), F.array(line).alias("lines"), F.create_map(F.lit("status"), "o_orderstatus").alias("tags"),
        F.lit(1).alias("size", metadata={"default": 7}),
        F.col("o_orderdate").cast("date").alias("day", metadata={"default": "1970-01-01"}), F.col("o_orderstatus").cast("binary").alias("raw"), F.lit(1).cast("smallint").alias("small"), F.lit(1).cast("tinyint").alias("tiny"), F.lit(1).cast("float").alias("ratio"),
    )
    return mapping.mappings_of(route.targets(orders.select(F.lit("orders").alias("resource"))), orders.schema).drop("resource")


@query("""SELECT resource, m.* FROM (SELECT DISTINCT lower(source) AS resource FROM documents), (VALUES ('doc_id', 'long', NULL, NULL), ('text', 'text', 256, NULL), ('lang', 'text', 256, NULL), ('source', 'text', 256, NULL), ('n_chars', 'long', NULL, NULL))
m(path, type, keyword_ignore_above, null_value)""")
def mapping_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return mapping.mappings_of(route.targets(docs.select(route.route_index(F.col("source")).alias("resource"))), docs.schema)


@query("SELECT DISTINCT lower(source) AS resource FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE n_chars > 16000)")
def unmapped_resources(spark, sf_dir):
    """Resources that need a mapping and have none yet: here those that have a very long document are mapped."""
    docs = table(spark, sf_dir, "documents").withColumn("resource", route.route_index(F.col("source")))
    return mapping.unmapped(docs, docs.where("n_chars > 16000").select("resource").distinct())


@query("SELECT event_type AS resource, 'k' AS field, 'BIGINT' AS type, count(*) AS n FROM events WHERE json_type(props, '$.k') IS NOT NULL GROUP BY 1")
def inferred_fields(spark, sf_dir):
    return mapping.infer_fields(table(spark, sf_dir, "events").select(F.col("event_type").alias("resource"), F.col("props").alias("doc")))


# Batches


@query("SELECT CAST(user_id % 4 AS INTEGER) AS partition, (row_number() OVER (PARTITION BY user_id % 4 ORDER BY event_id) - 1) // 100 AS batch, event_id AS offset FROM events")
def bulk_batches_by_count(spark, sf_dir):
    return frame.frame_by_count(event_changes(table(spark, sf_dir, "events")).select("topic", "partition", "offset"), 100).drop("topic")


@query("""
WITH RECURSIVE d AS (SELECT doc_id, CAST(doc_id % 64 AS INTEGER) AS p, strlen(text) AS n, row_number() OVER (PARTITION BY doc_id % 64 ORDER BY doc_id) AS rn FROM documents),
f AS (
  SELECT p, rn, doc_id, 0 AS batch, n AS held FROM d WHERE rn = 1
  UNION ALL SELECT d.p, d.rn, d.doc_id, CASE WHEN f.held >= 50000 THEN f.batch + 1 ELSE f.batch END, CASE WHEN f.held >= 50000 THEN d.n ELSE f.held + d.n END FROM f JOIN d ON d.p = f.p AND d.rn = f.rn + 1
)
SELECT p AS partition, doc_id AS offset, CAST(batch AS BIGINT) AS batch FROM f""")
def bulk_batches_by_bytes(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.lit("documents").alias("topic"), F.pmod("doc_id", F.lit(64)).cast("int").alias("partition"), F.col("doc_id").alias("offset"), F.octet_length("text").cast("long").alias("n"))
    return frame.frame_by_bytes(docs, "n", 50_000).select("partition", "offset", "batch")


@query("""
SELECT event_id, 0 AS line_no, '{"' || CASE WHEN event_type = 'error' THEN 'delete' ELSE 'index' END || '":{"_index":"events","_id":"' || user_id || '","version":' || event_id || ',"version_type":"external"}}' AS line FROM events
UNION ALL SELECT event_id, 1, '{"user_id":' || user_id || '}' FROM events WHERE event_type <> 'error'""")
def bulk_lines(spark, sf_dir):
    rows = event_actions(event_changes(table(spark, sf_dir, "events"))).withColumn("doc_json", F.concat(F.lit('{"user_id":'), "id", F.lit("}")))
    return frame.bulk_lines(rows, version="version").select(F.col("offset").alias("event_id"), "line_no", "line")


# Outcomes


@query("""
SELECT error_class, processed, reported, fatal, count(*) AS n FROM (
  SELECT CASE event_type WHEN 'error' THEN 'malformed' WHEN 'click' THEN 'conflict' WHEN 'signup' THEN 'other' ELSE 'ok' END AS error_class,
    event_type <> 'signup' AS processed, event_type IN ('error', 'signup') OR (event_type = 'click' AND event_id % 2 = 1) AS reported, event_type = 'signup' AS fatal FROM events)
GROUP BY ALL""")
def response_classes(spark, sf_dir):
    """Answers to writes, as a target gives them, are made of the events; their items are then paired and classified."""
    error = F.expr("case event_type when 'error' then 'document_parsing_exception' when 'click' then 'version_conflict_engine_exception' when 'signup' then 'es_rejected_execution_exception' end")
    item = F.concat(F.lit('{"index":{"_id":"'), F.col("event_id"), F.lit('","status":200'), F.coalesce(F.concat(F.lit(',"error":{"type":"'), error, F.lit('","reason":"r"}')), F.lit("")), F.lit("}}"))
    events = table(spark, sf_dir, "events").select(F.floor(F.col("event_id") / 2000).alias("batch_id"), "event_id", item.alias("item"))
    answers = events.groupBy("batch_id").agg(F.array_sort(F.collect_list(F.struct("event_id", "item"))).alias("rows"))
    responses = answers.select("batch_id", F.concat(F.lit('{"items":['), F.array_join("rows.item", ","), F.lit("]}")).alias("response"))
    batches = answers.select("batch_id", F.posexplode("rows.event_id").alias("pos", "event_id")).withColumn("external", F.col("event_id") % 2 == 0)
    paired = outcome.pair(outcome.response_items(responses), batches)
    return outcome.classify(paired, "warn", F.col("external")).groupBy("error_class", "processed", "reported", "fatal").agg(F.count("*").alias("n"))


# Progress


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_changes(table(spark, sf_dir, "events")).select("topic", "partition", "offset", (F.col("offset") % 97 != 0).alias("processed"))


SAFE = """
WITH r AS (SELECT CAST(user_id % 4 AS INTEGER) AS partition, event_id AS o, event_id % 97 <> 0 {more} AS processed FROM events),
s AS (SELECT partition, max(o) FILTER (WHERE processed AND (first_open IS NULL OR o < first_open)) + 1 AS commit_offset
  FROM r LEFT JOIN (SELECT partition, min(o) AS first_open FROM r WHERE NOT processed GROUP BY 1) USING (partition) GROUP BY 1)
"""


@query(SAFE.format(more="") + "SELECT 'events' AS topic, partition, commit_offset FROM s WHERE commit_offset IS NOT NULL")
def safe_offsets(spark, sf_dir):
    return progress.safe_offsets(_records(spark, sf_dir))


@query(SAFE.format(more="") + "SELECT 'events' AS topic, partition, commit_offset FROM s WHERE commit_offset IS NOT NULL")
def safe_offsets_stream(spark, sf_dir):
    """The same from runs of offsets as keyed state: the last safe offset that a micro-batch gave for each partition."""
    root = shared(spark, "offsets")
    own = spark.newSession()  # the state store is a setting of the session; the caller's stays as it is
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    records = event_changes(_stream(own, sf_dir, "events")).select("topic", "partition", "offset", (F.col("offset") % 97 != 0).alias("processed"))

    def one(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    offsets.stream_safe_offsets(records).writeStream.outputMode("update").foreachBatch(one).option("checkpointLocation", root + "/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{root}/out").groupBy("topic", "partition").agg(F.max("commit_offset").alias("commit_offset"))


@query(SAFE.format(more="OR event_id % 2 = 0") + "SELECT 'events' AS topic, partition, commit_offset FROM s WHERE commit_offset IS NOT NULL")
def safe_offsets_after_replay(spark, sf_dir):
    first = _records(spark, sf_dir)
    again = first.where("offset % 2 = 0").withColumn("processed", F.lit(True))
    return progress.safe_offsets(progress.merge_replays(first.unionByName(again)))


@query("SELECT 'events' AS topic, CAST(user_id % 4 AS INTEGER) AS partition, max(event_id) + 1 AS commit_offset FROM events GROUP BY ALL HAVING bool_and(event_type <> 'error' OR user_id % 4 < 2)")
def all_or_none_offsets(spark, sf_dir):
    rows = event_changes(table(spark, sf_dir, "events")).withColumn("processed", F.col("value").isNotNull() | (F.col("partition") < 2))
    return progress.all_or_none_offsets(rows)


@query(SAFE.format(more="") + "SELECT 'events' AS topic, partition, count(*) FILTER (WHERE commit_offset IS NULL OR o >= commit_offset) AS pending, count(*) FILTER (WHERE commit_offset IS NULL OR o >= commit_offset) > 200 AS paused FROM r LEFT JOIN s USING (partition) GROUP BY partition")
def backlog(spark, sf_dir):
    return progress.backlog(_records(spark, sf_dir), 200)


@query(SAFE.format(more="OR event_id < 97") + "SELECT 'events' AS topic, partition, commit_offset FROM s WHERE commit_offset IS NOT NULL AND partition <> 1")
def progress_after_handover(spark, sf_dir):
    done = progress.safe_offsets(_records(spark, sf_dir).withColumn("processed", F.col("processed") | (F.col("offset") < 97)))
    return progress.hand_over(done, spark.createDataFrame([("events", 1), ("other", 0)], "topic string, partition int"))


# Nested documents


@query("""
WITH w AS (SELECT *, CASE WHEN o_orderkey % 11 = 0 THEN 'none' WHEN o_orderkey % 7 = 0 THEN 'list' ELSE o_orderstatus END AS kind FROM orders)
SELECT 'unknown' AS kind, 'n' AS path, count(*) AS n FROM w WHERE kind = 'P' HAVING count(*) > 0
UNION ALL SELECT 'unknown', 'done.by.' || o_orderpriority, count(*) FROM w WHERE kind = 'F' AND o_orderpriority NOT IN ('1-URGENT', '2-HIGH') GROUP BY 2
UNION ALL SELECT 'bad', 'done', count(*) FROM w WHERE kind = 'list' HAVING count(*) > 0
UNION ALL SELECT 'bad', 'done.key', count(*) FROM w WHERE kind = 'F' AND o_orderkey > 1 HAVING count(*) > 0""")
def nested_conformance(spark, sf_dir):
    """Documents against declared fields at every depth: names that are not declared, values that don't fit, an array where an object is declared."""
    priorities = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    declared = {"open": {"key": "bigint", "by": dict.fromkeys(priorities, "bigint")}, "done": {"key": "boolean", "by": dict.fromkeys(priorities[:2], "bigint")}}
    docs = checks.conforms(table(spark, sf_dir, "orders").select(F.expr(NESTED).alias("doc")), declared)
    found = [docs.select(F.lit(kind).alias("kind"), F.explode(c).alias("path")) for kind, c in (("unknown", "unknown_fields"), ("bad", "bad_fields"))]
    return found[0].unionByName(found[1]).groupBy("kind", "path").agg(F.count("*").alias("n"))


@query(f"""
WITH RECURSIVE w AS (SELECT o_orderstatus AS resource, CAST({NESTED} AS JSON) AS j FROM orders),
nodes(resource, path, v) AS (
  SELECT resource, [k], json_extract(j, '$."' || k || '"') FROM (SELECT *, unnest(json_keys(j)) AS k FROM w WHERE j IS NOT NULL)
  UNION ALL SELECT resource, CASE WHEN u.k IS NULL THEN path ELSE list_append(path, u.k) END, u.e FROM (SELECT resource, path, unnest(CASE json_type(v)
    WHEN 'OBJECT' THEN list_transform(json_keys(v), lambda x: struct_pack(k := x, e := json_extract(v, '$."' || x || '"')))
    ELSE list_transform(CAST(v AS JSON[]), lambda x: struct_pack(k := CAST(NULL AS VARCHAR), e := x)) END) AS u FROM nodes WHERE json_type(v) IN ('OBJECT', 'ARRAY'))),
kinds AS (SELECT resource, array_to_string(path, '/') AS path, CASE json_type(v) WHEN 'UBIGINT' THEN 'bigint' WHEN 'BIGINT' THEN 'bigint' WHEN 'VARCHAR' THEN 'string' WHEN 'OBJECT' THEN 'object' WHEN 'NULL' THEN NULL END AS kind FROM nodes WHERE json_type(v) <> 'ARRAY')
SELECT resource, path, count(*) AS n, CASE WHEN count(DISTINCT kind) = 0 THEN 'null' WHEN count(DISTINCT kind) = 1 THEN min(kind) END AS type, count(DISTINCT kind) > 1 AS conflict FROM kinds GROUP BY ALL""")
def inferred_nested_fields(spark, sf_dir):
    docs = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("resource"), F.expr(NESTED).alias("doc"))
    return mapping.infer_tree(docs).withColumn("path", F.array_join("path", "/"))


@query("SELECT CASE WHEN event_id % 2 = 0 THEN CAST(event_id % 50 AS VARCHAR) END AS at, count(*) AS n FROM events GROUP BY 1")
def timestamp_from_dotted_field(spark, sf_dir):
    """A name with a dot is a field's whole name, and no path."""
    doc = F.expr("""case when event_id % 2 = 0 then '{"event":{"time":1},"event.time":"' || (event_id % 50) || '"}' else '{"event":{"time":"9"}}' end""")
    return table(spark, sf_dir, "events").groupBy(project.event_time_of_json(doc, ["absent.time", "event.time"]).alias("at")).agg(F.count("*").alias("n"))


# Streams: the same results from files as they come


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table's files as a stream; a table that is one file is a stream of it."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 4).option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(f"{sf_dir}/{name}.parquet*")


@query(LATEST)
def latest_documents_stream(spark, sf_dir):
    root = shared(spark, "state")
    options = Options(null_policy="delete")
    state_sink.keep_state(event_changes(_stream(spark, sf_dir, "events")), f"{root}/out", options, f"{root}/checkpoint").awaitTermination()
    return _documents(resolve.live(state.read_state(spark, f"{root}/out")))


@query(LATEST)
def latest_documents_lingering(spark, sf_dir):
    """The same with micro-batches that wait for more, until nothing new comes."""
    root = shared(spark, "state")
    options = Options(null_policy="delete", linger_ms=100)
    running = state_sink.keep_state(event_changes(_stream(spark, sf_dir, "events")), f"{root}/out", options, f"{root}/checkpoint", linger=True)
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return _documents(resolve.live(state.read_state(spark, f"{root}/out")))


@query(FIRST_TURN)
def first_create_stream(spark, sf_dir):
    root = shared(spark, "state")

    def one(batch: DataFrame, batch_id: int) -> None:
        state.update_state(_conversation_actions(batch), root + "/out", batch_id, resolve.first_create_wins)

    _stream(spark, sf_dir, "conversations").writeStream.foreachBatch(one).option("checkpointLocation", root + "/checkpoint").trigger(availableNow=True).start().awaitTermination()
    return state.read_state(spark, root + "/out").select("id", "doc.*")


@query("""SELECT CAST(user_id AS VARCHAR) AS id, event_id AS version, CASE WHEN event_type = 'error' THEN 'delete' ELSE 'index' END AS op,
  CASE WHEN event_type <> 'error' THEN event_type END AS event_type, CASE WHEN event_type <> 'error' THEN value END AS value, CASE WHEN event_type <> 'error' THEN props END AS props FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1""")
def stream_latest_versions(spark, sf_dir):
    """Keyed state: each micro-batch emits the writes that became an id's state; the last of these per id is its state."""
    root = shared(spark, "latest")
    own = spark.newSession()  # the state store is a setting of the session; the caller's stays as it is
    own.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    emitted = latest.stream_latest(event_actions(event_changes(_stream(own, sf_dir, "events"))))

    def one(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    emitted.writeStream.outputMode("update").foreachBatch(one).option("checkpointLocation", root + "/checkpoint").trigger(availableNow=True).start().awaitTermination()
    last = spark.read.parquet(f"{root}/out").groupBy("id").agg(F.max("version").alias("version"), F.max_by(F.struct("op", "doc_json"), "version").alias("won"))
    return last.select("id", "version", "won.op", F.from_json("won.doc_json", "event_type string, value double, props string").alias("doc")).select("id", "version", "op", "doc.*")


@query(MERGED.format(open="max(o_orderkey) FILTER (WHERE o_orderstatus = 'O')", done="max(o_orderkey) FILTER (WHERE o_orderstatus = 'F')", a="open_key", b="done_key"))
def merged_orders_stream(spark, sf_dir):
    """A stream of partial documents, upserted: what is absent in one stays, and a delete clears all."""
    root = shared(spark, "upserts")
    options = Options(write_method="upsert", null_policy="delete")
    orders = _stream(spark, sf_dir, "orders")
    part = F.when(F.col("o_orderstatus") == "O", F.to_json(F.struct(F.col("o_orderkey").alias("open_key")))).when(F.col("o_orderstatus") == "F", F.to_json(F.struct(F.col("o_orderkey").alias("done_key"))))
    rows = source.as_changes(orders, topic=F.lit("orders"), partition=F.pmod("o_custkey", F.lit(4)), offset="o_orderkey", key="o_custkey", value=part)
    state_sink.keep_state(rows, f"{root}/out", options, f"{root}/checkpoint").awaitTermination()
    kept = resolve.live(state.read_state(spark, f"{root}/out"))
    return kept.select("id", *(F.get_json_object("doc_json", f"$.{f}").cast("long").alias(f) for f in ("open_key", "done_key")))


@query("""
SELECT kind, n FROM (
  SELECT 'written' AS kind, count(*) AS n FROM (SELECT DISTINCT user_id FROM events WHERE event_type NOT IN ('error', 'view'))
  UNION ALL SELECT 'malformed', count(*) FROM events WHERE event_type IN ('error', 'view')
  UNION ALL SELECT 'mapped', 0)""")
def malformed_in_a_job(spark, sf_dir):
    """A job that checks documents against the target's fields: malformed ones are rejects of the write, the others become state."""
    root = shared(spark, "checked")
    options = Options(malformed_policy="warn", declared_fields={"k": "bigint"})
    doc = F.when(F.col("event_type") == "error", '{"k":"text"}').when(F.col("event_type") == "view", '{"other":1}').otherwise(F.col("props"))
    rows = source.as_changes(table(spark, sf_dir, "events"), topic=F.lit("events"), partition=F.lit(0), offset="event_id", key="user_id", value=doc)
    state_sink.apply_changes(rows, root, 0, options)
    rejected = state.read_rejects(spark, root).where("stage = 'write'")
    counts = [state.read_state(spark, root).select(F.lit("written").alias("kind")), rejected.select(F.lit("malformed").alias("kind"))]
    counted = counts[0].unionByName(counts[1]).groupBy("kind").agg(F.count("*").alias("n"))
    mapped = state.mapped(spark, root, 1).agg(F.count("*").alias("n")).select(F.lit("mapped").alias("kind"), "n")
    return counted.unionByName(mapped)


@query("""
WITH p AS (SELECT * FROM (VALUES ('ignore', false), ('warn', false), ('fail', true)) v(policy, stopped))
SELECT policy, stopped, CASE WHEN stopped THEN 0 ELSE (SELECT count(DISTINCT user_id) FROM events WHERE event_type NOT IN ('error', 'view')) END AS written,
  (SELECT count(*) FROM events WHERE event_type IN ('error', 'view')) AS malformed FROM p""")
def malformed_policies(spark, sf_dir):
    """Under every policy malformed documents are rejects; under `fail` the job stops after they are written."""
    doc = F.when(F.col("event_type") == "error", '{"k":"text"}').when(F.col("event_type") == "view", '{"other":1}').otherwise(F.col("props"))
    rows = source.as_changes(table(spark, sf_dir, "events"), topic=F.lit("events"), partition=F.lit(0), offset="event_id", key="user_id", value=doc)
    out = None
    for policy in ("ignore", "warn", "fail"):
        root, stopped = shared(spark, policy), False
        try:
            state_sink.apply_changes(rows, root, 0, Options(malformed_policy=policy, declared_fields={"k": "bigint"}))
        except checks.InvalidRecords:
            stopped = True
        kept = state.read_state(spark, root)
        kinds = [state.read_rejects(spark, root).where("stage = 'write'").select(F.lit("malformed").alias("kind"))] + ([kept.select(F.lit("written").alias("kind"))] if kept is not None else [])
        for rows_of_kind in kinds:
            own = rows_of_kind.select(F.lit(policy).alias("policy"), F.lit(stopped).alias("stopped"), "kind")
            out = own if out is None else out.unionByName(own)
    count = lambda kind: F.count(F.when(F.col("kind") == kind, 1)).alias(kind)
    return out.groupBy("policy", "stopped").agg(count("written"), count("malformed"))


@query("SELECT 'events' AS resource, path, type FROM (VALUES ('event_type', 'text'), ('value', 'double'), ('props', 'text')) m(path, type) WHERE (SELECT count(*) FROM events) > 0")
def mappings_of_a_job(spark, sf_dir):
    """Two batches of a job map their resource once, from the values' schema."""
    root, options = shared(spark, "mapped"), Options(null_policy="delete")
    events = table(spark, sf_dir, "events")
    for batch in (0, 1):
        state_sink.apply_changes(event_changes(events.where(F.col("event_id") % 2 == batch)), root, batch, options)
    return spark.read.parquet(f"{root}/mappings").select("resource", "path", "type")
