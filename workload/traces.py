"""Span trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetry_spark.functions.privacy import strict_span_name
from telemetry_spark.functions.timefmt import iso_millis
from telemetry_spark.functions.tracing import is_span_id, is_trace_id, traceparent
from telemetry_spark.operators import traces as op
from telemetry_spark.sources.envelopes import trace_envelopes
from workload.performance import PAGE_PARTS_SQL, REDUCED_PATH_SQL
from workload.tables import (
    LINE_ID_SQL,
    ORDER_SPANS_SQL,
    events,
    hex_id,
    hex_sql,
    item,
    line_id,
    order_spans,
    table,
)

def recorded_order():
    return [F.col("seq"), F.col("started_at"), F.col("span_id")]


def slow_traces(spark, sf):
    kept = op.slow_traces(order_spans(spark, sf), 2.0)
    return kept.groupBy("trace_id").agg(
        F.count(F.lit(1)).alias("spans"), F.max("duration_ms").alias("longest_ms")
    )


SLOW_SQL = f"""
WITH s AS ({ORDER_SPANS_SQL}),
slow AS (SELECT trace_id FROM s WHERE parent_span_id IS NULL AND duration_ms >= 2000)
SELECT trace_id, count(*) AS spans, max(duration_ms) AS longest_ms FROM s
WHERE trace_id IN (SELECT trace_id FROM slow) GROUP BY trace_id"""


def supplier_spans(spark, sf):
    """One trace per supplier, long enough to meet the cap."""
    supplier = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("string").alias("trace_id"), F.lit("root").alias("span_id"),
        F.lit(None).cast("string").alias("parent_span_id"), F.lit(None).cast("timestamp").alias("started_at"),
    )
    lines = table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("trace_id"), line_id().alias("span_id"),
        F.lit("root").alias("parent_span_id"), F.col("l_shipdate").cast("timestamp").alias("started_at"),
    )
    return supplier.unionByName(lines)


def capped_spans(spark, sf):
    kept = op.cap_spans(supplier_spans(spark, sf), [F.col("started_at"), F.col("span_id")])
    return kept.select("trace_id", "span_id", "parent_span_id")


CAPPED_SQL = f"""
SELECT s_suppkey::VARCHAR AS trace_id, 'root' AS span_id, NULL AS parent_span_id FROM supplier
UNION ALL
SELECT l_suppkey::VARCHAR, id, 'root' FROM (SELECT *, {LINE_ID_SQL} AS id FROM lineitem)
QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate, id) <= 499"""


def assembled_traces(spark, sf):
    traces = op.assemble_traces(order_spans(spark, sf), recorded_order())
    return traces.select(
        "trace_id", F.size("spans").alias("spans"), F.col("spans")[0]["name"].alias("root_name"),
        F.array_join(F.transform("spans", lambda s: s["span_id"]), ",").alias("span_ids"),
    )


ASSEMBLED_SQL = f"""
WITH s AS ({ORDER_SPANS_SQL}),
slow AS (SELECT trace_id, name FROM s WHERE parent_span_id IS NULL AND duration_ms >= 1000),
k AS (SELECT s.*, slow.name AS root_name,
             row_number() OVER (PARTITION BY s.trace_id ORDER BY parent_span_id IS NOT NULL, seq, started_at, span_id)
             AS n FROM s JOIN slow USING (trace_id))
SELECT trace_id, CAST(count(*) AS INTEGER) AS spans, any_value(root_name) AS root_name,
       string_agg(span_id, ',' ORDER BY n) AS span_ids FROM k WHERE n <= 500 GROUP BY trace_id"""


def trace_bodies(spark, sf):
    bodies = trace_envelopes(op.assemble_traces(order_spans(spark, sf), recorded_order()))
    return bodies.select("trace_id", "records", F.md5("body").alias("body_md5"))


SPAN_JSON_SQL = """'{"span_id":"' || span_id || '","parent_span_id":'
  || CASE WHEN parent_span_id IS NULL THEN 'null' ELSE '"' || parent_span_id || '"' END || ',"name":"' || name
  || '","kind":"' || CASE WHEN parent_span_id IS NULL THEN 'controller' ELSE 'service' END || '","started_at":"'
  || strftime(started_at, '%Y-%m-%dT%H:%M:%S.%gZ') || '","duration_ms":' || duration_ms
  || ',"environment":"production","release":null,"data":{}}'"""
BODIES_SQL = f"""
WITH s AS ({ORDER_SPANS_SQL}),
slow AS (SELECT trace_id FROM s WHERE parent_span_id IS NULL AND duration_ms >= 1000),
k AS (SELECT s.*, row_number() OVER (PARTITION BY trace_id ORDER BY parent_span_id IS NOT NULL, seq, started_at,
             span_id) AS n FROM s WHERE trace_id IN (SELECT trace_id FROM slow))
SELECT trace_id, CAST(count(*) AS INTEGER) AS records,
       md5('{{"trace_id":"' || trace_id || '","spans":[' || string_agg({SPAN_JSON_SQL}, ',' ORDER BY n) || ']}}')
       AS body_md5 FROM k WHERE n <= 500 GROUP BY trace_id"""


def event_forest(spark, sf):
    """Eight big traces: events 0 to 7 are roots, and event e hangs under event e / 2."""
    e = F.col("event_id")
    level = F.greatest(F.floor(F.log2(F.greatest(e, F.lit(1)).cast("double"))) - 2, F.lit(0))
    trace = F.when(e < 8, e).otherwise(F.floor(e / F.pow(F.lit(2.0), level)))
    return table(spark, sf, "events").select(
        trace.cast("string").alias("trace_id"), e.cast("string").alias("span_id"),
        F.when(e >= 8, F.floor(e / 2).cast("string")).alias("parent_span_id"), F.col("event_type").alias("name"),
    )


def span_tree(spark, sf):
    return op.span_tree(event_forest(spark, sf)).select(
        "trace_id", "span_id", "depth", F.array_join("path", ">").alias("path")
    )


TREE_SQL = """
WITH RECURSIVE t AS (
  SELECT event_id AS root, event_id, 0 AS depth, event_type AS path FROM events WHERE event_id < 8
  UNION ALL
  SELECT t.root, e.event_id, t.depth + 1, t.path || '>' || e.event_type
  FROM t JOIN events e ON e.event_id // 2 = t.event_id AND e.event_id >= 8)
SELECT root::VARCHAR AS trace_id, event_id::VARCHAR AS span_id, depth, path FROM t"""


def errors_to_traces(spark, sf):
    trace = F.when(F.col("value") >= 10, hex_id(F.col("event_id") + 1, 32))
    errors = events(spark, sf).where("event_type = 'error'").select("event_id", trace.alias("trace_id"))
    return op.link_errors_to_traces(errors, order_spans(spark, sf))


LINK_SQL = f"""
WITH s AS ({ORDER_SPANS_SQL}),
t AS (SELECT trace_id, max(name) FILTER (parent_span_id IS NULL) AS trace_name,
             max(duration_ms) FILTER (parent_span_id IS NULL) AS trace_duration_ms, count(*) AS trace_spans
      FROM s GROUP BY trace_id),
e AS (SELECT event_id, CASE WHEN value >= 10 THEN {hex_sql('event_id + 1', 32)} END AS trace_id
      FROM events WHERE event_type = 'error')
SELECT event_id, e.trace_id, trace_name, trace_duration_ms, trace_spans FROM e LEFT JOIN t USING (trace_id)"""


def stitched_traces(spark, sf):
    """A backend request for every line, one in nine with a header no tracer would write."""
    client = order_spans(spark, sf)
    seed = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    ours = traceparent(
        hex_id(F.col("l_orderkey") + 1, 32), line_id(), F.lit(None).cast("string"), F.lit(True)
    )
    header = F.when(F.col("l_tax") == 0, F.upper(ours)).otherwise(ours)
    backend = table(spark, sf, "lineitem").select(
        F.concat_ws("-", F.lit("b"), seed).alias("span_id"), F.concat(F.lit("part "), F.col("l_partkey")).alias("name"),
        header.alias("traceparent"),
    )
    return op.stitch_traces(client, backend)


STITCH_SQL = f"""
WITH l AS (SELECT *, {hex_sql('l_orderkey + 1', 32)} AS trace_id, {LINE_ID_SQL} AS parent_span_id FROM lineitem)
SELECT trace_id, parent_span_id, 'b-' || concat_ws('-', b.l_orderkey, b.l_linenumber, b.l_partkey, b.l_suppkey) AS backend_span_id,
       'part ' || b.l_partkey AS backend_name, 'line ' || c.l_linenumber AS client_name
FROM l b JOIN l c USING (trace_id, parent_span_id)
WHERE b.l_tax <> 0 OR (regexp_full_match(parent_span_id, '[0-9]+') AND regexp_full_match(trace_id, '[0-9]+'))"""

CELL = 4 * 86400


def thread_spans(spark, sf):
    """Spans of one thread per user: each stays open to the end of its four-day cell, small ones are only recorded."""
    cell_end = F.timestamp_seconds((F.floor(F.unix_micros("ts") / (CELL * 1_000_000)) + 1) * CELL)
    spans = events(spark, sf).select(
        F.col("user_id").alias("trace_id"), F.lit("main").alias("thread"), F.col("event_id").cast("string").alias("span_id"),
        F.col("ts").alias("started_at"), cell_end.alias("ended_at"), (F.col("value") >= 15).alias("opens"),
        F.lit(False).alias("is_root"),
    )
    tops = spans.groupBy("trace_id").agg(F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"))
    root = tops.select(
        "trace_id", F.lit("main").alias("thread"), F.concat(F.lit("root-"), F.col("trace_id")).alias("span_id"),
        "started_at", "ended_at", F.lit(True).alias("opens"), F.lit(True).alias("is_root"),
    )
    return spans.unionByName(root)


def inferred_parents(spark, sf):
    return op.infer_parents(thread_spans(spark, sf), 86400.0).select("trace_id", "span_id", "parent_span_id")


PARENTS_SQL = f"""
WITH s AS (SELECT *, CAST(floor(epoch_us(ts) / {CELL * 1_000_000}) AS BIGINT) AS cell FROM events),
p AS (SELECT c.event_id, arg_max(o.event_id, o.ts) AS parent FROM s c
      JOIN s o ON o.user_id = c.user_id AND o.cell = c.cell AND o.ts < c.ts AND o.value >= 15 GROUP BY c.event_id)
SELECT s.user_id AS trace_id, s.event_id::VARCHAR AS span_id,
       coalesce(p.parent::VARCHAR, 'root-' || s.user_id) AS parent_span_id
FROM s LEFT JOIN p USING (event_id)
UNION ALL SELECT DISTINCT user_id, 'root-' || user_id, NULL FROM events"""


def deduped_spans(spark, sf):
    """Spans named by event type and item, recorded again and again, up to their user's first big purchase."""
    rows = events(spark, sf)
    recorded = rows.select(
        F.col("user_id").alias("trace_id"), F.concat_ws("-", "event_type", F.floor(item(rows) / 20)).alias("span_id"),
        "event_id", F.col("ts").alias("recorded_at"),
    )
    finishes = rows.where("event_type = 'purchase' and value > 40").select(
        F.col("user_id").alias("trace_id"), F.col("ts").alias("finished_at")
    )
    return op.dedupe_finish(recorded, finishes).drop("recorded_at")


DEDUPE_SQL = """
WITH r AS (SELECT user_id AS trace_id, event_type || '-' || CAST(floor(CAST(props->>'k' AS BIGINT) / 20) AS BIGINT)
                  AS span_id, event_id, ts FROM events),
f AS (SELECT user_id AS trace_id, min(ts) AS finished FROM events WHERE event_type = 'purchase' AND value > 40
      GROUP BY 1)
SELECT trace_id, span_id, event_id FROM (SELECT * FROM r QUALIFY row_number() OVER
  (PARTITION BY trace_id, span_id ORDER BY ts) = 1) LEFT JOIN f USING (trace_id)
WHERE finished IS NULL OR ts <= finished"""


def span_records(spark, sf):
    """Database spans with raw SQL in two places, and spans of kinds that ignore it."""
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    statement = F.concat(
        F.lit("SELECT * FROM orders WHERE o_orderkey = "), key, F.lit(" AND o_orderpriority = '"),
        F.col("o_orderpriority"), F.lit("'"),
    )
    raw = table(spark, sf, "orders").select(
        key.alias("seq"), F.when(status == "O", "db").when(status == "F", "database").otherwise("redis").alias("kind"),
        F.col("o_orderdate").cast("timestamp").alias("started_at"),
        (F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(secs=F.col("o_totalprice") / 1000)).alias("ended_at"),
        F.when(key % 2 == 0, statement).alias("statement"), F.when(key % 3 == 0, " SQLite ").alias("db_system"),
        F.to_json(F.struct(statement.alias("db.statement"), key.alias("rows"))).alias("data"),
    )
    built = op.spans(raw)
    return built.select("seq", "kind", "duration_ms", iso_millis(F.col("started_at")).alias("started_at"), "data")


MASKED_ORDER = "SELECT * FROM orders WHERE o_orderkey = ? AND o_orderpriority = ?"
SPAN_RECORDS_SQL = f"""
SELECT o_orderkey AS seq, CASE o_orderstatus WHEN 'O' THEN 'other' WHEN 'F' THEN 'database' ELSE 'redis' END AS kind,
  floor(CAST(round(o_totalprice * 1000) AS BIGINT) / 1000.0 * 100 + 0.5) / 100 AS duration_ms,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%gZ') AS started_at,
  CASE o_orderstatus WHEN 'F' THEN '{{"rows":' || o_orderkey || ',"db.statement":"{MASKED_ORDER}"'
    || CASE WHEN o_orderkey % 3 = 0 THEN ',"db.system":"sqlite"' ELSE '' END || '}}'
  ELSE '{{"db.statement":"SELECT * FROM orders WHERE o_orderkey = ' || o_orderkey || ' AND o_orderpriority = '''
    || o_orderpriority || '''","rows":' || o_orderkey || '}}' END AS data
FROM orders"""


def request_spans(spark, sf):
    page = F.col("page_id")
    calls = table(spark, sf, "pages").select(
        page, F.when(page % 4 == 0, "create order").alias("name"), F.when(page % 3 > 0, "POST").alias("method"),
        F.when(page % 5 > 0, F.col("url")).alias("url"), F.when(page % 2 == 0, 201).alias("status"),
    )
    return op.request_spans(calls).select("page_id", "name", "kind", "data")


REQUEST_SQL = """
SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'create order' ELSE CASE WHEN page_id % 3 > 0 THEN 'POST' ELSE 'GET' END
  || ' ' || CASE WHEN page_id % 5 > 0 THEN regexp_extract(url, '^https?://([^/?#:]+)', 1) ELSE 'unknown host' END END
  AS name, 'http' AS kind, CASE WHEN page_id % 2 = 0 THEN '{"status":201}' ELSE '{}' END AS data FROM pages"""


def strict_span_records(spark, sf):
    """Spans named by a full URL, a raw path, or a plain name, with data that has to go."""
    page = F.col("page_id")
    name = (
        F.when(page % 3 == 0, F.concat(F.lit("get "), F.col("url")))
        .when(page % 3 == 1, F.regexp_extract("url", "^https?://[^/]+(/.*)$", 1))
        .otherwise("OrdersController#create")
    )
    data = F.when(page % 2 == 0, F.lit('{"status":200}')).otherwise(
        F.concat(F.lit('{"db.system":"sqlite","rows":'), page, F.lit("}"))
    )
    raw = table(spark, sf, "pages").select(page, name.alias("name"), data.alias("data"))
    return op.strict_spans(raw)


STRICT_SPANS_SQL = f"""
SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'GET ' || regexp_extract(url, '^https?://([^/?#:]+)', 1)
  WHEN 1 THEN {REDUCED_PATH_SQL} ELSE 'OrdersController#create' END AS name,
  CASE WHEN page_id % 2 = 0 THEN NULL ELSE '{{"db.system":"sqlite"}}' END AS data FROM ({PAGE_PARTS_SQL})"""


def trace_ids(spark, sf):
    key = F.col("o_orderkey")
    ids = table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "O", F.upper(hex_id(key, 32))).otherwise(hex_id(key, 32)).alias("t"),
        F.when(F.col("o_orderstatus") == "P", hex_id(key, 15)).otherwise(hex_id(key, 16)).alias("s"),
    )
    return ids.select("o_orderkey", is_trace_id(F.col("t")).alias("trace_ok"), is_span_id(F.col("s")).alias("span_ok"))


IDS_SQL = f"""
SELECT o_orderkey, o_orderkey > 0 AND (o_orderstatus <> 'O' OR regexp_full_match(to_hex(o_orderkey), '[0-9]+'))
  AS trace_ok, o_orderkey > 0 AND o_orderstatus <> 'P' AS span_ok FROM orders"""


def strict_span_names(spark, sf):
    page = F.col("page_id")
    name = F.when(page % 2 == 0, F.concat(F.lit("PUT user:p@ss@"), F.regexp_replace("url", "^https?://", ""))).otherwise(
        F.concat(F.lit("post  "), F.col("url"))
    )
    return table(spark, sf, "pages").select("page_id", strict_span_name(name).alias("name"))


SPAN_NAMES_SQL = """
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'PUT ' ELSE 'POST ' END
  || regexp_extract(url, '^https?://([^/?#:]+)', 1) AS name FROM pages"""

QUERIES = {
    "slow_traces": (slow_traces, SLOW_SQL),
    "capped_spans": (capped_spans, CAPPED_SQL),
    "assembled_traces": (assembled_traces, ASSEMBLED_SQL),
    "trace_bodies": (trace_bodies, BODIES_SQL),
    "span_tree": (span_tree, TREE_SQL),
    "errors_to_traces": (errors_to_traces, LINK_SQL),
    "stitched_traces": (stitched_traces, STITCH_SQL),
    "inferred_parents": (inferred_parents, PARENTS_SQL),
    "deduped_spans": (deduped_spans, DEDUPE_SQL),
    "span_records": (span_records, SPAN_RECORDS_SQL),
    "request_spans": (request_spans, REQUEST_SQL),
    "strict_span_records": (strict_span_records, STRICT_SPANS_SQL),
    "strict_span_names": (strict_span_names, SPAN_NAMES_SQL),
    "trace_ids": (trace_ids, IDS_SQL),
}
