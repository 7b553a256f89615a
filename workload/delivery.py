"""Delivery accounting and the predicates that gate reporting."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetry_spark.functions import delivery as fn
from telemetry_spark.operators import delivery as op
from workload.tables import events, table

LINE_STATUS = {1: 200, 2: 301, 3: 404, 4: 408, 5: 429, 6: 503, 7: 0}
LINE_STATUS_SQL = "CASE l_linenumber " + " ".join(f"WHEN {n} THEN {s}" for n, s in LINE_STATUS.items()) + " END"
EVENT_STATUS = {"purchase": 200, "signup": 422, "view": 503, "click": 429, "error": 0}
EVENT_STATUS_SQL = "CASE event_type " + " ".join(f"WHEN '{e}' THEN {s}" for e, s in EVENT_STATUS.items()) + " END"


def line_attempts(spark, sf):
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("payload_id"), F.expr(LINE_STATUS_SQL).alias("status")
    )


def delivery_outcomes(spark, sf):
    outcomes = op.with_outcome(line_attempts(spark, sf))
    return outcomes.groupBy("status", "outcome", "drop_reason").agg(F.count(F.lit(1)).alias("attempts"))


OUTCOMES_SQL = f"""
WITH a AS (SELECT {LINE_STATUS_SQL} AS status FROM lineitem)
SELECT status, CASE status WHEN 200 THEN 'delivered' WHEN 404 THEN 'rejected' ELSE 'failed' END AS outcome,
       CASE status WHEN 200 THEN NULL WHEN 404 THEN 'rejected by the server (HTTP 404)'
            WHEN 0 THEN 'the server could not be reached' ELSE 'the server answered HTTP ' || status END AS drop_reason,
       count(*) AS attempts FROM a GROUP BY ALL"""


def event_attempts(spark, sf):
    return events(spark, sf).select(
        F.col("user_id").alias("source"), F.col("event_id").alias("batch_id"), F.col("ts").alias("attempted_at"),
        F.expr(EVENT_STATUS_SQL).alias("status"),
    )


def retry_streaks(spark, sf):
    return op.streaks(event_attempts(spark, sf)).drop("attempted_at")


STREAKS_SQL = f"""
WITH a AS (SELECT user_id AS source, event_id AS batch_id, {EVENT_STATUS_SQL} AS status, ts FROM events),
b AS (SELECT *, sum(CASE WHEN status IN (200, 422) THEN 1 ELSE 0 END) OVER (PARTITION BY source ORDER BY ts, batch_id)
             AS island FROM a),
c AS (SELECT *, sum(CASE WHEN status IN (200, 422) THEN 0 ELSE 1 END)
             OVER (PARTITION BY source, island ORDER BY ts, batch_id) AS failures FROM b),
d AS (SELECT *, CASE WHEN status IN (200, 422) THEN 0 ELSE (failures - 1) % 5 + 1 END AS s FROM c)
SELECT source, batch_id, status,
       CASE status WHEN 200 THEN 'delivered' WHEN 422 THEN 'rejected' ELSE 'failed' END AS outcome,
       CAST(s AS INTEGER) AS streak,
       CASE WHEN status = 200 THEN 'delivered' WHEN status = 422 OR s = 5 THEN 'dropped' ELSE 'kept' END AS action
FROM d"""


def pending_payloads(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("payload_id"), "o_orderpriority")
    return op.pending_after(orders, line_attempts(spark, sf))


PENDING_SQL = """
SELECT o_orderkey AS payload_id, o_orderpriority FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linenumber IN (1, 3))"""


def payloads(spark, sf):
    """Pending reports of each user; some of unknown age."""
    return events(spark, sf).select(
        F.col("user_id").alias("source"), F.col("event_id").alias("payload_id"),
        F.when(F.col("event_type") != "signup", F.col("ts")).alias("created_at"),
    )


NOW = "2024-01-31 00:00:00"


def retained_payloads(spark, sf):
    kept, dropped = op.retain(payloads(spark, sf), F.lit(NOW).cast("timestamp"))
    return kept.withColumn("drop_reason", F.lit(None).cast("string")).unionByName(dropped).drop("created_at")


RETAIN_SQL = f"""
WITH p AS (SELECT user_id AS source, event_id AS payload_id,
                  CASE WHEN event_type <> 'signup' THEN ts END AS created_at FROM events),
q AS (SELECT *, coalesce(created_at < TIMESTAMP '{NOW}' - INTERVAL 7 DAY, false) AS expired FROM p),
r AS (SELECT *, row_number() OVER (PARTITION BY source, expired ORDER BY created_at DESC NULLS LAST, payload_id DESC)
             AS position FROM q)
SELECT source, payload_id, CASE WHEN expired THEN 'expired' WHEN position > 20 THEN 'excess' END AS drop_reason
FROM r"""


def pending_oldest_first(spark, sf):
    """Every report still inside the limits, with its place in the order in which they go out."""
    kept, _ = op.retain(payloads(spark, sf), F.lit(NOW).cast("timestamp"))
    return op.upload_order(kept).select("source", "payload_id", "position")


OLDEST_SQL = f"""
SELECT source, payload_id, row_number() OVER (ORDER BY created_at NULLS FIRST, payload_id) AS position
FROM (SELECT r.*, CASE WHEN event_type <> 'signup' THEN ts END AS created_at
  FROM ({RETAIN_SQL}) r JOIN events ON event_id = payload_id WHERE drop_reason IS NULL)"""

QUEUE_LIMIT = 3


def queue_admission(spark, sf):
    """A small queue per user: clicks and purchases are deliveries, everything else is a trace that finished."""
    moves = events(spark, sf).select(
        F.col("user_id").alias("source"), F.col("ts").alias("at"), F.col("event_id").alias("trace_id"),
        F.when(F.col("event_type").isin("click", "purchase"), -1).otherwise(1).alias("delta"),
    )
    return op.admit(moves, limit=QUEUE_LIMIT).drop("at")


QUEUE_SQL = f"""
WITH RECURSIVE m AS (
  SELECT user_id AS source, event_id AS trace_id,
         CASE WHEN event_type IN ('click', 'purchase') THEN -1 ELSE 1 END AS delta,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
w AS (
  SELECT source, trace_id, delta, n, delta <= {QUEUE_LIMIT} AS admitted, least(delta, {QUEUE_LIMIT}) AS pending
  FROM m WHERE n = 1
  UNION ALL
  SELECT m.source, m.trace_id, m.delta, m.n, w.pending + m.delta <= {QUEUE_LIMIT},
         least(w.pending + m.delta, {QUEUE_LIMIT})
  FROM w JOIN m ON m.source = w.source AND m.n = w.n + 1)
SELECT source, trace_id, delta, admitted, pending FROM w"""


def dsns(spark, sf):
    """A DSN per page: keys that need decoding, passwords, ports and other paths among them."""
    page = F.col("page_id")
    host = F.regexp_extract("url", "^https?://([^/?#]+)", 1)
    dsn = (
        F.when(page % 5 == 0, F.concat(F.lit("https://"), host, F.lit("/api/v1/events")))
        .when(page % 5 == 1, F.concat(F.lit("https://k%2B"), page, F.lit("@"), host, F.lit("/api/v1/events")))
        .when(page % 5 == 2, F.concat(F.lit("http://k"), page, F.lit(":pw@"), host, F.lit(":8443/v1/events?x=1")))
        .when(page % 5 == 3, F.concat(F.lit("https://k"), page, F.lit("@"), host, F.lit("/ingest")))
        .otherwise("")
    )
    return table(spark, sf, "pages").select("page_id", dsn.alias("dsn"))


def endpoints(spark, sf):
    dsn = F.col("dsn")
    return dsns(spark, sf).select(
        "page_id", fn.dsn_api_key(dsn).alias("api_key"), fn.dsn_ingestion_url(dsn).alias("ingestion_url"),
        *[fn.endpoint_for(dsn, signal).alias(signal) for signal in fn.ENDPOINTS],
    )


_URL_SQL = """CASE page_id % 5 WHEN 0 THEN 'https://' || host || '/api/v1/{0}'
  WHEN 1 THEN 'https://' || host || '/api/v1/{0}' WHEN 2 THEN 'http://' || host || ':8443/v1/{0}?x=1'
  WHEN 3 THEN 'https://' || host || '/ingest' END"""
ENDPOINTS_SQL = f"""
WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host FROM pages)
SELECT page_id, CASE page_id % 5 WHEN 1 THEN 'k+' || page_id WHEN 2 THEN 'k' || page_id WHEN 3 THEN 'k' || page_id END
       AS api_key, {_URL_SQL.format('events')} AS ingestion_url,
       {', '.join(f"{_URL_SQL.format(s)} AS {s}" for s in fn.ENDPOINTS)} FROM p"""


def configs(spark, sf):
    """Settings per nation: some without a DSN, some without a key, some in a quiet environment."""
    region, key = F.col("n_regionkey"), F.col("n_nationkey")
    dsn = F.when(region == 0, "").when(region == 1, "https://tracker.example.com/api/v1/events").otherwise(
        F.concat(F.lit("https://k"), key, F.lit("@tracker.example.com/api/v1/events"))
    )
    environment = F.when(key % 3 == 0, "production").when(key % 3 == 1, "staging").otherwise("development")
    return table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("project"), dsn.alias("dsn"), environment.alias("environment"),
        F.array(F.lit("production"), F.lit("staging")).alias("enabled_environments"),
    )


def enabled_records(spark, sf):
    customers = table(spark, sf, "customer").select(F.col("c_nationkey").alias("project"), "c_custkey")
    reporting = op.filter_enabled(customers, configs(spark, sf))
    joined = op.with_config(reporting, configs(spark, sf))
    return joined.groupBy("project", "environment").agg(F.count(F.lit(1)).alias("records"))


ENABLED_SQL = """
SELECT c_nationkey AS project, CASE n_nationkey % 3 WHEN 0 THEN 'production' ELSE 'staging' END AS environment,
       count(*) AS records
FROM customer JOIN nation ON c_nationkey = n_nationkey
WHERE n_regionkey NOT IN (0, 1) AND n_nationkey % 3 <> 2 GROUP BY ALL"""

TARGETS = ["Example.com", ".example.net"]
PATTERN = "^blog[.]"


def propagation(spark, sf):
    host = F.upper(F.regexp_extract("url", "^https?://([^/?#]+)", 1))
    targets = F.array(*[F.lit(t) for t in TARGETS])
    return table(spark, sf, "pages").select(
        "page_id", fn.should_propagate(host, targets).alias("listed"),
        fn.should_propagate(host, F.array(F.lit(TARGETS[0])), (PATTERN,)).alias("listed_or_matched"),
        fn.should_propagate(host).alias("everywhere"), fn.should_propagate(host, enabled=False).alias("nowhere"),
    )


PROPAGATION_SQL = """
WITH p AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS h FROM pages)
SELECT page_id, regexp_matches(h, '(^|[.])example[.](com|net)$') AS listed,
       regexp_matches(h, '(^|[.])example[.]com$') OR starts_with(h, 'blog.') AS listed_or_matched,
       true AS everywhere, false AS nowhere FROM p"""


def safe_urls(spark, sf):
    url = F.when(F.col("page_id") % 3 == 0, F.regexp_replace("url", "^https?", "javascript")).when(
        F.col("page_id") % 3 == 1, F.upper("url")
    ).otherwise(F.col("url"))
    return table(spark, sf, "pages").select("page_id", fn.safe_url(url).alias("url"))


SAFE_URLS_SQL = """
SELECT page_id, CASE page_id % 3 WHEN 0 THEN NULL WHEN 1 THEN upper(url) ELSE url END AS url FROM pages"""

QUERIES = {
    "delivery_outcomes": (delivery_outcomes, OUTCOMES_SQL),
    "retry_streaks": (retry_streaks, STREAKS_SQL),
    "pending_payloads": (pending_payloads, PENDING_SQL),
    "retained_payloads": (retained_payloads, RETAIN_SQL),
    "pending_oldest_first": (pending_oldest_first, OLDEST_SQL),
    "queue_admission": (queue_admission, QUEUE_SQL),
    "endpoints": (endpoints, ENDPOINTS_SQL),
    "enabled_records": (enabled_records, ENABLED_SQL),
    "propagation": (propagation, PROPAGATION_SQL),
    "safe_urls": (safe_urls, SAFE_URLS_SQL),
}
