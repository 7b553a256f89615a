"""Strict privacy."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetry_spark.functions import privacy as fn
from telemetry_spark.functions.timefmt import iso_seconds
from telemetry_spark.operators.events import strict_events, strict_failures
from telemetry_spark.operators.issues import issue_sketches, merged_issues
from telemetry_spark.operators.issues import issues as issues_of
from workload.performance import PAGE_PARTS_SQL, REDUCED_PATH_SQL
from workload.tables import ITEM_SQL, events, iso_sql, item, table

EMAIL_SQL = "[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\\.[a-zA-Z]{2,}"


def normalized_sql(text: str) -> str:
    """The rules in order. Numbers go by whole words, since this engine has no lookaround; the same holds for single
    quotes, whose rule only looks at the characters beside them."""
    step = f"regexp_replace({text}, '{EMAIL_SQL}', '<email>', 'g')"
    step = f"""regexp_replace({step}, '"[^"\\r\\n]*"', '<str>', 'g')"""
    step = f"regexp_replace({step}, '(^|[^A-Za-z0-9_])''[^''\\r\\n]*''', '\\1<str>', 'g')"
    step = f"regexp_replace({step}, '0x[0-9a-fA-F]{{4,}}', '0x', 'g')"
    words = f"regexp_extract_all({step}, '[A-Za-z0-9_]+|[^A-Za-z0-9_]+')"
    return (
        f"array_to_string(list_transform({words}, "
        "lambda w: CASE WHEN regexp_full_match(w, '[0-9]+') THEN '<n>' ELSE w END), '')"
    )


def message_fingerprints(spark, sf):
    """Every document and every turn of conversation as an error message."""
    documents = table(spark, sf, "documents").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("id"), F.col("text")
    )
    turns = table(spark, sf, "conversations").select(
        F.concat(F.lit("c"), F.col("conv_id"), F.lit("."), F.col("turn")).alias("id"), F.col("text")
    )
    messages = documents.unionByName(turns)
    return messages.select("id", fn.message_fingerprint(F.col("text")).alias("fingerprint"))


FINGERPRINT_SQL = f"""
WITH m AS (SELECT 'd' || doc_id AS id, text FROM documents
           UNION ALL SELECT 'c' || conv_id || '.' || turn, text FROM conversations)
SELECT id, left(sha256({normalized_sql('text')}), 32) AS fingerprint FROM m"""


def error_rows(spark, sf):
    """Errors whose messages differ only in their values."""
    rows = events(spark, sf)
    message = F.concat(
        F.lit("Could not "), F.col("event_type"), F.lit(" item "), item(rows), F.lit(' of "user '), F.col("user_id"),
        F.lit("\" for 'acct "), F.col("user_id"), F.lit("' at 0x7f"), F.lpad(F.hex("event_id"), 6, "0"),
        F.lit(" mail u"), F.col("user_id"), F.lit("@example.com"),
    )
    return rows.select(
        "event_id", F.concat(F.lit("Error"), F.floor(item(rows) / 10)).alias("exception_class"), message.alias("message"),
        F.col("ts").alias("occurred_at"), "user_id", "event_type", "props", "value",
    )


def issues(spark, sf):
    found = issues_of(error_rows(spark, sf).drop("event_type"))
    stamped = {c: iso_seconds(F.col(c)) for c in ("first_seen", "last_seen")}
    return found.withColumns(stamped)


ISSUES_SQL = f"""
SELECT 'Error' || CAST(floor({ITEM_SQL} / 10) AS BIGINT) AS exception_class,
  left(sha256('Could not ' || event_type || ' item <n> of <str> for <str> at 0x mail <email>'), 32)
    AS message_fingerprint,
  count(*) AS events, {iso_sql('min(ts)')} AS first_seen, {iso_sql('max(ts)')} AS last_seen,
  count(DISTINCT user_id) AS affected_users
FROM events GROUP BY 1, 2"""


def daily_issues(spark, sf):
    """Issues by day, merged from the sketches of their hours."""
    hours = issue_sketches(error_rows(spark, sf).drop("event_type"))
    return merged_issues(hours, "1 day").select(
        "exception_class", iso_seconds(F.col("period_started_at")).alias("period_started_at"), "events", "affected_users")


DAILY_ISSUES_SQL = f"""
SELECT 'Error' || CAST(floor({ITEM_SQL} / 10) AS BIGINT) AS exception_class, {iso_sql("date_trunc('day', ts)")} AS period_started_at,
  count(*) AS events, count(DISTINCT user_id) AS affected_users FROM events GROUP BY 1, event_type, 2"""


def strict_event_rows(spark, sf):
    """Events reduced twice over, the second time to show that nothing more happens."""
    rows = error_rows(spark, sf)
    raw = rows.select(
        "event_id", "exception_class", "message",
        F.concat(F.lit('{"k":'), item(rows), F.lit(',"who":"Jane","nested":{"a":1},"type":"'), F.col("event_type"),
                 F.lit('"}')).alias("context"),
        F.lit('{"email":"ada@example.com"}').alias("tags"),
        F.struct(
            F.when(F.col("value") >= 5, F.col("user_id").cast("string")).otherwise(" ").alias("id"),
            F.lit("ada@example.com").alias("email"),
        ).alias("user"),
        F.concat(F.lit("GET /users/"), F.col("user_id"), F.lit("/items?x=1")).alias("transaction_name"),
        F.lit("/users/1").alias("endpoint"), F.lit("SELECT 1").alias("sql_statement"),
    )
    reduced = strict_events(strict_events(raw, ["k", "type", "nested"]), ["k", "type", "nested"])
    return reduced.withColumn("user", F.col("user.id"))


STRICT_EVENTS_SQL = f"""
SELECT event_id, 'Error' || CAST(floor({ITEM_SQL} / 10) AS BIGINT) AS exception_class, '' AS message,
  left(sha256('Could not ' || event_type || ' item <n> of <str> for <str> at 0x mail <email>'), 32)
    AS message_fingerprint,
  '{{"k":' || {ITEM_SQL} || ',"type":"' || event_type || '"}}' AS context, CAST(NULL AS VARCHAR) AS tags,
  CASE WHEN value >= 5 THEN user_id::VARCHAR END AS "user", 'GET /users/:path' AS transaction_name
FROM events"""


def kept_fingerprints(spark, sf):
    """A well-formed fingerprint is kept in lower case; anything else is computed from the message."""
    priority = F.col("o_orderpriority")
    given = (
        F.when(priority == "1-URGENT", F.upper(F.md5(F.col("o_orderkey").cast("string"))))
        .when(priority == "2-HIGH", F.left(F.md5(F.col("o_orderkey").cast("string")), F.lit(31)))
        .when(priority == "3-MEDIUM", F.lit("x" * 32))
    )
    message = F.concat(F.lit("order "), F.col("o_orderkey"), F.lit(" is "), F.col("o_orderstatus"))
    return table(spark, sf, "orders").select("o_orderkey", fn.fingerprint_of(given, message).alias("fingerprint"))


KEPT_SQL = """
SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN md5(o_orderkey::VARCHAR)
  ELSE left(sha256('order <n> is ' || o_orderstatus), 32) END AS fingerprint FROM orders"""


def strict_pages(spark, sf):
    url = F.col("url")
    path = F.regexp_extract(url, "^https?://[^/]+(/.*)$", 1)
    template = F.when(F.col("page_id") % 2 == 0, F.concat(path, F.lit("/:id"))).otherwise(path)
    return table(spark, sf, "pages").select(
        "page_id", fn.strict_page_url(url).alias("page_url"), fn.strict_path(path).alias("path"),
        fn.host_of(url).alias("host"), fn.host_of(path).alias("path_host"),
        fn.strict_transaction(F.concat(F.lit("GET "), path)).alias("transaction_name"),
        fn.strict_path(F.regexp_replace(template, "[?#].*$", "/{slug}")).alias("template"),
    )


PAGES_SQL = f"""
SELECT page_id, regexp_extract(url, '^(https?://[^/?#:]+)', 1) || {REDUCED_PATH_SQL} AS page_url,
  {REDUCED_PATH_SQL} AS path, regexp_extract(url, '^https?://([^/?#:]+)', 1) AS host, CAST(NULL AS VARCHAR) AS path_host,
  'GET ' || {REDUCED_PATH_SQL} AS transaction_name,
  CASE WHEN regexp_matches(t, '[?#]') THEN regexp_replace(t, '[?#].*$', '/{{slug}}')
       WHEN page_id % 2 = 0 THEN t ELSE {REDUCED_PATH_SQL} END AS template
FROM (SELECT *, regexp_extract(url, '^https?://[^/]+(/.*)$', 1) || CASE WHEN page_id % 2 = 0 THEN '/:id' ELSE '' END
        AS t FROM ({PAGE_PARTS_SQL}))"""


def route_parameters(spark, sf):
    size = F.col("p_size")
    segment = (
        F.when(size % 7 == 0, F.concat(F.lit(":"), "p_name"))
        .when(size % 7 == 1, F.concat(F.lit("{"), "p_name", F.lit("}")))
        .when(size % 7 == 2, F.concat(F.lit("<"), "p_name", F.lit(">")))
        .when(size % 7 == 3, F.concat(F.lit("["), "p_name", F.lit("\n]")))
        .when(size % 7 == 4, F.concat(F.lit("*"), "p_name"))
        .when(size % 7 == 5, F.lit("{}"))
        .otherwise(F.col("p_name"))
    )
    return table(spark, sf, "part").select("p_partkey", fn.is_route_parameter(segment).alias("is_parameter"))


ROUTE_SQL = "SELECT p_partkey, p_size % 7 IN (0, 1, 2, 4) AS is_parameter FROM part"


def failed_jobs(spark, sf):
    rows = events(spark, sf)
    failures = rows.select(
        "event_id", F.concat(F.lit("Job"), "event_type").alias("error_class"), F.lit("card declined").alias("error_message"),
        F.concat(F.lit("/jobs/"), "user_id", F.lit("/charge")).alias("transaction_name"),
    )
    return strict_failures(failures)


FAILED_JOBS_SQL = """
SELECT event_id, 'Job' || event_type AS error_class, '/jobs/:path' AS transaction_name FROM events"""


def user_ids(spark, sf):
    kind = F.col("o_orderpriority")
    user = (
        F.when(kind == "1-URGENT", F.concat(F.lit('{"id":'), "o_custkey", F.lit(',"email":"a@b.co"}')))
        .when(kind == "2-HIGH", F.concat(F.lit('{"id":"u'), "o_custkey", F.lit('"}')))
        .when(kind == "3-MEDIUM", F.when(F.col("o_custkey") % 2 == 0, '{"id":true}').otherwise('{"id":false}'))
        .when(kind == "5-LOW", F.lit('{"id":"  ","email":"a@b.co"}'))
        .otherwise('{"email":"a@b.co"}')
    )
    return table(spark, sf, "orders").select("o_orderkey", fn.user_id_from_json(user).alias("user_id"))


USER_IDS_SQL = """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN o_custkey::VARCHAR WHEN '2-HIGH' THEN 'u' || o_custkey
  WHEN '3-MEDIUM' THEN CASE WHEN o_custkey % 2 = 0 THEN 'true' END END AS user_id FROM orders"""

QUERIES = {
    "message_fingerprints": (message_fingerprints, FINGERPRINT_SQL),
    "issues": (issues, ISSUES_SQL),
    "daily_issues": (daily_issues, DAILY_ISSUES_SQL),
    "strict_events": (strict_event_rows, STRICT_EVENTS_SQL),
    "kept_fingerprints": (kept_fingerprints, KEPT_SQL),
    "strict_pages": (strict_pages, PAGES_SQL),
    "route_parameters": (route_parameters, ROUTE_SQL),
    "failed_jobs": (failed_jobs, FAILED_JOBS_SQL),
    "user_ids": (user_ids, USER_IDS_SQL),
}
