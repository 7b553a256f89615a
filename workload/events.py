"""Error events, trails, users and changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetry_spark.config import Config
from telemetry_spark.functions.frames import parse_frames
from telemetry_spark.functions.timefmt import iso_millis, iso_seconds
from telemetry_spark.operators import breadcrumbs as trail
from telemetry_spark.operators import changes as change
from telemetry_spark.operators.events import build_events
from telemetry_spark.plans.session import fresh_dir
from telemetry_spark.schemas import BREADCRUMB, ERROR_EVENT
from telemetry_spark.sources.envelopes import change_envelopes
from telemetry_spark.sources.reports import complete_signal_reports, read_trails, signal_events, write_events, write_trails
from workload.tables import ITEM_SQL, events, iso_sql, item, table

CLEARS = "event_type = 'purchase' and value > 30"


def crumbs(spark, sf):
    """Everything a user does but fail is a breadcrumb; a big purchase clears the trail."""
    rows = events(spark, sf)
    return rows.where("event_type <> 'error'").select(
        "user_id", F.col("ts").alias("at"), F.col("event_id").alias("seq"), F.expr(CLEARS).alias("is_clear"), "event_id",
    )


def errors(spark, sf):
    return events(spark, sf).where("event_type = 'error'").select(
        "user_id", F.col("ts").alias("at"), F.col("event_id").alias("seq"), "event_id"
    )


def error_trails(spark, sf):
    found = trail.attach_breadcrumbs(errors(spark, sf), crumbs(spark, sf), ["user_id"], F.col("event_id"), slice_seconds=86400)
    return found.select(
        "event_id", F.size("breadcrumbs").alias("crumbs"), F.array_join("breadcrumbs", ",").alias("trail")
    )


TRAILS_SQL = f"""
WITH r AS (SELECT *, event_type = 'error' AS is_error, {CLEARS} AS is_clear FROM events),
e AS (SELECT *, sum(CASE WHEN is_clear THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS epoch FROM r),
p AS (SELECT x.event_id, c.event_id AS crumb, row_number() OVER (PARTITION BY x.event_id ORDER BY c.ts DESC, c.event_id DESC) AS n
      FROM e x JOIN e c ON c.user_id = x.user_id AND c.epoch = x.epoch AND NOT c.is_error AND NOT c.is_clear
        AND (c.ts, c.event_id) < (x.ts, x.event_id) WHERE x.is_error),
t AS (SELECT event_id, count(*) AS crumbs, string_agg(crumb, ',' ORDER BY n DESC) AS trail FROM p WHERE n <= 30 GROUP BY 1)
SELECT e.event_id, CAST(coalesce(crumbs, 0) AS INTEGER) AS crumbs, coalesce(trail, '') AS trail
FROM e LEFT JOIN t USING (event_id) WHERE is_error"""


def long_trails(spark, sf):
    """Trails no clear cuts short, so that the cap of 30 is met."""
    never = crumbs(spark, sf).withColumn("is_clear", F.lit(False))
    found = trail.attach_breadcrumbs(errors(spark, sf), never, ["user_id"], F.col("event_id"), slice_seconds=86400)
    return found.select(
        "event_id", F.size("breadcrumbs").alias("crumbs"), F.array_join("breadcrumbs", ",").alias("trail")
    )


LONG_SQL = """
WITH p AS (SELECT x.event_id, c.event_id AS crumb, row_number() OVER (PARTITION BY x.event_id ORDER BY c.ts DESC, c.event_id DESC) AS n
           FROM events x JOIN events c ON c.user_id = x.user_id AND c.event_type <> 'error'
             AND (c.ts, c.event_id) < (x.ts, x.event_id) WHERE x.event_type = 'error'),
t AS (SELECT event_id, count(*) AS crumbs, string_agg(crumb, ',' ORDER BY n DESC) AS trail FROM p WHERE n <= 30 GROUP BY 1)
SELECT e.event_id, CAST(coalesce(crumbs, 0) AS INTEGER) AS crumbs, coalesce(trail, '') AS trail
FROM events e LEFT JOIN t USING (event_id) WHERE e.event_type = 'error'"""


def last_breadcrumbs(spark, sf):
    newest = [F.col("at").desc(), F.col("seq").desc()]
    return trail.last_n(crumbs(spark, sf), ["user_id"], newest, 30).select("user_id", "event_id")


LAST_SQL = """
SELECT user_id, event_id FROM events WHERE event_type <> 'error'
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) <= 30"""


def trail_epochs(spark, sf):
    numbered = trail.epochs(crumbs(spark, sf), ["user_id"], [F.col("at"), F.col("seq")], F.col("at"), 86400)
    return numbered.select("event_id", "epoch")


EPOCHS_SQL = f"""
SELECT event_id, CAST(sum(CASE WHEN {CLEARS} THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT)
  AS epoch FROM events WHERE event_type <> 'error'"""


def resolved_users(spark, sf):
    """Errors under the user last set on their device: a signup sets one, a purchase clears it."""
    rows = events(spark, sf)
    signed = F.when(F.col("event_type") == "signup", item(rows).cast("string"))
    user_changes = rows.where("event_type in ('signup', 'purchase')").select(
        "user_id", F.col("ts").alias("at"), F.col("event_id").alias("seq"), signed.alias("user")
    )
    failing = rows.where("event_type = 'error'").select(
        "user_id", "event_id", F.col("ts").alias("at"), F.when(F.col("value") > 40, "explicit").alias("user")
    )
    return trail.resolve_user(failing, user_changes, ["user_id"]).drop("at")


USERS_SQL = f"""
WITH u AS (SELECT user_id, ts, CASE WHEN event_type = 'signup' THEN {ITEM_SQL}::VARCHAR END AS current FROM events
           WHERE event_type IN ('signup', 'purchase')),
e AS (SELECT * FROM events WHERE event_type = 'error')
SELECT e.user_id, e.event_id, CASE WHEN e.value > 40 THEN 'explicit' ELSE u.current END AS "user"
FROM e ASOF LEFT JOIN u ON e.user_id = u.user_id AND e.ts >= u.ts"""


def previous_trails(spark, sf):
    """Crashes with the trail last written on their device before them, a second's slack allowed."""
    rows = events(spark, sf)
    crashes = rows.where("event_type = 'error'").select("user_id", "event_id", F.col("ts").alias("crashed_at"))
    entry = F.struct(
        F.lit("custom").alias("category"), F.concat(F.lit("item "), item(rows)).alias("message"), F.lit("info").alias("level"),
        F.col("ts").alias("timestamp"), F.lit("{}").alias("data"),
    )
    trails = rows.where("event_type = 'view'").select(
        "user_id", F.col("ts").alias("modified_at"), F.array(entry).alias("breadcrumbs")
    )
    found = trail.attach_previous_trail(crashes, trails, ["user_id"])
    return found.select("event_id", F.col("breadcrumbs")[0]["message"].alias("last_message"))


PREVIOUS_SQL = f"""
WITH t AS (SELECT user_id, ts, 'item ' || {ITEM_SQL} AS last_message FROM events WHERE event_type = 'view'),
e AS (SELECT user_id, event_id, ts + INTERVAL 1 SECOND AS limit_at FROM events WHERE event_type = 'error')
SELECT event_id, last_message FROM e ASOF LEFT JOIN t ON e.user_id = t.user_id AND e.limit_at >= t.ts"""

REPORTING = Config(
    dsn="https://key@tracker.example.com/api/v1/events", release="1.4.0", server_name="web-1", executable="Shop",
    capture_sql_statement=True,
)


def raw_errors(spark, sf):
    """Exceptions with everything an error can carry."""
    rows = events(spark, sf).where("event_type = 'error'")
    user = F.col("user_id").cast("string")
    crumb = F.struct(
        F.lit("payment").alias("category"), F.concat(F.lit("mailed u"), user, F.lit("@example.com")).alias("message"),
        F.lit("info").alias("level"), F.col("ts").alias("timestamp"), F.lit('{"password":"x","n":1}').alias("data"),
    )
    return rows.select(
        "event_id", F.when(item(rows) % 2 == 0, "PaymentError").alias("exception_class"),
        F.concat(F.lit("failed for u"), user, F.lit("@example.com")).alias("message"), F.col("ts").alias("occurred_at"),
        F.array(
            F.concat(F.lit("0   Shop    0x0000000100abcd12 -[Cart pay:"), user, F.lit("] + 82")), F.lit("not a frame"),
            F.lit("1   UIKitCore 0x00000001 main + 4"),
        ).alias("stack"),
        F.concat(F.lit('{"order":'), item(rows), F.lit(',"api_key":"k"}')).alias("context"),
        F.create_map(F.lit("sql"), F.concat(F.lit("EXEC dbo.pay @id = "), user)).alias("info"),
        F.struct(user.alias("id"), F.concat(F.lit("u"), user, F.lit("@example.com")).alias("email")).alias("user"),
        F.array(crumb).alias("breadcrumbs"), F.lpad(F.lower(F.hex("event_id")), 32, "0").alias("trace_id"),
    )


def built_events(spark, sf):
    built = build_events(raw_errors(spark, sf), REPORTING)
    return built.select(
        "event_id", "exception_class", "message", iso_seconds(F.col("occurred_at")).alias("occurred_at"), "environment",
        "release", "server_name", "context", "tags", "sdk_name", "sql_statement", "trace_id",
        F.to_json("backtrace", {"ignoreNullFields": "false"}).alias("backtrace"), F.col("user.email").alias("email"),
        F.array_join("sql_objects.procedures", ",").alias("procedures"),
        F.concat_ws("|", F.col("breadcrumbs")[0]["message"], F.col("breadcrumbs")[0]["data"]).alias("crumb"),
    )


BUILT_SQL = f"""
SELECT event_id, CASE WHEN {ITEM_SQL} % 2 = 0 THEN 'PaymentError' ELSE 'NSException' END AS exception_class,
  'failed for [EMAIL FILTERED]' AS message, {iso_sql('ts')} AS occurred_at, 'production' AS environment,
  '1.4.0' AS release, 'web-1' AS server_name, '{{"order":' || {ITEM_SQL} || ',"api_key":"[FILTERED]"}}' AS context,
  '{{}}' AS tags, 'objc' AS sdk_name, 'EXEC dbo.pay @id = ?' AS sql_statement,
  lpad(lower(to_hex(event_id)), 32, '0') AS trace_id,
  '[{{"file":"Shop","line":null,"method":"-[Cart pay:' || user_id || ']","in_app":true}},'
    || '{{"file":"UIKitCore","line":null,"method":"main","in_app":false}}]' AS backtrace,
  'u' || user_id || '@example.com' AS email, 'dbo.pay' AS procedures,
  'mailed [EMAIL FILTERED]|{{"password":"[FILTERED]","n":1}}' AS crumb
FROM events WHERE event_type = 'error'"""


def written_events(spark, sf):
    """Events written as JSON documents and read back under the event schema."""
    path = fresh_dir(spark, "written-events")
    write_events(build_events(raw_errors(spark, sf), REPORTING).drop("event_id"), path)
    back = spark.read.schema(ERROR_EVENT).json(path)
    return back.select(
        "trace_id", "exception_class", "message", iso_seconds(F.col("occurred_at")).alias("occurred_at"), "context",
        "release", F.size("backtrace").alias("frames"), F.col("user.id").alias("user"),
    )


WRITTEN_SQL = f"""
SELECT lpad(lower(to_hex(event_id)), 32, '0') AS trace_id,
  CASE WHEN {ITEM_SQL} % 2 = 0 THEN 'PaymentError' ELSE 'NSException' END AS exception_class,
  'failed for [EMAIL FILTERED]' AS message, {iso_sql('ts')} AS occurred_at,
  '{{"api_key":"[FILTERED]","order":' || {ITEM_SQL} || '}}' AS context, '1.4.0' AS release, 2 AS frames,
  user_id::VARCHAR AS "user" FROM events WHERE event_type = 'error'"""


def signal_reports(spark, sf):
    """Raw signal reports of every error, completed and scrubbed."""
    rows = events(spark, sf).where("event_type = 'error'")
    text = F.concat(
        F.when(item(rows) % 2 == 0, "Abort trap").otherwise("Segmentation fault: 11"), F.lit("\n0   Shop 0x1 main + "),
        F.col("user_id"), F.lit("\n\n1   u"), F.col("user_id"), F.lit("@example.com\n"),
    )
    raw = rows.select("event_id", F.col("ts").alias("crashed_at"), text.alias("value"))
    now = F.lit("2024-02-01 00:00:00").cast("timestamp")
    done = complete_signal_reports(signal_events(raw), REPORTING, now)
    return done.select(
        "event_id", "exception_class", "message", iso_seconds(F.col("occurred_at")).alias("occurred_at"), "release",
        F.array_join(F.transform("backtrace", lambda f: f["method"]), "|").alias("methods"), "context",
    )


SIGNALS_SQL = f"""
WITH s AS (SELECT *, CASE WHEN {ITEM_SQL} % 2 = 0 THEN 'Abort trap' ELSE 'Segmentation fault: 11' END AS name
           FROM events WHERE event_type = 'error')
SELECT event_id, 'Signal: ' || name AS exception_class, 'Uncaught fatal signal: ' || name AS message,
  '2024-02-01T00:00:00Z' AS occurred_at, '1.4.0' AS release,
  '0   Shop 0x1 main + ' || user_id || '|1   [EMAIL FILTERED]' AS methods, '{{}}' AS context FROM s"""


def completed_reports(spark, sf):
    """Raw signal reports with what their handler could not know: the user current at upload and the trail the crashed run left."""
    rows = events(spark, sf)
    signed = F.when(F.col("event_type") == "signup", item(rows).cast("string"))
    users = rows.where("event_type in ('signup', 'purchase')").select(
        "user_id", F.col("ts").alias("at"), F.col("event_id").alias("seq"), F.when(signed.isNotNull(), F.struct(signed.alias("id"))).alias("user")
    )
    entry = F.struct(F.concat(F.lit("item "), item(rows)).alias("message"))
    trails = rows.where("event_type = 'view'").select("user_id", F.col("ts").alias("modified_at"), F.array(entry).alias("breadcrumbs"))
    raw = rows.where("event_type = 'error'").select(
        "event_id", "user_id", F.col("ts").alias("crashed_at"), F.concat(F.lit("Abort trap\n0   Shop 0x1 main + "), "event_id").alias("value")
    )
    uploaded = F.col("crashed_at") + F.make_dt_interval(hours=F.lit(1))
    done = complete_signal_reports(signal_events(raw), REPORTING, uploaded, users, trails, ("user_id",))
    return done.select(
        "event_id", "exception_class", F.col("user.id").alias("user"), F.col("breadcrumbs")[0]["message"].alias("last_message"),
        iso_seconds(F.col("occurred_at")).alias("occurred_at"),
    )


COMPLETED_SQL = f"""
WITH u AS (SELECT user_id, ts, CASE WHEN event_type = 'signup' THEN {ITEM_SQL}::VARCHAR END AS current FROM events
           WHERE event_type IN ('signup', 'purchase')),
t AS (SELECT user_id, ts, 'item ' || {ITEM_SQL} AS last_message FROM events WHERE event_type = 'view'),
e AS (SELECT user_id, event_id, ts + INTERVAL 1 HOUR AS uploaded, ts + INTERVAL 1 SECOND AS limit_at FROM events WHERE event_type = 'error'),
s AS (SELECT e.*, u.current AS "user" FROM e ASOF LEFT JOIN u ON e.user_id = u.user_id AND e.uploaded >= u.ts)
SELECT event_id, 'Signal: Abort trap' AS exception_class, "user", last_message, {iso_sql('uploaded')} AS occurred_at
FROM s ASOF LEFT JOIN t ON s.user_id = t.user_id AND s.limit_at >= t.ts"""


def parsed_frames(spark, sf):
    line = F.concat(
        F.lit(" "), F.col("l_linenumber"), F.when(F.col("l_returnflag") == "R", "  Shop  0x").otherwise("  libz.dylib  0x"),
        F.lpad(F.lower(F.hex("l_partkey")), 8, "0"), F.lit(" -[Part load:"), F.col("l_suppkey"), F.lit("]"),
        F.when(F.col("l_linestatus") == "F", " + 12 ").otherwise(" no offset"),
    )
    frames = parse_frames(F.array(line), F.lit("Shop"))
    seed = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, sf, "lineitem").select(seed.alias("id"), F.get(frames, F.lit(0)).alias("f")).select(
        "id", F.col("f.file").alias("file"), F.col("f.method").alias("method"), F.col("f.in_app").alias("in_app")
    )


FRAMES_SQL = """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id,
  CASE WHEN l_linestatus = 'F' THEN CASE WHEN l_returnflag = 'R' THEN 'Shop' ELSE 'libz.dylib' END END AS file,
  CASE WHEN l_linestatus = 'F' THEN '-[Part load:' || l_suppkey || ']' END AS method,
  CASE WHEN l_linestatus = 'F' THEN l_returnflag = 'R' END AS in_app FROM lineitem"""


def long_stacks(spark, sf):
    """Stacks around the limit of 500 frames, a line in seven of them no frame."""
    depth = 380 + F.col("s_suppkey") * 7 % 400
    line = lambda i: F.concat(i.cast("string"), F.when(i % 7 == 0, " no frame ").otherwise(" Shop 0x1f "), F.lit("f"), i.cast("string"), F.lit(" + 3"))
    frames = parse_frames(F.transform(F.sequence(F.lit(1).cast("bigint"), depth), line), F.lit("Shop"))
    stacks = table(spark, sf, "supplier").select("s_suppkey", frames.alias("frames"))
    return stacks.select("s_suppkey", F.size("frames").alias("frames"), F.element_at("frames", -1)["method"].alias("last"))


STACKS_SQL = """
SELECT s_suppkey, CAST(least(500, d - d // 7) AS INTEGER) AS frames,
       'f' || CASE WHEN d - d // 7 > 500 THEN 583 WHEN d % 7 = 0 THEN d - 1 ELSE d END AS last
FROM (SELECT s_suppkey, 380 + s_suppkey * 7 % 400 AS d FROM supplier)"""


def reread_trails(spark, sf):
    """Trails written the way a run leaves them, and read back: texts and data scrubbed, empty trails left out."""
    rows = events(spark, sf).where("event_type in ('view', 'click')")
    entry = F.struct(
        F.lit("custom").alias("category"), F.concat(F.lit("mail u"), F.col("user_id"), F.lit("@x.org")).alias("message"),
        F.lit("info").alias("level"), F.col("ts").alias("timestamp"),
        F.concat(F.lit('{"pwd": 1, "k": '), item(rows), F.lit("}")).alias("data"),
    )
    crumbs = F.when(F.col("event_type") == "view", F.array(entry)).otherwise(F.array().cast(f"array<{BREADCRUMB}>"))
    trails = rows.select(F.col("event_id").cast("string").alias("device"), F.col("ts").alias("modified_at"), crumbs.alias("breadcrumbs"))
    path = fresh_dir(spark, "trails")
    write_trails(trails, path)
    crumb = F.col("breadcrumbs")[0]
    return read_trails(spark, path).select("device", crumb["message"].alias("message"), crumb["data"].alias("data"))


REREAD_SQL = f"""
SELECT event_id::VARCHAR AS device, 'mail [EMAIL FILTERED]' AS message, '{{"pwd":"[FILTERED]","k":' || {ITEM_SQL} || '}}' AS data
FROM events WHERE event_type = 'view'"""


def raw_changes(spark, sf):
    """A change per document: whole texts as titles."""
    key = F.col("doc_id")
    text = F.when(key % 11 == 0, " \n\t ").otherwise(F.concat(F.lit(" \n"), "text"))
    return table(spark, sf, "documents").select(
        F.when(key % 3 == 0, "feature_flag").when(key % 3 == 1, "config").otherwise("flag").alias("kind"),
        text.alias("title"),
        F.when(key % 2 == 0, "qa").alias("environment"),
        F.timestamp_seconds(F.lit(1704067200) + key * 60).alias("occurred_at"),
        F.when(key % 2 == 0, F.concat(F.lit('{"n":'), key, F.lit("}"))).otherwise("[1").alias("details"),
        F.when(key % 5 == 0, "").otherwise(F.col("source")).alias("service"), F.lit(None).cast("string").alias("actor"),
        F.when(key % 7 == 0, "javascript:alert(1)").otherwise(F.concat(F.lit("https://x.test/"), key)).alias("url"),
        F.when(key % 4 > 0, F.concat("source", F.lit("-"), "lang")).alias("id"),
    )


def change_records(spark, sf):
    built = change.enabled_changes(raw_changes(spark, sf), REPORTING)
    return built.withColumns({"title": F.md5("title"), "occurred_at": iso_millis(F.col("occurred_at"))})


CHANGES_SQL = """
SELECT CASE doc_id % 3 WHEN 0 THEN 'feature_flag' WHEN 1 THEN 'config' ELSE 'other' END AS kind,
  md5(left(regexp_replace(text, '^[\\s\\x{a0}]+|[\\s\\x{a0}]+$', '', 'g'), 200)) AS title,
  CASE WHEN doc_id % 2 = 0 THEN 'qa' ELSE 'production' END AS environment,
  strftime(make_timestamp((1704067200 + doc_id * 60) * 1000000), '%Y-%m-%dT%H:%M:%S.%gZ') AS occurred_at,
  CASE WHEN doc_id % 2 = 0 THEN '{"n":' || doc_id || '}' END AS details,
  CASE WHEN doc_id % 5 > 0 THEN source END AS service, CAST(NULL AS VARCHAR) AS actor,
  CASE WHEN doc_id % 7 > 0 THEN 'https://x.test/' || doc_id END AS url,
  CASE WHEN doc_id % 4 > 0 THEN source || '-' || lang END AS id
FROM documents WHERE doc_id % 11 <> 0"""


def deduped_changes(spark, sf):
    kept = change.dedupe_changes(change.changes(raw_changes(spark, sf)))
    return kept.select("id", "kind", iso_millis(F.col("occurred_at")).alias("occurred_at"))


DEDUPED_SQL = f"""
WITH c AS ({CHANGES_SQL})
SELECT id, kind, occurred_at FROM (SELECT * FROM c WHERE id IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY occurred_at) = 1)
UNION ALL SELECT id, kind, occurred_at FROM c WHERE id IS NULL"""


def change_bodies(spark, sf):
    return change_envelopes(change.changes(raw_changes(spark, sf))).select("body")


BODIES_SQL = """
SELECT '{"kind":"' || CASE doc_id % 3 WHEN 0 THEN 'feature_flag' WHEN 1 THEN 'config' ELSE 'other' END
  || '","title":' || to_json(left(regexp_replace(text, '^[\\s\\x{a0}]+|[\\s\\x{a0}]+$', '', 'g'), 200))
  || ',"environment":"' || CASE WHEN doc_id % 2 = 0 THEN 'qa' ELSE 'production' END
  || '","occurred_at":"' || strftime(make_timestamp((1704067200 + doc_id * 60) * 1000000), '%Y-%m-%dT%H:%M:%S.%gZ')
  || '"' || CASE WHEN doc_id % 2 = 0 THEN ',"details":{"n":' || doc_id || '}' ELSE '' END
  || CASE WHEN doc_id % 5 > 0 THEN ',"service":"' || source || '"' ELSE '' END
  || CASE WHEN doc_id % 7 > 0 THEN ',"url":"https://x.test/' || doc_id || '"' ELSE '' END
  || CASE WHEN doc_id % 4 > 0 THEN ',"id":"' || source || '-' || lang || '"' ELSE '' END || '}' AS body
FROM documents WHERE doc_id % 11 <> 0"""


def timeline(spark, sf):
    """Signups of big values as changes, errors around them."""
    rows = events(spark, sf)
    environment = F.when(F.col("user_id") % 3 == 0, "staging").otherwise("production")
    failing = rows.where("event_type = 'error'").select("event_id", environment.alias("environment"), F.col("ts").alias("occurred_at"))
    records = rows.where("event_type = 'signup' and value > 30").select(
        F.col("event_id").alias("change_id"), environment.alias("environment"), F.col("ts").alias("occurred_at"),
        F.lit("config").alias("kind"), F.concat(F.lit("item "), item(rows)).alias("title"),
    )
    return failing, records


def errors_around_changes(spark, sf):
    failing, records = timeline(spark, sf)
    return change.errors_around_changes(failing, records, 7200, 3600)


TIMELINE_SQL = f"""
e AS (SELECT event_id, ts, CASE WHEN user_id % 3 = 0 THEN 'staging' ELSE 'production' END AS environment FROM events
      WHERE event_type = 'error'),
c AS (SELECT event_id AS change_id, ts, CASE WHEN user_id % 3 = 0 THEN 'staging' ELSE 'production' END AS environment,
             'item ' || {ITEM_SQL} AS title FROM events WHERE event_type = 'signup' AND value > 30)"""
AROUND_SQL = f"""
WITH {TIMELINE_SQL}
SELECT c.environment, c.change_id::VARCHAR AS change_id,
  count(*) FILTER (e.ts >= c.ts - INTERVAL 2 HOUR AND e.ts < c.ts) AS errors_before,
  count(*) FILTER (e.ts >= c.ts AND e.ts <= c.ts + INTERVAL 1 HOUR) AS errors_after
FROM c LEFT JOIN e ON e.environment = c.environment GROUP BY ALL"""


def latest_changes(spark, sf):
    failing, records = timeline(spark, sf)
    found = change.latest_change(failing, records, 7200)
    return found.select("event_id", F.col("change.change_id").alias("change_id"), F.col("change.title").alias("title"))


LATEST_SQL = f"""
WITH {TIMELINE_SQL}
SELECT event_id, CASE WHEN e.ts - c.ts <= INTERVAL 2 HOUR THEN change_id END AS change_id,
       CASE WHEN e.ts - c.ts <= INTERVAL 2 HOUR THEN title END AS title
FROM e ASOF LEFT JOIN c ON e.environment = c.environment AND e.ts >= c.ts"""

QUERIES = {
    "error_trails": (error_trails, TRAILS_SQL),
    "long_trails": (long_trails, LONG_SQL),
    "last_breadcrumbs": (last_breadcrumbs, LAST_SQL),
    "trail_epochs": (trail_epochs, EPOCHS_SQL),
    "resolved_users": (resolved_users, USERS_SQL),
    "previous_trails": (previous_trails, PREVIOUS_SQL),
    "built_events": (built_events, BUILT_SQL),
    "written_events": (written_events, WRITTEN_SQL),
    "completed_reports": (completed_reports, COMPLETED_SQL),
    "signal_reports": (signal_reports, SIGNALS_SQL),
    "parsed_frames": (parsed_frames, FRAMES_SQL),
    "long_stacks": (long_stacks, STACKS_SQL),
    "reread_trails": (reread_trails, REREAD_SQL),
    "change_records": (change_records, CHANGES_SQL),
    "deduped_changes": (deduped_changes, DEDUPED_SQL),
    "change_bodies": (change_bodies, BODIES_SQL),
    "errors_around_changes": (errors_around_changes, AROUND_SQL),
    "latest_changes": (latest_changes, LATEST_SQL),
}
