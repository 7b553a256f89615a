"""Error events, trails, and reports on disk."""

import json
import os

from helpers import values
from pyspark.sql import functions as F

from telemetry_spark.config import Config
from telemetry_spark.functions import frames, pii, privacy
from telemetry_spark.operators import breadcrumbs, events
from telemetry_spark.operators.issues import issues, sql_object_counts
from telemetry_spark.sources import envelopes, reports

DSN = "https://key@tracker.example.com/api/v1/events"
CRUMB = "array<struct<category:string,message:string,level:string,timestamp:timestamp,data:string>>"
ERROR = (
    "exception_class string, message string, context string, sql string, trace_id string, "
    f"user struct<id:string,email:string>, breadcrumbs {CRUMB}, stack array<string>, transaction_name string"
)


def error(spark, **given):
    fields = {f: None for f in ("exception_class", "message", "context", "sql", "trace_id", "user", "breadcrumbs", "stack",
                                "transaction_name")}
    return spark.createDataFrame([tuple((fields | given).values())], ERROR)


def test_an_event_is_filled_in_scrubbed_and_keeps_its_user(spark):
    crumbs = [("custom", "emailed alice@example.com", "info", None, '{"password":"hunter2"}')]
    df = error(
        spark, message="failed for user@example.com", context='{"user":{"email":"ada@example.com","password":"hunter2"}}',
        user=("42", "ada@example.com"), breadcrumbs=crumbs, sql="EXEC dbo.sp_refund_order @order_id = 8814, @note = 'a@b.co'",
        stack=["12  MyApp    0x0000000100abcd12 -[MyClass myMethod] + 82", "?", "1 UIKit 0x1f main + 3"],
    )
    cfg = Config(dsn=DSN, release="abc123", server_name="web-1", executable="MyApp")
    got = events.build_events(df, cfg).first()
    assert (got.exception_class, got.message, got.environment, got.release, got.server_name, got.sdk_name) == (
        "NSException", "failed for [EMAIL FILTERED]", "production", "abc123", "web-1", "objc"
    )
    assert json.loads(got.context) == {"user": {"email": "[EMAIL FILTERED]", "password": "[FILTERED]"}}
    assert got.user.email == "ada@example.com" and got.tags == "{}"
    assert got.breadcrumbs[0].message == "emailed [EMAIL FILTERED]" and got.breadcrumbs[0].data == '{"password":"[FILTERED]"}'
    assert got.sql_objects.procedures == ["dbo.sp_refund_order"] and "sql_statement" not in got.asDict()
    assert [(f.file, f.line, f.method, f.in_app) for f in got.backtrace] == [
        ("MyApp", None, "-[MyClass myMethod]", True), ("UIKit", None, "main", False)
    ]
    both = events.build_events(df, Config(dsn=DSN, capture_sql_statement=True)).first()
    assert both.sql_statement == "EXEC dbo.sp_refund_order @order_id = ?, @note = ?"
    neither = events.build_events(df, Config(dsn=DSN, capture_sql_objects=False))
    assert "sql_objects" not in neither.columns
    assert events.build_events(df, Config(dsn=DSN, environment="development")).isEmpty()


def test_scrubbing_can_be_off(spark):
    df = error(spark, message="failed for user@example.com", context='{"email":"ada@example.com"}', breadcrumbs=[])
    got = events.build_events(df, Config(dsn=DSN, scrub=False)).first()
    assert got.message == "failed for user@example.com" and got.context == '{"email":"ada@example.com"}'
    assert got.breadcrumbs is None


def test_a_strict_event_carries_no_free_text(spark):
    df = error(
        spark, message="Couldn't find Invoice with id=8821", user=("42", "ada@example.com"),
        context='{"error_code":"E42","feature":7,"nested":{"a":"b"},"patient":"Jane Doe","on":true}',
        sql="SELECT * FROM patients WHERE name = 'Jane'", trace_id="0af7651916cd43dd8448eb211c80319c",
        transaction_name="/patients/42",
    ).withColumn("occurred_at", F.lit("2024-01-15 10:29:58").cast("timestamp"))
    allowed = ("error_code", "feature", "nested")
    cfg = Config(dsn=DSN, strict_privacy=True, privacy_allowed_fields=allowed, capture_sql_statement=True)
    strict = events.build_events(df, cfg)
    got = strict.first()
    assert got.message == "" and got.message_fingerprint == "b6959809369b97323c7852eaeb67d4ef"
    assert not {"breadcrumbs", "endpoint", "sql_statement"} & set(strict.columns)
    assert json.loads(got.context) == {"error_code": "E42", "feature": 7} and got.tags is None
    assert got.user.asDict() == {"id": "42"} and got.sql_objects.relations == ["patients"]
    assert got.transaction_name == "/patients/:path" and got.trace_id == "0af7651916cd43dd8448eb211c80319c"
    assert events.strict_events(strict, allowed).first() == got
    scrubbed = events.build_events(error(spark, message="failed for user@example.com"), cfg).first()
    masked = spark.range(1).select(privacy.message_fingerprint(F.lit("failed for [EMAIL FILTERED]"))).first()[0]
    assert scrubbed.message_fingerprint == masked


def test_strict_frames_users_and_failures(spark):
    df = spark.createDataFrame(
        [("boom", [("app.rb", 3, "secret", ["a"])], (True,))],
        "message string, backtrace array<struct<file:string,line:int,context_line:string,pre_context:array<string>>>, "
        "user struct<id:boolean>",
    )
    got = events.strict_events(df).first()
    assert got.backtrace[0].asDict() == {"file": "app.rb", "line": 3} and got.user.id == "true"
    assert got.message_fingerprint == "81f52337ebb4cb1669bb802c708807dd"
    jobs = spark.createDataFrame([("E", "card for Jane declined", "/patients/42/charge")], "error_class string, error_message string, transaction_name string")
    assert events.strict_failures(jobs).first().asDict() == {"error_class": "E", "transaction_name": "/patients/:path"}
    users = ['{"id":42}', '{"id":"x"}', '{"id":true}', '{"id":false}', '{"id":" "}', '{"id":{"a":1}}', "{}", "nope", None]
    ids = spark.createDataFrame([(u,) for u in users], "u string").select(privacy.user_id_from_json(F.col("u"))).collect()
    assert [r[0] for r in ids] == ["42", "x", "true", None, None, None, None, None, None]


def test_nested_columns_are_scrubbed_by_name_and_text(spark):
    df = spark.createDataFrame(
        [("hunter2", "sk_live_abc", 3, (("ada@example.com",), ["no PII here"]), "strong")],
        "password string, `API-Key` string, count int, user struct<who:struct<email:string>,notes:array<string>>, opinion string",
    )
    got = pii.scrub_columns(df).first()
    assert (got["password"], got["API-Key"], got["count"], got["opinion"]) == ("[FILTERED]", "[FILTERED]", 3, "strong")
    assert got.user.who.email == "[EMAIL FILTERED]" and got.user.notes == ["no PII here"]
    deep = spark.createDataFrame([({"a": ["x@y.com"], "token": ["t"]}, [[("x@y.com", 1)]])],
                                 "m map<string,array<string>>, l array<array<struct<mail:string,n:int>>>")
    got = pii.scrub_columns(deep).first()
    assert got.m == {"a": ["[EMAIL FILTERED]"], "token": None} and got.l[0][0].mail == "[EMAIL FILTERED]"
    nothing = spark.createDataFrame([(None, None, None)], "s string, l array<string>, r struct<a:string>")
    assert tuple(pii.scrub_columns(nothing).first()) == (None, None, None)


def test_frames_stop_at_500(spark):
    lines = [f"{i} App 0x1 f{i} + 1" for i in range(700)]
    df = spark.createDataFrame([(lines,), (None,)], "stack array<string>")
    got = df.select(F.size(frames.parse_frames(F.col("stack"), F.lit(None).cast("string"))).alias("n")).collect()
    assert [r.n for r in got] == [500, 0]


def crumb_rows(spark, rows):
    df = spark.createDataFrame(rows, "device string, seq bigint, message string, is_clear boolean")
    return df.withColumn("at", F.timestamp_seconds(F.col("seq") * 1000))


def test_trails_keep_order_cap_and_clear(spark):
    rows = [("d", i, f"m{i}", i == 7) for i in range(50)] + [("hot", i, f"h{i}", False) for i in range(400)]
    crumbs = crumb_rows(spark, rows)
    at = [("d", 5), ("d", 7), ("d", 8), ("d", 49), ("hot", 399), ("none", 3)]
    errors = spark.createDataFrame([(d, s, f"{d}{s}") for d, s in at], "device string, seq bigint, id string")
    errors = errors.withColumns({"at": F.timestamp_seconds(F.col("seq") * 1000), "seq": F.col("seq") + 1000})
    got = breadcrumbs.attach_breadcrumbs(errors, crumbs, ["device"], F.col("message"), 30, slice_seconds=20000)
    trails = {r.id: r.breadcrumbs for r in got.collect()}
    assert trails["d5"] == [f"m{i}" for i in range(6)] and trails["d7"] == [] and trails["none3"] == []
    assert trails["d8"] == ["m8"] and trails["d49"] == [f"m{i}" for i in range(20, 50)]
    assert trails["hot399"] == [f"h{i}" for i in range(370, 400)]
    last = breadcrumbs.last_n(crumbs, ["device"], [F.col("seq").desc()], 2)
    assert sorted(r.message for r in last.collect()) == ["h398", "h399", "m48", "m49"]
    strict = breadcrumbs.recorded(crumbs, Config(strict_privacy=True))
    assert strict.isEmpty() and breadcrumbs.recorded(crumbs, Config(track_breadcrumbs=False)).isEmpty()


def test_a_trail_belongs_to_a_crash_not_before_its_last_write(spark):
    trails = spark.createDataFrame([("d", 100.0, [("c", "m", "i", None, "{}")])], f"device string, s double, breadcrumbs {CRUMB}")
    trails = trails.select("device", F.timestamp_millis((F.col("s") * 1000).cast("bigint")).alias("modified_at"), "breadcrumbs")
    crashes = spark.createDataFrame([("d", i, s) for i, s in enumerate([99.0, 98.9, 160.0, 40.0])], "device string, i int, s double")
    crashes = crashes.withColumn("crashed_at", F.timestamp_millis((F.col("s") * 1000).cast("bigint")))
    got = breadcrumbs.attach_previous_trail(crashes, trails, ["device"])
    assert {r.i: r.breadcrumbs is not None for r in got.collect()} == {0: True, 1: False, 2: True, 3: False}


def test_users_are_set_and_cleared(spark):
    changes = spark.createDataFrame([("d", 1, "ada"), ("d", 5, None), ("d", 9, "bob")], "device string, seq int, user string")
    changes = changes.withColumn("at", F.timestamp_seconds("seq"))
    rows = spark.createDataFrame([("d", s, None) for s in (0, 1, 4, 5, 10)] + [("d", 6, "own"), ("x", 3, None)], "device string, s int, user string")
    got = breadcrumbs.resolve_user(rows.withColumn("at", F.timestamp_seconds("s")), changes, ["device"])
    assert {(r.device, r.s): r.user for r in got.collect()} == {
        ("d", 0): None, ("d", 1): "ada", ("d", 4): "ada", ("d", 5): None, ("d", 10): "bob", ("d", 6): "own", ("x", 3): None
    }


def test_reports_are_read_completed_and_reduced(spark, scratch):
    files = {
        "a.json": '{"exception_class":"RuntimeError",\n "message":"boom","context":{"a":1}}', "b.json": "[1]", "c.json": "{bad",
        "signal-6-1700000000.txt": "Abort trap\n0   MyApp    0x01 -[MyClass crash] + 12\n\n1   mail ada@example.com\n",
        "trail.breadcrumbs.json.bak": "[]",
    }
    for name, text in files.items():
        with open(os.path.join(scratch, name), "w") as f:
            f.write(text)
    found, corrupt = reports.read_events(spark, scratch)
    assert values(found, "exception_class", "message") == [("RuntimeError", "boom")]
    assert sorted(r._corrupt_record for r in corrupt.collect()) == ["[1]", "{bad"]
    signal = reports.read_signal_reports(spark, scratch).first()
    assert (signal.exception_class, signal.message) == ("Signal: Abort trap", "Uncaught fatal signal: Abort trap")
    assert [(f.file, f.line, f.method, f.in_app) for f in signal.backtrace] == [
        (None, None, "0   MyApp    0x01 -[MyClass crash] + 12", False), (None, None, "1   mail ada@example.com", False)
    ]
    assert signal.crashed_at.timestamp() == 1700000000
    now = F.lit("2024-01-01 00:00:00").cast("timestamp")
    plain = reports.pending_events(spark, scratch, Config(dsn=DSN, release="1.0"), now=now, scrub=False)
    assert plain.count() == 2
    done = plain.where("exception_class like 'Signal%'").first()
    assert (done.release, done.context, done.backtrace[1].method) == ("1.0", "{}", "1   mail ada@example.com")
    scrubbed = reports.pending_events(spark, scratch, Config(dsn=DSN), now=now).where("exception_class like 'Signal%'").first()
    assert scrubbed.backtrace[1].method == "1   mail [EMAIL FILTERED]"
    strict = reports.pending_events(spark, scratch, Config(dsn=DSN, strict_privacy=True), now=now)
    assert {r.message for r in strict.collect()} == {""} and {r.context for r in strict.collect()} == {None}


def test_events_and_trails_survive_a_round_trip(spark, scratch):
    df = error(spark, message="boom", context='{"a":1}', stack=["1 UIKit 0x1f main + 3"], user=("7", None))
    built = events.build_events(df.withColumn("occurred_at", F.lit("2024-01-15 10:29:58").cast("timestamp")), Config(dsn=DSN))
    reports.write_events(built, scratch + "/events")
    document = json.loads(spark.read.text(scratch + "/events").first().value)
    assert document["occurred_at"] == "2024-01-15T10:29:58Z" and document["context"] == {"a": 1}
    assert document["release"] is None and document["server_name"] is None and "breadcrumbs" not in document
    assert document["backtrace"] == [{"file": "UIKit", "line": None, "method": "main", "in_app": False}]
    trails = spark.createDataFrame([("d", [("c", "mail a@b.co", "info", None, '{"pwd":"x"}')])], f"device string, breadcrumbs {CRUMB}")
    stamped = trails.withColumn("modified_at", F.lit("2024-01-15 10:29:58").cast("timestamp"))
    reports.write_trails(stamped, scratch + "/trails")
    back = reports.read_trails(spark, scratch + "/trails").first()
    assert (back.breadcrumbs[0].message, back.breadcrumbs[0].data) == ("mail [EMAIL FILTERED]", '{"pwd":"[FILTERED]"}')


def test_envelopes(spark, scratch):
    df = spark.range(25).select(F.col("id").alias("n"), F.lit(None).cast("string").alias("release"))
    got = envelopes.to_envelopes(df, "performance_samples", [F.col("n")], F.floor(F.col("n") / 4), batch_size=10)
    rows = got.orderBy("batch_id").collect()
    assert [r.records for r in rows] == [10, 10, 5]
    assert [s["n"] for r in rows for s in json.loads(r.body)["samples"]] == list(range(25))
    assert json.loads(rows[0].body)["samples"][0]["release"] is None
    routed = envelopes.routed(got, "performance_samples", F.lit(DSN))
    assert routed.first().endpoint == "https://tracker.example.com/api/v1/performance_samples"
    envelopes.write_envelopes(routed, scratch + "/out")
    assert spark.read.json(scratch + "/out").count() == 3


def test_roll_ups(spark):
    rows = [("E", "user 1 failed", "a"), ("E", "user 2 failed", "a"), ("E", "user 3 failed", "b"), ("F", "user 3 failed", None)]
    df = spark.createDataFrame(rows, "exception_class string, message string, user_id string").withColumn("occurred_at", F.current_timestamp())
    got = {r.exception_class: (r.events, r.affected_users) for r in issues(df).collect()}
    assert got == {"E": (3, 2), "F": (1, 0)}
    assert {r.affected_users for r in issues(df, approx=True).collect()} == {2, 0}
    objects = spark.createDataFrame([(("SELECT", [], ["t"]),), (None,), (("SELECT", ["f"], ["t"]),)],
                                    "sql_objects struct<operation:string,procedures:array<string>,relations:array<string>>")
    assert {(r.object_name, r.statements) for r in sql_object_counts(objects).collect()} == {("t", 2), ("f", 1)}
