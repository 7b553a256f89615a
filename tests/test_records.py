"""Metrics, delivery, changes, performance: the record rules, row by row."""

import math

import pytest
from helpers import values
from pyspark.sql import functions as F

from telemetry_spark.config import Config
from telemetry_spark.functions import changefields, delivery, latency, tracing
from telemetry_spark.operators import changes, metrics, performance
from telemetry_spark.operators import delivery as accounting
from telemetry_spark.schemas import ATTEMPT, CHANGE, INFRA_METRIC, MEASUREMENT


def one(spark, *columns):
    return tuple(spark.range(1).select(*columns).first())


def column(spark, fn, inputs, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, c {kind}")
    return [r.o for r in df.select("i", fn(F.col("c")).alias("o")).orderBy("i").collect()]


def test_latency_buckets(spark):
    cases = {10.0: "50", 50.0: "50", 50.5: "100", 4999.0: "5000", 10001.0: "inf", 1e6: "inf"}
    cases |= {float(b): str(b) for b in latency.BOUNDARIES_MS}
    assert column(spark, latency.latency_bucket, list(cases), "double") == list(cases.values())


def timings(spark, rows):
    data = [(name, "production", None, ms) for name, ms in rows]
    df = spark.createDataFrame(data, "transaction_name string, environment string, release string, duration_ms double")
    return df.withColumn("ts", F.lit("2024-01-15 10:00:05").cast("timestamp"))


def test_tallies_and_histogram(spark):
    rows = [("GET /users/:id", 10.0), ("GET /users/:id", 30.0), ("POST /orders", 5.0)]
    rows += [("GET /posts", float(d)) for d in (15, 33, 180, 930, 20500)]
    wire = performance.with_histogram(performance.performance_samples(timings(spark, rows)))
    got = {r.transaction_name: r for r in wire.collect()}
    users = got["GET /users/:id"]
    assert (users.request_count, users.duration_sum_ms, users.max_duration_ms) == (2, 40.0, 30.0)
    assert got["GET /posts"].histogram == {"50": 2, "250": 1, "1000": 1, "inf": 1}
    assert got["POST /orders"].request_count == 1
    assert (users.period_ended_at - users.period_started_at).total_seconds() == 60


def test_strict_names_share_a_tally(spark):
    rows = [("GET /patients/41", 10.0), ("GET /patients/42", 30.0), ("PatientsController#show", 5.0), ("GET /visits/:id", 5.0)]
    got = performance.performance_samples(timings(spark, rows), Config(strict_privacy=True))
    assert dict(values(got, "transaction_name", "request_count")) == {
        "GET /patients/:path": 2, "PatientsController#show": 1, "GET /visits/:id": 1
    }
    off = performance.performance_samples(timings(spark, rows), Config(track_performance=False))
    assert off.isEmpty()


def test_percentiles_walk_the_buckets(spark):
    rows = [("a", float(d)) for d in [10] * 50 + [200] * 45 + [20000] * 5]
    got = performance.with_percentiles(performance.performance_samples(timings(spark, rows))).first()
    assert (got.p50_ms, got.p95_ms, got.p99_ms) == (50.0, 250.0, 20000.0)


def test_subtraction_keeps_the_maximum_and_drops_empty_keys(spark):
    current = performance.performance_samples(timings(spark, [("x", 10.0), ("x", 300.0), ("gone", 5.0)]))
    sent = performance.performance_samples(timings(spark, [("x", 300.0), ("gone", 5.0)]))
    left = performance.with_histogram(performance.subtract_delivered(current, sent)).collect()
    assert [(r.transaction_name, r.request_count, r.duration_sum_ms, r.max_duration_ms, r.histogram) for r in left] == [
        ("x", 1, 10.0, 300.0, {"50": 1})
    ]


def test_only_finite_numbers_are_metrics(spark):
    df = spark.createDataFrame(
        [("nan", math.nan), ("inf", math.inf), ("-inf", -math.inf), ("missing", None), ("ok", 3.0), ("minus", -12.5)],
        "metric_name string, value double",
    )
    assert sorted(r.metric_name for r in metrics.valid_metrics(df).collect()) == ["minus", "ok"]
    assert metrics.valid_metrics(df.withColumn("value", F.lit("12"))).isEmpty()
    assert column(spark, metrics.metric_value_default, [None, 49.0], "double") == [1.0, 49.0]


def test_hostname_falls_back_to_the_server(spark):
    df = spark.createDataFrame([("cpu", 0.4, "db-1", None), ("mem", 0.7, None, None), ("disk", 0.1, "", None)], INFRA_METRIC)
    kept, dropped = metrics.resolve_hostname(df, "web-1")
    assert values(kept, "metric_name", "hostname") == [("cpu", "db-1"), ("mem", "web-1")]
    assert values(dropped, "metric_name") == [("disk",)]
    _, dropped = metrics.resolve_hostname(df)
    assert len(dropped.collect()) == 2


def test_a_batch_takes_the_first_thousand(spark):
    df = spark.range(1050).select(
        F.lit("m").alias("metric_name"), F.col("id"), F.lit("2024-01-01 00:00:01").cast("timestamp").alias("recorded_at")
    )
    kept = metrics.cap_batch(df, ["metric_name"], [F.col("id")], "60 seconds")
    assert kept.agg(F.count("*"), F.max("id")).first() == (1000, 999)
    assert metrics.cap_overflow(df, ["metric_name"], "60 seconds").first().dropped == 50


def test_outcomes_and_reasons(spark):
    statuses = {200: "delivered", 204: "delivered", 400: "rejected", 401: "rejected", 422: "rejected", 0: "failed",
                301: "failed", 408: "failed", 429: "failed", 503: "failed"}
    assert column(spark, delivery.delivery_outcome, list(statuses), "int") == list(statuses.values())
    assert [delivery.delivery_outcome_of(s) for s in statuses] == list(statuses.values())
    assert column(spark, delivery.drop_reason, [403, 0, 503], "int") == [
        "rejected by the server (HTTP 403)", "the server could not be reached", "the server answered HTTP 503"
    ]


def test_dsn(spark):
    dsns = [
        "https://secret-key@tracker.example.com/api/v1/events", "https://secret%2Bkey@tracker.example.com/api/v1/events",
        None, "", "https://tracker.example.com/api/v1/events", "no dsn", "https://k:pw@h.test:8443/x/events?y=1",
        "https://a+b@h.test/events", "https://k@/events",
    ]
    assert column(spark, delivery.dsn_api_key, dsns) == ["secret-key", "secret+key", None, None, None, None, "k", "a+b", None]
    plain = "https://tracker.example.com/api/v1/events"
    assert column(spark, delivery.dsn_ingestion_url, dsns) == [
        plain, plain, None, None, plain, None, "https://h.test:8443/x/events?y=1", "https://h.test/events", None
    ]
    swapped = column(spark, lambda c: delivery.endpoint_for(c, "spans"), [dsns[0], "https://k@h.test/ingest", dsns[6]])
    assert swapped == ["https://tracker.example.com/api/v1/spans", "https://h.test/ingest", "https://h.test:8443/x/spans?y=1"]


def test_enabled(spark):
    df = spark.range(3)
    good = Config(dsn="https://key@tracker.example.com/api/v1/events")
    assert accounting.filter_enabled(df, good).count() == 3
    for bad in (Config(), Config(dsn="https://h.test/x"), Config(dsn=good.dsn, environment="development")):
        assert accounting.filter_enabled(df, bad).isEmpty()


def test_propagation(spark):
    hosts = ["example.com", "api.EXAMPLE.com", "badexample.com", "example.com.evil.test", "internal.test", "db.internal.test",
             None, ""]
    targets = F.array(F.lit("Example.com"), F.lit(".internal.test"))
    listed = column(spark, lambda h: delivery.should_propagate(h, targets), hosts)
    assert listed == [True, True, False, False, True, True, False, False]
    pattern = column(spark, lambda h: delivery.should_propagate(h, None, ("^api[0-9]+\\.corp$",)), ["API7.corp", "api.corp", None])
    assert pattern == [True, False, False]
    empty = F.array().cast("array<string>")
    assert one(
        spark, delivery.should_propagate(F.lit(None).cast("string")), delivery.should_propagate(F.lit("a.test"), empty),
        delivery.should_propagate(F.lit("a.test"), enabled=False),
        delivery.should_propagate(F.lit(None).cast("string"), F.lit(None).cast("array<string>")),
    ) == (True, False, False, True)


def attempts(spark, statuses):
    rows = [("s", i, s) for i, s in enumerate(statuses)]
    df = spark.createDataFrame(rows, "source string, batch_id bigint, status int")
    return df.withColumn("attempted_at", F.timestamp_seconds(F.col("batch_id") * 7200)).select(
        "source", "batch_id", "attempted_at", "status"
    )


@pytest.mark.parametrize(
    "statuses, streaks, actions",
    [
        ([503] * 6, [1, 2, 3, 4, 5, 1], ["kept"] * 4 + ["dropped", "kept"]),
        ([503, 503, 503, 503, 200, 503], [1, 2, 3, 4, 0, 1], ["kept"] * 4 + ["delivered", "kept"]),
        ([0, 403, 429, 408], [1, 0, 1, 2], ["kept", "dropped", "kept", "kept"]),
        ([503] * 11, [1, 2, 3, 4, 5] * 2 + [1], (["kept"] * 4 + ["dropped"]) * 2 + ["kept"]),
    ],
)
def test_failure_streaks(spark, statuses, streaks, actions):
    got = accounting.streaks(attempts(spark, statuses), slice_seconds=10000).orderBy("batch_id").collect()
    assert [r.streak for r in got] == streaks
    assert [r.action for r in got] == actions
    assert ATTEMPT.startswith("source")


def test_retention_keeps_the_newest_twenty_within_seven_days(spark):
    now = F.lit("2024-01-31 00:00:00").cast("timestamp")
    df = spark.range(23).select(
        F.lit("d").alias("source"), F.col("id").alias("payload_id"), (now - F.make_dt_interval(hours=23 - F.col("id"))).alias("created_at")
    )
    kept, dropped = accounting.retain(df, now)
    assert sorted(r.payload_id for r in kept.collect()) == list(range(3, 23))
    assert {(r.payload_id, r.drop_reason) for r in dropped.collect()} == {(0, "excess"), (1, "excess"), (2, "excess")}
    aged = spark.createDataFrame([("d", 1, 7 * 24 + 1), ("d", 2, 7 * 24 - 1), ("d", 3, None)], "source string, payload_id int, h int")
    aged = aged.withColumn("created_at", now - F.make_dt_interval(hours=F.col("h")))
    kept, dropped = accounting.retain(aged, now)
    assert [r.payload_id for r in accounting.oldest_first(kept).collect()] == [3, 2]
    assert [(r.payload_id, r.drop_reason) for r in dropped.collect()] == [(1, "expired")]


def test_queue_admits_a_hundred(spark):
    moves = [("s", i, 1) for i in range(105)] + [("s", 105, -1), ("s", 106, 1), ("s", 107, 1)]
    df = spark.createDataFrame(moves, "source string, trace_id bigint, delta int")
    got = accounting.admit(df.withColumn("at", F.timestamp_seconds("trace_id")), slice_seconds=10).orderBy("trace_id").collect()
    admitted = [r.admitted for r in got]
    assert admitted[:100] == [True] * 100 and admitted[100:105] == [False] * 5 and admitted[105:] == [True, True, False]
    assert got[-1].pending == 100


def test_change_fields(spark):
    kinds = list(changefields.CHANGE_KINDS) + ["flag", None]
    assert column(spark, changefields.change_kind, kinds) == [*changefields.CHANGE_KINDS, "other", "other"]
    titles = column(spark, changefields.change_title, ["a" * 250, "   ", "  x \n", None])
    assert titles == ["a" * 200, None, "x", None]
    assert column(spark, changefields.valid_details, ['{"a":1}', "[1]", "nope", None]) == ['{"a":1}', None, None, None]
    urls = ["https://x.test/a", "HTTP://x.test", "javascript:alert(1)", "relative", None, "https://a b"]
    assert column(spark, delivery.safe_url, urls) == ["https://x.test/a", "HTTP://x.test", None, None, None, None]


def test_changes_fill_in_and_drop(spark):
    when = F.lit("2026-09-21 14:13:20").cast("timestamp")
    rows = [
        ("feature_flag", "new_checkout turned on", None, None, '{"key":"new_checkout"}', "ios-app", "", "https://f.test/x", "flag-123"),
        ("other", "  ", None, None, None, None, None, None, None),
    ]
    df = spark.createDataFrame(rows, CHANGE).withColumn("occurred_at", when)
    got = changes.changes(df).collect()
    assert [tuple(r)[:3] for r in got] == [("feature_flag", "new_checkout turned on", "production")]
    assert (got[0].service, got[0].actor, got[0].id, got[0].url) == ("ios-app", None, "flag-123", "https://f.test/x")
    assert changes.enabled_changes(df, Config(environment="development")).isEmpty()
    twice = df.unionByName(df).where("kind = 'feature_flag'")
    unnamed = twice.withColumn("id", F.lit(None).cast("string"))
    assert changes.dedupe_changes(twice).count() == 1 and changes.dedupe_changes(unnamed).count() == 2


def test_trace_scalars(spark):
    good, zero = "0af7651916cd43dd8448eb211c80319c", "0" * 32
    assert column(spark, tracing.is_trace_id, [good, zero, good.upper(), good[:31], None]) == [True] + [False] * 4
    header = f"00-{good}-b7ad6b7169203331-01"
    parsed = column(spark, tracing.parse_traceparent, [header, header.upper(), f"00-{zero}-b7ad6b7169203331-01", "x", None])
    assert [tuple(p) for p in parsed] == [(good, "b7ad6b7169203331")] + [(None, None)] * 4
    lit = F.lit
    assert one(
        spark, tracing.traceparent(lit(good), lit("b7ad6b7169203331"), lit(None).cast("string"), lit(True)),
        tracing.traceparent(lit(good), lit("b7ad6b7169203331"), lit("own"), lit(True)),
        tracing.traceparent(lit(good), lit("b7ad6b7169203331"), lit(None).cast("string"), lit(False)),
    ) == (header, "own", None)
    assert column(spark, tracing.round_ms, [1.005, 1.006, 2.0], "double") == [1.0, 1.01, 2.0]
    ids = spark.range(50).select(tracing.trace_id().alias("t"), tracing.span_id(F.col("id")).alias("s"))
    assert ids.where(tracing.is_trace_id(F.col("t")) & tracing.is_span_id(F.col("s"))).count() == 50
    kinds = list(tracing.SPAN_KINDS) + ["db", None]
    assert column(spark, tracing.span_kind, kinds) == [*tracing.SPAN_KINDS, "other", "other"]
    assert MEASUREMENT.startswith("transaction_name")


def test_span_data(spark):
    sql = "SELECT \"a'b\" = 'c' AND token = \"tok-secret\""
    rows = [
        ("database", '{"rows":3}', "SELECT * FROM orders WHERE email = 'a@b.co' AND total > 4200", "SQLite"),
        ("database", "{\"db.statement\":\"SELECT count(*) FROM carts WHERE token = 'secret'\"}", None, None),
        ("service", None, "SELECT 'x'", "sqlite"),
        ("database", None, sql, " MySQL "),
        ("http", '{"status":200}', None, None),
        ("database", None, "SELECT " + "a, " * 3000 + "b FROM t", None),
    ]
    df = spark.createDataFrame(rows, "kind string, data string, statement string, system string")
    got = [r[0] for r in df.select(tracing.span_data(F.col("kind"), F.col("data"), F.col("statement"), F.col("system"))).collect()]
    assert got[:5] == [
        '{"rows":3,"db.statement":"SELECT * FROM orders WHERE email = ? AND total > ?","db.system":"sqlite"}',
        '{"db.statement":"SELECT count(*) FROM carts WHERE token = ?"}', "{}",
        '{"db.statement":"SELECT ? = ? AND token = ?","db.system":"mysql"}', '{"status":200}',
    ]
    assert got[5].endswith('..."}') and len(got[5]) == 4003 + len('{"db.statement":""}')


def test_what_a_literal_begins_with_leaves_none_out(spark):
    """Asking for a literal's first letters before its pattern changes nothing, whatever stands before it."""
    import random

    from telemetry_spark.functions import sqltext

    rng = random.Random(4)
    texts = ["".join(rng.choices(["'", '"', "$", "$a$", "1", ".5", "0x1F", "E'", "u&'", "N", "b", "\\", " ", "x", "_", "e9", "\n"], k=25)) for _ in range(400)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for asked, double in ((sqltext.LITERAL, ""), (sqltext.LITERAL_WITH_DOUBLE_QUOTES, f"|{sqltext.DOUBLE_QUOTED_STRING}")):
        plain = f"(?s){sqltext.STRING}{double}|{sqltext.DOLLAR_QUOTED}|{sqltext.NUMBER}"
        assert f"(?={sqltext.BEGINS}" in asked
        assert df.where(F.regexp_replace("t", asked, "?") != F.regexp_replace("t", plain, "?")).isEmpty()
