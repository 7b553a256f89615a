"""Joins of two streams: rows in any order, sides that go quiet, restarts, and the batch operators they must agree with."""

from datetime import datetime, timedelta

from helpers import values
from pyspark.sql import functions as F

from telemetry_spark.operators import traces
from telemetry_spark.streaming import joins, runs

T0 = datetime(2024, 1, 1)
SPAN = "trace_id string, span_id string, parent_span_id string, name string, started_at timestamp, duration_ms double"
ERROR = "id string, trace_id string, occurred_at timestamp"
LINKED = ["id", "trace_id", "trace_spans", "trace_name", "trace_duration_ms"]


def at(minutes):
    return T0 + timedelta(minutes=minutes)


def put(spark, folder, schema, *rows):
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("append").parquet(folder)


def span(trace, span_id, minute, parent=None, name="GET /"):
    return (trace, span_id, parent, name, at(minute), 5.0)


def links(spark, scratch):
    spans = runs.file_stream(spark, f"{scratch}/spans", SPAN)
    errors = runs.file_stream(spark, f"{scratch}/errors", ERROR)
    return joins.stream_linked_errors(errors, spans, "10 minutes", "30 minutes", "2 hours", f"{scratch}/clock")


def test_errors_meet_traces_that_end_later(spark, scratch):
    """Errors and spans in two goes with a restart, in the second of which one side alone has rows; equal to the batch."""
    runs.prepare(spark)
    put(spark, f"{scratch}/errors", ERROR, ("in", "t1", at(1)), ("unknown", "t9", at(2)), ("none", None, at(3)), ("untimed", "t1", None),
        ("rootless", "t2", at(4)))
    put(spark, f"{scratch}/spans", SPAN, span("t1", "r", 0), span("t2", "c", 2, "x"), span(None, "n", 1))
    runs.flush_now(links(spark, scratch), f"{scratch}/out", f"{scratch}/checkpoint")
    put(spark, f"{scratch}/spans", SPAN, span("t1", "c1", 20, "r"), span("t1", "c2", 10, "r"), span("t3", "r3", 21, None, "POST /"))
    runs.flush_now(links(spark, scratch), f"{scratch}/out", f"{scratch}/checkpoint")
    put(spark, f"{scratch}/errors", ERROR, ("later", "t3", at(40)), ("again", "t1", at(20)))
    got = joins.flush_joined(links(spark, scratch), f"{scratch}/out", f"{scratch}/checkpoint", f"{scratch}/clock", at(1000))
    errors, spans = spark.read.schema(ERROR).parquet(f"{scratch}/errors"), spark.read.schema(SPAN).parquet(f"{scratch}/spans")
    want = traces.link_errors_to_traces(errors.where("occurred_at is not null"), spans)
    expected = set(values(want, *LINKED)) | {("untimed", "t1", None, None, None)}
    assert set(values(got, *LINKED)) == expected and got.count() == 7
    assert {r.id: r.trace_spans for r in got.collect()}["in"] == 3


def test_what_waits_too_long_comes_out_once(spark, scratch):
    """A trace that pauses counts as two and links an error once; state is let go when its time has passed."""
    runs.prepare(spark)
    put(spark, f"{scratch}/spans", SPAN, span("t", "a", 0), span("t", "b", 5, "a"), span("t", "c", 100, "a"))
    put(spark, f"{scratch}/errors", ERROR, ("first", "t", at(6)), ("between", "t", at(60)), ("second", "t", at(110)))
    got = joins.flush_joined(links(spark, scratch), f"{scratch}/out", f"{scratch}/checkpoint", f"{scratch}/clock", at(1000))
    assert sorted(values(got, "id", "trace_spans")) == [("between", None), ("first", 2), ("second", 1)]
    kept = [spark.read.format("statestore").option("joinSide", side).option("operatorId", operator).load(f"{scratch}/checkpoint")
            for operator in joined_operators(spark, scratch) for side in ("left", "right")]
    assert sum(df.count() for df in kept) == 0


def joined_operators(spark, scratch):
    found = spark.read.format("state-metadata").load(f"{scratch}/checkpoint").where("operatorName = 'symmetricHashJoin'")
    return [r[0] for r in found.select("operatorId").distinct().collect()]


def test_no_rows_at_all(spark, scratch):
    runs.prepare(spark)
    put(spark, f"{scratch}/spans", SPAN)
    put(spark, f"{scratch}/errors", ERROR)
    got = joins.flush_joined(links(spark, scratch), f"{scratch}/out", f"{scratch}/checkpoint", f"{scratch}/clock", at(1000))
    assert got.columns == ["id", "trace_id", "occurred_at", "trace_spans", "trace_name", "trace_duration_ms"] and got.count() == 0


def test_requests_meet_their_callers(spark, scratch):
    """A request may come before its caller's span does; one too far from it in time stays alone, as does one with a bad header."""
    runs.prepare(spark)
    client, backend = "trace_id string, span_id string, name string, started_at timestamp", "span_id string, name string, traceparent string, started_at timestamp"
    ids = {n: (f"{n:032x}", f"{n:016x}") for n in range(1, 7)}
    header = {n: f"00-{t}-{s}-01" for n, (t, s) in ids.items()}
    callers = [(*ids[n], f"call {n}", at(60)) for n in (1, 2, 3, 4, 5)]
    requests = [("b1", "in time", header[1], at(61)), ("b1", "twice", header[1], at(62)), ("b2", "clock behind", header[2], at(59.5)),
                ("b3", "too late", header[3], at(200)), ("b4", "bad", "00-xyz", at(61)), ("b5", "no time", header[5], None), ("b6", "no caller", header[6], at(61))]

    def build():
        return joins.stream_stitched(
            runs.file_stream(spark, f"{scratch}/client", client), runs.file_stream(spark, f"{scratch}/backend", backend), clock=f"{scratch}/clock")

    put(spark, f"{scratch}/backend", backend, *requests[:3], *requests[4:])
    put(spark, f"{scratch}/client", client)
    runs.flush_now(build(), f"{scratch}/out", f"{scratch}/checkpoint")
    put(spark, f"{scratch}/client", client, *callers)
    runs.flush_now(build(), f"{scratch}/out", f"{scratch}/checkpoint")
    put(spark, f"{scratch}/backend", backend, requests[3])
    got = joins.flush_joined(build(), f"{scratch}/out", f"{scratch}/checkpoint", f"{scratch}/clock", at(1000))
    assert sorted(values(got, "backend_name", "client_name")) == [("clock behind", "call 2"), ("in time", "call 1"), ("twice", "call 1")]
    whole = traces.stitch_traces(spark.createDataFrame(callers, client), spark.createDataFrame(requests, backend))
    late = whole.where(~F.col("backend_name").isin("too late", "no time"))
    assert sorted(values(got)) == sorted(values(late, *got.columns))
