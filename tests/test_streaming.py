"""Streams over several files: state carries over between micro-batches, and failed deliveries are retried."""

import os
import time

import duckdb
import pytest
from pyspark.sql import functions as F

from telemetry_spark.operators.performance import performance_samples
from telemetry_spark.streaming import runs, state
from telemetry_spark.streaming.flush import MetricFlusher
from telemetry_spark.streaming.windows import stream_changes, stream_performance
from workload.streams import QUERIES


@pytest.fixture
def stream(spark, scratch):
    """Write each batch of rows as one file, then read them back one file per micro-batch."""
    runs.prepare(spark)

    def make(schema, batches):
        for i, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{scratch}/in/{i:03d}")
        return runs.file_stream(spark, f"{scratch}/in/*", schema, files_per_trigger=1)

    return make


def flushed(spark, df, scratch, name="out"):
    schema = df.schema
    runs.flush_now(df, f"{scratch}/{name}", f"{scratch}/{name}-checkpoint")
    return spark.read.schema(schema).parquet(f"{scratch}/{name}").collect()


def timed(df):
    return df.withColumn("at", F.timestamp_seconds("seq"))


TALLY = "source string, seq bigint, kind string, transaction_name string, duration_ms double, status int"


def tally(seq, ms=None, name="x", status=None, kind="record"):
    return ("s", seq, kind, name if kind == "record" else None, ms, status)


def flush(seq, status):
    return [tally(seq, kind="snapshot"), tally(seq + 1, kind="outcome", status=status)]


def samples(spark, stream, scratch, batches, **options):
    rows = flushed(spark, state.keyed(timed(stream(TALLY, batches)), "source", state.TallyFlusher(**options)), scratch)
    found = [(r.flush_seq, r.transaction_name, r.request_count, r.duration_sum_ms, r.max_duration_ms, r.histogram) for r in rows]
    return sorted(found)


def test_a_failed_delivery_keeps_every_tally(spark, stream, scratch):
    batches = [[tally(1, 10.0), *flush(2, 503)], [tally(5, 300.0), *flush(6, 202)], [tally(9, 7.0, "y"), *flush(10, 401)], flush(20, 200)]
    assert samples(spark, stream, scratch, batches) == [
        (2, "x", 1, 10.0, 10.0, {"50": 1}), (6, "x", 2, 310.0, 300.0, {"50": 1, "500": 1}), (10, "y", 1, 7.0, 7.0, {"50": 1})
    ]


def test_the_fifth_failure_in_a_row_drops_the_batch(spark, stream, scratch):
    batches = [[tally(1, 10.0)], *[flush(10 * i, 503) for i in range(1, 7)], [tally(70, 1.0), *flush(71, 200)]]
    got = samples(spark, stream, scratch, batches)
    assert [g[0] for g in got] == [10, 20, 30, 40, 50, 71]
    assert got[-1][2:4] == (1, 1.0)


def test_a_record_during_delivery_is_never_lost(spark, stream, scratch):
    batches = [
        [tally(1, 10.0), tally(2, kind="snapshot")], [tally(3, 25.0), tally(4, 7.0, "new"), tally(5, kind="outcome", status=202)],
        flush(6, 202),
    ]
    assert samples(spark, stream, scratch, batches) == [
        (2, "x", 1, 10.0, 10.0, {"50": 1}), (6, "new", 1, 7.0, 7.0, {"50": 1}), (6, "x", 1, 25.0, 25.0, {"50": 1})
    ]


@pytest.mark.parametrize("carry, expected", [(False, 5.0), (True, 900.0)])
def test_the_maximum_after_a_delivery(spark, stream, scratch, carry, expected):
    batches = [[tally(1, 900.0), tally(2, kind="snapshot"), tally(3, 5.0), tally(4, kind="outcome", status=200), *flush(6, 200)]]
    assert samples(spark, stream, scratch, batches, carry_max=carry)[1][4] == expected


def test_a_ring_carries_over_and_clears(spark, stream, scratch):
    schema = "device string, seq bigint, kind string, id string, crumb string"
    batches = [
        [("d", i, "crumb", None, f"c{i}") for i in range(25)], [("d", 25 + i, "crumb", None, f"c{25 + i}") for i in range(10)],
        [("d", 40, "error", "e1", None), ("d", 41, "clear", None, None), ("d", 42, "error", "e2", None)],
        [("d", 43, "crumb", None, "after"), ("d", 44, "error", "e3", None)],
    ]
    rows = flushed(spark, state.keyed(timed(stream(schema, batches)), "device", state.BreadcrumbRing()), scratch)
    got = {r.id: r.trail for r in rows}
    assert got == {"e1": [f"c{i}" for i in range(5, 35)], "e2": [], "e3": ["after"]}


def test_a_user_carries_over_and_clears(spark, stream, scratch):
    schema = "device string, seq bigint, kind string, id string, user string"
    batches = [
        [("d", 1, "event", "e0", None), ("d", 2, "set", None, "ada")], [("d", 3, "event", "e1", None), ("d", 4, "event", "e2", "own")],
        [("d", 5, "set", None, None)], [("d", 6, "event", "e3", None)],
    ]
    rows = flushed(spark, state.keyed(timed(stream(schema, batches)), "device", state.UserState()), scratch)
    assert {r.id: r.user for r in rows} == {"e0": None, "e1": "ada", "e2": "own", "e3": None}


def test_a_trace_waits_for_its_root(spark, stream, scratch):
    schema = "trace_id string, seq bigint, is_root boolean, duration_ms double, span string"

    def span(trace, seq, root=False, ms=1.0):
        return (trace, seq, root, ms, f"{trace}{seq}")

    batches = [
        [span("a", 1), span("b", 1), span("big", 1)], [span("a", 2), *[span("big", i) for i in range(2, 700)]],
        [span("a", 3, True, 1000.0), span("b", 2, True, 999.0), span("big", 800, True, 5000.0)],
        [span("a", 4), span("a", 5, True, 9000.0)],
    ]
    assembled = state.keyed(timed(stream(schema, batches)), "trace_id", state.TraceAssembler(), "1 hour")
    got = {r.trace_id: (r.spans, r.root, list(r.rest)) for r in flushed(spark, assembled, scratch)}
    assert got["a"] == (3, "a3", ["a1", "a2"]) and "b" not in got
    assert got["big"][0] == 500 and got["big"][2] == [f"big{i}" for i in range(1, 500)]


def test_a_trace_without_a_limit_keeps_all_its_spans(spark, stream, scratch):
    schema = "trace_id string, seq bigint, is_root boolean, duration_ms double, span string"

    def span(trace, seq, root=False):
        return (trace, seq, root, 5000.0, f"{trace}{seq}")

    batches = [[span("big", i) for i in range(1, 30)], [span("big", i) for i in range(30, 1300)], [span("big", i) for i in range(1300, 1310)],
               [span("big", 1310, True), span("big", 1311), span("open", 1), span("open", 2)]]
    assembled = state.keyed(timed(stream(schema, batches)), "trace_id", state.TraceAssembler(limit=None), "1 hour")
    found = flushed(spark, assembled, scratch)
    assert [(r.trace_id, r.spans, r.root) for r in found] == [("big", 1310, "big1310")]
    assert list(found[0].rest) == [f"big{i}" for i in range(1, 1310)]


def test_long_traces_go_out_in_frames_of_their_own(monkeypatch):
    monkeypatch.setattr(state, "SENT_SPANS", 10)
    rows = [("a", ["s"] * 12), ("b", None), ("c", ["s"] * 4), ("d", ["s"] * 6), ("e", [])]
    assert [list(f["t"]) for f in state._frames(iter(rows), ["t", "rest"], 1)] == [["a"], ["b", "c", "d"], ["e"]]
    assert [len(f) for f in state._frames(iter(rows), ["t", "rest"])] == [5]


def test_the_traces_query_sends_every_span_before_the_root(spark, scratch):
    os.makedirs(f"{scratch}/sf")
    rows = [(i, f"2024-01-0{1 + i // 4} 00:00:0{i}", 1, "purchase" if i == 9 else "view", 30.0, "{}") for i in range(10)]
    events = spark.createDataFrame(rows, "event_id bigint, ts string, user_id bigint, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{scratch}/sf/events.parquet")
    query, sql = QUERIES["streamed_traces"]
    assert [tuple(r) for r in query(spark, f"{scratch}/sf").collect()] == [("0", 10, "9", "0,1,2,3,4,5,6,7,8")]
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW events AS SELECT * FROM '{scratch}/sf/events.parquet/*.parquet'")
        assert con.execute(sql).fetchall() == [("0", 10, "9", "0,1,2,3,4,5,6,7,8")]


def test_a_queue_admits_while_there_is_room(spark, stream, scratch):
    schema = "source string, seq bigint, trace_id string, delta int"
    batches = [[("s", i, f"t{i}", 1) for i in range(3)], [("s", 3, "t3", 1), ("s", 4, "t0", -1), ("s", 5, "t5", 1)]]
    rows = flushed(spark, state.keyed(timed(stream(schema, batches)), "source", state.QueueAdmission(3)), scratch)
    got = {r.trace_id: r.admitted for r in rows if r.trace_id != "t0"}
    assert got == {"t1": True, "t2": True, "t3": False, "t5": True}


def test_windows_match_the_batch_and_late_rows_are_dropped(spark, stream, scratch):
    schema = "transaction_name string, environment string, release string, s bigint, duration_ms double"

    def rows(*seconds):
        return [("x", "production", None, s, float(s)) for s in seconds]

    batches = [rows(5, 30, 65), rows(130, 200), rows(900), rows(10), rows(2000)]
    source = stream(schema, batches).withColumn("ts", F.timestamp_seconds("s"))
    got = flushed(spark, stream_performance(source, watermark="60 seconds"), scratch)
    every = [r for b in batches for r in b if r[3] not in (10, 2000)]
    batch = performance_samples(spark.createDataFrame(every, schema).withColumn("ts", F.timestamp_seconds("s"))).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, batch), key=str)


def test_changes_are_idempotent(spark, stream, scratch):
    schema = "id string, seq bigint"
    batches = [[("a", 1), ("a", 2), (None, 3), (None, 3)], [("a", 4), ("b", 5)]]
    source = stream(schema, batches).withColumn("occurred_at", F.timestamp_seconds("seq"))
    got = [r.id for r in flushed(spark, stream_changes(source), scratch)]
    assert sorted(got, key=str) == [None, None, "a", "b"]


METRIC = "source string, seq bigint, name string, recorded_at timestamp"


def test_metrics_wait_for_a_delivery_that_succeeds(spark, scratch):
    answers, seen = iter([503, 202, 403, 503, 503, 503, 503, 503, 200]), []

    def deliver(entries, batch_id):
        seen.append(sorted(r.name for r in entries.collect()))
        return next(answers)

    flusher = MetricFlusher(deliver, scratch + "/state")

    def batch(*names):
        rows = [("s", i, n) for i, n in enumerate(names)]
        return spark.createDataFrame(rows, "source string, seq bigint, name string").withColumn("recorded_at", F.current_timestamp())

    nothing = spark.createDataFrame([], METRIC)
    for i, names in enumerate([("a",), ("b",), ("c",), ("d",), (), (), (), (), ("e",)]):
        flusher(batch(*names) if names else nothing, i)
    flusher(batch("e"), 8)  # a batch that is run again is not sent again
    flusher(nothing, 9)  # nothing left: no delivery
    assert seen == [["a"], ["a", "b"], ["c"], ["d"], ["d"], ["d"], ["d"], ["d"], ["e"]]
    assert sorted(os.listdir(scratch + "/state")) == ["entries", "marks"]
    assert os.listdir(scratch + "/state/entries") == [] and len([m for m in os.listdir(scratch + "/state/marks") if m[0] != "."]) == 1
    outcomes = [r.outcome for r in flusher.history(spark).orderBy("batch_id").collect()]
    assert outcomes == ["failed", "delivered", "rejected", *["failed"] * 4, "dropped", "delivered"]


def test_a_flush_takes_at_most_a_thousand_per_source(spark, scratch):
    sizes = []
    flusher = MetricFlusher(lambda e, i: sizes.append(e.count()) or 503, scratch + "/state")
    rows = spark.range(1050).select(
        F.lit("s").alias("source"), F.col("id").alias("seq"), F.lit("m").alias("name"), F.lit("2024-01-01").cast("timestamp").alias("recorded_at")
    )
    flusher(rows, 0)
    flusher(rows, 1)
    assert sizes == [1000, 1000]


def test_run_flush_hands_over_every_batch_once(spark, stream, scratch):
    source = stream("seq bigint", [[(1,), (2,)], [(3,)]])
    got = {}
    runs.run_flush(source, lambda df, i: got.setdefault(i, sorted(r.seq for r in df.collect())), scratch + "/checkpoint")
    assert got == {0: [1, 2], 1: [3]}
    runs.run_flush(source, lambda df, i: got.setdefault(i, []), scratch + "/checkpoint")
    assert len(got) == 2


def test_what_waits_keeps_its_place(spark, scratch):
    """A late row with an old time does not push out an entry that already waits."""
    seen = []
    flusher = MetricFlusher(lambda e, i: seen.append(sorted(r.name for r in e.collect())) or 503, scratch + "/state", limit=2)

    def rows(*named):
        data = [("s", i, name, day) for i, (name, day) in enumerate(named)]
        return spark.createDataFrame(data, "source string, seq bigint, name string, day string").selectExpr(
            "source", "seq", "name", "cast(day as timestamp) as recorded_at")

    flusher(rows(("new", "2024-01-05"), ("newer", "2024-01-06")), 0)
    flusher(rows(("late", "2023-01-01")), 1)
    assert seen == [["new", "newer"], ["new", "newer"]]


def test_a_failed_delivery_is_tried_again_without_new_rows(spark, stream, scratch):
    answers, seen = iter([503, 503, 202]), []

    def deliver(entries, batch_id):
        seen.append(sorted(r.name for r in entries.collect()))
        return next(answers)

    source = stream("source string, seq bigint, name string", [[("s", 1, "a")]])
    source = source.withColumn("recorded_at", F.lit("2024-01-01").cast("timestamp"))
    query = runs.run_flush(source, MetricFlusher(deliver, scratch + "/state"), scratch + "/checkpoint", "1 second")
    until = time.time() + 60
    while len(seen) < 3 and time.time() < until and query.exception() is None:
        time.sleep(0.5)
    runs.discard(query)
    assert seen == [["a"], ["a"], ["a"]]


def test_rows_that_lack_a_value_do_not_stop_a_stream(spark, stream, scratch):
    schema = "trace_id string, seq bigint, is_root boolean, duration_ms double, span string"
    batches = [[("a", 1, False, None, "a1"), ("b", 1, True, None, "b1")], [("a", 2, True, float("nan"), "a2"), ("c", 1, True, 2000.0, "c1")]]
    assembled = state.keyed(timed(stream(schema, batches)), "trace_id", state.TraceAssembler(), "1 hour")
    assert {r.trace_id for r in flushed(spark, assembled, scratch)} == {"c"}


def test_a_tally_passes_over_what_was_not_measured(spark, stream, scratch):
    schema = "source string, seq bigint, kind string, transaction_name string, duration_ms double, status int"
    batches = [[("s", 1, "record", "t", None, None), ("s", 2, "record", "t", 70.0, None), ("s", 3, "snapshot", None, None, None)],
               [("s", 4, "outcome", None, None, None), ("s", 5, "snapshot", None, None, None)]]
    rows = flushed(spark, state.keyed(timed(stream(schema, batches)), "source", state.TallyFlusher()), scratch)
    assert [(r.flush_seq, r.request_count, r.duration_sum_ms) for r in rows] == [(3, 1, 70.0), (5, 1, 70.0)]


def test_an_unfinished_trace_is_counted_when_it_is_given_up(spark, stream, scratch):
    schema = "trace_id string, seq bigint, is_root boolean, duration_ms double, span string"
    day = 86400
    batches = [[("a", 1, False, 1.0, "a1"), ("a", 2, False, 1.0, "a2")], [("b", 3 * day, True, 5000.0, "b1")], [("c", 6 * day, True, 1.0, "c1")]]
    assembled = state.keyed(timed(stream(schema, batches)), "trace_id", state.TraceAssembler(), "1 hour")
    got = {(r.trace_id, r.spans, r.root) for r in flushed(spark, assembled, scratch)}
    assert got == {("a", 2, None), ("b", 1, "b1")}
