"""Span trees against brute force."""

import random

from helpers import values
from pyspark.sql import functions as F

from telemetry_spark.config import Config
from telemetry_spark.operators import traces

SPAN = "trace_id string, span_id string, parent_span_id string, name string, kind string, duration_ms double, seq int, data string"


def spans(spark, rows):
    df = spark.createDataFrame(rows, SPAN)
    at = F.timestamp_millis(F.lit(1700000000123) + F.col("seq"))
    return df.withColumns({"started_at": at, "environment": F.lit("production"), "release": F.lit(None).cast("string")})


def test_threshold_drops_below_and_keeps_equal(spark):
    rows = [("slow", "r", None, "a", "controller", 1000.0, 0, "{}"), ("slow", "c", "r", "b", "http", 1.0, 1, "{}"),
            ("fast", "r", None, "a", "controller", 999.99, 0, "{}")]
    assert {r.trace_id for r in traces.slow_traces(spans(spark, rows)).collect()} == {"slow"}


def test_a_trace_holds_500_spans_root_first(spark):
    rows = [("t", f"s{i}", "r", "q", "database", 1.0, i, "{}") for i in range(700)]
    rows += [("t", "r", None, "root", "controller", 5000.0, 900, "{}")]
    got = traces.assemble_traces(spans(spark, rows), [F.col("seq")]).first().spans
    assert len(got) == 500 and got[0].name == "root" and got[0].parent_span_id is None
    assert [s.span_id for s in got[1:]] == [f"s{i}" for i in range(499)]
    assert got[1].started_at == "2023-11-14T22:13:20.123Z"


def test_a_trace_without_its_root_leaves_room_for_it(spark):
    rows = [("t", f"s{i}", "r", "q", "database", 1.0, i, "{}") for i in range(700)]
    assert traces.cap_spans(spans(spark, rows), [F.col("seq")]).agg(F.count("*"), F.max("seq")).first() == (499, 498)


def test_the_longest_of_several_roots_decides_and_all_stay(spark):
    rows = [("t", "c", "r1", "c", "service", 9000.0, 0, "{}"), ("t", "r1", None, "first", "controller", 5.0, 1, "{}"),
            ("t", "r2", None, "second", "controller", 1000.0, 2, "{}"), ("t", "c", "r1", "a", "service", 2.0, 0, "{}"),
            ("fast", "r", None, "r", "controller", 999.0, 0, "{}"), ("fast", "c", "r", "c", "service", 5000.0, 1, "{}"),
            ("rootless", "c", "r", "c", "service", 5000.0, 1, "{}"), ("unknown", "r", None, "r", "controller", None, 1, "{}"),
            (None, "r", None, "r", "controller", 2000.0, 0, "{}"), (None, "c", "r", "c", "service", 1.0, 0, "{}")]
    given = spans(spark, rows).repartition(3)
    got = {r.trace_id: [s.name for s in r.spans] for r in traces.assemble_traces(given, [F.col("seq")]).collect()}
    assert got == {"t": ["first", "second", "a", "c"], None: ["r", "c"]}  # spans that tie go by their own fields
    assert set(values(traces.cap_spans(given, [F.col("seq")], 500, 1.0).groupBy("trace_id").count())) == {("t", 4), (None, 2)}
    assert traces.cap_spans(given, [F.col("seq")], 500, 1.0).columns == given.columns


def test_a_strict_trace_reduces_every_span(spark):
    rows = [
        ("t", "r", None, "GET /patients/42/notes", "controller", 5000.0, 0, "{}"),
        ("t", "h", "r", "GET https://api.example.com/patients/42?q=jane", "http", 1.0, 1, '{"status":200}'),
        ("t", "d", "r", "SELECT notes", "database", 1.0, 2, '{"rows":3,"db.statement":"SELECT ?","db.system":"sqlite"}'),
    ]
    got = traces.assemble_traces(spans(spark, rows), [F.col("seq")], Config(strict_privacy=True)).first().spans
    assert [s.name for s in got] == ["GET /patients/:path", "GET api.example.com", "SELECT notes"]
    assert [s.data for s in got] == [None, None, '{"db.statement":"SELECT ?","db.system":"sqlite"}']


def test_tree_of_a_chain_a_star_and_an_orphan(spark):
    chain = [("chain", f"s{i}", f"s{i - 1}" if i else None, f"n{i}", "service", 1.0, i, "{}") for i in range(60)]
    star = [("star", "r", None, "r", "service", 1.0, 0, "{}")]
    star += [("star", f"c{i}", "r", f"c{i}", "service", 1.0, i, "{}") for i in range(50)]
    orphans = [("lost", "a", "missing", "a", "service", 1.0, 0, "{}"), ("lost", "b", "a", "b", "service", 1.0, 1, "{}")]
    cycle = [("loop", "a", "b", "a", "service", 1.0, 0, "{}"), ("loop", "b", "a", "b", "service", 1.0, 1, "{}")]
    got = traces.span_tree(spans(spark, chain + star + orphans + cycle))
    depth = {(r.trace_id, r.span_id): r.depth for r in got.collect()}
    assert depth == {("chain", f"s{i}"): i for i in range(60)} | {("star", "r"): 0} | {("star", f"c{i}"): 1 for i in range(50)}
    path = got.where("trace_id = 'chain' and span_id = 's3'").first().path
    assert path == ["n0", "n1", "n2", "n3"]


def nested(rng, start, end, depth, out):
    """Calls within ``[start, end)``, each holding further calls."""
    at = start
    while at < end - 2 and len(out) < 400:
        at += rng.randint(1, 6)
        stop = min(end, at + rng.randint(1, 40))
        if stop - at < 2:
            break
        out.append((at, stop, rng.random() < 0.8))
        if out[-1][2] and depth < 6:
            nested(rng, at, stop, depth + 1, out)
        at = stop


def test_parents_are_the_innermost_open_span(spark):
    rng = random.Random(11)
    rows, want = [], {}
    for trace in ("t1", "t2"):
        rows.append((trace, "main", f"{trace}-root", 0, 1000, True, True))
        for thread in ("main", "worker"):
            calls = []
            nested(rng, 0, 300, 0, calls)
            named = [(f"{trace}-{thread}-{i}", *c) for i, c in enumerate(calls)]
            for name, start, stop, opens in named:
                rows.append((trace, thread, name, start, stop, opens, False))
                holders = [(s, -e, n) for n, s, e, o in named if o and s < start < e]
                want[name] = max(holders)[2] if holders else f"{trace}-root"
    schema = "trace_id string, thread string, span_id string, s int, e int, opens boolean, is_root boolean"
    df = spark.createDataFrame(rows, schema).select(
        "trace_id", "thread", "span_id", F.timestamp_seconds("s").alias("started_at"), F.timestamp_seconds("e").alias("ended_at"),
        "opens", "is_root",
    )
    got = {r.span_id: r.parent_span_id for r in traces.infer_parents(df, slice_seconds=20).collect()}
    assert {k: v for k, v in got.items() if not k.endswith("root")} == want
    assert got["t1-root"] is None


def test_finish_is_idempotent_and_late_spans_are_dropped(spark):
    recorded = spark.createDataFrame(
        [("t", "a", 1), ("t", "a", 2), ("t", "b", 5), ("t", "late", 9), ("open", "x", 99)], "trace_id string, span_id string, s int"
    ).withColumn("recorded_at", F.timestamp_seconds("s"))
    finishes = spark.createDataFrame([("t", 5), ("t", 20)], "trace_id string, s int").select(
        "trace_id", F.timestamp_seconds("s").alias("finished_at")
    )
    got = traces.dedupe_finish(recorded, finishes)
    assert sorted(values(got, "trace_id", "span_id", "s")) == [("open", "x", 99), ("t", "a", 1), ("t", "b", 5)]


def test_request_spans_and_links(spark):
    calls = spark.createDataFrame(
        [(None, "POST", "https://api.example.com/orders/42", 201), (None, None, None, None), ("create order", "GET", "x", 200)],
        "name string, method string, url string, status int",
    )
    got = traces.request_spans(calls).collect()
    assert [(r.name, r.data) for r in got] == [
        ("POST api.example.com", '{"status":201}'), ("GET unknown host", "{}"), ("create order", '{"status":200}')
    ]
    events = spark.createDataFrame([(1, "t"), (2, None), (3, "gone")], "id int, trace_id string")
    rows = [("t", "r", None, "root", "controller", 7.0, 0, "{}"), ("t", "c", "r", "c", "http", 1.0, 1, "{}")]
    linked = {r.id: (r.trace_name, r.trace_spans) for r in traces.link_errors_to_traces(events, spans(spark, rows)).collect()}
    assert linked == {1: ("root", 2), 2: (None, None), 3: (None, None)}


def test_tracing_off_records_nothing(spark):
    rows = [("t", "r", None, "root", "db", 7.005, 0, "{}")]
    df = spans(spark, rows)
    assert traces.spans(df, Config(track_tracing=False)).isEmpty()
    built = traces.spans(df).first()
    assert (built.kind, built.duration_ms) == ("other", 7.01)  # 7.005 * 100 is 700.5, rounded half up
