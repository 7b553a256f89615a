"""Streams whose rows come out of order give what they would in order."""

import random

import pytest
from pyspark.sql import functions as F

from telemetry_spark.streaming import runs, state

CRUMB = "device string, seq bigint, kind string, id string, crumb string"
TALLY = "source string, seq bigint, kind string, transaction_name string, duration_ms double, status int"


@pytest.fixture
def stream(spark, scratch):
    runs.prepare(spark)

    def make(schema, batches):
        for i, rows in enumerate(batches):
            spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/in/{i:03d}")
        return runs.file_stream(spark, f"{scratch}/in/*", schema, files_per_trigger=1).withColumn("at", F.timestamp_seconds("seq"))

    return make


def brute_trails(rows, size):
    rings, out = {}, {}
    for device, _, kind, name, crumb in sorted(rows, key=lambda r: (r[0], r[1])):
        ring = rings.setdefault(device, [])
        if kind == "crumb":
            ring.append(crumb)
        elif kind == "clear":
            ring.clear()
        else:
            out[name] = ring[-size:]
    return out, {d: r[-size:] for d, r in rings.items() if r}


def scattered(rows, batches, late):
    """Rows dealt to micro-batches by their time and a lateness of up to ``late`` seconds, in no order inside."""
    rng, out, last = random.Random(8), [[] for _ in range(batches)], max(r[1] for r in rows) + late + 1
    for row in rows:
        out[(row[1] + rng.randrange(late)) * batches // last].append(row)
    for batch in out:
        rng.shuffle(batch)
    return out


def test_trails_of_a_scattered_stream(spark, stream, scratch):
    rng = random.Random(2)
    rows = [(rng.choice(["hot", "hot", "a", "b"]), i, rng.choices(["crumb", "error", "clear"], [20, 4, 1])[0], f"e{i}", f"c{i}") for i in range(600)]
    want, kept = brute_trails(rows, 5)
    df, checkpoint = stream(CRUMB, scattered(rows, 3, 60)), scratch + "/checkpoint"
    got = state.collected_in_order(df, "device", state.BreadcrumbRing(5), "90 seconds", checkpoint)
    assert {r.id: r.trail for r in got.collect()} == want
    assert {r.device: r.trail for r in state.kept_trails(spark, checkpoint).collect()} == kept
    assert runs.state_rows(spark, checkpoint, "waiting").isEmpty() and runs.state_rows(spark, checkpoint, "chunks").isEmpty()


def test_rows_of_a_hot_key_are_kept_in_the_chunks_they_came_in(spark, stream, scratch):
    rows = [("hot", 1 + i % 50, "crumb", None, f"c{i}") for i in range(2500)]
    rows += [("hot", 50, "error", "e", None)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 500)
    try:
        df = state.keyed(stream(CRUMB, [rows]), "device", state.BreadcrumbRing(), "1 hour")
        runs.flush_now(df, scratch + "/out", scratch + "/checkpoint")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    chunks = runs.state_rows(spark, scratch + "/checkpoint", "chunks").select("user_map_key.*", "user_map_value.rows")
    assert chunks.count() >= 5 and chunks.select("slot").distinct().count() == 1


def test_a_user_set_late_still_counts(stream):
    schema = "device string, seq bigint, kind string, id string, user string"
    df = stream(schema, [[("d", 10, "event", "e1", None), ("d", 30, "event", "e2", "own")], [("d", 5, "set", None, "ada"), ("d", 20, "set", None, None)],
                         [("d", 25, "event", "e3", None), ("d", None, "event", "e4", None)]])
    got = state.collected_in_order(df, "device", state.UserState(), "5 minutes")
    assert {r.id: r.user for r in got.collect()} == {"e1": "ada", "e2": "own", "e3": None}


def rec(at, ms, name="x"):
    return ("s", at, "record", name, ms, None)


def outcome(at, status):
    return ("s", at, "outcome", None, None, status)


def test_flushes_fall_due_by_themselves_and_say_their_period(stream):
    """A failed flush is tried again at the next multiple with what has come in since, from the same start; a timer sends the last."""
    batches = [
        [rec(70, 300.0), rec(10, 20.0), outcome(61, 503)], [outcome(121, 202), rec(65, 5.0, "y")],
        [rec(200, 9000.0)], [rec(4000, 1.0)],
    ]
    got = state.collected_in_order(stream(TALLY, batches), "source", state.TallyFlusher(interval_ms=60_000), "10 minutes")
    rows = sorted((r.flush_seq, r.transaction_name, r.request_count, r.duration_sum_ms, r.max_duration_ms, r.histogram,
                   r.period_started_at.minute * 60 + r.period_started_at.second, r.period_ended_at.minute * 60 + r.period_ended_at.second) for r in got.collect())
    assert rows == [
        (1, "x", 1, 20.0, 20.0, {"50": 1}, 10, 60),
        (2, "x", 2, 320.0, 300.0, {"50": 1, "500": 1}, 10, 120), (2, "y", 1, 5.0, 5.0, {"50": 1}, 10, 120),
        (3, "x", 1, 9000.0, 9000.0, {"10000": 1}, 120, 240),
    ]


def test_state_is_kept_by_transaction_and_label(spark, stream, scratch):
    df = state.keyed(stream(TALLY, [[rec(1, 20.0), rec(2, 300.0), rec(3, 30.0, "y")]]), "source", state.TallyFlusher())
    runs.flush_now(df, scratch + "/out", scratch + "/checkpoint")
    tallies = runs.state_rows(spark, scratch + "/checkpoint", "tallies").select("user_map_key.*", "user_map_value.*").collect()
    assert {(r.transaction_name, r.n, r.total) for r in tallies} == {("x", 2, 320.0), ("y", 1, 30.0)}
    labels = runs.state_rows(spark, scratch + "/checkpoint", "labels").select("user_map_key.*", "user_map_value.n").collect()
    assert {tuple(r) for r in labels} == {("x", "50", 1), ("x", "500", 1), ("y", "50", 1)}


def test_keys_of_a_bucket_wait_together(spark, stream, scratch):
    """What a call and a timer cost is shared by the keys of a bucket; each key's trail stays its own."""
    rows = [(f"d{i % 1500}", 1 + i // 1500, "crumb", None, f"c{i}") for i in range(3000)]
    df = state.keyed(stream(CRUMB, [rows]), "device", state.BreadcrumbRing(), "1 hour")
    runs.flush_now(df, scratch + "/out", scratch + "/checkpoint")
    assert runs.state_rows(spark, scratch + "/checkpoint", "waiting").count() <= state.BUCKETS


def test_sources_of_a_bucket_keep_their_own_tallies(spark, stream):
    rows = [(f"s{i % 700}", 10 + i // 700, "record", "x", float(i % 700), None) for i in range(1400)]
    rows += [(f"s{i}", 20, "snapshot", None, None, None) for i in range(700)]
    got = state.collected_in_order(stream(TALLY, [rows]), "source", state.TallyFlusher(), "1 minute").collect()
    assert {(r.source, r.request_count, r.duration_sum_ms) for r in got} == {(f"s{i}", 2, 2.0 * i) for i in range(700)}
