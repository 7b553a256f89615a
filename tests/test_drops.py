"""Drops counted in passing, in batch and in streams, and users counted by sketches."""

import time

from helpers import values
from pyspark.sql import functions as F

from telemetry_spark.operators.drops import DropLedger, DropListener, keep_in_stream
from telemetry_spark.operators.issues import issue_sketches, issues, merged_issues
from telemetry_spark.streaming import runs, state


def test_a_ledger_counts_the_first_reason(spark):
    df = spark.createDataFrame([(i, None if i % 10 == 0 else float(i)) for i in range(100)], "id int, v double")
    ledger = DropLedger()
    kept = ledger.keep(df, "metric", {"no value": F.col("v").isNull(), "small": F.col("v") < 20, "odd id": F.col("id") % 2 == 1})
    none = ledger.keep(df, "other", {"never": F.lit(None).cast("boolean")})
    rows, every = kept.count(), none.count()
    got = {(s, r): n for s, r, n in values(ledger.report(spark))}
    want = {(s, r): df.where(c).count() for s, r, c in [
        ("metric", "no value", "v is null"), ("metric", "small", "v < 20"), ("metric", "odd id", "v >= 20 and id % 2 = 1")]}
    assert got == want and rows + sum(got.values()) == 100 and every == 100


def test_a_ledger_reads_its_input_once(spark, scratch):
    spark.range(1000).selectExpr("id", "id % 7 as v").write.parquet(scratch + "/in")
    ledger = DropLedger()
    kept = ledger.keep(spark.read.parquet(scratch + "/in"), "x", {"three": F.col("v") == 3})
    plan = kept._jdf.queryExecution().executedPlan().toString()
    kept.write.parquet(scratch + "/out")
    assert plan.count("FileScan") == 1 and values(ledger.report(spark)) == [("x", "three", 143)]


def test_a_stream_tells_what_it_drops_and_what_comes_late(spark, scratch):
    """Rows sent, dropped by a rule and dropped for coming late are all rows there were."""
    runs.prepare(spark)
    schema = "device string, seq bigint, kind string, id string, user string"
    batches = [[("d", i, "event", f"a{i}", "u") for i in range(1, 51)], [("d", 5000, "event", "b", "u")], [("d", 5001, "event", "c", None)],
               [("d", 3, "event", "late", "u"), ("d", 5002, "event", "d", "u"), ("d", 5003, "event", None, "u")], [("d", 9000, "event", "e", "u")]]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{scratch}/in/{i:03d}")
    listener = DropListener()
    spark.streams.addListener(listener)
    try:
        source = runs.file_stream(spark, f"{scratch}/in/*", schema, files_per_trigger=1).withColumn("at", F.timestamp_seconds("seq"))
        kept = keep_in_stream(source, "event", {"no id": F.col("id").isNull()})
        df = state.collected_in_order(kept, "device", state.UserState(), "1 minute")
        rows = df.count()
        until = time.time() + 30
        while time.time() < until and len({b for _, b, _, _ in listener.batches}) < len(batches):
            time.sleep(0.5)
    finally:
        spark.streams.removeListener(listener)
    got = {(s, r): n for s, r, n in values(listener.report(spark))}
    assert got == {("event", "no id"): 1, ("stream", "late"): 1} and rows + 2 == sum(map(len, batches))


def test_sketches_of_hours_merge_to_any_span(spark):
    """Exact for few users, within 2 % for many, whatever the hours they are merged from."""
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, "Rare").otherwise("Hot").alias("exception_class"), F.lit("boom").alias("message"),
        F.timestamp_seconds(1_700_000_000 + F.col("id") * 3).alias("occurred_at"),
        F.when(F.col("id") % 3 == 0, F.col("id") % 97).otherwise((F.col("id") * 7919) % 20_011).alias("user_id"),
    )
    hours = issue_sketches(df)
    assert hours.groupBy("exception_class").count().agg(F.min("count")).first()[0] >= 50
    want = {r.exception_class: r for r in issues(df).collect()}
    for r in merged_issues(hours).collect():
        exact = want[r.exception_class]
        assert (r.events, r.first_seen, r.last_seen) == (exact.events, exact.first_seen, exact.last_seen)
        assert r.affected_users == exact.affected_users if exact.affected_users < 100 else abs(r.affected_users / exact.affected_users - 1) < 0.02
    days = {(r.exception_class, r.period_started_at): r for r in merged_issues(hours, "1 day").collect()}
    exact = df.groupBy(F.window("occurred_at", "1 day").start.alias("d"), "exception_class").agg(F.count_distinct("user_id").alias("n")).collect()
    assert len(days) == len(exact)
    for r in exact:
        assert abs(days[r.exception_class, r.d].affected_users / r.n - 1) < (0.02 if r.n >= 100 else 1e-9)
