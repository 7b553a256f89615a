"""Tallies of a stream: sent by the watermark or when asked for, each record once."""

import pytest
from pyspark.sql import functions as F

from telemetry_spark.config import Config
from telemetry_spark.operators.performance import performance_samples
from telemetry_spark.streaming import runs
from telemetry_spark.streaming.tallies import collected_tallies, flush_open, partial_tallies, stream_tallies

SCHEMA = "transaction_name string, environment string, release string, s bigint, duration_ms double"


class Feed:
    """Rows written file by file, each file one micro-batch of a stream that can be stopped and taken up again."""

    def __init__(self, spark, scratch):
        runs.prepare(spark)
        self.spark, self.scratch, self.files = spark, scratch, 0

    def add(self, *rows):
        data = [(n, "production", None, s, ms) for n, s, ms in rows]
        self.spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{self.scratch}/in/{self.files:03d}")
        self.files += 1

    def source(self):
        df = runs.file_stream(self.spark, f"{self.scratch}/in/*", SCHEMA, files_per_trigger=1)
        return df.withColumn("ts", F.timestamp_seconds("s"))

    def samples(self, **options):
        return stream_tallies(self.source(), self.scratch + "/control", **options)

    def flush(self):
        flush_open(self.samples(), *(f"{self.scratch}/{name}" for name in ("out", "checkpoint", "control")))

    def sent(self):
        rows = self.spark.read.schema(self.samples().schema).parquet(self.scratch + "/out").collect()
        return sorted((r.transaction_name, r.period_started_at.minute, r.request_count, r.duration_sum_ms, r.max_duration_ms) for r in rows)


@pytest.fixture
def feed(spark, scratch):
    return Feed(spark, scratch)


def test_a_flush_sends_and_retires_what_is_open(spark, feed):
    """Nothing is sent twice: what comes into a flushed window afterwards is a tally of its own, and an idle flush sends nothing."""
    feed.add(("a", 0, 10.0), ("a", 59, 60.0), ("b", 30, 5.0))
    feed.flush()
    first = [("a", 0, 2, 70.0, 60.0), ("b", 0, 1, 5.0, 5.0)]
    assert feed.sent() == first and runs.state_rows(spark, feed.scratch + "/checkpoint", "tally").isEmpty()
    feed.flush()
    assert feed.sent() == first
    feed.add(("a", 20, 7.0))
    feed.flush()
    assert feed.sent() == [("a", 0, 1, 7.0, 7.0), *first]


def test_the_watermark_closes_windows_once_and_late_rows_are_dropped(feed):
    feed.add(("a", 0, 1.0))
    feed.add(("a", 3000, 1.0))  # closes the first window
    feed.add(("a", 3001, 2.0))
    feed.add(("a", 1, 1.0), ("a", 3002, 2.0))  # the first is late: its window has been sent
    feed.flush()
    assert feed.sent() == [("a", 0, 1, 1.0, 1.0), ("a", 50, 3, 5.0, 2.0)]


def test_the_stream_agrees_with_the_batch(spark, feed):
    rows = [(f"t{i % 5}" if i % 3 else "hot", (i * 37) % 900, float((i * 7919) % 12000)) for i in range(1500)]
    for start in range(0, 1500, 500):
        feed.add(*rows[start : start + 500])
    got = collected_tallies(feed.source(), every="1 minute", watermark="1 hour")
    want = performance_samples(feed.spark.read.schema(SCHEMA).parquet(feed.scratch + "/in/*").withColumn("ts", F.timestamp_seconds("s")), every="1 minute")
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))


def test_a_task_sends_few_rows_of_a_hot_key(spark):
    """A hundred thousand rows of one key and window leave a task as one row a bucket and Arrow batch."""
    df = spark.range(100_000, numPartitions=2).select(
        F.lit("hot").alias("transaction_name"), F.lit("p").alias("environment"), F.lit(None).cast("string").alias("release"),
        F.timestamp_seconds(F.col("id") % 60).alias("ts"), (F.col("id") % 40).cast("double").alias("duration_ms"))
    rows = partial_tallies(df).collect()
    assert len(rows) <= 2 * (50_000 // 1000 + 1) and sum(r.n for r in rows) == 100_000


def test_rows_that_lack_a_value_and_strict_names(feed):
    feed.add(("a", 1, None), ("a", None, 5.0), (None, 2, 3.0), ("/users/123/orders", 1, 5.0), ("/users/456/orders", 2, 6.0))
    rows = collected_tallies(feed.source(), cfg=Config(strict_privacy=True)).collect()
    got = {(r.transaction_name, r.request_count, r.duration_sum_ms, r.le_50) for r in rows}
    assert got == {("a", 1, 0.0, 0), (None, 1, 3.0, 1), ("/users/:path", 2, 11.0, 2)}
