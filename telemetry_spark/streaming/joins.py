"""Errors and back-end requests joined to traces while both sides stream in."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_spark.functions.tracing import parse_traceparent
from telemetry_spark.operators.traces import trace_top
from telemetry_spark.streaming.runs import control_stream, flush_now, seconds_of

CLOCK = "__clock timestamp"


def with_clock(df: DataFrame, at: str, watermark: str, clock: str | None = None) -> DataFrame:
    """Rows with a watermark that the rows of a control folder move, too: without them a side that has gone quiet keeps the other's
    rows waiting. Rows without a time are left out, as no watermark would ever pass them."""
    timed = df.where(F.col(at).isNotNull()).withColumn("__clock", F.lit(None).cast("timestamp"))
    if clock is not None:
        # Read with the rows' own columns, which its files do not have: nulls that the optimizer does not know of and cannot fold.
        absent = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != at)
        ticks = control_stream(df.sparkSession, clock, f"{CLOCK}, {absent}" if absent else CLOCK)
        timed = timed.unionByName(ticks.withColumn(at, F.col("__clock")))
    # What is not deterministic stays where it is: filters of a join above would else move below the watermark, which has to see the clock's
    # rows. It also lets every column be null, so that state has one schema whether or not the clock has rows.
    marked = timed.withWatermark(at, watermark).withColumn("__live", F.spark_partition_id() >= 0)
    kept = marked.where(F.col(at).isNotNull() & ~F.col(at).eqNullSafe(F.col("__clock")))
    return kept.select(*[F.col(c) if c == at else F.when(F.col("__live"), F.col(c)).alias(c) for c in df.columns])


def _key(name: str) -> Column:
    """A join key that is never null, so that state has one schema whichever side has rows."""
    return F.coalesce(F.col(name), F.lit(""))


def set_clock(spark: SparkSession, clock: str, at: datetime) -> None:
    """Say that nothing from before ``at`` is to come any more, but for what the watermark allows."""
    spark.createDataFrame([(at,)], CLOCK).coalesce(1).write.mode("append").parquet(clock)


def stream_linked_errors(
    errors: DataFrame, spans: DataFrame, watermark: str = "10 minutes", gap: str = "1 hour", longest: str = "1 day", clock: str | None = None,
) -> DataFrame:
    """Each error (``occurred_at``, ``trace_id``) with its trace's root and number of spans, as ``link_errors_to_traces`` has it.

    A trace is complete when none of its spans has started for ``gap``; it then is one row, and the spans themselves are forgotten. An error
    is linked if it happened between the trace's first span and its completion, and waits for that at most ``longest`` and ``gap``; then it
    comes out without a trace. State is what lies within these times. A trace that pauses for longer than ``gap`` counts as several, which do
    not overlap, so no error comes out twice. Errors without a trace id or a time come out at once, without a trace.
    """
    sessions = with_clock(spans.where("trace_id is not null"), "started_at", watermark, clock).groupBy(
        "trace_id", F.session_window("started_at", gap).alias("__session"))
    known = sessions.agg(F.count(F.lit(1)).alias("trace_spans"), trace_top().alias("__top"))
    root = F.when(~F.col("__top.first.late"), F.col("__top"))
    known = known.select(
        _key("trace_id").alias("__trace"), F.col("__session.start").alias("__opened"), F.window_time("__session").alias("__closed"),
        "trace_spans", root["name"].alias("trace_name"), root["duration_ms"].alias("trace_duration_ms"),
    )
    waiting = "trace_id is not null and occurred_at is not null"
    # Spark reads off such a condition how long rows have to be kept, if the bound is one interval.
    wait = seconds_of(errors.sparkSession, longest, gap)
    within = F.expr(f"__key = __trace and occurred_at >= __opened and occurred_at <= __closed "
                    f"and occurred_at >= __closed - interval {wait} seconds")
    held = with_clock(errors.where(waiting), "occurred_at", watermark, clock).withColumn("__key", _key("trace_id"))
    linked = held.join(known, within, "left_outer")
    # Those that wait for nothing run beside the join under a watermark of their own, which Spark takes the least of.
    others = with_clock(errors.where("occurred_at is not null and trace_id is null"), "occurred_at", watermark, clock)
    linked = linked.drop("__key", "__trace", "__opened", "__closed").unionByName(others, allowMissingColumns=True)
    return linked.unionByName(errors.where("occurred_at is null"), allowMissingColumns=True)


def stream_stitched(
    client: DataFrame, backend: DataFrame, watermark: str = "10 minutes", within: str = "1 hour", ahead: str = "1 minute", clock: str | None = None,
) -> DataFrame:
    """Back-end roots under the client span whose id their ``traceparent`` names, as ``stitch_traces`` has it.

    A back-end request starts at most ``within`` after its caller's span and, as clocks differ, at most ``ahead`` before it. Either side
    waits in state for no longer than that. Headers that no tracer would write and rows without a time are left out.
    """
    parsed = parse_traceparent(F.col("traceparent"))
    continued = with_clock(backend, "started_at", watermark, clock).select(
        parsed["trace_id"].alias("trace_id"), parsed["parent_span_id"].alias("parent_span_id"),
        F.col("span_id").alias("backend_span_id"), F.col("name").alias("backend_name"), F.col("started_at").alias("__continued"),
    ).where("trace_id is not null and parent_span_id is not null").withColumns({"__key": _key("trace_id"), "__parent": _key("parent_span_id")})
    callers = with_clock(client, "started_at", watermark, clock).select(
        _key("trace_id").alias("__trace"), _key("span_id").alias("__span"), F.col("name").alias("client_name"), F.col("started_at").alias("__called"),
    )
    near = F.expr(f"__key = __trace and __parent = __span and __continued >= __called - interval {ahead} "
                  f"and __continued <= __called + interval {within}")
    return continued.join(callers, near).drop("__key", "__parent", "__trace", "__span", "__called", "__continued")


def flush_joined(df: DataFrame, path: str, checkpoint: str, clock: str, until: datetime) -> DataFrame:
    """Process everything that has arrived, set the clock to ``until`` so that nothing waits any longer, and stop. A later run goes on
    from here; what it brings from before ``until`` is late."""
    spark = df.sparkSession
    schema = df.schema
    flush_now(df, path, checkpoint)
    set_clock(spark, clock, until)
    flush_now(df, path, checkpoint)
    return spark.read.schema(schema).parquet(path)
