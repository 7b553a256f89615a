"""The streaming operators, each over the events as a file source, held against SQL over the same table."""

from __future__ import annotations

from pyspark import TaskContext
from pyspark.sql import functions as F

from telemetry_spark.config import MAX_BATCH_ENTRIES, Config
from telemetry_spark.operators import changes as change
from telemetry_spark.operators.performance import PERIOD
from telemetry_spark.plans.session import fresh_dir
from telemetry_spark.sources.reports import CORRUPT
from telemetry_spark.streaming import state
from telemetry_spark.streaming.flush import MetricFlusher
from telemetry_spark.streaming.ingest import stream_reports
from telemetry_spark.streaming.joins import flush_joined, stream_linked_errors, stream_stitched
from telemetry_spark.streaming.runs import collected, file_stream, flush_now, prepare, run_flush
from telemetry_spark.streaming.sink import FolderReceiver, folder_at, received, run_delivery
from telemetry_spark.streaming.tallies import collected_tallies
from telemetry_spark.streaming.windows import stream_changes
from telemetry_spark.functions.timefmt import iso_seconds
from telemetry_spark.functions.tracing import traceparent
from workload.delivery import QUEUE_LIMIT, QUEUE_SQL
from workload.events import CLEARS, REPORTING, TRAILS_SQL, USERS_SQL
from workload.performance import PERFORMANCE_SAMPLES_SQL
from workload.tables import events, hex_id, hex_sql, iso_sql, item

EVENT_SCHEMA = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
#: Events arrive in micro-batches of so many days of the month.
BATCH_DAYS = 8
BATCH_SQL = f"(day(ts) - 1) // {BATCH_DAYS}"


#: How late an event may come in a scattered stream, what the watermark allows, and how much of a key's time is replayed at once.
LATE_DAYS, LATE_WATERMARK, SLOT_MS = 1, "2 days", state.DAY_MS


def event_stream(spark, sf, scattered=False):
    """The events as they would arrive: written out days by days, each part one micro-batch of the stream. In a scattered stream an
    event may come up to a day late, so that of the days around the end of a part some events come in the next one."""
    prepare(spark)
    path, files = fresh_dir(spark, "event-files"), spark.sparkContext.defaultParallelism
    rows = spark.read.parquet(f"{sf}/events.parquet")
    late = F.pmod(F.xxhash64("event_id"), F.lit(100)) / 100 * LATE_DAYS if scattered else F.lit(0)
    seconds = F.hour("ts") * 3600 + F.minute("ts") * 60 + F.second("ts")
    part = F.floor((F.dayofmonth("ts") - 1 + seconds / 86400 + late) / BATCH_DAYS)
    for number in range(31 // BATCH_DAYS + 1):
        rows.where(part == number).repartition(files, "event_id").write.mode("append").parquet(path)
    df = file_stream(spark, path, EVENT_SCHEMA, files_per_trigger=files)
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def streamed_performance(spark, sf):
    """Hourly tallies: of the windows the watermark has closed, and of those that are open when the stream is flushed."""
    timings = event_stream(spark, sf).select(
        F.col("event_type").alias("transaction_name"), F.lit("production").alias("environment"),
        F.lit(None).cast("string").alias("release"), "ts", (F.col("value") * 20).alias("duration_ms"),
    )
    sent = collected_tallies(timings, every="1 hour")
    stamped = {c: iso_seconds(F.col(c)) for c in PERIOD}
    return sent.withColumns({"duration_sum_ms": F.round("duration_sum_ms", 4), **stamped}).drop("environment", "release")


def in_order(rows, key, processor, **options):
    processor.slot_ms = SLOT_MS
    return state.collected_in_order(rows, key, processor, LATE_WATERMARK, **options)


def trail_rows(spark, sf):
    kind = F.when(F.col("event_type") == "error", "error").when(F.expr(CLEARS), "clear").otherwise("crumb")
    return event_stream(spark, sf, scattered=True).select(
        "user_id", F.col("ts").alias("at"), F.col("event_id").alias("seq"), kind.alias("kind"),
        F.col("event_id").cast("string").alias("id"), F.col("event_id").cast("string").alias("crumb"),
    )


def streamed_trails(spark, sf):
    """Trails of errors out of a stream that comes out of order."""
    found = in_order(trail_rows(spark, sf), "user_id", state.BreadcrumbRing())
    return found.select(
        F.col("id").cast("bigint").alias("event_id"), "crumbs", F.array_join("trail", ",").alias("trail")
    )


def kept_trails(spark, sf):
    """The trails a stream still keeps when all events have come, read out of its state."""
    checkpoint = fresh_dir(spark, "kept-trails")
    in_order(trail_rows(spark, sf), "user_id", state.BreadcrumbRing(), checkpoint=checkpoint)
    kept = state.kept_trails(spark, checkpoint)
    return kept.select("user_id", F.size("trail").alias("crumbs"), F.array_join("trail", ",").alias("trail"))


KEPT_TRAILS_SQL = f"""
WITH c AS (SELECT user_id, event_id, ts, max(CASE WHEN {CLEARS} THEN (ts, event_id) END) OVER (PARTITION BY user_id) AS cleared
           FROM events WHERE event_type <> 'error'),
n AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM c
      WHERE cleared IS NULL OR (ts, event_id) > cleared)
SELECT user_id, count(*)::INTEGER AS crumbs, string_agg(event_id, ',' ORDER BY n DESC) AS trail FROM n WHERE n <= 30 GROUP BY user_id"""


def streamed_users(spark, sf):
    """Users of errors out of a stream that comes out of order."""
    rows = event_stream(spark, sf, scattered=True).where("event_type in ('signup', 'purchase', 'error')")
    user = F.when(F.col("event_type") == "signup", item(rows).cast("string")).when(
        (F.col("event_type") == "error") & (F.col("value") > 40), "explicit"
    )
    shaped = rows.select(
        "user_id", F.col("ts").alias("at"), F.col("event_id").alias("seq"),
        F.when(F.col("event_type") == "error", "event").otherwise("set").alias("kind"),
        F.concat_ws(":", "user_id", "event_id").alias("id"), user.alias("user"),
    )
    found = in_order(shaped, "user_id", state.UserState())
    ids = F.split("id", ":")
    return found.select(ids[0].cast("bigint").alias("user_id"), ids[1].cast("bigint").alias("event_id"), "user")


def streamed_traces(spark, sf):
    """A trace per order-like group of ten events, the first purchase its root; all spans before it, none after it."""
    rows = event_stream(spark, sf)
    shaped = rows.select(
        F.floor(F.col("event_id") / 10).cast("string").alias("trace_id"), F.col("ts").alias("at"),
        F.col("event_id").alias("seq"), F.col("event_id").cast("string").alias("span_id"),
        (F.col("event_type") == "purchase").alias("is_root"), (F.col("value") * 40).alias("duration_ms"),
        F.col("event_id").cast("string").alias("span"),
    )
    found = collected(state.keyed(shaped, "trace_id", state.TraceAssembler(limit=None, ttl_ms=60 * state.DAY_MS), "10 minutes"), "stream-traces")
    return found.where("root is not null").select("trace_id", "spans", "root", F.array_join("rest", ",").alias("rest"))


STREAM_TRACES_SQL = """
WITH e AS (SELECT *, event_id // 10 AS trace, row_number() OVER (PARTITION BY event_id // 10 ORDER BY ts, event_id) AS n
           FROM events),
r AS (SELECT trace, arg_min(event_id, n) AS root, arg_min(value, n) AS value, min(n) AS n FROM e
      WHERE event_type = 'purchase' GROUP BY trace)
SELECT r.trace::VARCHAR AS trace_id, CAST(r.n AS INTEGER) AS spans, r.root::VARCHAR AS root,
       coalesce(string_agg(e.event_id, ',' ORDER BY e.n) FILTER (e.n < r.n), '') AS rest
FROM r JOIN e USING (trace) WHERE r.value * 40 >= 1000 GROUP BY r.trace, r.n, r.root"""


def strict_streamed_traces(spark, sf):
    """Traces of ten events each with names that tell too much, reduced before they are kept; a purchase is the root."""
    rows = event_stream(spark, sf)
    recorded = rows.select(
        F.floor(F.col("event_id") / 10).cast("string").alias("trace_id"), F.col("event_id").cast("string").alias("span_id"),
        F.when(F.col("event_type") != "purchase", "up").alias("parent_span_id"), F.concat(F.lit("GET https://api.example.com/users/"), "user_id").alias("name"),
        F.lit("http").alias("kind"), F.col("ts").alias("started_at"), (F.col("value") * 40).alias("duration_ms"),
        F.lit("production").alias("environment"), F.lit(None).cast("string").alias("release"), F.lit('{"status":200,"who":"ada"}').alias("data"),
        F.col("event_id").alias("seq"),
    )
    found = collected(state.stream_traces(recorded, Config(strict_privacy=True), ttl_ms=60 * state.DAY_MS), "strict-traces")
    root = F.from_json("root", "name string, span_id string")
    return found.where("root is not null").select("trace_id", "spans", root["span_id"].alias("root"), root["name"].alias("name"))


STRICT_STREAM_SQL = """
WITH e AS (SELECT *, event_id // 10 AS trace, row_number() OVER (PARTITION BY event_id // 10 ORDER BY ts, event_id) AS n FROM events),
r AS (SELECT trace, arg_min(event_id, n) AS root, arg_min(value, n) AS value, min(n) AS n FROM e WHERE event_type = 'purchase' GROUP BY trace)
SELECT trace::VARCHAR AS trace_id, n::INTEGER AS spans, root::VARCHAR AS root, 'GET api.example.com' AS name FROM r WHERE value * 40 >= 1000"""


def streamed_admission(spark, sf):
    moves = event_stream(spark, sf).select(
        F.col("user_id").cast("string").alias("source"), F.col("ts").alias("at"), F.col("event_id").alias("seq"),
        F.col("event_id").cast("string").alias("trace_id"),
        F.when(F.col("event_type").isin("click", "purchase"), -1).otherwise(1).alias("delta"),
    )
    found = collected(state.keyed(moves, "source", state.QueueAdmission(QUEUE_LIMIT)), "stream-admission")
    return found.select(
        F.col("source").cast("bigint").alias("source"), F.col("trace_id").cast("bigint").alias("trace_id"),
        "admitted", "pending",
    )


ADMISSION_SQL = f"SELECT source, trace_id, admitted, pending FROM ({QUEUE_SQL})"


def streamed_tallies(spark, sf):
    """Tallies per user: a purchase is a flush that succeeds, a click one that fails, everything else a timing. They come out of order."""
    rows = event_stream(spark, sf, scattered=True)
    base = rows.select(
        F.col("user_id").cast("string").alias("source"), F.col("ts").alias("at"), "event_id",
        F.when(F.col("event_type").isin("purchase", "click"), F.array(F.lit("snapshot"), F.lit("outcome")))
        .otherwise(F.array(F.lit("record"))).alias("kinds"),
        F.lit("all").alias("transaction_name"), (F.col("value") * 20).alias("duration_ms"),
        F.when(F.col("event_type") == "purchase", 200).otherwise(503).alias("status"),
    )
    moves = base.select("*", F.posexplode("kinds").alias("step", "kind")).select(
        "source", "at", (F.col("event_id") * 2 + F.col("step")).alias("seq"), "kind", "transaction_name", "duration_ms",
        "status",
    )
    found = in_order(moves, "source", state.TallyFlusher())
    return found.select(
        F.col("source").cast("bigint").alias("source"), F.floor(F.col("flush_seq") / 2).alias("event_id"),
        "request_count", F.round("duration_sum_ms", 4).alias("duration_sum_ms"), "max_duration_ms",
        F.coalesce(F.try_element_at("histogram", F.lit("50")), F.lit(0)).alias("le_50"),
        F.coalesce(F.try_element_at("histogram", F.lit("500")), F.lit(0)).alias("le_500"),
        *[iso_seconds(F.col(c)).alias(c) for c in PERIOD],
    )


TALLIES_SQL = f"""
WITH RECURSIVE m AS (
  SELECT user_id AS source, event_id, event_type, ts, value * 20 AS d,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events),
w AS (
  SELECT source, 0 AS n, NULL::BIGINT AS event_id, 0 AS failures, []::DOUBLE[] AS held, false AS flush, []::DOUBLE[] AS sent,
         ts AS started, ts AS sent_started, ts AS ended
  FROM m WHERE n = 1
  UNION ALL
  SELECT m.source, m.n, m.event_id,
    CASE WHEN m.event_type = 'click' AND len(w.held) > 0 THEN (w.failures + 1) % 5
         WHEN m.event_type = 'purchase' AND len(w.held) > 0 THEN 0 ELSE w.failures END,
    CASE WHEN m.event_type = 'purchase' OR (m.event_type = 'click' AND w.failures = 4) THEN []::DOUBLE[]
         WHEN m.event_type = 'click' THEN w.held ELSE list_append(w.held, m.d) END,
    m.event_type IN ('click', 'purchase') AND len(w.held) > 0, w.held,
    CASE WHEN len(w.held) > 0 AND (m.event_type = 'purchase' OR m.event_type = 'click' AND w.failures = 4) THEN m.ts ELSE w.started END,
    w.started, m.ts
  FROM w JOIN m ON m.source = w.source AND m.n = w.n + 1)
SELECT source, event_id, len(sent) AS request_count, round(list_sum(sent), 4) AS duration_sum_ms,
  CASE WHEN list_max(sent) > 0 THEN list_max(sent) ELSE 0 END AS max_duration_ms,
  len(list_filter(sent, lambda d: d <= 50)) AS le_50, len(list_filter(sent, lambda d: d > 250 AND d <= 500)) AS le_500,
  {iso_sql('sent_started')} AS period_started_at, {iso_sql('ended')} AS period_ended_at
FROM w WHERE flush"""


def streamed_changes(spark, sf):
    """Changes named by user and day, each name once."""
    records = event_stream(spark, sf).select(
        F.col("event_type").alias("kind"), F.col("event_type").alias("title"), F.lit(None).cast("string").alias("environment"),
        F.col("ts").alias("occurred_at"), F.lit(None).cast("string").alias("details"), F.lit(None).cast("string").alias("service"),
        F.lit(None).cast("string").alias("actor"), F.lit(None).cast("string").alias("url"),
        F.when(F.col("event_type") != "view", F.concat_ws("-", "user_id", F.dayofmonth("ts"))).alias("id"),
    )
    return collected(stream_changes(change.changes(records), "31 days"), "stream-changes").groupBy("id").agg(
        F.count(F.lit(1)).alias("records")
    )


STREAM_CHANGES_SQL = """
SELECT DISTINCT user_id || '-' || day(ts) AS id, 1 AS records FROM events WHERE event_type <> 'view'
UNION ALL SELECT NULL, count(*) FROM events WHERE event_type = 'view'"""


def streamed_metrics(spark, sf):
    """Metrics through a flusher whose delivery writes them: what a buffer holds of each kind goes out in a flush."""
    rows = event_stream(spark, sf).select(
        F.col("event_type").alias("source"), F.col("event_id").alias("seq"), "value", F.col("ts").alias("recorded_at")
    )
    sent = fresh_dir(spark, "stream-metrics")

    def deliver(entries, batch_id):
        entries.write.mode("overwrite").parquet(f"{sent}/batch={batch_id}")
        return 202

    run_flush(rows, MetricFlusher(deliver, fresh_dir(spark, "flush-state")), fresh_dir(spark, "flush-checkpoint"))
    return spark.read.parquet(sent).select("source", "seq", "value")


STREAM_METRICS_SQL = f"""
SELECT event_type AS source, event_id AS seq, value FROM events
QUALIFY row_number() OVER (PARTITION BY event_type, {BATCH_SQL} ORDER BY ts, event_id) <= {MAX_BATCH_ENTRIES}"""


#: A folder of reports holds so many at most, so that many tasks share in listing them.
FOLDER_FILES = 1000


def write_files(df, path):
    """A file for each row, of its ``text`` and under its ``name``, in folders of each task. Through Spark's own writers a file would be
    a folder of its own and take half a dozen commands of the system. A task that runs again writes its files over."""

    def write(batches):
        system, root = folder_at(path)
        rows = (row for batch in batches for row in zip(*batch.columns, strict=True))
        for n, (name, text) in enumerate(rows):
            folder = f"{root}/{TaskContext.get().partitionId()}-{n // FOLDER_FILES}"
            if n % FOLDER_FILES == 0:
                system.create_dir(folder)
            with system.open_output_stream(f"{folder}/{name}") as out:
                out.write(text.as_buffer())
        yield from ()

    df.select("name", "text").mapInArrow(write, "n bigint").write.format("noop").mode("overwrite").save()


def ingested_reports(spark, sf):
    """Every user's last error as a file of their own, read as a stream in two goes with a restart in between: a JSON document, or for
    every third user a raw signal report. Every fifth of the others left a file that holds no document."""
    prepare(spark)
    failed = events(spark, sf).where("event_type = 'error'").groupBy("user_id").agg(F.max("event_id").alias("event_id"))
    broken = F.when(F.col("user_id") % 5 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    path, archive, out, checkpoint = (fresh_dir(spark, f"reports-{name}") for name in ("in", "archive", "out", "checkpoint"))
    signal = F.concat(F.lit("Abort trap\n0   Shop 0x1 u"), "user_id", F.lit("@example.com + "), "event_id")
    # Two documents in one file are no document.
    documents = F.transform(broken, lambda n: F.to_json(F.struct(
        F.lit("E").alias("exception_class"), F.concat(F.lit("failed "), "event_id").alias("message"), n.alias("n"))))
    is_signal = F.col("user_id") % 3 == 0
    for half in range(2):
        # The number is given, or so few bytes would meet in one task, which would write all the files.
        own = failed.where(F.col("user_id") % 2 == half).repartition(4 * spark.sparkContext.defaultParallelism, "user_id")
        write_files(own.select(
            F.concat(F.lit("u="), "user_id", F.when(is_signal, ".txt").otherwise(".json")).alias("name"),
            F.concat(F.when(is_signal, F.coalesce(signal, F.lit(""))).otherwise(F.array_join(documents, "\n")), F.lit("\n")).alias("text")), path)
        rows = stream_reports(spark, path, REPORTING, archive, files_per_trigger=1000)
        flush_now(rows.select("exception_class", "message", F.element_at("backtrace", 1)["method"].alias("method"), CORRUPT), out, checkpoint)
    read = spark.read.schema(f"exception_class string, message string, method string, {CORRUPT} string").parquet(out)
    return read.select("exception_class", "message", "method", F.length(CORRUPT).alias("corrupt_letters"))


INGESTED_SQL = """
WITH e AS (SELECT user_id, max(event_id) AS event_id FROM events WHERE event_type = 'error' GROUP BY user_id)
SELECT CASE WHEN user_id % 3 = 0 THEN 'Signal: Abort trap' WHEN user_id % 5 <> 0 THEN 'E' END AS exception_class,
  CASE WHEN user_id % 3 = 0 THEN 'Uncaught fatal signal: Abort trap' WHEN user_id % 5 <> 0 THEN 'failed ' || event_id END AS message,
  CASE WHEN user_id % 3 = 0 THEN '0   Shop 0x1 [EMAIL FILTERED] + ' || event_id END AS method,
  CASE WHEN user_id % 3 <> 0 AND user_id % 5 = 0
       THEN 2 * length('{"exception_class":"E","message":"failed ' || event_id || '","n":1}' || chr(10)) END AS corrupt_letters
FROM e"""



def sunk_events(spark, sf):
    """Every event through the sink that delivers in tasks, with the batch that settled it."""
    folder, rows = fresh_dir(spark, "sunk"), event_stream(spark, sf)
    run_delivery(rows, FolderReceiver(folder), fresh_dir(spark, "sunk-checkpoint"))
    return received(spark, folder, rows.schema).select("batch_id", "event_id", "user_id", "event_type", "value")


SUNK_SQL = f"SELECT {BATCH_SQL} AS batch_id, event_id, user_id, event_type, value FROM events"


def joined(spark, sf, name, build):
    """What a join of two streams comes to when the clock has passed the last event by far."""
    clock, out, checkpoint = (fresh_dir(spark, f"{name}-{part}") for part in ("clock", "out", "checkpoint"))
    last = events(spark, sf).agg(F.coalesce(F.max("ts"), F.timestamp_seconds(F.lit(0))) + F.expr("interval 10 days")).first()[0]
    return flush_joined(build(clock), out, checkpoint, clock, last)


def streamed_links(spark, sf):
    """Errors linked to traces while both stream in, out of order: a user's events of a day are a trace, its purchases are roots. Errors
    of small value have no trace, those of large value one that has no spans."""
    day = F.concat_ws("-", "user_id", F.dayofmonth("ts"))
    spans = event_stream(spark, sf, scattered=True).select(
        day.alias("trace_id"), F.col("event_id").cast("string").alias("span_id"), F.when(F.col("event_type") != "purchase", "up").alias("parent_span_id"),
        F.concat_ws(" ", "event_type", "event_id").alias("name"), F.col("ts").alias("started_at"), F.col("value").alias("duration_ms"),
    )
    trace = F.when(F.col("value") > 40, F.concat(day, F.lit("-lost"))).when(F.col("value") >= 5, day)
    errors = event_stream(spark, sf, scattered=True).where("event_type = 'error'").select("event_id", F.col("ts").alias("occurred_at"), trace.alias("trace_id"))
    found = joined(spark, sf, "links", lambda clock: stream_linked_errors(errors, spans, LATE_WATERMARK, gap="1 day", clock=clock))
    return found.select("event_id", "trace_id", "trace_spans", "trace_name", "trace_duration_ms")


STREAM_LINKS_SQL = """
WITH t AS (SELECT user_id || '-' || day(ts) AS trace_id, count(*) AS trace_spans,
                  arg_min(event_type || ' ' || event_id, (ts, event_id)) FILTER (event_type = 'purchase') AS trace_name,
                  arg_min(value, (ts, event_id)) FILTER (event_type = 'purchase') AS trace_duration_ms FROM events GROUP BY 1),
e AS (SELECT event_id, CASE WHEN value > 40 THEN user_id || '-' || day(ts) || '-lost' WHEN value >= 5 THEN user_id || '-' || day(ts) END AS trace_id
      FROM events WHERE event_type = 'error')
SELECT event_id, e.trace_id, trace_spans, trace_name, trace_duration_ms FROM e LEFT JOIN t USING (trace_id)"""


def streamed_stitches(spark, sf):
    """Every event's call, and the back-end request it made some minutes later; one in nine with a header no tracer would write."""
    trace, span = hex_id(F.col("event_id") % 1000 + 1, 32), hex_id(F.col("event_id") + 1, 16)
    client = event_stream(spark, sf, scattered=True).select(
        trace.alias("trace_id"), span.alias("span_id"), F.concat_ws(" ", F.lit("call"), "event_id").alias("name"), F.col("ts").alias("started_at"))
    ours = traceparent(trace, span, F.lit(None).cast("string"), F.lit(True))
    header = F.when(F.col("event_id") % 9 == 0, F.concat(F.lit("x"), ours)).otherwise(ours)
    backend = event_stream(spark, sf, scattered=True).select(
        F.concat(F.lit("b"), "event_id").alias("span_id"), F.col("event_type").alias("name"), header.alias("traceparent"),
        (F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") % 50).cast("int"))).alias("started_at"))
    return joined(spark, sf, "stitches", lambda clock: stream_stitched(client, backend, LATE_WATERMARK, clock=clock))


STREAM_STITCHES_SQL = f"""
SELECT {hex_sql('event_id % 1000 + 1', 32)} AS trace_id, {hex_sql('event_id + 1', 16)} AS parent_span_id, 'b' || event_id AS backend_span_id,
       event_type AS backend_name, 'call ' || event_id AS client_name
FROM events WHERE event_id % 9 <> 0"""

QUERIES = {
    "sunk_events": (sunk_events, SUNK_SQL),
    "streamed_links": (streamed_links, STREAM_LINKS_SQL),
    "streamed_stitches": (streamed_stitches, STREAM_STITCHES_SQL),
    "ingested_reports": (ingested_reports, INGESTED_SQL),
    "streamed_performance": (streamed_performance, PERFORMANCE_SAMPLES_SQL),
    "streamed_trails": (streamed_trails, TRAILS_SQL),
    "kept_trails": (kept_trails, KEPT_TRAILS_SQL),
    "streamed_users": (streamed_users, USERS_SQL),
    "streamed_traces": (streamed_traces, STREAM_TRACES_SQL),
    "strict_streamed_traces": (strict_streamed_traces, STRICT_STREAM_SQL),
    "streamed_admission": (streamed_admission, ADMISSION_SQL),
    "streamed_tallies": (streamed_tallies, TALLIES_SQL),
    "streamed_changes": (streamed_changes, STREAM_CHANGES_SQL),
    "streamed_metrics": (streamed_metrics, STREAM_METRICS_SQL),
}
