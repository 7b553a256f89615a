"""Latency tallies."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetry_spark.config import Config
from telemetry_spark.functions.latency import BOUNDARIES_MS, BUCKET_COLUMNS
from telemetry_spark.functions.timefmt import iso_seconds
from telemetry_spark.operators import performance as op
from telemetry_spark.sources.envelopes import to_envelopes
from workload.tables import MEASUREMENTS_SQL, events, iso_sql, measurements, table

NAME = ["transaction_name"]
BOUNDS = [0, *BOUNDARIES_MS]


def bucket_sql(duration: str, where: str = "true") -> str:
    parts = [f"count(*) FILTER ({duration} <= {BOUNDARIES_MS[0]} AND {where}) AS {BUCKET_COLUMNS[0]}"]
    for low, high, name in zip(BOUNDARIES_MS, BOUNDARIES_MS[1:], BUCKET_COLUMNS[1:]):
        parts.append(f"count(*) FILTER ({duration} > {low} AND {duration} <= {high} AND {where}) AS {name}")
    parts.append(f"count(*) FILTER ({duration} > {BOUNDARIES_MS[-1]} AND {where}) AS {BUCKET_COLUMNS[-1]}")
    return ", ".join(parts)


def rounded(df):
    return df.withColumn("duration_sum_ms", F.round("duration_sum_ms", 4))


def _hourly(spark, sf):
    return op.performance_samples(measurements(spark, sf), every="1 hour")


def _wire(df):
    stamped = {c: iso_seconds(F.col(c)) for c in op.PERIOD if c in df.columns}
    return rounded(df).withColumns(stamped).drop("environment", "release")


def performance_samples(spark, sf):
    return _wire(_hourly(spark, sf))


HOURLY_SQL = f"""
SELECT transaction_name, date_trunc('hour', ts) AS started, count(*) AS request_count, sum(duration_ms) AS s,
       max(duration_ms) AS max_duration_ms, {bucket_sql('duration_ms')}
FROM ({MEASUREMENTS_SQL}) GROUP BY ALL"""
PERFORMANCE_SAMPLES_SQL = f"""
SELECT * EXCLUDE (started, s), round(s, 4) AS duration_sum_ms, {iso_sql('started')} AS period_started_at,
       {iso_sql('started + INTERVAL 1 HOUR')} AS period_ended_at FROM ({HOURLY_SQL})"""


def minute_samples(spark, sf):
    return _wire(op.performance_samples(measurements(spark, sf)))


MINUTE_SAMPLES_SQL = f"""
SELECT transaction_name, {iso_sql("date_trunc('minute', ts)")} AS period_started_at,
       {iso_sql("date_trunc('minute', ts) + INTERVAL 1 MINUTE")} AS period_ended_at, count(*) AS request_count,
       round(sum(duration_ms), 4) AS duration_sum_ms, max(duration_ms) AS max_duration_ms, {bucket_sql('duration_ms')}
FROM ({MEASUREMENTS_SQL}) GROUP BY ALL"""


def performance_percentiles(spark, sf):
    return rounded(op.with_percentiles(op.merge_samples(_hourly(spark, sf), NAME)))


def percentile_sql(permille: int) -> str:
    rank = f"ceil(request_count * {permille} / 1000)"
    cases, seen = [], []
    for boundary, name in zip(BOUNDARIES_MS, BUCKET_COLUMNS):
        seen.append(name)
        cases.append(f"WHEN {' + '.join(seen)} >= {rank} THEN {float(boundary)}")
    return f"CAST(CASE {' '.join(cases)} ELSE max_duration_ms END AS DOUBLE)"


PERCENTILES_SQL = f"""
WITH t AS (SELECT transaction_name, count(*) AS request_count, round(sum(duration_ms), 4) AS duration_sum_ms,
                  max(duration_ms) AS max_duration_ms, {bucket_sql('duration_ms')}
           FROM ({MEASUREMENTS_SQL}) GROUP BY transaction_name)
SELECT *, {percentile_sql(500)} AS p50_ms, {percentile_sql(950)} AS p95_ms, {percentile_sql(990)} AS p99_ms FROM t"""


def merged_samples(spark, sf):
    wire = op.without_histogram(op.with_histogram(_hourly(spark, sf)))
    return rounded(op.merge_samples(wire, ["environment"]))


MERGED_SQL = f"""
SELECT 'production' AS environment, count(*) AS request_count, round(sum(duration_ms), 4) AS duration_sum_ms,
       max(duration_ms) AS max_duration_ms, {bucket_sql('duration_ms')} FROM ({MEASUREMENTS_SQL})"""


def top_transactions(spark, sf):
    return _wire(op.top_transactions(_hourly(spark, sf), 20))


TOP_SQL = f"""
SELECT * EXCLUDE (started, s), round(s, 4) AS duration_sum_ms, {iso_sql('started')} AS period_started_at,
       {iso_sql('started + INTERVAL 1 HOUR')} AS period_ended_at
FROM (SELECT * FROM ({HOURLY_SQL}) ORDER BY s DESC, transaction_name, started LIMIT 20)"""


def feature_gates(spark, sf):
    """How many samples are left with the feature on, and with it off."""
    timings = measurements(spark, sf)
    counted = [
        op.performance_samples(timings, Config(track_performance=on), "1 hour").agg(F.count(F.lit(1)).alias("samples"))
        .select(F.lit(on).alias("tracked"), "samples")
        for on in (True, False)
    ]
    return counted[0].unionByName(counted[1])


GATES_SQL = f"SELECT true AS tracked, count(*) AS samples FROM ({HOURLY_SQL}) UNION ALL SELECT false, 0"


def sample_bodies(spark, sf):
    """Samples in bodies of a hundred, read back out of the bodies."""
    wire = op.with_histogram(_hourly(spark, sf))
    order = [F.col(c) for c in ("period_started_at", "transaction_name")]
    slices = F.floor(F.unix_seconds("period_started_at") / 86400)
    sent = to_envelopes(wire, "performance_samples", order, slices, batch_size=100)
    read = "samples array<struct<transaction_name:string,request_count:bigint,max_duration_ms:double,histogram:map<string,bigint>>>"
    rows = sent.select("batch_id", "records", F.explode(F.from_json("body", read)["samples"]).alias("s"))
    return rows.select(
        "batch_id", "records", F.col("s.transaction_name").alias("transaction_name"), F.col("s.request_count").alias("request_count"),
        F.col("s.max_duration_ms").alias("max_duration_ms"),
        F.aggregate(F.map_values("s.histogram"), F.lit(0).cast("bigint"), lambda a, b: a + b).alias("in_buckets"),
    )


BODIES_SQL = f"""
SELECT (n - 1) // 100 AS batch_id, CAST(count(*) OVER (PARTITION BY (n - 1) // 100) AS INTEGER) AS records,
       transaction_name, request_count, max_duration_ms, request_count AS in_buckets
FROM (SELECT *, row_number() OVER (ORDER BY started, transaction_name) AS n FROM ({HOURLY_SQL}))"""


def heaviest_transactions(spark, sf):
    """The transactions that took most time in all."""
    return rounded(op.top_transactions(op.merge_samples(_hourly(spark, sf), NAME), 3))


HEAVIEST_SQL = f"""
SELECT transaction_name, count(*) AS request_count, round(sum(duration_ms), 4) AS duration_sum_ms,
       max(duration_ms) AS max_duration_ms, {bucket_sql('duration_ms')}
FROM ({MEASUREMENTS_SQL}) GROUP BY transaction_name ORDER BY sum(duration_ms) DESC, transaction_name LIMIT 3"""


def slowest_transactions(spark, sf):
    """The transactions with the highest 95th percentile, by name where equal."""
    merged = op.with_percentiles(op.merge_samples(_hourly(spark, sf), NAME), (0.95, 0.999))
    return rounded(op.top_transactions(merged, 3, "p95_ms"))


SLOWEST_SQL = f"""
WITH t AS (SELECT transaction_name, count(*) AS request_count, round(sum(duration_ms), 4) AS duration_sum_ms,
                  max(duration_ms) AS max_duration_ms, {bucket_sql('duration_ms')}
           FROM ({MEASUREMENTS_SQL}) GROUP BY transaction_name)
SELECT *, {percentile_sql(950)} AS p95_ms, {percentile_sql(999)} AS p99_9_ms FROM t
ORDER BY p95_ms DESC, transaction_name LIMIT 3"""

SENT = "ts < TIMESTAMP '2024-01-16' OR transaction_name = 'view'"


def subtracted_tallies(spark, sf):
    """What remains of each tally when the first half of the month, and every view, has been delivered."""
    all_time = measurements(spark, sf)
    current = op.merge_samples(op.performance_samples(all_time, every="1 day"), NAME)
    sent = op.merge_samples(op.performance_samples(all_time.where(SENT), every="1 day"), NAME)
    return rounded(op.subtract_delivered(current, sent, NAME))


SUBTRACT_SQL = f"""
SELECT transaction_name, count(*) FILTER (NOT ({SENT})) AS request_count,
       round(sum(duration_ms) FILTER (NOT ({SENT})), 4) AS duration_sum_ms, max(duration_ms) AS max_duration_ms,
       {bucket_sql('duration_ms', f'NOT ({SENT})')}
FROM ({MEASUREMENTS_SQL}) GROUP BY transaction_name HAVING count(*) FILTER (NOT ({SENT})) > 0"""

STRICT = Config(strict_privacy=True)


def page_loads(spark, sf):
    """Page loads named by their raw path, timed by the length of the page."""
    return table(spark, sf, "pages").select(
        F.concat(F.lit("GET "), F.regexp_extract("url", "^https?://[^/]+(/.*)$", 1)).alias("transaction_name"),
        F.lit("production").alias("environment"), F.lit("1.4.0").alias("release"),
        F.lit("2024-01-01 00:00:30").cast("timestamp").alias("ts"), F.length("html").cast("double").alias("duration_ms"),
    )


def strict_performance(spark, sf):
    return _wire(op.performance_samples(page_loads(spark, sf), STRICT)).drop(*op.PERIOD)


REDUCED_PATH_SQL = """
CASE WHEN len(parts) = 0 THEN '/' ELSE '/' || CASE WHEN regexp_matches(parts[1], '[0-9]') OR length(parts[1]) > 40
     THEN ':id' ELSE parts[1] END || CASE WHEN len(parts) > 1 THEN '/:path' ELSE '' END END"""
PAGE_PARTS_SQL = """
SELECT *, list_filter(string_split(regexp_extract(url, '^https?://[^/?#]+([^?#]*)', 1), '/'), lambda s: s <> '')
       AS parts FROM pages"""
STRICT_PERFORMANCE_SQL = f"""
WITH m AS (SELECT 'GET ' || {REDUCED_PATH_SQL} AS transaction_name, CAST(length(html) AS DOUBLE) AS duration_ms
           FROM ({PAGE_PARTS_SQL}))
SELECT transaction_name, count(*) AS request_count, round(sum(duration_ms), 4) AS duration_sum_ms,
       max(duration_ms) AS max_duration_ms, {bucket_sql('duration_ms')} FROM m GROUP BY transaction_name"""


def tally_lookup(spark, sf):
    samples = op.performance_samples(page_loads(spark, sf), STRICT)
    return _wire(op.tally_for(samples, "GET /en/of/jane-doe?x=1", STRICT)).drop(*op.PERIOD)


TALLY_LOOKUP_SQL = f"SELECT * FROM ({STRICT_PERFORMANCE_SQL}) WHERE transaction_name = 'GET /en/:path'"


def latency_buckets(spark, sf):
    from telemetry_spark.functions.latency import latency_bucket

    labelled = events(spark, sf).select(latency_bucket(F.col("value") * 25).alias("bucket"), "value")
    return labelled.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("longest"))


LATENCY_BUCKETS_SQL = f"""
SELECT CASE {' '.join(f"WHEN value * 25 <= {b} THEN '{b}'" for b in BOUNDARIES_MS)} ELSE 'inf' END AS bucket,
       count(*) AS n, max(value) AS longest FROM events GROUP BY 1"""

QUERIES = {
    "performance_samples": (performance_samples, PERFORMANCE_SAMPLES_SQL),
    "performance_minute_samples": (minute_samples, MINUTE_SAMPLES_SQL),
    "performance_percentiles": (performance_percentiles, PERCENTILES_SQL),
    "merged_samples": (merged_samples, MERGED_SQL),
    "top_transactions": (top_transactions, TOP_SQL),
    "feature_gates": (feature_gates, GATES_SQL),
    "sample_bodies": (sample_bodies, BODIES_SQL),
    "heaviest_transactions": (heaviest_transactions, HEAVIEST_SQL),
    "slowest_transactions": (slowest_transactions, SLOWEST_SQL),
    "subtracted_tallies": (subtracted_tallies, SUBTRACT_SQL),
    "strict_performance": (strict_performance, STRICT_PERFORMANCE_SQL),
    "tally_lookup": (tally_lookup, TALLY_LOOKUP_SQL),
    "latency_buckets": (latency_buckets, LATENCY_BUCKETS_SQL),
}
