"""Business and infrastructure metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetry_spark.functions.timefmt import iso_seconds
from telemetry_spark.operators import metrics as op
from telemetry_spark.operators.delivery import drop_report, label_retention, retain, streaks
from telemetry_spark.operators.drops import DropLedger
from telemetry_spark.sources.envelopes import routed, to_envelopes
from workload import delivery
from workload.tables import events, iso_sql, table

THIRTY_DAYS = 30 * 86400


def readings(spark, sf):
    """Line margins as readings: some not a number, some infinite, some missing, many negative."""
    value = (
        F.when(F.col("l_tax") == 0, float("nan"))
        .when(F.col("l_discount") == 0, float("inf"))
        .when(F.col("l_linenumber") != 7, F.col("l_extendedprice") - 20000)
    )
    return table(spark, sf, "lineitem").select(
        F.concat_ws(".", "l_returnflag", "l_linestatus").alias("metric_name"), value.alias("value")
    )


def valid_metric_totals(spark, sf):
    totals = op.metric_totals(op.valid_metrics(readings(spark, sf)), ["metric_name"])
    return totals.withColumn("total", F.round("total", 2))


VALID_SQL = """
SELECT l_returnflag || '.' || l_linestatus AS metric_name, count(*) AS readings,
       round(sum(l_extendedprice - 20000), 2) AS total
FROM lineitem WHERE l_tax <> 0 AND l_discount <> 0 AND l_linenumber <> 7 GROUP BY 1"""


def metrics(spark, sf):
    """One business metric per event; a signup is a bare counter."""
    return events(spark, sf).select(
        "event_id", F.col("event_type").alias("metric_name"),
        op.metric_value_default(F.when(F.col("event_type") != "signup", F.col("value"))).alias("value"),
        F.lit("production").alias("environment"), F.lit(None).cast("string").alias("release"),
        F.col("ts").alias("recorded_at"),
    )


METRICS_SQL = """
SELECT event_id, event_type AS metric_name, CASE WHEN event_type = 'signup' THEN 1.0 ELSE value END::DOUBLE AS value,
       ts AS recorded_at FROM events"""


def metric_totals(spark, sf):
    totals = op.metric_totals(metrics(spark, sf), ["metric_name"], "1 hour")
    stamped = {c: iso_seconds(F.col(c)) for c in ("period_started_at", "period_ended_at")}
    return totals.withColumns({"total": F.round("total", 4), **stamped})


TOTALS_SQL = f"""
SELECT metric_name, {iso_sql("date_trunc('hour', recorded_at)")} AS period_started_at,
       {iso_sql("date_trunc('hour', recorded_at) + INTERVAL 1 HOUR")} AS period_ended_at,
       count(*) AS readings, round(sum(value), 4) AS total FROM ({METRICS_SQL}) GROUP BY ALL"""


def infrastructure(spark, sf):
    host = F.when(F.col("event_type") == "view", "").when(
        F.col("event_type") != "click", F.concat(F.lit("db-"), F.col("user_id"))
    )
    return events(spark, sf).select("event_id", host.alias("hostname"), "value", F.col("ts").alias("recorded_at"))


def resolved_hostnames(spark, sf):
    kept, dropped = op.resolve_hostname(infrastructure(spark, sf), "web-1")
    both = kept.withColumn("kept", F.lit(True)).unionByName(dropped.withColumn("kept", F.lit(False)))
    return both.groupBy("hostname", "kept").agg(F.count(F.lit(1)).alias("readings"))


HOSTNAMES_SQL = """
WITH h AS (SELECT CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN 'web-1' ELSE 'db-' || user_id END AS hostname
           FROM events)
SELECT hostname, hostname IS NOT NULL AS kept, count(*) AS readings FROM h GROUP BY ALL"""


def capped_metrics(spark, sf):
    """The first 1000 readings of each metric in thirty days."""
    order = [F.col("recorded_at"), F.col("event_id")]
    kept = op.cap_batch(metrics(spark, sf), ["metric_name"], order, "30 days")
    return kept.select("event_id", "metric_name", iso_seconds(F.col("recorded_at")).alias("recorded_at"))


WINDOW_SQL = f"CAST(floor(epoch(recorded_at) / {THIRTY_DAYS}) AS BIGINT)"
CAPPED_SQL = f"""
SELECT event_id, metric_name, {iso_sql('recorded_at')} AS recorded_at FROM ({METRICS_SQL})
QUALIFY row_number() OVER (PARTITION BY metric_name, {WINDOW_SQL} ORDER BY recorded_at, event_id) <= 1000"""


def metric_overflow(spark, sf):
    over = op.cap_overflow(metrics(spark, sf), ["metric_name"], "30 days")
    return over.withColumn("period_started_at", iso_seconds(F.col("period_started_at")))


OVERFLOW_SQL = f"""
SELECT metric_name, {iso_sql(f"make_timestamp({WINDOW_SQL} * {THIRTY_DAYS} * 1000000)")} AS period_started_at,
       greatest(count(*) - 1000, 0) AS dropped FROM ({METRICS_SQL}) GROUP BY ALL"""


def drop_counts(spark, sf):
    """Everything that is dropped, by signal and reason: by the metric rules, the buffer, deliveries and retention."""
    lines = readings(spark, sf)
    invalid = lines.where(~F.coalesce(op.finite(F.col("value")), F.lit(False)))
    _, homeless = op.resolve_hostname(infrastructure(spark, sf), "web-1")
    over = op.cap_overflow(metrics(spark, sf), ["metric_name"], "30 days")
    tried = streaks(delivery.event_attempts(spark, sf)).where("action = 'dropped'")
    _, stale = retain(delivery.payloads(spark, sf), F.lit(delivery.NOW).cast("timestamp"))

    def named(df, signal, reason, records=1):
        reason = F.lit(reason) if isinstance(reason, str) else reason
        records = F.lit(records) if isinstance(records, int) else records
        return df.select(F.lit(signal).alias("signal"), reason.alias("reason"), records.cast("bigint").alias("records"))

    rejected = F.when(F.col("outcome") == "rejected", "rejected").otherwise("failed too often")
    parts = [
        named(invalid, "metric", "not a finite number"), named(homeless, "infra_metric", "no hostname"),
        named(over.where("dropped > 0"), "metric", "buffer full", F.col("dropped")), named(tried, "batch", rejected),
        named(stale, "event", F.col("drop_reason")),
    ]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return drop_report(every, F.col("records"))


DROPS_SQL = f"""
SELECT 'metric' AS signal, 'not a finite number' AS reason, count(*) AS dropped FROM lineitem
WHERE l_tax = 0 OR l_discount = 0 OR l_linenumber = 7
UNION ALL SELECT 'infra_metric', 'no hostname', count(*) FROM events WHERE event_type = 'view'
UNION ALL SELECT 'metric', 'buffer full', sum(dropped) FROM ({OVERFLOW_SQL}) HAVING sum(dropped) > 0
UNION ALL SELECT 'batch', CASE outcome WHEN 'rejected' THEN 'rejected' ELSE 'failed too often' END, count(*)
  FROM ({delivery.STREAKS_SQL}) WHERE action = 'dropped' GROUP BY 2
UNION ALL SELECT 'event', drop_reason, count(*) FROM ({delivery.RETAIN_SQL}) WHERE drop_reason IS NOT NULL GROUP BY 2"""


def drops_in_passing(spark, sf):
    """What the rules, deliveries and retention drop, counted by the very passes that let the rest through."""
    ledger = DropLedger()
    kept = [
        ledger.keep(readings(spark, sf), "metric", {"not a finite number": ~F.coalesce(op.finite(F.col("value")), F.lit(False))}),
        ledger.keep(op.with_hostname(infrastructure(spark, sf), "web-1"), "infra_metric", {"no hostname": F.col("hostname").isNull()}),
    ]
    tried = streaks(delivery.event_attempts(spark, sf))
    dropped = F.col("action") == "dropped"
    kept.append(ledger.keep(tried, "batch", {
        "rejected": dropped & (F.col("outcome") == "rejected"), "failed too often": dropped & (F.col("outcome") != "rejected")}))
    aged = label_retention(delivery.payloads(spark, sf), F.lit(delivery.NOW).cast("timestamp"))
    kept.append(ledger.keep(aged, "event", {r: F.col("drop_reason") == r for r in ("expired", "excess")}))
    for rows in kept:
        rows.write.format("noop").mode("overwrite").save()
    return ledger.report(spark)


PASSING_SQL = f"SELECT * FROM ({DROPS_SQL}) WHERE reason <> 'buffer full' AND dropped > 0"


def metric_envelopes(spark, sf):
    """Bodies of 1000 metrics each, with the endpoint they go to."""
    fields = metrics(spark, sf).withColumn("stamp", iso_seconds(F.col("recorded_at")))
    shaped = fields.select(
        "event_id", "metric_name", "value", "environment", "release", F.col("recorded_at").alias("at"),
        F.col("stamp").alias("recorded_at"),
    )
    bodies = to_envelopes(
        shaped, "custom_metrics", [F.col("at"), F.col("event_id")],
        fields=["metric_name", "value", "environment", "release", "recorded_at"],
    )
    return routed(bodies, "custom_metrics", F.lit("https://key@tracker.example.com/api/v1/events"))


ENVELOPES_SQL = f"""
WITH m AS (SELECT *, row_number() OVER (ORDER BY recorded_at, event_id) AS position FROM ({METRICS_SQL}))
SELECT CAST(floor((position - 1) / 1000) AS BIGINT) AS batch_id, CAST(count(*) AS INTEGER) AS records,
       '{{"metrics":[' || string_agg('{{"metric_name":"' || metric_name || '","value":' || value
         || ',"environment":"production","release":null,"recorded_at":"' || {iso_sql('recorded_at')} || '"}}', ','
         ORDER BY position) || ']}}' AS body,
       'https://tracker.example.com/api/v1/custom_metrics' AS endpoint
FROM m GROUP BY 1"""

QUERIES = {
    "valid_metric_totals": (valid_metric_totals, VALID_SQL),
    "metric_totals": (metric_totals, TOTALS_SQL),
    "resolved_hostnames": (resolved_hostnames, HOSTNAMES_SQL),
    "capped_metrics": (capped_metrics, CAPPED_SQL),
    "metric_overflow": (metric_overflow, OVERFLOW_SQL),
    "drops_in_passing": (drops_in_passing, PASSING_SQL),
    "drop_counts": (drop_counts, DROPS_SQL),
    "metric_envelopes": (metric_envelopes, ENVELOPES_SQL),
}
