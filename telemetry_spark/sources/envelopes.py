"""Wire envelopes: records in numbered batches, one JSON body each."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_spark.config import MAX_BATCH_ENTRIES
from telemetry_spark.functions.delivery import endpoint_for
from telemetry_spark.plans.caps import numbered

# The key a signal's records are listed under.
LIST_KEYS = {
    "performance_samples": "samples",
    "custom_metrics": "metrics",
    "infrastructure_metrics": "metrics",
}


def to_envelopes(
    df: DataFrame,
    signal: str,
    order: Sequence[Column],
    slice_by: Column | None = None,
    keys: Sequence[str] = (),
    batch_size: int = MAX_BATCH_ENTRIES,
    fields: Sequence[str] | None = None,
) -> DataFrame:
    """Bodies of at most ``batch_size`` records each, in order. Only one batch is ever gathered in one place."""
    named = list(fields or [c for c in df.columns if c not in keys])
    placed = numbered(df, keys, order, slice_by, "__position")
    batch = F.floor((F.col("__position") - 1) / batch_size).alias("batch_id")
    record = F.struct(F.col("__position").alias("p"), F.struct(*named).alias("r"))
    # Compared by position alone: records may hold maps, which have no order.
    by_position = lambda a, b: F.when(a["p"] < b["p"], -1).otherwise(1)
    listed = placed.groupBy(*keys, batch).agg(F.array_sort(F.collect_list(record), by_position).alias("entries"))
    records = F.transform("entries", lambda e: e["r"])
    body = F.to_json(F.struct(records.alias(LIST_KEYS[signal])), {"ignoreNullFields": "false"})
    return listed.select(*keys, "batch_id", F.size("entries").alias("records"), body.alias("body"))


def trace_envelopes(traces: DataFrame) -> DataFrame:
    """One body per assembled trace. A span's data goes in as JSON, and a root's parent as an explicit null."""
    span = F.transform("spans", lambda s: s.withField("data", F.try_parse_json(s["data"])))
    body = F.to_json(F.struct("trace_id", span.alias("spans")), {"ignoreNullFields": "false"})
    return traces.select("trace_id", F.size("spans").alias("records"), body.alias("body"))


def change_envelopes(changes: DataFrame) -> DataFrame:
    """One body per change, attributes it lacks left out."""
    document = F.struct(
        "kind", "title", "environment",
        F.date_format("occurred_at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("occurred_at"),
        F.try_parse_json("details").alias("details"), "service", "actor", "url", "id",
    )
    return changes.select(F.lit(1).alias("records"), F.to_json(document).alias("body"))


def routed(envelopes: DataFrame, signal: str, dsn: Column) -> DataFrame:
    return envelopes.withColumn("endpoint", endpoint_for(dsn, signal))


def write_envelopes(envelopes: DataFrame, path: str) -> None:
    """Bodies as they are posted, one a line, by endpoint."""
    envelopes.select("endpoint", "body").write.mode("append").partitionBy("endpoint").text(path)
