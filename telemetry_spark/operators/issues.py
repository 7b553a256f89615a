"""Roll-ups over error events."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_spark.functions.privacy import fingerprint_of


def issues(
    events: DataFrame, user: str = "user_id", approx: bool = False, keys: Sequence[str] = ()
) -> DataFrame:
    """Errors of one class and message shape, with their number, first and last sighting and affected users.

    The exact distinct count shuffles by (issue, user) first, so a hot issue is spread over its users.
    """
    count_users = F.approx_count_distinct if approx else F.count_distinct
    existing = F.col("message_fingerprint") if "message_fingerprint" in events.columns else F.lit(None).cast("string")
    marked = events.withColumn("message_fingerprint", fingerprint_of(existing, F.col("message")))
    return marked.groupBy(*keys, "exception_class", "message_fingerprint").agg(
        F.count(F.lit(1)).alias("events"),
        F.min("occurred_at").alias("first_seen"),
        F.max("occurred_at").alias("last_seen"),
        count_users(user).alias("affected_users"),
    )


def issue_sketches(
    events: DataFrame, every: str = "1 hour", user: str = "user_id", keys: Sequence[str] = (), lg_k: int = 14
) -> DataFrame:
    """Issues per window of ``occurred_at`` with a sketch of their affected users, small enough to keep for good.

    Sketches of any windows can be merged; ``2 ** lg_k`` registers are within about 1 % and exact while users are few. Map-side
    partials combine before the shuffle, so a hot issue is no hot task.
    """
    existing = F.col("message_fingerprint") if "message_fingerprint" in events.columns else F.lit(None).cast("string")
    marked = events.withColumn("message_fingerprint", fingerprint_of(existing, F.col("message")))
    by = [*keys, "exception_class", "message_fingerprint"]
    found = marked.groupBy(F.window("occurred_at", every).alias("w"), *by).agg(
        F.count(F.lit(1)).alias("events"), F.min("occurred_at").alias("first_seen"), F.max("occurred_at").alias("last_seen"),
        F.hll_sketch_agg(F.col(user).cast("string"), lg_k).alias("users"),
    )
    return found.select(*by, F.col("w.start").alias("period_started_at"), "events", "first_seen", "last_seen", "users")


def merged_issues(sketches: DataFrame, every: str | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Issues over longer windows, or over all time, with how many users they affected: sketches are merged, events not read again."""
    by = [*keys, "exception_class", "message_fingerprint"]
    window = [] if every is None else [F.window("period_started_at", every).alias("w")]
    found = sketches.groupBy(*window, *by).agg(
        F.sum("events").alias("events"), F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("affected_users"),
    )
    return found if every is None else found.withColumn("period_started_at", F.col("w.start")).drop("w")


def sql_object_counts(events: DataFrame) -> DataFrame:
    """How many failing statements touch each procedure and relation."""
    def named(kind: str, names: str):
        return F.transform(
            F.coalesce(F.col(f"sql_objects.{names}"), F.array().cast("array<string>")),
            lambda n: F.struct(F.lit(kind).alias("object_type"), n.alias("object_name")),
        )

    found = F.concat(named("procedure", "procedures"), named("relation", "relations"))
    objects = events.select(F.col("sql_objects.operation").alias("operation"), F.explode(found).alias("o"))
    return objects.groupBy("o.object_type", "o.object_name", "operation").agg(F.count(F.lit(1)).alias("statements"))
