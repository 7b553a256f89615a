"""Delivery accounting: retry streaks, retention, what is still pending, and what was dropped and why."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_spark.config import (
    MAX_CONSECUTIVE_FAILURES,
    MAX_PAYLOAD_AGE_SECONDS,
    MAX_PENDING_PAYLOADS,
    MAX_PENDING_TRACES,
    Config,
)
from telemetry_spark.functions.delivery import (
    DELIVERED,
    FAILED,
    REJECTED,
    delivery_outcome,
    drop_reason,
    dsn_api_key,
    is_enabled,
)
from telemetry_spark.functions.timefmt import micros
from telemetry_spark.plans.caps import first_n, numbered
from telemetry_spark.plans.running import clock_slices, running, running_since


def with_config(df: DataFrame, configs: DataFrame, on: str = "project") -> DataFrame:
    """Records with their project's settings. The optimizer broadcasts the settings while they are small enough."""
    return df.join(configs, on, "inner")


def filter_enabled(df: DataFrame, cfg: Config | DataFrame, on: str = "project") -> DataFrame:
    """Records of projects that report: a DSN with a key, and an environment in the enabled set."""
    if isinstance(cfg, DataFrame):
        enabled = cfg.where(is_enabled(F.col("dsn"), F.col("environment"), F.col("enabled_environments")))
        return df.join(enabled.select(on), on, "left_semi")
    if cfg.environment not in cfg.enabled_environments:
        return df.where(F.lit(False))
    return df.where(dsn_api_key(F.lit(cfg.dsn)).isNotNull())


def with_outcome(attempts: DataFrame) -> DataFrame:
    status = F.col("status")
    outcome = delivery_outcome(status)
    return attempts.withColumns(
        {"outcome": outcome, "drop_reason": F.when(outcome != DELIVERED, drop_reason(status))}
    )


def streaks(
    attempts: DataFrame,
    keys: Sequence[str] = ("source",),
    order: Sequence[Column] | None = None,
    limit: int = MAX_CONSECUTIVE_FAILURES,
    slice_seconds: float | None = None,
) -> DataFrame:
    """Failures in a row at each attempt and what becomes of the batch: any answer resets the streak, and the
    ``limit``-th failure drops the batch and starts again."""
    order = order or [F.col("attempted_at"), F.col("batch_id")]
    tried = attempts.withColumn("outcome", delivery_outcome(F.col("status")))
    failed = F.col("outcome") == FAILED
    counted = running_since(
        tried, keys, order, clock_slices(micros(F.col("attempted_at")), slice_seconds), ~failed, F.lit(1), "__failures"
    )
    streak = F.when(failed, F.pmod(F.col("__failures") - 1, F.lit(limit)) + 1).otherwise(0)
    return counted.withColumn("streak", streak.cast("int")).drop("__failures").withColumn(
        "action",
        F.when(F.col("outcome") == DELIVERED, "delivered")
        .when((F.col("outcome") == REJECTED) | (F.col("streak") == limit), "dropped")
        .otherwise("kept"),
    )


def pending_after(payloads: DataFrame, attempts: DataFrame, on: str = "payload_id") -> DataFrame:
    """Payloads no attempt has delivered or had rejected."""
    settled = attempts.where(delivery_outcome(F.col("status")) != FAILED).select(on).distinct()
    return payloads.join(settled, on, "left_anti")


def label_retention(
    payloads: DataFrame,
    now: Column,
    max_age_seconds: int = MAX_PAYLOAD_AGE_SECONDS,
    max_n: int = MAX_PENDING_PAYLOADS,
    keys: Sequence[str] = ("source",),
) -> DataFrame:
    """Payloads with ``drop_reason``: ``expired`` beyond the age, ``excess`` beyond the newest ``max_n`` of the rest.

    A payload of unknown age never expires and counts as the oldest. Only the newest of each key are ever ranked;
    the oldest of them is the line every other payload is held against.
    """
    created = micros(F.col("created_at"))
    expired = F.coalesce(created < micros(now) - max_age_seconds * 1_000_000, F.lit(False))
    age = F.struct(F.coalesce(created, F.lit(-(1 << 62))).alias("created"), F.col("payload_id").alias("id"))
    aged = payloads.withColumns({"__expired": expired, "__age": age, "__key": F.struct(*keys)})
    newest = first_n(aged.where(~F.col("__expired")).select("__key", "__age"), ["__key"], [F.col("__age").desc()], max_n)
    lines = newest.groupBy("__key").agg(F.min("__age").alias("__line"))
    reason = F.when(F.col("__expired"), "expired").when(F.col("__age") < F.col("__line"), "excess")
    held = aged.join(lines, "__key", "left")
    return held.withColumn("drop_reason", reason).drop("__key", "__expired", "__age", "__line")


def retain(payloads: DataFrame, now: Column, **options) -> tuple[DataFrame, DataFrame]:
    """Payloads kept, and those dropped with their reason."""
    labelled = label_retention(payloads, now, **options)
    kept = labelled.where(F.col("drop_reason").isNull()).drop("drop_reason")
    return kept, labelled.where(F.col("drop_reason").isNotNull())


def oldest_first(payloads: DataFrame) -> DataFrame:
    return payloads.orderBy(F.col("created_at").asc_nulls_first(), "payload_id")


def upload_order(payloads: DataFrame, slice_seconds: float | None = None) -> DataFrame:
    """Add ``position``, from 1: oldest first, those of unknown age before all others.

    Payloads are counted by slices of equal size, so no task sees all of them, nor all those of unknown age.
    """
    order = [F.col("created_at").asc_nulls_first(), F.col("payload_id")]
    return numbered(payloads, [], order, clock_slices(micros(F.col("created_at")), slice_seconds))


def admit(
    events: DataFrame,
    keys: Sequence[str] = ("source",),
    limit: int = MAX_PENDING_TRACES,
    slice_seconds: float | None = 3600.0,
) -> DataFrame:
    """Occupancy of a bounded queue from its finishes (``delta`` +1) and deliveries (-1, of admitted traces only).

    A trace that finds ``limit`` pending is dropped. Without the bound the occupancy would be the running sum; every
    new high of that sum above the limit is one drop, so sum and running maximum give the bounded queue exactly.
    """
    order = [F.col("at"), F.col("delta"), F.col("trace_id")]
    slice_by = clock_slices(micros(F.col("at")), slice_seconds)
    summed = running(events, keys, order, slice_by, __sum=("sum", F.col("delta")))
    highs = running(summed, keys, order, slice_by, __high=("max_before", F.col("__sum")))
    ceiling = F.greatest(F.coalesce(F.col("__high"), F.lit(limit)), F.lit(limit))
    dropped = (F.col("delta") > 0) & (F.col("__sum") > ceiling)
    lost = F.greatest(F.greatest(F.col("__high"), F.col("__sum")) - limit, F.lit(0))
    return highs.withColumns({"admitted": ~dropped, "pending": (F.col("__sum") - lost).cast("int")}).drop(
        "__sum", "__high"
    )


def drop_report(dropped: DataFrame, records: Column | None = None) -> DataFrame:
    """Dropped records counted by signal and reason; ``records`` says how many a row stands for, one if not given."""
    count = F.count(F.lit(1)) if records is None else F.sum(records)
    return dropped.groupBy("signal", "reason").agg(count.alias("dropped"))
