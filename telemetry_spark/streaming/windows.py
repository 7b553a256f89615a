"""Streams that need no state of their own: windowed tallies and idempotent changes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from telemetry_spark.config import Config
from telemetry_spark.operators.performance import KEYS, performance_samples


def stream_performance(
    df: DataFrame,
    cfg: Config = Config(),
    every: str | None = None,
    watermark: str = "10 minutes",
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Tallies per event-time window, each sent once when the watermark passes its end; later rows are dropped."""
    return performance_samples(df.withWatermark("ts", watermark), cfg, every, keys)


def stream_changes(df: DataFrame, watermark: str = "1 hour") -> DataFrame:
    """One record per id within the watermark; records without an id all pass."""
    named = df.where("id is not null").withWatermark("occurred_at", watermark)
    unnamed = df.where("id is null").withWatermark("occurred_at", watermark)
    return named.dropDuplicatesWithinWatermark(["id"]).unionByName(unnamed)
