"""Latency tallies per transaction and flush window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_spark.config import Config
from telemetry_spark.functions.latency import (
    BUCKET_COLUMNS,
    bucket_counts,
    bucket_percentile,
    histogram_columns,
    histogram_map,
)
from telemetry_spark.functions.privacy import strict_transaction

KEYS = ("transaction_name", "environment", "release")
PERIOD = ("period_started_at", "period_ended_at")


def measured(df: DataFrame, cfg: Config) -> DataFrame:
    """The measurements that count: none when the feature is off, names reduced first under strict privacy so that
    raw paths that differ only in ids share one tally."""
    if not cfg.track_performance:
        return df.where(F.lit(False))
    if cfg.strict_privacy:
        return df.withColumn("transaction_name", strict_transaction(F.col("transaction_name")))
    return df


def tally_aggregates() -> list[Column]:
    duration = F.col("duration_ms")
    return [
        F.count(F.lit(1)).alias("request_count"),
        F.sum(duration).alias("duration_sum_ms"),
        F.greatest(F.max(duration), F.lit(0.0)).alias("max_duration_ms"),
        *bucket_counts(duration),
    ]


def performance_samples(
    df: DataFrame, cfg: Config = Config(), every: str | None = None, keys: Sequence[str] = KEYS
) -> DataFrame:
    """Count, sum, maximum and bucket counts per key and flush window: map-side partials, then one shuffle."""
    window = F.window("ts", every or cfg.performance_flush_interval)
    grouped = measured(df, cfg).groupBy(window.alias("w"), *keys).agg(*tally_aggregates())
    return grouped.select(
        *keys, F.col("w.start").alias(PERIOD[0]), F.col("w.end").alias(PERIOD[1]),
        *[c for c in grouped.columns if c not in ("w", *keys)],
    )


def with_histogram(samples: DataFrame) -> DataFrame:
    """The wire form: bucket columns folded into one label-to-count map."""
    folded = samples.withColumn("histogram", histogram_map(*[F.col(c) for c in BUCKET_COLUMNS]))
    return folded.drop(*BUCKET_COLUMNS)


def without_histogram(samples: DataFrame) -> DataFrame:
    return samples.select("*", *histogram_columns(F.col("histogram"))).drop("histogram")


def merge_samples(samples: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Samples added up: counts and sums add, the maximum is the largest."""
    return samples.groupBy(*keys).agg(
        F.sum("request_count").alias("request_count"),
        F.sum("duration_sum_ms").alias("duration_sum_ms"),
        F.max("max_duration_ms").alias("max_duration_ms"),
        *[F.sum(c).alias(c) for c in BUCKET_COLUMNS],
    )


def percentile_name(q: float) -> str:
    """``p95_ms``; ``p99_9_ms`` where a whole percentage would not tell it apart."""
    return f"p{round(q * 100, 4):g}_ms".replace(".", "_")


def with_percentiles(samples: DataFrame, quantiles: Sequence[float] = (0.5, 0.95, 0.99)) -> DataFrame:
    counts = [F.col(c) for c in BUCKET_COLUMNS]
    return samples.withColumns(
        {percentile_name(q): bucket_percentile(counts, q, F.col("max_duration_ms")) for q in quantiles}
    )


def top_transactions(samples: DataFrame, k: int, by: str = "duration_sum_ms") -> DataFrame:
    """The ``k`` heaviest samples by a column, names and then periods breaking ties."""
    ties = [F.col(c) for c in (*KEYS, *PERIOD) if c in samples.columns]
    return samples.orderBy(F.col(by).desc_nulls_last(), *ties).limit(k)


def tally_for(samples: DataFrame, name: str, cfg: Config = Config()) -> DataFrame:
    """The sample of one transaction, looked up under the name it is tallied by."""
    wanted = strict_transaction(F.lit(name)) if cfg.strict_privacy else F.lit(name)
    return samples.where(F.col("transaction_name") == wanted)


def subtract_delivered(current: DataFrame, sent: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """What is left of tallies after a delivery. Counts and sums stop at zero, emptied keys go, and the maximum stays:
    it cannot be taken apart."""
    taken = [c for c in ("request_count", "duration_sum_ms", *BUCKET_COLUMNS) if c in current.columns]
    delivered = sent.select(
        *[F.col(k).alias(f"__sent_{k}") for k in keys], *[F.col(c).alias(f"__sent_{c}") for c in taken]
    )
    same_key = [F.col(k).eqNullSafe(F.col(f"__sent_{k}")) for k in keys]
    rest = {
        c: F.greatest(F.col(c) - F.coalesce(F.col(f"__sent_{c}"), F.lit(0)), F.lit(0).cast(current.schema[c].dataType))
        for c in taken
    }
    left = current.join(delivered, same_key, "left").withColumns(rest).select(*current.columns)
    return left.where(F.col("request_count") > 0)
