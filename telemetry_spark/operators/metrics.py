"""Business and infrastructure metrics: one row per reading, never summed on capture."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_spark.config import MAX_BATCH_ENTRIES
from telemetry_spark.functions.text import empty_to_null
from telemetry_spark.plans.caps import first_n


def metric_value_default(value: Column) -> Column:
    """A bare counter counts one."""
    return F.coalesce(value, F.lit(1.0))


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != float("inf"))


def valid_metrics(df: DataFrame, value: str = "value") -> DataFrame:
    """Readings with a finite number. A value held as text is not a number, whatever it looks like."""
    if not isinstance(df.schema[value].dataType, T.NumericType):
        return df.where(F.lit(False))
    return df.where(finite(F.col(value).cast("double")))


def with_hostname(df: DataFrame, default: str | None = None) -> DataFrame:
    """The given host, else the server's own; an empty one is none."""
    return df.withColumn("hostname", empty_to_null(F.coalesce(F.col("hostname"), F.lit(default))))


def resolve_hostname(df: DataFrame, default: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Readings with a host, and the dropped ones without."""
    resolved = with_hostname(df, default)
    return resolved.where(F.col("hostname").isNotNull()), resolved.where(F.col("hostname").isNull())


def metric_totals(df: DataFrame, keys: Sequence[str], every: str | None = None, value: str = "value") -> DataFrame:
    """Exact count and sum per metric, per window of ``recorded_at`` where one is given."""
    aggregates = [F.count(F.lit(1)).alias("readings"), F.sum(value).alias("total")]
    if every is None:
        return df.groupBy(*keys).agg(*aggregates)
    grouped = df.groupBy(F.window("recorded_at", every).alias("w"), *keys).agg(*aggregates)
    return grouped.select(
        *keys, F.col("w.start").alias("period_started_at"), F.col("w.end").alias("period_ended_at"),
        "readings", "total",
    )


def cap_batch(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], every: str, n: int = MAX_BATCH_ENTRIES
) -> DataFrame:
    """The entries a buffer takes between two flushes: the first ``n`` per key and window; the newest are dropped."""
    windowed = df.withColumn("__flush", F.window("recorded_at", every)["start"])
    return first_n(windowed, [*keys, "__flush"], order, n).drop("__flush")


def cap_overflow(df: DataFrame, keys: Sequence[str], every: str, n: int = MAX_BATCH_ENTRIES) -> DataFrame:
    """How many entries ``cap_batch`` drops per key and window: a count, so nothing is ranked for it."""
    grouped = df.groupBy(F.window("recorded_at", every).alias("w"), *keys).agg(F.count(F.lit(1)).alias("__n"))
    dropped = F.greatest(F.col("__n") - n, F.lit(0))
    return grouped.select(*keys, F.col("w.start").alias("period_started_at"), dropped.alias("dropped"))
