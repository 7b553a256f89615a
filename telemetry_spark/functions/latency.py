"""Latency buckets and percentiles read off bucket counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bounds in milliseconds; anything longer counts under the overflow label.
BOUNDARIES_MS = (50, 100, 250, 500, 1000, 2500, 5000, 10000)
OVERFLOW = "inf"
LABELS = (*[str(b) for b in BOUNDARIES_MS], OVERFLOW)
BUCKET_COLUMNS = tuple(f"le_{label}" for label in LABELS)


def latency_bucket(duration_ms: Column) -> Column:
    """Label of the smallest boundary at or above a duration."""
    label = F.when(duration_ms <= BOUNDARIES_MS[0], LABELS[0])
    for boundary, text in zip(BOUNDARIES_MS[1:], LABELS[1:]):
        label = label.when(duration_ms <= boundary, text)
    return label.otherwise(OVERFLOW)


def bucket_counts(duration_ms: Column) -> list[Column]:
    """One counting aggregate per bucket. Plain long columns combine before the shuffle; a map would not."""
    lows, highs = (None, *BOUNDARIES_MS), (*BOUNDARIES_MS, None)
    counts = []
    for low, high, name in zip(lows, highs, BUCKET_COLUMNS):
        inside = [duration_ms > low] if low is not None else []
        inside += [duration_ms <= high] if high is not None else []
        counts.append(F.count_if(reduce(lambda a, b: a & b, inside)).alias(name))
    return counts


def histogram_map(*counts: Column) -> Column:
    """Bucket counts as a label-to-count map with only the labels that occurred."""
    labels = F.array(*[F.lit(label) for label in LABELS])
    return F.map_filter(F.map_from_arrays(labels, F.array(*counts)), lambda k, v: v > 0)


def histogram_columns(histogram: Column) -> list[Column]:
    return [
        F.coalesce(F.try_element_at(histogram, F.lit(label)), F.lit(0).cast("bigint")).alias(name)
        for label, name in zip(LABELS, BUCKET_COLUMNS)
    ]


def bucket_percentile(counts: list[Column], q: float, max_ms: Column) -> Column:
    """Upper bound of the first bucket whose cumulative count reaches ``ceil(q * n)``; the maximum for overflow."""
    millionths = round(q * 1_000_000)
    total = reduce(lambda a, b: a + b, counts)
    rank = F.ceil(total * millionths / 1_000_000)
    seen = F.lit(0)
    bound = None
    for boundary, count in zip(BOUNDARIES_MS, counts):
        seen = seen + count
        reached = seen >= rank
        value = F.lit(float(boundary))
        bound = F.when(reached, value) if bound is None else bound.when(reached, value)
    return F.when(total > 0, bound.otherwise(max_ms))


def histogram_percentile(histogram: Column, q: float, max_ms: Column) -> Column:
    return bucket_percentile(histogram_columns(histogram), q, max_ms)
