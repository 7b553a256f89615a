"""Running aggregates per key that do not need a whole key in one task.

A window partitioned by key alone puts all rows of a hot key in one task. Here a key's rows are cut into slices.
Each slice is scanned on its own, one small row per slice carries what came before it, and the
two are joined on (key, slice). The work of a hot key spreads over as many tasks as it has slices.

By default slices are cut by rows: Spark samples (key, order), cuts its range at quantiles, and what lies between two cuts is a slice, however
its rows lie in time. That deals and writes the rows once more. Where rows are known to spread over time, slices of a clock (``clock_slices``)
are cheaper, because they follow from the row itself.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetry_spark.plans.session import cut_lineage

KEY, SLICE = "__key", "__slice"


def _prefix(window):
    return window.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def _before(window):
    return window.rowsBetween(Window.unboundedPreceding, -1)


def clock_slices(at_micros: Column, seconds: float | None) -> Column | None:
    """Slices of so many seconds of a time in microseconds; none if slices are to be cut by rows."""
    return None if seconds is None else F.floor(at_micros / int(seconds * 1_000_000))


def _sliced(df: DataFrame, keys: Sequence[str], order: Sequence[Column], slice_by: Column | None) -> DataFrame:
    """Key and slice as two columns. A struct of keys is never null and equals itself even where a key is null, so
    the join back is a plain equality on the partitioning the windows already made.

    Cut by rows, a slice is one range of (key, order). Rows that are equal there are told apart by a hash of all they hold, so
    that many rows of one moment, or without a time, make several ranges; only rows alike in every column stay together. The
    rows are written, so that all that is read off the slices reads the same cuts.
    """
    rows = df.withColumn(KEY, F.struct(F.lit(0).alias("one"), *[F.col(k) for k in keys]))
    if slice_by is not None:
        return rows.withColumn(SLICE, slice_by)
    hashable = [F.col(f.name) for f in df.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    dealt = rows.repartitionByRange(KEY, *order, F.xxhash64(*hashable))
    return cut_lineage(dealt.withColumn(SLICE, F.spark_partition_id()))


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    slice_by: Column | None = None,
    **aggregates: tuple[str, Column],
) -> DataFrame:
    """Add running aggregates over each key in ``order``, the current row included (except for ``max_before``).

    ``aggregates`` maps a new column to ``("sum" | "max" | "max_before" | "last", value)``; ``last`` skips nulls.
    ``slice_by`` must not decrease along ``order``; without it slices are cut by rows.
    """
    names = list(aggregates)
    rows = _sliced(df, keys, order, slice_by)
    local = Window.partitionBy(KEY, SLICE).orderBy(*order)
    across = _before(Window.partitionBy(KEY).orderBy(SLICE))
    totals, carries, scans, results = [], [], {}, {}
    for name, (kind, value) in aggregates.items():
        scan, carry, total = f"__scan_{name}", f"__carry_{name}", f"__total_{name}"
        if kind == "sum":
            totals.append(F.sum(value).alias(total))
            carries.append(F.sum(total).over(across).alias(carry))
            scans[scan] = F.sum(value).over(_prefix(local))
            zero = F.lit(0)
            results[name] = F.coalesce(F.col(scan), zero) + F.coalesce(F.col(carry), zero)
        elif kind == "max":
            totals.append(F.max(value).alias(total))
            carries.append(F.max(total).over(across).alias(carry))
            scans[scan] = F.max(value).over(_prefix(local))
            results[name] = F.greatest(scan, carry)
        elif kind == "max_before":
            totals.append(F.max(value).alias(total))
            carries.append(F.max(total).over(across).alias(carry))
            scans[scan] = F.max(value).over(_before(local))
            results[name] = F.greatest(scan, carry)
        elif kind == "last":
            rank = F.when(value.isNotNull(), F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)]))
            totals.append(F.max_by(value, rank).alias(total))
            carries.append(F.last(total, ignorenulls=True).over(across).alias(carry))
            scans[scan] = F.last(value, ignorenulls=True).over(_prefix(local))
            results[name] = F.coalesce(F.col(scan), F.col(carry))
        else:
            raise ValueError(f"unknown running aggregate {kind!r}")
    slices = rows.groupBy(KEY, SLICE).agg(*totals)
    carried = slices.select(KEY, SLICE, *carries)
    joined = rows.withColumns(scans).join(carried, [KEY, SLICE], "left")
    return joined.withColumns(results).drop(KEY, SLICE, *scans, *[f"__carry_{n}" for n in names])


def running_since(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    slice_by: Column | None,
    reset: Column,
    value: Column,
    name: str,
) -> DataFrame:
    """Add the sum of ``value`` over a key's rows after the last row where ``reset`` holds (a reset row gets 0)."""
    rows = _sliced(df, keys, order, slice_by).withColumns(
        {"__reset": reset.cast("int"), "__value": F.when(reset, 0).otherwise(value)}
    )
    local = _prefix(Window.partitionBy(KEY, SLICE).orderBy(*order))
    rows = rows.withColumns({"__epoch": F.sum("__reset").over(local), "__sum": F.sum("__value").over(local)})
    # The sum at the last reset seen, to take off again.
    at_reset = F.when(F.col("__reset") == 1, F.col("__sum"))
    rows = rows.withColumn("__base", F.last(at_reset, ignorenulls=True).over(local))
    slices = rows.groupBy(KEY, SLICE).agg(
        F.max("__reset").alias("__had_reset"),
        (F.sum("__value") - F.coalesce(F.max_by("__base", "__epoch"), F.lit(0))).alias("__tail"),
    )
    by_key = Window.partitionBy(KEY).orderBy(SLICE)
    slices = slices.withColumn("__era", F.sum("__had_reset").over(_prefix(by_key)))
    era = _prefix(Window.partitionBy(KEY, "__era").orderBy(SLICE))
    slices = slices.withColumn("__out", F.sum("__tail").over(era))
    carried = slices.select(KEY, SLICE, F.lag("__out").over(by_key).alias("__carry"))
    joined = rows.join(carried, [KEY, SLICE], "left")
    since = F.col("__sum") - F.coalesce(F.col("__base"), F.lit(0))
    open_ended = F.when(F.col("__epoch") == 0, F.coalesce(F.col("__carry"), F.lit(0))).otherwise(0)
    return joined.withColumn(name, since + open_ended).drop(
        KEY, SLICE, "__reset", "__value", "__epoch", "__sum", "__base", "__carry"
    )
