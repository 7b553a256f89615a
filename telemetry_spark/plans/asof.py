"""As-of lookups without a theta join: both sides in one ordered stream per key, the latest value carried along."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_spark.functions.timefmt import micros
from telemetry_spark.plans.running import clock_slices, running


def latest_as_of(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_time: Column,
    right_time: Column,
    right_order: Column,
    value: Column,
    name: str,
    slice_seconds: float | None = None,
) -> DataFrame:
    """Add to each left row the ``value`` of the latest right row of its keys at or before it, null if there is none.

    ``right_order`` breaks ties between right rows of one moment, the highest wins.
    """
    row = F.struct(*[F.col(c) for c in left.columns])
    lookups = left.select(
        *keys, micros(left_time).alias("__at"), F.lit(1).alias("__side"), F.lit(None).cast("string").alias("__tie"),
        row.alias("__row"),
    )
    known = right.select(
        *keys, micros(right_time).alias("__at"), F.lit(0).alias("__side"), right_order.alias("__tie"),
        F.struct(value.alias("value")).alias("__known"),
    )
    tie_type = known.schema["__tie"].dataType
    lookups = lookups.withColumn("__tie", F.col("__tie").cast(tie_type))
    both = known.unionByName(lookups, allowMissingColumns=True)
    order = [F.col("__at"), F.col("__side"), F.col("__tie")]
    slice_by = clock_slices(F.col("__at"), slice_seconds)
    carried = running(both, keys, order, slice_by, __latest=("last", F.col("__known")))
    return carried.where("__side = 1").select("__row.*", F.col("__latest.value").alias(name))
