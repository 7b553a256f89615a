"""The first or last rows of each group."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetry_spark.plans.running import running

LEAST_SALTS = 8


def salts_for(df: DataFrame) -> int:
    """Salts that balance the two rounds of ``first_n``: of m tasks, m / salts meet in the first and salts in the second."""
    return max(LEAST_SALTS, math.isqrt(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def first_of(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each group: an aggregate that combines before the shuffle and sorts nothing. Rows that are
    equal in ``order`` go by all their columns, so the result is the same in every run."""
    rest = [F.col(c) for c in df.columns]
    first = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order)], F.xxhash64(*rest).alias("tie"))
    found = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), first).alias("__first"))
    return found.select("__first.*")


def first_n(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, salts: int | None = None
) -> DataFrame:
    """The first ``n`` rows of each group.

    Spark limits each group within every task before it shuffles (``WindowGroupLimit``). A first round over salted
    groups shares what is left of a hot group between tasks, so the last round sees at most ``salts * n`` of it. The
    salt only decides where a row is looked at: with a total ``order`` the result is the same for any salts.
    """
    rows, salts = df, salts_for(df) if salts is None else salts
    if salts > 1:
        rows = rows.withColumn("__salt", F.spark_partition_id() % salts)
        salted = Window.partitionBy(*keys, "__salt").orderBy(*order)
        rows = rows.withColumn("__rank", F.row_number().over(salted)).where(F.col("__rank") <= n)
        rows = rows.drop("__salt", "__rank")
    ranked = rows.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("__rank") <= n).drop("__rank")


def numbered(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], slice_by: Column | None = None, name: str = "position"
) -> DataFrame:
    """Add each row's position in its group, from 1, for callers that need the rows past a cap as well."""
    return running(df, keys, order, slice_by, **{name: ("sum", F.lit(1))})
