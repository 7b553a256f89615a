"""Sharding by sampled splitters: shards of near equal bytes, with equal texts next to each other.

Method. Records are ordered by (hash of the text, hash of the id). A size-weighted sample of their keys, bounded in number,
gives splitters at its quantiles; every record falls into the range between two splitters. A range that holds more than its
share (a text with very many copies) is subdivided at quantiles of the second key. Exact byte sums of the ranges, and a running sum
within each, tell at which byte of the whole a record begins, and that decides the shard. A shard differs from the
mean by less than its largest record.

Defined results: a null text has no bytes; copies lie in one shard unless a border falls into them or they are larger than
a shard; rows that repeat both keys keep an order by id and size, and which of two equal rows comes first makes no difference;
no rows give no shards; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import IntegerType

from telemetry_spark.llm.common import written

HEADER = 16
#: Ranges for each shard, sampled keys for each range, and by how much a range may exceed its share before it is cut.
RANGES_PER_SHARD, KEYS_PER_RANGE, OVERFULL = 32, 8, 2.0


def range_of(splitters: np.ndarray, column: Column) -> Column:
    """The number of splitters at or below a value."""

    @pandas_udf(IntegerType())
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in batches:
            yield pd.Series(np.searchsorted(splitters, values.to_numpy(np.int64), side="right").astype(np.int32))

    return place(column)


def quantiles(keys: np.ndarray, weights: np.ndarray, parts: int) -> np.ndarray:
    """Splitters of ``parts`` parts of near equal weight."""
    if not len(keys):
        return np.zeros(0, np.int64)
    order = np.argsort(keys)
    reached = np.cumsum(weights[order])
    cuts = np.searchsorted(reached, reached[-1] * np.arange(1, parts) / parts)
    return np.unique(keys[order][np.minimum(cuts, len(keys) - 1)])


def sampled(records: DataFrame, by: list[str], total: int, ranges: int) -> pd.DataFrame:
    """About ``KEYS_PER_RANGE`` keys for each range, drawn in proportion to size, with the bytes each stands for."""
    mean = max(1, total) / (ranges * KEYS_PER_RANGE)
    dice = F.pmod(F.xxhash64("key", "tie", "doc_id", F.lit(by[-1])), F.lit(1 << 30)) / F.lit(float(1 << 30))
    picked = records.where(dice * mean < F.col("size"))
    weight = F.sum(F.greatest(F.col("size").cast("double"), F.lit(mean)))
    return picked.groupBy(*by).agg(weight.alias("weight")).toPandas()


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    binary = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    records = written(
        docs.select(
            F.col(id_col).cast("bigint").alias("doc_id"), (F.octet_length(binary) + HEADER).cast("bigint").alias("size"),
            F.crc32(binary).alias("text_crc32"), F.xxhash64(binary).alias("key"), F.xxhash64(F.col(id_col)).alias("tie"),
        ),
        "shard-records",
    )
    total = records.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    ranges = shards * RANGES_PER_SHARD
    keys = sampled(records, ["key"], total, ranges)
    splitters = quantiles(keys["key"].to_numpy(np.int64), keys["weight"].to_numpy(), ranges)
    ranged = records.withColumn("range", range_of(splitters, F.col("key")))
    # Overfull ranges are those of a text with many copies; there are fewer of them than ranges.
    sizes = ranged.groupBy("range").agg(F.sum("size").alias("bytes"))
    heavy = {r[0]: r[1] for r in sizes.where(F.col("bytes") > OVERFULL * total / ranges).collect()}
    cuts = {}
    if heavy:
        ties = sampled(ranged.where(F.col("range").isin(list(heavy))), ["range", "tie"], total, ranges)
        for number, own in ties.groupby("range"):
            parts = int(heavy[number] * ranges // total) + 1
            cuts[number] = quantiles(own["tie"].to_numpy(np.int64), own["weight"].to_numpy(), parts)
    return placed(subdivided(ranged, cuts), total, shards)


def subdivided(ranged: DataFrame, cuts: dict[int, np.ndarray]) -> DataFrame:
    """Number the parts of overfull ranges; a range that is not overfull is its only part."""

    @pandas_udf(IntegerType())
    def part(ranges: pd.Series, ties: pd.Series) -> pd.Series:
        out = np.zeros(len(ranges), np.int32)
        for number in ranges.unique():
            if number in cuts:
                mine = (ranges == number).to_numpy()
                out[mine] = np.searchsorted(cuts[number], ties.to_numpy(np.int64)[mine], side="right")
        return pd.Series(out)

    return ranged.withColumn("part", part("range", "tie") if cuts else F.lit(0))


def placed(ranged: DataFrame, total: int, shards: int) -> DataFrame:
    """Shard and slot of every record, from exact sums over ranges and a running sum within each."""
    sums = ranged.groupBy("range", "part").agg(F.sum("size").alias("bytes"))
    before = Window.orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range only
    starts = sums.select("range", "part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("begin"))
    inside = Window.partitionBy("range", "part").orderBy("key", "tie", "doc_id", "size")
    rows = ranged.join(starts, ["range", "part"])
    own = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    rows = rows.withColumn("at", F.col("begin") + own)
    rows = rows.withColumn("shard", F.least(F.floor(F.col("at") * F.lit(float(shards)) / F.lit(float(max(1, total)))), F.lit(shards - 1)).cast("int"))
    counts = rows.groupBy("shard", "range", "part").agg(F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("shard").orderBy("range", "part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "range", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first"))
    ranked = Window.partitionBy("range", "part", "shard").orderBy("at", "doc_id")
    rows = rows.withColumn("rank", F.row_number().over(ranked) - 1).join(first, ["shard", "range", "part"])
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("first") + F.col("rank")).cast("bigint").alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, shards: int = 40) -> None:
    """Write the documents into one folder for each shard, in slot order within each file."""
    keys = {"__tie": F.xxhash64("doc_id"), "__crc": F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))}
    placing = shard(docs.select("doc_id", "text"), shards).select(
        F.xxhash64("doc_id").alias("__tie"), F.col("text_crc32").alias("__crc"), F.col("shard").alias("__shard"), F.col("slot").alias("__slot"))
    # Rows that repeat an id and a text go to the first of their places.
    first = placing.groupBy("__tie", "__crc").agg(F.min(F.struct("__shard", "__slot")).alias("__place"))
    rows = docs.withColumns(keys).join(first, ["__tie", "__crc"]).select(*docs.columns, "__place.*")
    ordered = rows.repartitionByRange(shards * 4, "__shard", "__slot").sortWithinPartitions("__shard", "__slot")
    ordered.drop("__slot").write.partitionBy("__shard").parquet(path)
