"""Starting, flushing and discarding streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from telemetry_spark.plans.session import fresh_dir, use_utc

#: Files that were read are moved away by so many threads of the driver, and the list of them is written anew every so many batches.
CLEANER_THREADS, LOG_BATCHES = 8, 100
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> None:
    """Session settings the streams need: UTC, a state store that is not held in memory, and as many tasks to list files as can run
    side by side a few times over (by default a task for every file of a batch). Files that were read are moved away by several threads
    (by default by one, which falls behind), and the list of all files ever read is written anew by one batch in many."""
    use_utc(spark)
    spark.conf.set("spark.sql.sources.parallelPartitionDiscovery.parallelism", 4 * spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.fileSource.cleaner.numThreads", CLEANER_THREADS)
    spark.conf.set("spark.sql.streaming.fileSource.log.compactInterval", LOG_BATCHES)


def file_stream(spark: SparkSession, path: str, schema: str, glob: str = "*.parquet", files_per_trigger: int = 1000) -> DataFrame:
    """New Parquet files under a folder as a stream, a bounded number of files per micro-batch."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
    return reader.option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def control_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows that steer a stream, out of a folder that may still be empty."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(folder)
    return file_stream(spark, path, schema)


def seconds_of(spark: SparkSession, *intervals: str) -> int:
    """The length of some intervals together."""
    moment = " + ".join(["timestamp_micros(0)", *[f"interval {i}" for i in intervals]])
    return spark.sql(f"select unix_seconds({moment})").first()[0]


def state_rows(spark: SparkSession, checkpoint: str, variable: str, flatten: bool = True) -> DataFrame:
    """What a stream keeps under one of its processor's names, as of its last committed batch: ``key`` with its value, or with the
    entries of a map or list, a row each unless they are not to be flattened."""
    reader = spark.read.format("statestore").option("stateVarName", variable)
    return reader.option("flattenCollectionTypes", flatten).load(checkpoint)


def start(df: DataFrame, path: str, checkpoint: str, every: str = "60 seconds") -> StreamingQuery:
    """Write a stream as Parquet, one micro-batch per flush interval."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    return writer.trigger(processingTime=every).start(path)


def flush_now(df: DataFrame, path: str, checkpoint: str) -> None:
    """Process everything that has arrived, then stop. Progress is committed, so a later flush goes on from here."""
    writer = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    writer.trigger(availableNow=True).start(path).awaitTermination()


def run_flush(
    df: DataFrame, deliver: Callable[[DataFrame, int], None], checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Hand each micro-batch to ``deliver(batch, batch_id)``. A batch that is retried comes with the same id, which is
    what a sink needs to take it once. Without an interval everything available is flushed and the stream stops. With one
    a batch comes at every interval, empty if nothing has arrived, so that what waits is tried again."""
    if every is None:
        writer = df.writeStream.foreachBatch(deliver).option("checkpointLocation", checkpoint)
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query
    ticks = df.sparkSession.readStream.format("rate").option("rowsPerSecond", 1).load()
    absent = [F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    ticking = df.withColumn("__tick", F.lit(False)).unionByName(ticks.select(*absent, F.lit(True).alias("__tick")))

    def without_ticks(batch: DataFrame, batch_id: int) -> None:
        deliver(batch.where("not __tick").drop("__tick"), batch_id)

    writer = ticking.writeStream.foreachBatch(without_ticks).option("checkpointLocation", checkpoint)
    return writer.trigger(processingTime=every).start()


def discard(query: StreamingQuery) -> None:
    """Stop a stream without committing the batch in progress."""
    query.stop()


def late_rows(query: StreamingQuery) -> int:
    """Rows that came after their window or trace had closed and were dropped, over the progress still at hand."""
    return sum(
        operator["numRowsDroppedByWatermark"]
        for progress in query.recentProgress
        for operator in progress["stateOperators"]
    )


def collected(df: DataFrame, name: str) -> DataFrame:
    """Flush a stream into a fresh folder under the shared one and read back what it wrote."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    schema = df.schema
    flush_now(df, path, fresh_dir(spark, f"{name}-checkpoint"))
    return spark.read.schema(schema).parquet(path)
