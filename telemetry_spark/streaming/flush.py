"""Micro-batch delivery with retries: nothing is lost while a delivery may still succeed."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_spark.config import MAX_BATCH_ENTRIES, MAX_CONSECUTIVE_FAILURES
from telemetry_spark.functions.delivery import FAILED, delivery_outcome_of
from telemetry_spark.plans.caps import first_n

MARK = "batch_id bigint, outcome string, failures int, pending boolean"
#: Flushes whose outcome is remembered.
HISTORY = 1000


class MetricFlusher:
    """Collects entries between flushes and delivers them together, for use with ``run_flush``.

    Entries of each micro-batch join those still waiting, at most ``limit`` per key: what already waits stays, and of the
    new ones the latest are dropped. They are written under ``state_dir`` before ``deliver(entries, batch_id)`` sees them;
    it answers with an HTTP status. A failed delivery leaves them waiting for the next flush, which may bring no new rows,
    and the ``max_failures``-th in a row drops them. A batch id that is already settled is not delivered again.

    ``state_dir`` holds the entries that wait and the outcomes of the last ``HISTORY`` flushes, and nothing else: what is
    settled is deleted once the mark that says so has been written.
    """

    def __init__(
        self,
        deliver: Callable[[DataFrame, int], int],
        state_dir: str,
        keys: Sequence[str] = ("source",),
        order: Sequence[Column] | None = None,
        limit: int = MAX_BATCH_ENTRIES,
        max_failures: int = MAX_CONSECUTIVE_FAILURES,
    ):
        self.deliver, self.state_dir, self.keys = deliver, state_dir.rstrip("/"), list(keys)
        self.order = order or [F.col("recorded_at"), F.col("seq")]
        self.limit, self.max_failures = limit, max_failures

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        marks = self._marks(spark)
        if any(m.batch_id == batch_id for m in marks):
            return
        last = max((m for m in marks if m.batch_id < batch_id), key=lambda m: m.batch_id, default=None)
        entries = batch.withColumn("__new", F.lit(1))
        if last is not None and last.pending:
            waiting = spark.read.schema(batch.schema).parquet(self._entries(last.batch_id))
            entries = waiting.withColumn("__new", F.lit(0)).unionByName(entries)
        path = self._entries(batch_id)
        kept = first_n(entries, self.keys, [F.col("__new"), *self.order], self.limit)
        kept.drop("__new").write.mode("overwrite").parquet(path)
        written = spark.read.schema(batch.schema).parquet(path)
        if written.isEmpty():
            self._delete(spark, path)
            return
        outcome = delivery_outcome_of(self.deliver(written, batch_id))
        failures = (last.failures if last else 0) + 1 if outcome == FAILED else 0
        waits = outcome == FAILED and failures < self.max_failures
        mark = (batch_id, outcome if waits or outcome != FAILED else "dropped", failures if waits else 0, waits)
        self._write_marks(spark, [*marks, mark][-HISTORY:], batch_id)
        for name in self._names(spark, "entries"):
            if name != f"batch-{batch_id}" or not waits:
                self._delete(spark, f"{self.state_dir}/entries/{name}")

    def _entries(self, batch_id: int) -> str:
        return f"{self.state_dir}/entries/batch-{batch_id}"

    def _files(self, spark: SparkSession, path: str):
        hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop

    def _names(self, spark: SparkSession, folder: str) -> list[str]:
        files, path = self._files(spark, f"{self.state_dir}/{folder}")
        return sorted(f.getPath().getName() for f in files.listStatus(path)) if files.exists(path) else []

    def _delete(self, spark: SparkSession, path: str) -> None:
        files, hadoop = self._files(spark, path)
        files.delete(hadoop, True)

    def _marks(self, spark: SparkSession) -> list:
        """Outcomes of the last flushes in order, from the newest complete file. The last says whether its entries wait."""
        for name in reversed(self._names(spark, "marks")):
            files, done = self._files(spark, f"{self.state_dir}/marks/{name}/_SUCCESS")
            if files.exists(done):
                rows = spark.read.schema(MARK).parquet(f"{self.state_dir}/marks/{name}")
                return sorted(rows.collect(), key=lambda m: m.batch_id)
        return []

    def _write_marks(self, spark: SparkSession, marks: list, batch_id: int) -> None:
        """One file holds all marks; the ones before it go when it is complete."""
        name = f"after-{batch_id:020d}"
        rows = spark.createDataFrame([tuple(m) for m in marks], MARK)
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.state_dir}/marks/{name}")
        for old in self._names(spark, "marks"):
            if old != name:
                self._delete(spark, f"{self.state_dir}/marks/{old}")

    def history(self, spark: SparkSession) -> DataFrame:
        """Outcomes of the last ``HISTORY`` flushes."""
        return spark.createDataFrame([tuple(m) for m in self._marks(spark)], MARK)
