"""A sink that delivers in tasks and settles a batch at once.

Each task of a micro-batch sends its rows as bodies, without the driver. What a task has sent counts only when the batch is settled, in one
step and under its number; a task that fails or is lost in between leaves bodies that no batch names. So a batch that fails half-way, or runs
again after it was settled, is delivered exactly once.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamArrowWriter, WriterCommitMessage
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from telemetry_spark.config import MAX_BATCH_ENTRIES, MAX_CONSECUTIVE_FAILURES
from telemetry_spark.functions.delivery import DELIVERED, FAILED, REJECTED, delivery_outcome_of

DROPPED = "dropped"
MANIFEST = "batch_id bigint, parts array<struct<part string, bodies bigint, delivered bigint, rejected bigint, dropped bigint>>"


@dataclass
class Part(WriterCommitMessage):
    """What one task sent: its bodies are ``{part}-0``, ``{part}-1``, ...; rows by outcome."""

    part: str
    bodies: int = 0
    delivered: int = 0
    rejected: int = 0
    dropped: int = 0


def folder_at(path: str) -> tuple[fs.FileSystem, str]:
    """A folder as pyarrow opens it: its file system, and its path there."""
    # "file:/a" is how Hadoop writes a local path.
    uri = path.replace("file:/", "/", 1) if path.startswith("file:/") and not path.startswith("file://") else path
    return fs.FileSystem.from_uri(uri)


class Receiver:
    """Where bodies go. Copies of it work in tasks, so it holds settings only."""

    def send(self, key: str, body: pa.Table) -> int:
        """Take a body under a key of its own and answer with an HTTP status. Called in tasks; nothing counts before ``settle``.
        A key may come again after a failure, with the same rows."""
        raise NotImplementedError

    def settle(self, batch_id: int, parts: list[Part]) -> None:
        """Make a batch count, once: a batch id that has been settled stays as it was. Called on the driver when all tasks are done."""
        raise NotImplementedError

    def forget(self, parts: list[Part]) -> None:
        """Let go of bodies that will never count. Not called for tasks that were lost."""


class FolderReceiver(Receiver):
    """Bodies as Parquet files in a folder all executors reach (any address pyarrow can open), batches as lists of parts."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def _open(self, *names: str) -> tuple[fs.FileSystem, str]:
        system, root = folder_at(self.path)
        return system, "/".join([root, *names])

    def _put(self, folder: str, name: str, write) -> None:
        """A file appears whole or not at all; names that begin with a dot are not read."""
        system, path = self._open(folder)
        system.create_dir(path)
        hidden = f"{path}/.{name}-{uuid.uuid4().hex}"
        with system.open_output_stream(hidden) as sink:
            write(sink)
        system.move(hidden, f"{path}/{name}")

    def send(self, key: str, body: pa.Table) -> int:
        self._put("bodies", f"{key}.parquet", lambda sink: pq.write_table(body, sink))
        return 201

    def settle(self, batch_id: int, parts: list[Part]) -> None:
        name = f"batch-{batch_id:020d}.json"
        system, path = self._open("batches", name)
        if system.get_file_info(path).type != fs.FileType.NotFound:
            self.forget(parts)
            return
        text = json.dumps({"batch_id": batch_id, "parts": [asdict(p) for p in parts]})
        self._put("batches", name, lambda sink: sink.write(text.encode()))

    def forget(self, parts: list[Part]) -> None:
        for part in parts:
            for body in range(part.bodies):
                system, path = self._open("bodies", f"{part.part}-{body}.parquet")
                if system.get_file_info(path).type != fs.FileType.NotFound:
                    system.delete_file(path)


class BodyWriter(DataSourceStreamArrowWriter):
    """Sends a task's rows in bodies of at most ``limit``. A body that fails is tried again after a pause; the ``max_failures``-th
    failure in a row drops it, as does a rejection, and the batch's record says how many rows went that way."""

    def __init__(self, receiver: Receiver, limit: int, max_failures: int, pause: float):
        self.receiver, self.limit, self.max_failures, self.pause = receiver, limit, max_failures, pause

    def _bodies(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held, rows = [], 0
        for batch in batches:
            while batch.num_rows:
                taken = batch.slice(0, self.limit - rows)
                batch = batch.slice(taken.num_rows)
                held.append(taken)
                rows += taken.num_rows
                if rows == self.limit:
                    yield pa.Table.from_batches(held)
                    held, rows = [], 0
        if held:
            yield pa.Table.from_batches(held)

    def _outcome(self, key: str, body: pa.Table) -> str:
        for attempt in range(self.max_failures):
            if attempt:
                time.sleep(self.pause)
            outcome = delivery_outcome_of(self.receiver.send(key, body))
            if outcome != FAILED:
                return outcome
        return DROPPED

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        sent = Part(uuid.uuid4().hex)
        for body in self._bodies(iterator):
            outcome = self._outcome(f"{sent.part}-{sent.bodies}", body)
            sent.bodies += 1
            sent.delivered += body.num_rows if outcome == DELIVERED else 0
            sent.rejected += body.num_rows if outcome == REJECTED else 0
            sent.dropped += body.num_rows if outcome == DROPPED else 0
        return sent

    def commit(self, messages: list[Part | None], batchId: int) -> None:
        self.receiver.settle(batchId, [m for m in messages if m is not None and m.bodies])

    def abort(self, messages: list[Part | None], batchId: int) -> None:
        self.receiver.forget([m for m in messages if m is not None])


def body_source(
    receiver: Receiver, limit: int = MAX_BATCH_ENTRIES, max_failures: int = MAX_CONSECUTIVE_FAILURES, pause: float = 1.0
) -> type[DataSource]:
    """A data source of a name of its own that streams can be written to."""
    name = f"bodies-{uuid.uuid4().hex}"

    class Bodies(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def streamWriter(self, schema: StructType, overwrite: bool) -> BodyWriter:
            return BodyWriter(receiver, limit, max_failures, pause)

    return Bodies


def run_delivery(df: DataFrame, receiver: Receiver, checkpoint: str, every: str | None = None, **options) -> StreamingQuery:
    """Deliver a stream in tasks. Without an interval everything available is delivered and the stream stops."""
    source = body_source(receiver, **options)
    df.sparkSession.dataSource.register(source)
    writer = df.writeStream.format(source.name()).option("checkpointLocation", checkpoint).outputMode("append")
    if every is not None:
        return writer.trigger(processingTime=every).start()
    query = writer.trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def settled(spark: SparkSession, path: str) -> DataFrame:
    """Batches that a ``FolderReceiver`` has settled, a row for each part: ``batch_id, part, bodies, delivered, rejected, dropped``."""
    batches = spark.read.schema(MANIFEST).json(f"{path}/batches")
    return batches.select("batch_id", F.inline("parts"))


def received(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows of settled batches, with ``batch_id``. Bodies that no batch names are not seen."""
    bodies = spark.read.schema(schema).parquet(f"{path}/bodies")
    part = F.substring_index(F.col("_metadata.file_name"), "-", 1)
    return bodies.withColumn("part", part).join(settled(spark, path).select("part", "batch_id"), "part").drop("part")
