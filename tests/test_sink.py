"""The sink that delivers in tasks: batches that fail half-way, batches that run twice, bodies that are refused."""

import os
import shutil

import pyarrow as pa
import pytest
from helpers import values
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from telemetry_spark.streaming import runs
from telemetry_spark.streaming.sink import BodyWriter, FolderReceiver, Part, received, run_delivery, settled

SCHEMA = "id bigint, text string"


# Made inside functions, as workers cannot import the tests.
def flaky(path):
    """Breaks on a body that holds the id 150, after others of the batch were sent, until a file says that it is mended."""

    class Flaky(FolderReceiver):
        def send(self, key, body):
            status = super().send(key, body)
            if 150 in body["id"].to_pylist() and not os.path.exists(f"{self.path}-mended"):
                raise OSError("the line went dead")
            return status

    return Flaky(path)


def strict(path):
    """Has no answer for bodies with an id below 100 and refuses those with one from 100 to 199."""

    class Strict(FolderReceiver):
        def send(self, key, body):
            least = min(body["id"].to_pylist())
            return 503 if least < 100 else 422 if least < 200 else super().send(key, body)

    return Strict(path)


@pytest.fixture
def source(spark, scratch):
    runs.prepare(spark)
    rows = spark.range(400).select("id", F.concat(F.lit("text "), "id").alias("text"))
    rows.repartitionByRange(4, "id").write.parquet(f"{scratch}/in")
    return lambda: runs.file_stream(spark, f"{scratch}/in", SCHEMA)


def bodies(path):
    return sorted(n for n in os.listdir(f"{path}/bodies") if not n.startswith("."))


def test_a_batch_that_fails_half_way_is_delivered_once(spark, scratch, source):
    out = f"{scratch}/out"
    with pytest.raises(StreamingQueryException):
        run_delivery(source(), flaky(out), f"{scratch}/checkpoint", limit=30)
    assert bodies(out) and not os.path.exists(f"{out}/batches")
    open(f"{out}-mended", "w").close()
    run_delivery(source(), flaky(out), f"{scratch}/checkpoint", limit=30)
    got = received(spark, out, SCHEMA)
    assert sorted(values(got, "id", "text")) == [(i, f"text {i}") for i in range(400)]
    assert values(settled(spark, out).agg(F.countDistinct("batch_id"), F.sum("delivered"), F.sum("rejected"), F.sum("dropped"))) == [(1, 400, 0, 0)]


def test_a_settled_batch_that_runs_again_stays_as_it_was(spark, scratch, source):
    """The stream stops after the batch was settled and before Spark noted it."""
    out = f"{scratch}/out"
    run_delivery(source(), FolderReceiver(out), f"{scratch}/checkpoint", limit=30)
    before, first = bodies(out), sorted(values(received(spark, out, SCHEMA)))
    shutil.copytree(f"{scratch}/checkpoint", f"{scratch}/cut", ignore=shutil.ignore_patterns("commits"))
    run_delivery(source(), FolderReceiver(out), f"{scratch}/cut", limit=30)
    assert bodies(out) == before and sorted(values(received(spark, out, SCHEMA))) == first and len(first) == 400
    spark.createDataFrame([(1000, "more")], SCHEMA).write.mode("append").parquet(f"{scratch}/in")
    run_delivery(source(), FolderReceiver(out), f"{scratch}/cut", limit=30)
    later = received(spark, out, SCHEMA).where("id >= 400")
    assert values(later, "id", "batch_id") == [(1000, 1)]


def test_refused_bodies_are_counted_and_the_rest_goes_out(spark, scratch, source):
    out = f"{scratch}/out"
    run_delivery(source(), strict(out), f"{scratch}/checkpoint", limit=1000, max_failures=3, pause=0.0)
    counts = settled(spark, out).agg(*[F.sum(c) for c in ("delivered", "rejected", "dropped")]).first()
    assert sum(counts) == 400 and counts[0] == received(spark, out, SCHEMA).count() and counts[1] + counts[2] >= 200
    assert received(spark, out, SCHEMA).where("id < 100").isEmpty()


def test_bodies_hold_the_limit_whatever_the_batches(scratch):
    writer = BodyWriter(FolderReceiver(scratch), limit=10, max_failures=1, pause=0.0)
    batches = [pa.RecordBatch.from_pydict({"id": list(range(n))}) for n in (3, 0, 25, 7, 5, 1)]
    sizes = [b.num_rows for b in writer._bodies(iter(batches))]
    assert sizes == [10, 10, 10, 10, 1] and list(writer._bodies(iter(()))) == []


def test_a_failure_is_tried_again(scratch):
    answers = [503, 0, 202, 503, 503, 503, 404]

    class Slow(FolderReceiver):
        def send(self, key, body):
            return answers.pop(0)

    writer = BodyWriter(Slow(scratch), limit=2, max_failures=3, pause=0.0)
    sent = writer.write(iter([pa.RecordBatch.from_pydict({"id": list(range(5))})]))
    assert (sent.bodies, sent.delivered, sent.dropped, sent.rejected) == (3, 2, 2, 1) and not answers


def test_a_part_without_rows_and_forgetting_twice(scratch):
    receiver = FolderReceiver(scratch)
    writer = BodyWriter(receiver, 10, 1, 0.0)
    assert writer.write(iter(())).bodies == 0
    sent = writer.write(iter([pa.RecordBatch.from_pydict({"id": [1]})]))
    writer.abort([sent, None, Part("never", 2)], 0)
    writer.abort([sent], 0)
    assert bodies(scratch) == []
