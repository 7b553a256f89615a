"""Pending reports: what is a report, and a folder read as a stream with restarts."""

import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from telemetry_spark.config import Config
from telemetry_spark.sources.reports import CORRUPT, is_json_object
from telemetry_spark.streaming import ingest, runs
from workload import streams

DSN = "https://key@tracker.example.com/api/v1/events"


def test_one_object_and_nothing_else(spark):
    good = ['{}', ' {"a": [1, {"b": null}]}\n', '{"document": 1, "x": "}"}', '\t{"é": "日本"}']
    bad = [None, '', ' ', '[]', '1', '"x"', 'null', '{', '{"a": 1', '{"a":1}{"a":2}', '{"a":1}\n{"a":2}', '{"a":1},"x":{}', '{"a":1}]', '{"a":1}}',
           '{"a":1} x', '{"a":1},"document":2', '{"a":1},"end":1}', 'x{"a":1}', '{"a":1},']
    df = spark.createDataFrame([(t,) for t in good + bad], "t string")
    assert [r[0] for r in df.select(is_json_object(F.col("t"))).collect()] == [True] * len(good) + [False] * len(bad)


@pytest.fixture
def folder(spark, scratch):
    runs.prepare(spark)
    os.makedirs(f"{scratch}/in/sub")

    def write(name, text):
        with open(f"{scratch}/in/{name}", "w") as f:
            f.write(text)

    return write


def taken(spark, scratch, cfg, archive=None):
    df = ingest.stream_reports(spark, f"{scratch}/in", cfg, archive, F.lit("2024-02-01").cast("timestamp"))
    schema = df.schema
    runs.flush_now(df, f"{scratch}/out", f"{scratch}/checkpoint")
    return spark.read.schema(schema).parquet(f"{scratch}/out")


def test_a_restart_reads_nothing_twice(spark, scratch, folder):
    cfg = Config(dsn=DSN, release="1.0", server_name="s")
    folder("a.json", json.dumps({"exception_class": "E", "message": "first", "environment": "staging", "context": "{}"}))
    folder("bad.json", '{"message": "cut o')
    folder("signal-6-1700000000.txt", "Abort trap\n0 Shop 0x1 mail a@b.org\n\n1 Shop")
    folder("notes.md", "{}")
    first = taken(spark, scratch, cfg, f"{scratch}/archive").collect()
    assert len(first) == 3
    by_class = {r.exception_class: r for r in first}
    assert by_class["E"].message == "first" and by_class["E"].environment == "staging" and by_class["E"].crashed_at is None
    signal = by_class["Signal: Abort trap"]
    assert signal.release == "1.0" and signal.crashed_at.year == 2023 and signal.occurred_at.year == 2024
    assert [f.method for f in signal.backtrace] == ["0 Shop 0x1 mail [EMAIL FILTERED]", "1 Shop"]
    assert by_class[None][CORRUPT] == '{"message": "cut o' and by_class[None].backtrace is None
    folder("sub/b.json", json.dumps({"exception_class": "F", "message": "second"}))
    everything = taken(spark, scratch, cfg, f"{scratch}/archive")
    assert everything.count() == 4 and ingest.corrupt(everything).count() == 1
    assert {r.exception_class for r in ingest.accepted(everything).collect()} == {"E", "F", "Signal: Abort trap"}
    assert taken(spark, scratch, cfg, f"{scratch}/archive").count() == 4
    assert os.path.exists(f"{scratch}/in/notes.md")


def test_read_files_move_to_the_archive(spark, scratch, folder):
    folder("a.json", "{}")
    cfg = Config(dsn=DSN)
    taken(spark, scratch, cfg, f"{scratch}/archive")
    folder("b.json", "{}")
    taken(spark, scratch, cfg, f"{scratch}/archive")
    kept = [f for _, _, files in os.walk(f"{scratch}/archive") for f in files if f.endswith(".json")]
    assert "a.json" in kept and not os.path.exists(f"{scratch}/in/a.json")


def test_strict_and_silent_projects(spark, scratch, folder):
    folder("a.json", json.dumps({"exception_class": "E", "message": "user 12 failed", "context": "{\"a\":1}"}))
    silent = ingest.stream_reports(spark, f"{scratch}/in", Config())
    runs.flush_now(silent, f"{scratch}/none", f"{scratch}/none-checkpoint")
    assert spark.read.schema(silent.schema).parquet(f"{scratch}/none").count() == 0
    strict = taken(spark, scratch, Config(dsn=DSN, strict_privacy=True)).first()
    assert strict.message is None or "12" not in strict.message


def test_files_are_read_byte_by_byte(spark, scratch, folder):
    texts = {"bom.json": b"\xef\xbb\xbf{}", "cut.json": b"{\"a\": \"\xff\xfe\"}", "lines.txt": b"a\r\nb\n\n", "a-b.c.json": b"{}\n",
             "zero.txt": b"a\x00b", "wide.json": "{\"é\": \"日本\"}".encode()}
    for name, text in [*texts.items(), ("empty.json", b"")]:  # Spark passes over files of no length
        with open(f"{scratch}/in/{name}", "wb") as f:
            f.write(text)
    files = ingest.report_files(spark, f"{scratch}/in").withColumn("bytes", F.hex("value"))
    schema = files.schema
    runs.flush_now(files, f"{scratch}/out", f"{scratch}/checkpoint")
    found = spark.read.schema(schema).parquet(f"{scratch}/out")
    assert {r.name: bytes.fromhex(r.bytes) for r in found.collect()} == texts
    whole = spark.read.text(f"{scratch}/in", wholetext=True, pathGlobFilter=ingest.REPORTS).select("value", F.col("_metadata.file_path").alias("payload_id"))
    assert found.select("value", "payload_id").exceptAll(whole).count() == 0 == whole.exceptAll(found.select("value", "payload_id")).count()


def test_many_small_files_are_read_by_few_tasks_and_moved_by_several_threads(spark, scratch, folder):
    for i in range(300):
        folder(f"{i}.json", json.dumps({"message": f"m{i}"}))
    found = taken(spark, scratch, Config(dsn=DSN), f"{scratch}/archive")
    assert {r.message for r in found.collect()} == {f"m{i}" for i in range(300)} and found.count() == 300
    written = [f for f in os.listdir(f"{scratch}/out") if f.endswith(".parquet")]
    assert len(written) <= max(spark.sparkContext.defaultParallelism, 5)
    assert int(spark.conf.get("spark.sql.streaming.fileSource.cleaner.numThreads")) > 1
    assert int(spark.conf.get("spark.sql.streaming.fileSource.log.compactInterval")) >= 100


def test_report_files_are_written_as_they_are_a_thousand_to_a_folder(spark, scratch, monkeypatch):
    monkeypatch.setattr(streams, "FOLDER_FILES", 3)
    rows = [(f"u={i}.json", f'{{"é": {i}}}\n') for i in range(20)]
    streams.write_files(spark.createDataFrame(rows, "name string, text string").coalesce(2), f"{scratch}/written")
    found, most = {}, 0
    for at, _, names in os.walk(f"{scratch}/written"):
        most = max(most, len(names))
        for name in names:
            with open(f"{at}/{name}", "rb") as f:
                found[name] = f.read().decode()
    assert found == dict(rows) and most <= 3


def test_the_reports_query_leaves_a_file_for_each_user(spark, scratch):
    os.makedirs(f"{scratch}/sf")
    rows = [(i, "2024-01-01 00:00:00", i % 31, "error" if i % 2 else "view", 1.0, "{}") for i in range(200)]
    events = spark.createDataFrame(rows, "event_id bigint, ts string, user_id bigint, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.parquet(f"{scratch}/sf/events.parquet")
    query, sql = streams.QUERIES["ingested_reports"]
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW events AS SELECT * FROM '{scratch}/sf/events.parquet/*.parquet'")
        want = con.execute(sql).fetchall()
    got = [tuple(r) for r in query(spark, f"{scratch}/sf").collect()]
    assert len(got) == 31 and sorted(map(repr, got)) == sorted(map(repr, want))


def test_files_are_listed_by_as_many_tasks_as_can_run(spark):
    runs.prepare(spark)
    tasks = int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism"))
    assert tasks == 4 * spark.sparkContext.defaultParallelism
