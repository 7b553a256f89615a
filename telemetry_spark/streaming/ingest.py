"""Pending reports as a stream: every file of a folder once, what holds no report told apart, files moved away when they are done."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_spark.config import Config
from telemetry_spark.operators.delivery import filter_enabled
from telemetry_spark.operators.events import strict_events
from telemetry_spark.schemas import ERROR_EVENT
from telemetry_spark.sources.reports import CORRUPT, complete_signal_reports, crash_time, is_json_object, signal_events

#: Reports are JSON documents and raw signal reports; other files are not looked at.
REPORTS = "*.{json,txt}"
#: Files are read as bytes. As whole texts each of them would cost a task a set-up of its own, several times as long as the reading.
FILE = "path string, modificationTime timestamp, length bigint, content binary"
#: A batch has a task per core, or for so many files if that makes more; by Spark's own measure some thirty small files would make a task.
TASK_FILES = 200


def report_files(spark: SparkSession, path: str, archive: str | None = None, files_per_trigger: int = 1000) -> DataFrame:
    """The texts of new report files under a folder, its subfolders included: ``value``, ``payload_id``, ``name``, ``created_at``.

    The stream's checkpoint says which files were read. With an ``archive`` outside of the folder, files go there once the
    batch that read them is committed and the next one begins, so that a folder that fills for ever stays small.
    """
    reader = spark.readStream.format("binaryFile").schema(FILE).option("pathGlobFilter", REPORTS)
    reader = reader.option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_trigger)
    if archive is not None:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    tasks = max(spark.sparkContext.defaultParallelism, -(-files_per_trigger // TASK_FILES))
    return reader.load(path).coalesce(tasks).select(
        F.col("content").cast("string").alias("value"), F.col("_metadata.file_path").alias("payload_id"), F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_modification_time").alias("created_at"),
    )


def report_events(files: DataFrame, cfg: Config = Config(), now: Column | None = None, scrub: bool = True) -> DataFrame:
    """Reports as events, in one pass over files of both kinds.

    Signal reports are completed with what the settings know. A ``.json`` file that holds no JSON object comes out as a row with its
    text under ``_corrupt_record`` and without an event. Nothing comes out unless the project reports.
    """
    name = F.col("name")
    is_json = name.endswith(".json")
    read = filter_enabled(files, cfg).withColumns({
        "__json": is_json,
        "__object": is_json & is_json_object(F.col("value")),
        "__text": F.col("value"),
        "crashed_at": F.when(~is_json, crash_time(name, F.col("created_at"))),
    })
    signals = complete_signal_reports(signal_events(read), cfg, now, scrub=scrub)
    event = F.when(F.col("__object"), F.from_json("__text", ERROR_EVENT))
    given = set(signals.columns)

    def attribute(field: T.StructField) -> Column:
        absent = F.lit(None).cast(field.dataType)
        own = F.col(field.name).cast(field.dataType) if field.name in given else absent
        return F.when(F.col("__json"), event[field.name]).otherwise(own).alias(field.name)

    corrupt = F.when(F.col("__json") & ~F.col("__object"), F.col("__text")).alias(CORRUPT)
    fields = T._parse_datatype_string(ERROR_EVENT).fields
    rows = signals.select("payload_id", "created_at", "crashed_at", corrupt, *map(attribute, fields))
    return strict_events(rows, cfg.privacy_allowed_fields) if cfg.strict_privacy else rows


def stream_reports(
    spark: SparkSession, path: str, cfg: Config = Config(), archive: str | None = None, now: Column | None = None, files_per_trigger: int = 1000,
) -> DataFrame:
    """What comes into a folder of pending reports, as events, each file once."""
    return report_events(report_files(spark, path, archive, files_per_trigger), cfg, now)


def accepted(rows: DataFrame) -> DataFrame:
    return rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def corrupt(rows: DataFrame) -> DataFrame:
    """Files that are dropped for holding no report: which, and what was in them."""
    return rows.where(F.col(CORRUPT).isNotNull()).select("payload_id", CORRUPT)
