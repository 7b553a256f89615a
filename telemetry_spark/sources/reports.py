"""Pending crash reports on disk: JSON events, raw signal reports and breadcrumb trails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_spark.config import Config
from telemetry_spark.functions.frames import raw_frames
from telemetry_spark.functions.timefmt import iso_seconds
from telemetry_spark.operators.breadcrumbs import attach_previous_trail, resolve_user, scrub_trails
from telemetry_spark.operators.delivery import filter_enabled, retain, upload_order
from telemetry_spark.operators.events import scrub_events, strict_events
from telemetry_spark.schemas import BREADCRUMB, ERROR_EVENT

CORRUPT = "_corrupt_record"
# Texts of a completed signal report.
SIGNAL_CLASS = "Signal: "
SIGNAL_MESSAGE = "Uncaught fatal signal: "


def is_json_object(text: Column) -> Column:
    """Whether a text is one JSON object and nothing else. Spark's readers stop where the first value ends, so the text is read as
    one member of an object with another member after it, which shows whether the text ends there, too."""
    after = F.concat(F.lit("end-"), F.hex(F.xxhash64(text)))
    whole = F.concat(F.lit('{"document":'), text, F.lit(',"'), after, F.lit('":1}'))
    members = F.json_object_keys(F.when(F.try_parse_json(whole).isNotNull(), whole))
    kind = F.schema_of_variant(F.try_parse_json(text))
    return F.coalesce(kind.startswith("OBJECT") & (members == F.array(F.lit("document"), after)), F.lit(False))


def read_events(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Event documents, one per file, and the text of files that hold no JSON object. The schema is fixed."""
    files = (
        spark.read.text(path, wholetext=True, pathGlobFilter="*.json")
        .select(
            F.col("value"), F.col("_metadata.file_path").alias("payload_id"),
            F.col("_metadata.file_modification_time").alias("created_at"),
        )
    )
    typed = files.withColumn("is_object", is_json_object(F.col("value")))
    parsed = typed.where("is_object").withColumn("event", F.from_json("value", ERROR_EVENT))
    corrupt = typed.where("not is_object").select("payload_id", F.col("value").alias(CORRUPT))
    return parsed.select("payload_id", "created_at", "event.*"), corrupt


def signal_events(df: DataFrame) -> DataFrame:
    """Raw reports (``value`` the whole text): the first line names the signal, every other non-empty one is a frame."""
    lines = F.split("value", "\n", -1)
    signal = F.get(lines, F.lit(0))
    return df.select(
        *[c for c in df.columns if c != "value"],
        F.concat(F.lit(SIGNAL_CLASS), signal).alias("exception_class"),
        F.concat(F.lit(SIGNAL_MESSAGE), signal).alias("message"),
        raw_frames(F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))).alias("backtrace"),
    )


def crash_time(file_name: Column, written: Column) -> Column:
    """When a raw signal report was begun: as its file's name says, or else when the file was written."""
    name = F.regexp_extract(file_name, r"\Asignal-[0-9]+-([0-9]{9,11})\.txt\z", 1)
    return F.coalesce(F.timestamp_seconds(F.when(name != "", name.cast("bigint"))), written)


def read_signal_reports(spark: SparkSession, path: str) -> DataFrame:
    """Raw signal reports as events. ``crashed_at`` comes from the file name, or else its modification time."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt")
    written = F.col("_metadata.file_modification_time")
    stamped = files.select(
        "value", F.col("_metadata.file_path").alias("payload_id"), written.alias("created_at"),
        crash_time(F.col("_metadata.file_name"), written).alias("crashed_at"),
    )
    return signal_events(stamped)


def complete_signal_reports(
    df: DataFrame,
    cfg: Config = Config(),
    now: Column | None = None,
    user_changes: DataFrame | None = None,
    trails: DataFrame | None = None,
    keys: tuple[str, ...] = ("device",),
    scrub: bool = True,
) -> DataFrame:
    """Fill in what a signal handler cannot know: settings, the upload time, the user current at upload, and the
    trail the crashed run left behind. ``scrub=False`` leaves the report's text as it was written."""
    uploaded = F.current_timestamp() if now is None else now
    done = df.withColumns(
        {
            "occurred_at": uploaded,
            "environment": F.lit(cfg.environment),
            "release": F.lit(cfg.release),
            "server_name": F.lit(cfg.server_name),
            "context": F.lit("{}"),
            "tags": F.lit("{}"),
        }
    )
    if scrub and cfg.scrub:
        done = scrub_events(done)
    if user_changes is not None:
        user_type = user_changes.schema["user"].dataType
        done = done.withColumns({"at": F.col("occurred_at"), "user": F.lit(None).cast(user_type)})
        done = resolve_user(done, user_changes, list(keys)).drop("at")
    if trails is not None:
        done = attach_previous_trail(done, trails, list(keys))
    return done


def pending_events(
    spark: SparkSession, path: str, cfg: Config = Config(), now: Column | None = None, **completion
) -> DataFrame:
    """What is to be uploaded out of a folder, as events: JSON documents and completed signal reports.

    Nothing unless the project reports; only files inside the age limit, the newest of them up to the limit on their
    number; ``position`` is the order in which they go out, oldest first.
    """
    uploaded = F.current_timestamp() if now is None else now
    events, _ = read_events(spark, path)
    signals = complete_signal_reports(read_signal_reports(spark, path), cfg, uploaded, **completion)
    found = filter_enabled(events.unionByName(signals, allowMissingColumns=True), cfg)
    kept, _ = retain(found.withColumn("source", F.lit("folder")), uploaded)
    waiting = upload_order(kept).drop("source")
    return strict_events(waiting, cfg.privacy_allowed_fields) if cfg.strict_privacy else waiting


def event_json(columns: list[str]) -> Column:
    """One event as a JSON document. Free-form text columns go in as JSON values, timestamps as UTC text without
    fraction. Null attributes are left out, except those a reader expects as explicit nulls."""
    explicit = {"release", "server_name"}
    documents = {"context", "tags"}
    optional = [c for c in columns if c not in explicit | {"backtrace"}]

    def typed(name: str) -> Column:
        if name in documents:
            return F.try_parse_json(name).alias(name)
        return (iso_seconds(F.col(name)) if name == "occurred_at" else F.col(name)).alias(name)

    parts = [F.to_json(F.struct(*[typed(c) for c in optional]))]
    shown = [c for c in columns if c in explicit]
    if shown:
        parts.append(F.to_json(F.struct(*shown), {"ignoreNullFields": "false"}))
    if "backtrace" in columns:
        # A frame's file and line stay explicit nulls, too.
        frames = F.to_json(F.struct("backtrace"), {"ignoreNullFields": "false"})
        parts.append(F.when(F.col("backtrace").isNotNull(), frames))
    bodies = [F.regexp_extract(p, r"(?s)\A\{(.*)\}\z", 1) for p in parts]
    filled = F.filter(F.array(*bodies), lambda b: b.isNotNull() & (b != ""))
    return F.concat(F.lit("{"), F.array_join(filled, ","), F.lit("}"))


def write_events(df: DataFrame, path: str) -> None:
    """Events as JSON lines, one document each, written by every task in parallel."""
    df.select(event_json(df.columns).alias("value")).write.mode("append").text(path)


def write_trails(trails: DataFrame, path: str, cfg: Config = Config()) -> None:
    """Trails (``breadcrumbs`` per key and ``modified_at``) as JSON, scrubbed unless scrubbing is off."""
    scrub_trails(trails, cfg).write.mode("append").json(path)


def read_trails(spark: SparkSession, path: str, keys: str = "device string") -> DataFrame:
    """Trails as they were written, to attach to the crashes of the runs that left them."""
    schema = f"{keys}, modified_at timestamp, breadcrumbs array<{BREADCRUMB}>"
    return spark.read.schema(schema).json(path).where("size(breadcrumbs) > 0 and modified_at is not null")
