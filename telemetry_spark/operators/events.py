"""Error events: assembled, scrubbed and reduced in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_spark.config import Config
from telemetry_spark.functions.frames import parse_frames
from telemetry_spark.functions.pii import scrub_columns
from telemetry_spark.functions.privacy import (
    allowed_fields,
    fingerprint_of,
    strict_transaction,
    user_id_only,
)
from telemetry_spark.functions.sqltext import mask_sql, sql_objects, statement_in
from telemetry_spark.operators.delivery import filter_enabled

DEFAULT_CLASS = "NSException"  # fixed value
SOURCE_KEYS = ("context_line", "pre_context", "post_context")  # fixed values
SCRUBBED = (
    "exception_class", "message", "backtrace", "environment", "release", "server_name", "context", "tags", "sdk_name",
    "breadcrumbs", "sql_objects", "sql_statement",
)
DROPPED_WHEN_STRICT = ("breadcrumbs", "endpoint", "sql_statement")  # fixed values


def _or_null(df: DataFrame, name: str, dtype: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(dtype)


def with_sql(df: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Objects of an error's statement, and the masked statement itself only when it is opted in to.

    The statement is ``sql`` where given, else found in ``info``, ``message`` and ``causes``. It is masked without
    a database system, since an event does not name one.
    """
    if not (cfg.capture_sql_objects or cfg.capture_sql_statement):
        return df
    causes = F.col("causes") if "causes" in df.columns else None
    info = _or_null(df, "info", "map<string,string>")
    found = F.coalesce(_or_null(df, "sql"), statement_in(info, F.col("message"), causes, cfg.sql_keys))
    masked = df.withColumn("__masked", mask_sql(found))
    added = {}
    if cfg.capture_sql_objects:
        added["sql_objects"] = sql_objects(F.col("__masked"))
    if cfg.capture_sql_statement:
        added["sql_statement"] = F.col("__masked")
    return masked.withColumns(added).drop("__masked")


def with_defaults(df: DataFrame, cfg: Config) -> DataFrame:
    """Every attribute of an event filled in from the error and the project's settings."""
    attributes = {
        "exception_class": F.coalesce(_or_null(df, "exception_class"), F.lit(DEFAULT_CLASS)),
        "message": F.coalesce(_or_null(df, "message"), F.lit("")),
        "occurred_at": F.coalesce(_or_null(df, "occurred_at", "timestamp"), F.current_timestamp()),
        "environment": F.coalesce(_or_null(df, "environment"), F.lit(cfg.environment)),
        "release": F.coalesce(_or_null(df, "release"), F.lit(cfg.release)),
        "server_name": F.coalesce(_or_null(df, "server_name"), F.lit(cfg.server_name)),
        "context": F.coalesce(_or_null(df, "context"), F.lit("{}")),
        "tags": F.lit("{}"),
        "sdk_name": F.lit(cfg.sdk_name),
    }
    if "stack" in df.columns:
        attributes["backtrace"] = parse_frames(F.col("stack"), F.lit(cfg.executable))
    if "breadcrumbs" in df.columns:
        attributes["breadcrumbs"] = F.when(F.size("breadcrumbs") > 0, F.col("breadcrumbs"))
    return df.withColumns(attributes)


def scrub_events(df: DataFrame) -> DataFrame:
    """Scrub every attribute that can hold text, the user and the trace id excepted: those are sent as they are."""
    documents = tuple(c for c in ("context", "tags") if c in df.columns)
    if "breadcrumbs" in df.columns:
        documents += ("breadcrumbs.data",)
    return scrub_columns(df, [c for c in SCRUBBED if c in df.columns], json_cols=documents)


def build_events(df: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Errors as events: assembled, SQL attached, scrubbed, and reduced last, so a fingerprint is of the message as it
    would have been sent. Columns only an error has (stack, info, causes, sql) are dropped."""
    events = with_sql(with_defaults(filter_enabled(df, cfg), cfg), cfg).drop("stack", "info", "causes", "sql")
    if cfg.scrub:
        events = scrub_events(events)
    return strict_events(events, cfg.privacy_allowed_fields) if cfg.strict_privacy else events


def strict_events(df: DataFrame, allowed: tuple[str, ...] | list[str] = ()) -> DataFrame:
    """Events without free text: the message as a fingerprint, listed fields only, the user as an id. Reducing an
    event again changes nothing, and attributes not named here pass through."""
    reduced = {
        "message_fingerprint": fingerprint_of(_or_null(df, "message_fingerprint"), F.col("message")),
        "message": F.lit(""),
    }
    for name in ("context", "tags"):
        if name in df.columns:
            reduced[name] = allowed_fields(F.col(name), list(allowed))
    if "user" in df.columns:
        user = df.schema["user"].dataType
        boolean = user["id"].dataType.typeName() == "boolean"
        identifier = user_id_only(F.col("user.id"), boolean)
        reduced["user"] = F.when(identifier.isNotNull(), F.struct(identifier.alias("id")))
    if "transaction_name" in df.columns:
        reduced["transaction_name"] = strict_transaction(F.col("transaction_name"))
    if "backtrace" in df.columns:
        frame = df.schema["backtrace"].dataType.elementType
        named = [k for k in SOURCE_KEYS if k in frame.names]
        if named:
            reduced["backtrace"] = F.transform("backtrace", lambda f: f.dropFields(*named))
    return df.withColumns(reduced).drop(*DROPPED_WHEN_STRICT)


def strict_failures(df: DataFrame) -> DataFrame:
    """Job failures without their error text."""
    kept = df.drop("error_message")
    if "transaction_name" not in df.columns:
        return kept
    return kept.withColumn("transaction_name", strict_transaction(F.col("transaction_name")))
