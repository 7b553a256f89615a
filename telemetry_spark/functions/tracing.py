"""Span and trace scalars: ids, headers, names, kinds and span data."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetry_spark.functions.privacy import json_object
from telemetry_spark.functions.sqltext import mask_sql
from telemetry_spark.functions.text import empty_to_null, let, strip

# Names and shapes that results must agree on.
SPAN_KINDS = ("controller", "service", "database", "redis", "http", "job", "other")
TRACE_ID = r"\A(?!0+\z)[0-9a-f]{32}\z"
SPAN_ID = r"\A(?!0+\z)[0-9a-f]{16}\z"
TRACEPARENT = r"\A00-(?!0{32})[0-9a-f]{32}-(?!0{16})[0-9a-f]{16}-[0-9a-f]{2}\z"
KEPT_DATA = ("db.statement", "db.system")


def span_kind(kind: Column) -> Column:
    return F.when(kind.isin(*SPAN_KINDS), kind).otherwise("other")


def round_ms(c: Column) -> Column:
    """Two decimals, halves away from zero, on the binary value."""
    return F.signum(c) * F.floor(F.abs(c) * 100 + 0.5) / 100


def is_trace_id(c: Column) -> Column:
    return F.coalesce(c.rlike(TRACE_ID), F.lit(False))


def is_span_id(c: Column) -> Column:
    return F.coalesce(c.rlike(SPAN_ID), F.lit(False))


def _hex_id(seed: Column, length: int) -> Column:
    digits = F.left(F.sha2(seed.cast("string"), 256), F.lit(length))
    return F.when(digits == "0" * length, F.lpad(F.lit("1"), length, "0")).otherwise(digits)


def trace_id(seed: Column | None = None) -> Column:
    """32 hex digits, never all zero: from a key, so that a retried task gives the same id, or at random."""
    return _hex_id(F.uuid() if seed is None else seed, 32)


def span_id(seed: Column | None = None) -> Column:
    return _hex_id(F.uuid() if seed is None else seed, 16)


def traceparent(trace: Column, span: Column, existing: Column, allowed: Column) -> Column:
    """The header a request goes out with: one already set stays, else a new one where propagation is allowed."""
    fresh = F.when(allowed & trace.isNotNull(), F.concat(F.lit("00-"), trace, F.lit("-"), span, F.lit("-01")))
    return F.coalesce(existing, fresh)


def parse_traceparent(c: Column) -> Column:
    """Trace id and parent span id of a header, null fields for a malformed one."""
    # Version, 32 digits, 16 digits and flags stand at fixed places in a well-formed header.
    valid = c.rlike(TRACEPARENT)
    return F.struct(
        F.when(valid, F.substring(c, 4, 32)).alias("trace_id"), F.when(valid, F.substring(c, 37, 16)).alias("parent_span_id")
    )


def request_name(method: Column, url: Column) -> Column:
    host = empty_to_null(F.try_parse_url(url, F.lit("HOST")))
    return F.concat(F.coalesce(method, F.lit("GET")), F.lit(" "), F.coalesce(host, F.lit("unknown host")))


def request_data(status: Column) -> Column:
    """Span data of a request: its status when there was a response, else nothing."""
    return F.when(status.isNotNull(), F.to_json(F.struct(status.alias("status")))).otherwise("{}")


def span_data(kind: Column, data: Column, statement: Column, system: Column) -> Column:
    """JSON data of a span. A database span carries its system and its statement masked for that system, and never
    the raw text; any other kind ignores both."""
    given = F.coalesce(json_object(data), F.create_map().cast("map<string,variant>"))

    def text_entry(m: Column, key: str) -> Column:
        value = F.try_element_at(m, F.lit(key))
        return F.when(F.schema_of_variant(value) == "STRING", value.cast("string"))

    def rebuild(p: Column) -> Column:
        masked = mask_sql(p["statement"], p["system"])
        entries = F.map_from_entries(
            F.filter(
                F.array(
                    F.struct(F.lit("db.statement").alias("key"), masked.cast("variant").alias("value")),
                    F.struct(F.lit("db.system").alias("key"), p["system"].cast("variant").alias("value")),
                ),
                lambda e: F.when(e["key"] == "db.system", p["system"].isNotNull()).otherwise(masked.isNotNull()),
            )
        )
        rest = F.map_filter(p["given"], lambda k, v: ~k.isin(*KEPT_DATA))
        return F.to_json(F.map_concat(rest, entries))

    raw = let(
        given,
        lambda m: F.struct(
            m.alias("given"),
            F.coalesce(statement, text_entry(m, "db.statement")).alias("statement"),
            empty_to_null(F.lower(strip(F.coalesce(system, text_entry(m, "db.system"))))).alias("system"),
        ),
    )
    return F.when(kind == "database", let(raw, rebuild)).otherwise(F.coalesce(data, F.lit("{}")))


def strict_data(data: Column) -> Column:
    """Span data with only the masked statement and the database system, null when it has neither."""
    kept = F.map_filter(json_object(data), lambda k, v: k.isin(*KEPT_DATA))
    return let(kept, lambda m: F.when(F.size(m) > 0, F.to_json(m)))
