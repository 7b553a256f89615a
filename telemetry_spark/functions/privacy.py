"""Strict privacy: message fingerprints, and paths, names and users reduced to what cannot identify anyone.

The character classes are spelled out in ASCII on purpose: here a letter or digit means an ASCII one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetry_spark.functions.pii import EMAIL
from telemetry_spark.functions.text import blank_to_null, chain, is_blank, let

# Patterns and lengths that results must agree on.
FINGERPRINT_LENGTH = 32
MAX_SEGMENT_LENGTH = 40
DOUBLE_QUOTED = r'"[^"\r\n]*+"'
SINGLE_QUOTED = r"(?<![A-Za-z0-9_])'[^'\r\n]*+'(?![A-Za-z0-9_])"
HEX_ID = r"0x[0-9a-fA-F]{4,}"
UUID = (
    r"(?<![A-Za-z0-9_])[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}(?![A-Za-z0-9_])"
)
NUMBER = r"(?<![A-Za-z0-9_])[0-9]++(?![A-Za-z0-9_])"
ROUTE_PARAMETER = r"\A(?:\*[^\n]*+|:[^\n]++|\{[^\n]+\}|<[^\n]+>|\[[^\n]+\])\z"
HTTP_NAME = r"(?i)^(GET|POST|PUT|PATCH|DELETE|HEAD|OPTIONS)[ \t\r\n\f\x0B]++([^ \t\r\n\f\x0B]++)"
SCHEME = r"(?i)^[a-z][a-z0-9+.-]*+://"
PORT = r":[0-9]+\z"


def normalized_message(c: Column) -> Column:
    """The shape of a message, with the values in it replaced. Null reads as empty."""

    def swap(needle: str, pattern: str, replacement: str):
        return lambda t: F.when(t.contains(needle), F.regexp_replace(t, pattern, replacement)).otherwise(t)

    return chain(
        F.coalesce(c, F.lit("")),
        swap("@", EMAIL, "<email>"),
        swap('"', DOUBLE_QUOTED, "<str>"),
        swap("'", SINGLE_QUOTED, "<str>"),
        swap("0x", HEX_ID, "0x"),
        swap("-", UUID, "<uuid>"),
        lambda t: F.regexp_replace(t, NUMBER, "<n>"),
    )


def message_fingerprint(c: Column) -> Column:
    return F.left(F.sha2(normalized_message(c), 256), F.lit(FINGERPRINT_LENGTH))


def valid_fingerprint(c: Column) -> Column:
    return let(F.lower(c), lambda f: F.when(f.rlike(r"\A[0-9a-f]{32}\z"), f))


def fingerprint_of(existing: Column, message: Column) -> Column:
    return F.coalesce(valid_fingerprint(existing), message_fingerprint(message))


def is_route_parameter(c: Column) -> Column:
    return F.coalesce(c.rlike(ROUTE_PARAMETER), F.lit(False))


def strict_path(c: Column) -> Column:
    """A route template whole; of a raw path only the first segment, since anything after it can name a person."""

    def reduce(path: Column) -> Column:
        def shorten(parts: Column) -> Column:
            first = F.get(parts, F.lit(0))
            named = F.when(
                first.rlike("[0-9]") | (F.length(first) > MAX_SEGMENT_LENGTH), F.lit(":id")
            ).otherwise(first)
            return F.concat(
                F.when(path.startswith("/"), F.lit("/")).otherwise(""),
                named,
                F.when(F.size(parts) > 1, F.lit("/:path")).otherwise(""),
            )

        segments = F.split(path, "/", -1)
        raw = F.coalesce(let(F.filter(segments, lambda s: s != ""), shorten), F.lit("/"))
        return F.when(F.exists(segments, is_route_parameter), path).otherwise(raw)

    return let(F.regexp_extract(F.coalesce(c, F.lit("")), r"\A[^?#]*+", 0), reduce)


path_without_ids = strict_path


def host_of(c: Column) -> Column:
    """The host of an address, or null for a relative path. By pattern, so an address no parser accepts still
    never passes through whole."""

    def take_apart(address: Column) -> Column:
        rest = F.regexp_replace(address, SCHEME, "")
        authority = F.regexp_replace(F.regexp_extract(rest, r"\A[^/?#]*+", 0), r"(?s)\A.*@", "")
        return F.struct(authority.alias("authority"), address.rlike(SCHEME).alias("scheme"))

    def without_port(parts: Column) -> Column:
        host = F.regexp_replace(parts["authority"], PORT, "")
        return F.struct(host.alias("host"), (parts["scheme"] | parts["authority"].rlike(PORT)).alias("explicit"))

    def name(parts: Column) -> Column:
        host = parts["host"]
        named = parts["explicit"] | host.contains(".") | (F.lower(host) == "localhost")
        return F.when((F.length(host) > 0) & named, host)

    return chain(c, take_apart, without_port, name)


def strict_span_name(c: Column) -> Column:
    """A path reduced, ``METHOD target`` as the method and the target's host or reduced path, else unchanged."""

    def reduce(name: Column) -> Column:
        target = F.regexp_extract(name, HTTP_NAME, 2)
        method = F.upper(F.regexp_extract(name, HTTP_NAME, 1))
        # One reduced path serves both a name that is a path and a call whose target is one.
        plain = let(
            F.struct(F.when(name.startswith("/"), name).otherwise(target).alias("t"), method.alias("method")),
            lambda p: F.struct(p["method"].alias("method"), F.when(~p["t"].startswith("/"), host_of(p["t"])).alias("host"),
                               strict_path(p["t"]).alias("path")),
        )
        called = let(plain, lambda p: F.concat(p["method"], F.lit(" "), F.coalesce(p["host"], p["path"])))
        return F.when(name.startswith("/"), plain["path"]).when(name.rlike(HTTP_NAME), called).otherwise(name)

    return let(c, reduce)


def strict_transaction(c: Column) -> Column:
    return let(c, lambda name: F.when(is_blank(name), name).otherwise(strict_span_name(name)))


def strict_page_url(c: Column) -> Column:
    """Scheme and host, without credentials or port, and the reduced path."""

    def split(url: Column) -> Column:
        scheme = F.regexp_extract(url, SCHEME, 0)
        rest = F.substr(url, F.length(scheme) + 1)
        authority = F.regexp_replace(F.regexp_extract(rest, r"\A[^/?#]*+", 0), r"(?s)\A.*@", "")
        absolute = F.struct(
            F.concat(scheme, F.regexp_replace(authority, PORT, "")).alias("origin"),
            F.regexp_extract(rest, r"(?s)\A[^/?#]*+(.*)\z", 1).alias("path"),
        )
        return F.when(scheme != "", absolute).otherwise(F.struct(F.lit("").alias("origin"), url.alias("path")))

    return chain(c, split, lambda parts: F.concat(parts["origin"], strict_path(parts["path"])))


def user_id_only(identifier: Column, boolean: bool = False) -> Column:
    """A user's id as text. A blank id, and a false one, is no id."""
    if boolean:
        return F.when(identifier, F.lit("true"))
    return blank_to_null(identifier.cast("string"))


_SCALAR_TYPES = r"\A(?:STRING|BOOLEAN|BIGINT|DOUBLE|FLOAT|DECIMAL\([0-9]+, ?[0-9]+\))\z"


def json_object(c: Column) -> Column:
    """The top level of a JSON object as a map of variants, null for anything else."""
    return let(
        F.try_parse_json(c),
        lambda v: F.when(F.schema_of_variant(v).startswith("OBJECT"), v.cast("map<string,variant>")),
    )


def user_id_from_json(user: Column) -> Column:
    """``user_id_only`` of the ``id`` of a JSON user object, where booleans, numbers and text can be told apart."""

    def pick(v: Column) -> Column:
        kind = F.schema_of_variant(v)
        text = v.cast("string")
        return (
            F.when(kind == "BOOLEAN", F.when(text == "true", text))
            .when(kind.rlike(_SCALAR_TYPES), blank_to_null(text))
        )

    return let(F.try_variant_get(F.try_parse_json(user), "$.id", "variant"), pick)


def allowed_fields(c: Column, keys: list[str] | tuple[str, ...]) -> Column:
    """The listed top-level entries of a JSON object that are text, numbers or booleans; null when none is left."""
    if not keys:
        return F.lit(None).cast("string")
    kept = F.map_filter(
        json_object(c), lambda k, v: k.isin(*keys) & F.schema_of_variant(v).rlike(_SCALAR_TYPES)
    )
    return let(kept, lambda m: F.when(F.size(m) > 0, F.to_json(m)))
