"""Delivery outcomes, endpoints and the predicates that gate reporting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetry_spark.functions.text import empty_to_null, let

# Outcomes, reason texts and endpoint names that results must agree on.
DELIVERED, REJECTED, FAILED = "delivered", "rejected", "failed"
ENDPOINTS = {
    "events": "/events",
    "performance_samples": "/performance_samples",
    "custom_metrics": "/custom_metrics",
    "infrastructure_metrics": "/infrastructure_metrics",
    "changes": "/changes",
    "spans": "/spans",
}
WEB_SCHEMES = ("http", "https")
# scheme, user info, host (a bracketed IPv6 address or a name), rest
_DSN = r"\A([A-Za-z][A-Za-z0-9+.-]*)://(?:([^/?#@]*)@)?(\[[^\]\s]*\]|[^/?#@:\s\[\]]*)((?::[0-9]*)?(?:[/?#]\S*)?)\z"


def delivery_outcome(status: Column) -> Column:
    """2xx is delivered; a 4xx other than 408 and 429 is rejected for good; anything else failed for now."""
    return (
        F.when(status.between(200, 299), DELIVERED)
        .when(status.between(400, 499) & ~status.isin(408, 429), REJECTED)
        .otherwise(FAILED)
    )


def delivery_outcome_of(status: int) -> str:
    """``delivery_outcome`` of the one status a flush got back, on the driver."""
    if 200 <= status < 300:
        return DELIVERED
    return REJECTED if 400 <= status < 500 and status not in (408, 429) else FAILED


def drop_reason(status: Column) -> Column:
    return (
        F.when(
            delivery_outcome(status) == REJECTED,
            F.concat(F.lit("rejected by the server (HTTP "), status.cast("string"), F.lit(")")),
        )
        .when(status == 0, "the server could not be reached")
        .otherwise(F.concat(F.lit("the server answered HTTP "), status.cast("string")))
    )


def dsn_api_key(dsn: Column) -> Column:
    """The percent-decoded user of a DSN; null without one, without a host, or when malformed."""
    info = empty_to_null(F.regexp_extract(dsn, _DSN, 2))
    # "+" stands for itself in a URL's user part, unlike in a form.
    user = F.regexp_extract(info, r"\A([^:]*)", 1)
    key = F.try_url_decode(F.replace(user, F.lit("+"), F.lit("%2B")))
    return F.when(_has_host(dsn), empty_to_null(key))


def _has_host(dsn: Column) -> Column:
    return F.coalesce(dsn.rlike(_DSN) & (F.regexp_extract(dsn, _DSN, 3) != ""), F.lit(False))


def dsn_ingestion_url(dsn: Column) -> Column:
    """A DSN without its credentials."""
    return F.when(_has_host(dsn), F.regexp_replace(dsn, r"\A([A-Za-z][A-Za-z0-9+.-]*://)[^/?#@]*@", "$1"))


def endpoint_for(dsn: Column, signal: str) -> Column:
    """The URL a signal is sent to: a path ending in ``/events`` has that swapped, any other is left alone."""
    return F.regexp_replace(dsn_ingestion_url(dsn), r"\A([^?#]*)/events(?=[?#]|\z)", f"$1{ENDPOINTS[signal]}")


def is_enabled(dsn: Column, environment: Column, enabled_environments: Column) -> Column:
    allowed = F.coalesce(F.array_contains(enabled_environments, environment), F.lit(False))
    return dsn_api_key(dsn).isNotNull() & allowed


def should_propagate(
    host: Column,
    targets: Column | None = None,
    patterns: tuple[str, ...] = (),
    enabled: bool = True,
) -> Column:
    """Whether a request to ``host`` carries the trace. No target list means every host does, even an unknown one;
    a target matches exactly or on a dot boundary, a pattern anywhere in the lowercased host."""
    if not enabled:
        return F.lit(False)
    if targets is None and not patterns:
        return F.lit(True)

    def matches(lowered: Column) -> Column:
        found = F.lit(False)
        if targets is not None:
            names = F.transform(targets, lambda t: F.regexp_replace(F.lower(t), r"\A\.", ""))
            found = F.exists(
                names, lambda n: (n != "") & ((lowered == n) | lowered.endswith(F.concat(F.lit("."), n)))
            )
        for pattern in patterns:
            found = found | lowered.rlike(pattern)
        return F.coalesce((lowered != "") & found, F.lit(False))

    listed = let(F.lower(host), matches)
    if targets is None:
        return listed
    return listed if patterns else F.when(targets.isNull(), True).otherwise(listed)


def safe_url(url: Column) -> Column:
    """A URL kept only when its scheme is http or https."""
    scheme = F.lower(F.regexp_extract(url, r"\A([A-Za-z][A-Za-z0-9+.-]*):\S*\z", 1))
    return F.when(scheme.isin(*WEB_SCHEMES), url)
