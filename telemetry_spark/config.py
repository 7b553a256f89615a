"""Job parameters, with the operating limits the results depend on."""

from __future__ import annotations

from dataclasses import dataclass

# Operating limits and defaults that results must agree on.
MAX_FRAMES = 500
MAX_SPANS = 500
MAX_PENDING_TRACES = 100
MAX_BATCH_ENTRIES = 1000
MAX_CONSECUTIVE_FAILURES = 5
MAX_PENDING_PAYLOADS = 20
MAX_PAYLOAD_AGE_SECONDS = 7 * 24 * 3600
MAX_TITLE_LENGTH = 200
TRAIL_SLACK_SECONDS = 1.0


@dataclass(frozen=True)
class Config:
    """Settings of one project. A table of these (see ``schemas.CONFIG``) is joined for many projects."""

    dsn: str | None = None
    environment: str = "production"
    release: str | None = None
    server_name: str | None = None
    sdk_name: str = "objc"  # fixed value: the client language events are marked with
    enabled_environments: tuple[str, ...] = ("production", "staging")
    scrub: bool = True
    capture_sql_objects: bool = True
    capture_sql_statement: bool = False
    # Keys of an error's info map that may hold its SQL, first non-blank wins. A client's own key goes first.
    sql_keys: tuple[str, ...] = ("sql", "statement", "query")
    track_breadcrumbs: bool = True
    max_breadcrumbs: int = 30
    track_performance: bool = True
    performance_flush_interval: str = "60 seconds"
    track_tracing: bool = True
    trace_capture_threshold: float = 1.0
    metric_flush_interval: str = "60 seconds"
    infrastructure_metric_flush_interval: str = "60 seconds"
    propagate_traces: bool = True
    trace_propagation_targets: tuple[str, ...] | None = None
    trace_propagation_patterns: tuple[str, ...] = ()
    strict_privacy: bool = False
    privacy_allowed_fields: tuple[str, ...] = ()
    executable: str | None = None
