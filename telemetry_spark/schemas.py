"""One explicit schema per signal. Free-form parts (context, tags, data, details) are JSON text."""

FRAME = "struct<file:string,line:int,method:string,in_app:boolean>"
BREADCRUMB = "struct<category:string,message:string,level:string,timestamp:timestamp,data:string>"
SQL_OBJECTS = "struct<operation:string,procedures:array<string>,relations:array<string>>"
USER = "struct<id:string,email:string,username:string>"

ERROR_EVENT = (
    f"exception_class string, message string, backtrace array<{FRAME}>, occurred_at timestamp, "
    "environment string, release string, server_name string, context string, tags string, sdk_name string, "
    f"breadcrumbs array<{BREADCRUMB}>, sql_objects {SQL_OBJECTS}, sql_statement string, user {USER}, "
    "trace_id string, message_fingerprint string, endpoint string, transaction_name string"
)
MEASUREMENT = "transaction_name string, environment string, release string, ts timestamp, duration_ms double"
PERFORMANCE_SAMPLE = (
    "transaction_name string, environment string, release string, period_started_at timestamp, "
    "period_ended_at timestamp, request_count bigint, duration_sum_ms double, max_duration_ms double, "
    "histogram map<string,bigint>"
)
METRIC = "metric_name string, value double, environment string, release string, recorded_at timestamp"
INFRA_METRIC = "metric_name string, value double, hostname string, recorded_at timestamp"
SPAN = (
    "trace_id string, span_id string, parent_span_id string, name string, kind string, started_at timestamp, "
    "duration_ms double, environment string, release string, data string"
)
CHANGE = (
    "kind string, title string, environment string, occurred_at timestamp, details string, service string, "
    "actor string, url string, id string"
)
ATTEMPT = "source string, batch_id bigint, attempted_at timestamp, status int"
CONFIG = "project string, dsn string, environment string, enabled_environments array<string>"
