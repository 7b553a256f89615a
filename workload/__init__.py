"""Registered queries: each operator over the given tables, with the SQL that must agree with it."""

from workload import delivery, events, metrics, performance, pii, privacy, sqltext, streams, traces

REGISTRY = {
    **performance.QUERIES,
    **metrics.QUERIES,
    **delivery.QUERIES,
    **traces.QUERIES,
    **privacy.QUERIES,
    **pii.QUERIES,
    **sqltext.QUERIES,
    **events.QUERIES,
    **streams.QUERIES,
}
