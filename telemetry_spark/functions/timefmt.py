"""Timestamp text. The session time zone is UTC (see ``plans.session``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_seconds(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def iso_millis(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def duration_ms(start: Column, end: Column) -> Column:
    return (micros(end) - micros(start)) / 1000
