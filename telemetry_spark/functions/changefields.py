"""Fields of a change record."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetry_spark.config import MAX_TITLE_LENGTH
from telemetry_spark.functions.text import empty_to_null, let, strip

# Fixed values.
CHANGE_KINDS = ("feature_flag", "config", "migration", "dependency", "infrastructure", "other")


def change_kind(kind: Column) -> Column:
    return F.when(kind.isin(*CHANGE_KINDS), kind).otherwise("other")


def change_title(title: Column) -> Column:
    """Trimmed and cut to 200 characters, null for a blank one."""
    return empty_to_null(F.left(strip(title), F.lit(MAX_TITLE_LENGTH)))


def valid_details(details: Column) -> Column:
    """Details kept only when they are a JSON object."""
    return let(
        F.schema_of_variant(F.try_parse_json(details)), lambda kind: F.when(kind.startswith("OBJECT"), details)
    )
