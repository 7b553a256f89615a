"""Changes (flags, configuration, deployments of infrastructure) and the errors around them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telemetry_spark.config import Config
from telemetry_spark.functions.changefields import change_kind, change_title, valid_details
from telemetry_spark.functions.delivery import safe_url
from telemetry_spark.functions.text import empty_to_null
from telemetry_spark.functions.timefmt import micros
from telemetry_spark.operators.delivery import filter_enabled
from telemetry_spark.plans.asof import latest_as_of
from telemetry_spark.plans.caps import first_of
from telemetry_spark.plans.running import clock_slices, running


def changes(df: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Change records: defaults filled in, each field cleaned, a blank title dropping the record."""
    built = df.select(
        change_kind(F.col("kind")).alias("kind"),
        change_title(F.col("title")).alias("title"),
        F.coalesce(F.col("environment"), F.lit(cfg.environment)).alias("environment"),
        F.coalesce(F.col("occurred_at"), F.current_timestamp()).alias("occurred_at"),
        valid_details(F.col("details")).alias("details"),
        empty_to_null(F.col("service")).alias("service"),
        empty_to_null(F.col("actor")).alias("actor"),
        safe_url(F.col("url")).alias("url"),
        empty_to_null(F.col("id")).alias("id"),
    )
    return built.where(F.col("title").isNotNull())


def enabled_changes(df: DataFrame, cfg: Config) -> DataFrame:
    return changes(filter_enabled(df, cfg), cfg)


def dedupe_changes(df: DataFrame) -> DataFrame:
    """One record per id, the earliest; records without an id are all kept."""
    order = [F.col("occurred_at"), F.col("kind"), F.col("title")]
    named = first_of(df.where(F.col("id").isNotNull()), ["id"], order)
    return named.unionByName(df.where(F.col("id").isNull()))


def errors_around_changes(
    errors: DataFrame,
    records: DataFrame,
    before_seconds: float,
    after_seconds: float,
    keys: Sequence[str] = ("environment",),
    slice_seconds: float | None = None,
) -> DataFrame:
    """Errors in ``[change - before, change)`` and ``[change, change + after]``, per change (``change_id``).

    Each change asks for the running number of errors at three moments, so the work is one ordered pass over errors
    and changes, however many errors stand around each change. Errors are counted per moment first, which bounds a
    burst of them by its moments.
    """
    at = micros(F.col("occurred_at"))
    before, after = int(before_seconds * 1_000_000), int(after_seconds * 1_000_000)
    moments_hit = errors.groupBy(*keys, at.alias("__at")).agg(F.count(F.lit(1)).alias("__error"))
    counted = moments_hit.select(
        *keys, "__at", F.lit(1).alias("__side"), "__error",
        F.lit(None).cast("string").alias("change_id"), F.lit(None).cast("int").alias("__probe"),
    )
    moments = F.array(
        F.struct((at - before).alias("at"), F.lit(0).alias("side"), F.lit(0).alias("probe")),
        F.struct(at.alias("at"), F.lit(0).alias("side"), F.lit(1).alias("probe")),
        F.struct((at + after).alias("at"), F.lit(2).alias("side"), F.lit(2).alias("probe")),
    )
    asked = records.select(*keys, F.col("change_id").cast("string"), F.explode(moments).alias("m")).select(
        *keys, F.col("m.at").alias("__at"), F.col("m.side").alias("__side"), F.lit(0).cast("bigint").alias("__error"),
        "change_id", F.col("m.probe").alias("__probe"),
    )
    order = [F.col("__at"), F.col("__side"), F.col("change_id")]
    slice_by = clock_slices(F.col("__at"), slice_seconds)
    seen = running(counted.unionByName(asked), keys, order, slice_by, __seen=("sum", F.col("__error")))

    def at_probe(i: int):
        return F.max(F.when(F.col("__probe") == i, F.col("__seen")))

    answers = seen.where(F.col("__probe").isNotNull()).groupBy(*keys, "change_id")
    return answers.agg(
        (at_probe(1) - at_probe(0)).alias("errors_before"), (at_probe(2) - at_probe(1)).alias("errors_after")
    )


def latest_change(
    errors: DataFrame,
    records: DataFrame,
    within_seconds: float,
    keys: Sequence[str] = ("environment",),
    slice_seconds: float | None = None,
) -> DataFrame:
    """Each error with the last change at or before it, null when that is more than ``within_seconds`` ago."""
    at = F.col("occurred_at")
    found = latest_as_of(
        errors, records, keys, at, at, F.col("change_id").cast("string"),
        F.struct(F.col("change_id"), F.col("kind"), F.col("title"), at.alias("changed_at")), "change", slice_seconds,
    )
    recent = micros(at) - micros(F.col("change.changed_at")) <= int(within_seconds * 1_000_000)
    return found.withColumn("change", F.when(recent, F.col("change")))
