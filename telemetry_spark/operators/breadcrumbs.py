"""Breadcrumb trails and current users, matched to errors by time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_spark.config import TRAIL_SLACK_SECONDS, Config
from telemetry_spark.functions.pii import scrub_columns
from telemetry_spark.functions.timefmt import micros
from telemetry_spark.plans.asof import latest_as_of
from telemetry_spark.plans.caps import first_n
from telemetry_spark.plans.running import clock_slices, running
from telemetry_spark.plans.session import cut_lineage


def recorded(crumbs: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Breadcrumbs with their defaults; none are recorded when the feature is off or under strict privacy."""
    if not cfg.track_breadcrumbs or cfg.strict_privacy:
        return crumbs.where(F.lit(False))
    defaults = {"category": "custom", "level": "info", "data": "{}"}
    return crumbs.withColumns({k: F.coalesce(F.col(k), F.lit(v)) for k, v in defaults.items() if k in crumbs.columns})


def epochs(
    crumbs: DataFrame, keys: Sequence[str], order: Sequence[Column], time: Column, slice_seconds: float | None = 3600.0
) -> DataFrame:
    """Number of clears up to and including each row: a clear starts a new trail."""
    return running(
        crumbs, keys, order, clock_slices(micros(time), slice_seconds), epoch=("sum", F.col("is_clear").cast("int"))
    )


def last_n(crumbs: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], n: int = 30) -> DataFrame:
    """The newest ``n`` of each trail."""
    return first_n(crumbs, keys, newest_first, n)


def attach_breadcrumbs(
    errors: DataFrame,
    crumbs: DataFrame,
    keys: Sequence[str],
    crumb: Column,
    n: int = 30,
    slice_seconds: float | None = 3600.0,
) -> DataFrame:
    """Add ``breadcrumbs`` to each error: its trail's last ``n`` since the last clear, oldest first.

    Both sides carry ``at`` and ``seq``; ``crumbs`` also ``is_clear``. Crumbs are numbered per key and stored in
    blocks of ``n``, each with the block before it, so every error finds its whole trail in exactly one block. Blocks
    hold at most ``2 * n`` crumbs and spread evenly, whatever the size of a trail.
    """
    is_crumb = ~F.col("is_clear")
    trail_rows = crumbs.select(
        *keys, micros(F.col("at")).alias("__at"), F.col("seq").alias("__seq"),
        is_crumb.cast("int").alias("__crumbs"), F.col("is_clear").cast("int").alias("__clears"),
        F.when(is_crumb, crumb).alias("__crumb"),
    )
    error_rows = errors.select(
        *keys, micros(F.col("at")).alias("__at"), F.col("seq").alias("__seq"),
        F.lit(0).alias("__crumbs"), F.lit(0).alias("__clears"),
        F.struct(*[F.col(c) for c in errors.columns]).alias("__error"),
    )
    slice_by = clock_slices(F.col("__at"), slice_seconds)
    placed = running(
        trail_rows.unionByName(error_rows, allowMissingColumns=True), keys, [F.col("__at"), F.col("__seq")], slice_by,
        __number=("sum", F.col("__crumbs")), __epoch=("sum", F.col("__clears")),
    )
    # Errors and blocks both come from here; a struct of the keys equals itself where a key is null.
    placed = cut_lineage(placed.withColumn("__who", F.struct(F.lit(0).alias("one"), *keys)))
    block = F.floor((F.col("__number") - 1) / n)
    entry = F.struct(F.col("__number").alias("number"), F.col("__epoch").alias("epoch"), F.col("__crumb").alias("crumb"))
    blocks = (
        placed.where("__crumbs = 1")
        .select("__who", F.explode(F.array(block, block + 1)).alias("__block"), entry.alias("__entry"))
        .groupBy("__who", "__block")
        .agg(F.collect_list("__entry").alias("__entries"))
    )
    asking = placed.where("__error is not null").select(
        "__who", "__number", "__epoch", block.alias("__block"), "__error"
    )
    joined = asking.join(blocks, ["__who", "__block"], "left")
    number, epoch = F.col("__number"), F.col("__epoch")
    mine = F.filter(
        F.coalesce(F.sort_array("__entries"), F.array().cast(joined.schema["__entries"].dataType)),
        lambda e: (e["epoch"] == epoch) & (e["number"] > number - n) & (e["number"] <= number),
    )
    return joined.select("__error.*", F.transform(mine, lambda e: e["crumb"]).alias("breadcrumbs"))


def attach_previous_trail(
    crashes: DataFrame,
    trails: DataFrame,
    keys: Sequence[str],
    slack_seconds: float = TRAIL_SLACK_SECONDS,
    slice_seconds: float | None = None,
) -> DataFrame:
    """Add the trail a crashed run left behind: the last one written no later than the crash, one second of slack
    allowed, null when a later run has replaced every such trail."""
    return latest_as_of(
        crashes, trails, keys, F.col("crashed_at") + F.make_dt_interval(secs=F.lit(slack_seconds)),
        F.col("modified_at"), F.to_json(F.struct("modified_at")), F.col("breadcrumbs"), "breadcrumbs", slice_seconds,
    )


def resolve_user(
    events: DataFrame, user_changes: DataFrame, keys: Sequence[str], slice_seconds: float | None = None
) -> DataFrame:
    """Fill in each event's user: its own, else the last one set on its key at or before it. Setting no user clears.

    Both sides carry ``at``; ``user_changes`` also ``seq``, the order of changes of one moment.
    """
    known = latest_as_of(
        events, user_changes, keys, F.col("at"), F.col("at"), F.col("seq"), F.col("user"), "__current", slice_seconds
    )
    return known.withColumn("user", F.coalesce(F.col("user"), F.col("__current"))).drop("__current")


def scrub_trails(trails: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Trails the way they are persisted: texts and free-form data scrubbed, unless scrubbing is off."""
    return scrub_columns(trails, ["breadcrumbs"], json_cols=("breadcrumbs.data",)) if cfg.scrub else trails
