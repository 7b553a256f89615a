"""Span trees: assembly, filtering, parents, and links from errors and between services."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetry_spark.config import MAX_SPANS, Config
from telemetry_spark.functions.privacy import strict_span_name
from telemetry_spark.functions.timefmt import duration_ms, iso_millis, micros
from telemetry_spark.functions.tracing import (
    parse_traceparent,
    request_data,
    request_name,
    round_ms,
    span_data,
    span_kind,
    strict_data,
)
from telemetry_spark.plans.caps import first_of
from telemetry_spark.plans.running import clock_slices, running
from telemetry_spark.plans.session import cut_lineage

IS_ROOT = "parent_span_id is null"


def spans(df: DataFrame, cfg: Config = Config()) -> DataFrame:
    """Recorded spans: kinds from the closed set, durations to two decimals, SQL masked; none when tracing is off.

    ``duration_ms`` may be given or follow from ``started_at`` and ``ended_at``; ``statement`` and ``db_system`` are
    optional.
    """
    given = set(df.columns)
    if "duration_ms" not in given:
        df = df.withColumn("duration_ms", duration_ms(F.col("started_at"), F.col("ended_at")))
    absent = F.lit(None).cast("string")
    statement, system, data = (F.col(c) if c in given else absent for c in ("statement", "db_system", "data"))
    built = {
        "data": span_data(F.col("kind"), data, statement, system),
        "kind": span_kind(F.col("kind")),
        "duration_ms": round_ms(F.col("duration_ms")),
        "environment": F.coalesce(F.col("environment") if "environment" in given else absent, F.lit(cfg.environment)),
        "release": F.coalesce(F.col("release") if "release" in given else absent, F.lit(cfg.release)),
    }
    recorded = df if cfg.track_tracing else df.where(F.lit(False))
    return recorded.withColumns(built).drop("statement", "db_system")


def request_spans(df: DataFrame) -> DataFrame:
    """Outbound calls as http spans, named by method and host unless a name was given; status only on a response."""
    name = F.coalesce(F.col("name"), request_name(F.col("method"), F.col("url")))
    return df.withColumns({"name": name, "kind": F.lit("http"), "data": request_data(F.col("status"))})


def strict_spans(df: DataFrame) -> DataFrame:
    return df.withColumns({"name": strict_span_name(F.col("name")), "data": strict_data(F.col("data"))})


def slow_traces(df: DataFrame, threshold_s: float = 1.0) -> DataFrame:
    """Whole traces whose root took at least the threshold."""
    slow = df.where(IS_ROOT).where(F.col("duration_ms") >= threshold_s * 1000).select("trace_id").distinct()
    return df.join(slow, "trace_id", "left_semi")


def roots(df: DataFrame) -> DataFrame:
    """One root per trace."""
    return first_of(df.where(IS_ROOT), ["trace_id"], [F.col("started_at"), F.col("span_id")])


def cap_spans(
    df: DataFrame, order: list[Column], limit: int = MAX_SPANS, threshold_s: float | None = None
) -> DataFrame:
    """The root and the first ``limit - 1`` other spans recorded in each trace, which is as many without its root.

    With a threshold only traces whose root took at least that long stay.
    """
    kept = _placed(df, order, limit)
    if threshold_s is not None:
        took = F.max(F.when(F.expr(IS_ROOT), F.col("duration_ms"))).over(Window.partitionBy("trace_id"))
        kept = kept.withColumn("__took", took).where(F.col("__took") >= threshold_s * 1000).drop("__took")
    return kept.drop("__late", "__place", "__longest")


def _placed(df: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The spans that the cap leaves, each with its place (equal where ``order`` is) and, if spans have durations, with
    ``__longest``: the longest of the roots up to it, which for a span that is no root is the longest of all.

    The root sorts first, so one ranking serves cap, place and threshold, and traces are moved once and sorted once on
    either side. Spark limits each trace within every task before it moves them (``WindowGroupLimit``): of a hot trace
    one task reads ``limit`` spans from each task at most.
    """
    late = df.withColumn("__late", F.expr(f"not ({IS_ROOT})"))
    ranked = Window.partitionBy("trace_id").orderBy("__late", *order)
    so_far = ranked.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = {
        "__n": F.row_number().over(ranked),
        "__place": F.rank().over(ranked),
        "__roots": F.count_if(~F.col("__late")).over(so_far),
    }
    if "duration_ms" in df.columns:
        seen["__longest"] = F.max(F.when(~F.col("__late"), F.col("duration_ms"))).over(so_far)
    room = (F.col("__roots") > 0) | (F.col("__n") <= limit - 1)
    return late.withColumns(seen).where((F.col("__n") <= limit) & room).drop("__n", "__roots")


def dedupe_finish(df: DataFrame, finishes: DataFrame) -> DataFrame:
    """The first record of each span, and of those only what was recorded before its trace first finished."""
    once = first_of(df, ["trace_id", "span_id"], [F.col("recorded_at")])
    finished = finishes.groupBy("trace_id").agg(F.min("finished_at").alias("__finished"))
    joined = once.join(finished, "trace_id", "left")
    in_time = F.col("__finished").isNull() | (F.col("recorded_at") <= F.col("__finished"))
    return joined.where(in_time).drop("__finished")


def assemble_traces(
    df: DataFrame, order: list[Column], cfg: Config = Config(), limit: int = MAX_SPANS
) -> DataFrame:
    """One envelope per slow trace: its capped spans, the root first and the rest as recorded.

    The cap comes first, so a hot trace moves ``limit`` spans of each task only, and no list holds more than ``limit``.
    """
    least = cfg.trace_capture_threshold * 1000
    kept = _placed(df, order, limit).where(~F.col("__late") | (F.col("__longest") >= least))
    if cfg.strict_privacy:
        kept = strict_spans(kept)
    span = F.struct(
        F.col("span_id"), F.col("parent_span_id"), F.col("name"), F.col("kind"),
        iso_millis(F.col("started_at")).alias("started_at"), F.col("duration_ms"),
        F.col("environment"), F.col("release"), F.col("data"),
    )
    listed = kept.groupBy("trace_id").agg(
        F.max("__longest").alias("__took"),
        F.sort_array(F.collect_list(F.struct(F.col("__place").alias("p"), span.alias("s")))).alias("entries"),
    ).where(F.col("__took") >= least)
    return listed.select("trace_id", F.col("entries.s").alias("spans"))


def span_tree(df: DataFrame, max_depth: int = MAX_SPANS) -> DataFrame:
    """Depth and path of names of every span that a root reaches within ``max_depth`` levels.

    Pointer doubling: each round every open span jumps to its ancestor's ancestor, so 500 levels take nine rounds.
    Spans find their ancestor by (trace, span) and never meet the rest of their trace, so a huge trace is no hot spot.
    """
    open_spans = df.select(
        "trace_id", "span_id", F.col("parent_span_id").alias("up"),
        F.when(F.expr(IS_ROOT), 0).otherwise(1).alias("depth"), F.array("name").alias("path"),
    )
    nodes = cut_lineage(open_spans)
    covered = 1
    while covered < max_depth:
        climbing = nodes.where("up is not null")
        if climbing.isEmpty():
            break
        above = nodes.select(
            "trace_id", F.col("span_id").alias("up"), F.col("up").alias("next_up"),
            F.col("depth").alias("up_depth"), F.col("path").alias("up_path"),
        )
        # An inner join: a span whose ancestor is missing hangs on nothing and is left out with all below it.
        jumped = climbing.join(above, ["trace_id", "up"]).select(
            "trace_id", "span_id", F.col("next_up").alias("up"),
            (F.col("depth") + F.col("up_depth")).alias("depth"), F.concat("up_path", "path").alias("path"),
        )
        nodes = cut_lineage(nodes.where("up is null").unionByName(jumped))
        covered *= 2
    return nodes.where("up is null").where(F.col("depth") < max_depth).drop("up")


def trace_top() -> Column:
    """A trace's first root as an aggregate, or its first span (``first.late``) if it has none."""
    first = F.struct(F.expr(f"not ({IS_ROOT})").alias("late"), "started_at", "span_id")
    return F.min(F.struct(first.alias("first"), "name", "duration_ms"))


def link_errors_to_traces(events: DataFrame, df: DataFrame) -> DataFrame:
    """Each error with its trace's root and number of spans, null for an error without a known trace."""
    # Errors outside any trace share a null id; they skip the joins instead of meeting in one partition.
    traced = events.where("trace_id is not null")
    known = df.groupBy("trace_id").agg(F.count(F.lit(1)).alias("trace_spans"), trace_top().alias("__top"))
    root = F.when(~F.col("__top.first.late"), F.col("__top"))
    known = known.select(
        "trace_id", "trace_spans", root["name"].alias("trace_name"), root["duration_ms"].alias("trace_duration_ms")
    )
    traced = traced.join(known, "trace_id", "left")
    return traced.unionByName(events.where("trace_id is null"), allowMissingColumns=True)


def stitch_traces(client: DataFrame, backend: DataFrame) -> DataFrame:
    """Backend roots under the client span whose id their ``traceparent`` names."""
    parsed = parse_traceparent(F.col("traceparent"))
    continued = backend.select(
        parsed["trace_id"].alias("trace_id"), parsed["parent_span_id"].alias("parent_span_id"),
        F.col("span_id").alias("backend_span_id"), F.col("name").alias("backend_name"),
    )
    callers = client.select(
        "trace_id", F.col("span_id").alias("parent_span_id"), F.col("name").alias("client_name")
    )
    return continued.join(callers, ["trace_id", "parent_span_id"])


def infer_parents(df: DataFrame, slice_seconds: float | None = 60.0) -> DataFrame:
    """Add ``parent_span_id``: the innermost span open on the same thread when a span starts, else the root.

    Spans of one thread nest like calls, so the number of open spans gives each its level, and its parent is the last
    span opened one level up. ``opens`` is false for spans only recorded, which never become parents. Two ordered
    passes replace the comparison of every span with every other.
    """
    inner = df.where(~F.col("is_root"))
    start, end = micros(F.col("started_at")), micros(F.col("ended_at"))
    holds = (F.col("opens") & (end > start)).cast("int")
    columns = F.struct(*[F.col(c) for c in df.columns])
    base = inner.select("trace_id", "thread", columns.alias("__span"), start.alias("s"), end.alias("e"), holds.alias("h"))
    opened = base.select(
        "trace_id", "thread", F.col("s").alias("__at"), F.lit(1).alias("__side"), (-F.col("e")).alias("__outer"),
        F.col("__span.span_id").alias("__id"), F.col("h").alias("__step"), "__span",
    )
    closed = base.where("h = 1").select(
        "trace_id", "thread", F.col("e").alias("__at"), F.lit(0).alias("__side"), F.col("s").alias("__outer"),
        F.col("__span.span_id").alias("__id"), F.lit(-1).alias("__step"),
    )
    order = [F.col("__at"), F.col("__side"), F.col("__outer"), F.col("__id")]
    slice_by = clock_slices(F.col("__at"), slice_seconds)
    both = opened.unionByName(closed, allowMissingColumns=True)
    leveled = running(both, ["trace_id", "thread"], order, slice_by, __depth=("sum", F.col("__step")))
    # Two more passes follow on what took two to make, so it is written once.
    placed = cut_lineage(leveled.where("__span is not null"))
    asks = placed.withColumns({"__level": F.col("__depth") - F.col("__step"), "__open": F.lit(None).cast("string")})
    holders = placed.where("__step = 1").withColumns(
        {"__level": F.col("__depth"), "__open": F.col("__id"), "__span": F.lit(None).cast(asks.schema["__span"].dataType)}
    )
    found = running(
        asks.unionByName(holders), ["trace_id", "thread", "__level"], order, slice_by, __parent=("last", F.col("__open"))
    )
    # Below level one nothing is open: the value there is always null and the root takes over.
    answered = found.where("__span is not null").select("__span.*", F.col("__parent").alias("__found"))
    tops = df.where("is_root").groupBy("trace_id").agg(F.min("span_id").alias("__root"))
    joined = answered.join(tops, "trace_id", "left")
    children = joined.withColumn("parent_span_id", F.coalesce("__found", "__root")).drop("__found", "__root")
    return children.unionByName(df.where("is_root").withColumn("parent_span_id", F.lit(None).cast("string")))
