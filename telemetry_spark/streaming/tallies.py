"""Tallies per event-time window that can be sent before their window has closed.

Each task first adds up its own rows by key, window and latency bucket, so a transaction with most of the rows reaches its state as a
few partial rows a task. The state is kept per key and window: a hot transaction spreads over the windows that are open. A window is sent
when the watermark passes its end, by a timer; or earlier, when a control row asks for it. Either way its state goes, so no record is ever sent twice;
a record of a window that has been sent early starts a new tally, which is sent in turn.

Control rows name the windows that are open. They are made out of the state itself (``request_flush``), by a job of its own, and reach a
running stream as one more file source.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from telemetry_spark.config import Config
from telemetry_spark.functions.latency import BUCKET_COLUMNS, LABELS, latency_bucket
from telemetry_spark.operators.performance import KEYS, PERIOD, measured
from telemetry_spark.plans.session import fresh_dir
from telemetry_spark.streaming.runs import control_stream, flush_now, state_rows

COUNTS = ("request_count", "duration_sum_ms", "max_duration_ms", *BUCKET_COLUMNS)
STATE = "request_count bigint, duration_sum_ms double, max_duration_ms double, " + ", ".join(f"{c} bigint" for c in BUCKET_COLUMNS)


def partial_tallies(df: DataFrame, cfg: Config = Config(), every: str | None = None, keys: Sequence[str] = KEYS) -> DataFrame:
    """``*keys, start_us, end_us, bucket, n, total, longest``: what each task's rows come to by key, window and latency bucket. No shuffle."""
    window = F.window("ts", every or cfg.performance_flush_interval)
    # A row without a duration counts as a request and falls into no bucket.
    rows = measured(df, cfg).where("ts is not null").select(
        *keys, window.alias("w"), F.when(F.col("duration_ms").isNotNull(), latency_bucket(F.col("duration_ms"))).alias("bucket"),
        F.col("duration_ms").cast("double").alias("duration_ms"),
    ).select(*keys, F.unix_micros("w.start").alias("start_us"), F.unix_micros("w.end").alias("end_us"), "bucket", "duration_ms")
    by = [*keys, "start_us", "end_us", "bucket"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every_row = pc.CountOptions(mode="all")
        for batch in batches:
            found = pa.Table.from_batches([batch]).group_by(by, use_threads=False).aggregate(
                [("duration_ms", "count", every_row), ("duration_ms", "sum"), ("duration_ms", "max")])
            columns = [found[c] for c in (*by, "duration_ms_count", "duration_ms_sum", "duration_ms_max")]
            yield from pa.Table.from_arrays(columns, [*by, "n", "total", "longest"]).to_batches()

    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    return rows.mapInArrow(run, f"{schema}, start_us bigint, end_us bigint, bucket string, n bigint, total double, longest double")


class WindowTallies(StatefulProcessor):
    """One tally per key and window. Rows: partial tallies, or control rows (``flush``) that have the tally sent at once."""

    def __init__(self, names: Sequence[str]):
        self.names = list(names)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.tally = handle.getValueState("tally", STATE)

    def handleInputRows(self, key, rows, timerValues):
        known = self.tally.exists()
        tally = list(self.tally.get()) if known else [0, 0.0, 0.0, *[0] * len(LABELS)]
        asked = False
        for chunk in rows:
            asked = asked or bool(chunk["flush"].any())
            data = chunk[~chunk["flush"]]
            tally[0] += int(data["n"].sum())
            tally[1] += float(data["total"].sum())
            tally[2] = max(tally[2], float(data["longest"].max()) if data["longest"].notna().any() else 0.0)
            for label, n in data.groupby("bucket")["n"].sum().items():
                tally[3 + LABELS.index(label)] += int(n)
        if asked:
            if known:
                self._forget(key)
            if tally[0]:
                yield self._sent(key, tally)
        elif tally[0]:
            if not known:
                self.handle.registerTimer(key[-1] // 1000)
            self.tally.update(tuple(tally))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        if self.tally.exists():
            tally = list(self.tally.get())
            self.tally.clear()
            yield self._sent(key, tally)

    def _forget(self, key) -> None:
        self.tally.clear()
        self.handle.deleteTimer(key[-1] // 1000)

    def _sent(self, key, tally: list) -> pd.DataFrame:
        return pd.DataFrame([(*key, *tally)], columns=[*self.names, *COUNTS])

    def close(self) -> None:
        pass


def control_schema(df: DataFrame, keys: Sequence[str] = KEYS) -> str:
    return ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + ", start_us bigint, end_us bigint"


def stream_tallies(
    df: DataFrame, control: str, cfg: Config = Config(), every: str | None = None, watermark: str = "10 minutes", keys: Sequence[str] = KEYS,
) -> DataFrame:
    """Samples of ``df`` per key and window, sent when the watermark passes a window's end or when a control row in the folder
    ``control`` asks for it. Rows are late only when their whole window is: the watermark goes by the ends of windows, a window's width
    and ``watermark`` behind the newest."""
    spark = df.sparkSession
    partial = partial_tallies(df, cfg, every, keys).withColumn("flush", F.lit(False))
    asked = control_stream(spark, control, control_schema(df, keys)).withColumn("flush", F.lit(True))
    both = partial.unionByName(asked, allowMissingColumns=True).withColumn("at", F.timestamp_micros("end_us"))
    width = F.expr(f"interval {every or cfg.performance_flush_interval}")
    seconds = spark.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(0)) + width)).first()[0] // 1_000_000
    names = [*keys, "start_us", "end_us"]
    held = both.withWatermark("at", f"interval {watermark} {seconds} seconds").groupBy(*names)
    sent = held.transformWithStateInPandas(
        statefulProcessor=WindowTallies(names), outputStructType=f"{control_schema(df, keys)}, {STATE}", outputMode="Append", timeMode="EventTime")
    return sent.select(
        *keys, F.timestamp_micros("start_us").alias(PERIOD[0]), F.timestamp_micros("end_us").alias(PERIOD[1]), *COUNTS)


def request_flush(spark: SparkSession, checkpoint: str, control: str) -> None:
    """Ask for every window that is open as of the stream's last committed batch: a control row each, written by tasks."""
    state_rows(spark, checkpoint, "tally").select("key.*").write.mode("append").parquet(control)


def flush_open(samples: DataFrame, path: str, checkpoint: str, control: str) -> None:
    """Process everything that has arrived, then send what is still open, and stop. A later flush goes on from here."""
    flush_now(samples, path, checkpoint)
    request_flush(samples.sparkSession, checkpoint, control)
    flush_now(samples, path, checkpoint)


def collected_tallies(df: DataFrame, **options) -> DataFrame:
    """Everything a finite stream comes to, windows that would stay open included, out of a fresh folder."""
    spark = df.sparkSession
    path, checkpoint, control = (fresh_dir(spark, f"tallies-{name}") for name in ("out", "checkpoint", "control"))
    samples = stream_tallies(df, control, **options)
    schema = samples.schema
    flush_open(samples, path, checkpoint, control)
    return spark.read.schema(schema).parquet(path)
