"""Drops counted by the pass that drops: no second read of what is let through."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

REPORT = "signal string, reason string, dropped bigint"


def _judged(df: DataFrame, reasons: Mapping[str, Column]) -> tuple[DataFrame, list[Column]]:
    """Rows with the first reason that holds for them, and a count for each reason. An unknown answer is no reason."""
    why = F.lit(None).cast("string")
    for reason, holds in reversed(list(reasons.items())):
        why = F.when(F.coalesce(holds, F.lit(False)), reason).otherwise(why)
    return df.withColumn("__why", why), [F.count_if(F.col("__why") == reason).alias(reason) for reason in reasons]


class DropLedger:
    """Counts what filters drop while some job runs over what they keep.

    ``keep`` returns the rows that stay. When an action has run over all of them, ``report`` has the counts. Each frame is to be run
    once: Spark counts its first action. As all of Spark's observed metrics the counts are taken as tasks finish, so a stage that runs again
    after an executor was lost may count its rows again; where counts have to be exact even then, use ``drop_report`` over the rows.
    """

    def __init__(self) -> None:
        self.watched: list[tuple[str, list[str], Observation]] = []

    def keep(self, df: DataFrame, signal: str, reasons: Mapping[str, Column]) -> DataFrame:
        judged, counts = _judged(df, reasons)
        seen = Observation(f"drops-{signal}-{len(self.watched)}")
        self.watched.append((signal, list(reasons), seen))
        return judged.observe(seen, *counts).where("__why is null").drop("__why")

    def report(self, spark: SparkSession) -> DataFrame:
        """``signal, reason, dropped`` for every reason that dropped anything. Waits for an action over every frame."""
        totals: dict[tuple[str, str], int] = {}
        for signal, reasons, seen in self.watched:
            for reason in reasons:
                totals[signal, reason] = totals.get((signal, reason), 0) + (seen.get.get(reason) or 0)
        return spark.createDataFrame([(*key, n) for key, n in totals.items() if n], REPORT)


def keep_in_stream(df: DataFrame, signal: str, reasons: Mapping[str, Column]) -> DataFrame:
    """The rows of a stream that stay; a ``DropListener`` is told how many do not, batch by batch."""
    judged, counts = _judged(df, reasons)
    return judged.observe(f"drops-{signal}", *counts).where("__why is null").drop("__why")


class DropListener(StreamingQueryListener):
    """Adds up what the streams of a session drop, by query, signal and reason. Rows behind the watermark count as ``late``.

    A batch that runs again after a failure reports again under its number and replaces what it said before.
    """

    def __init__(self) -> None:
        self.batches: dict[tuple[str, int, str, str], int] = {}

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        for name, row in progress.observedMetrics.items():
            if name.startswith("drops-"):
                for reason, n in row.asDict().items():
                    self.batches[str(progress.id), progress.batchId, name.removeprefix("drops-"), reason] = n or 0
        late = sum(o.numRowsDroppedByWatermark for o in progress.stateOperators)
        signal = progress.name or "stream"
        # Batches without new rows report under the number of the batch to come.
        key = (str(progress.id), progress.batchId, signal, "late")
        self.batches[key] = max(late, self.batches.get(key, 0))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def report(self, spark: SparkSession) -> DataFrame:
        totals: dict[tuple[str, str], int] = {}
        for (_, _, signal, reason), n in self.batches.items():
            totals[signal, reason] = totals.get((signal, reason), 0) + n
        return spark.createDataFrame([(*key, n) for key, n in totals.items() if n], REPORT)
