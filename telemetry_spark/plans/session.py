"""What the operators need from a session."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def use_utc(spark: SparkSession) -> None:
    """Wire timestamps are UTC text, so the session has to read and print UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the session names for checkpoints; a temporary one only for a local run that names none."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    path = os.path.join(tempfile.gettempdir(), f"telemetry-{spark.sparkContext.applicationId}")
    spark.conf.set("spark.checkpoint.dir", path)
    return path


def fresh_dir(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Checkpoint, so the rounds of an iterative operator neither re-run each other nor pile up one plan."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
