"""Telemetry read out of the given tables. Each view here has its SQL twin, used by the comparison queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_spark.plans.session import use_utc

EPOCH_TEXT = "%Y-%m-%dT%H:%M:%SZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    use_utc(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = table(spark, sf_dir, "events")
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def iso_sql(ts: str) -> str:
    return f"strftime({ts}, '{EPOCH_TEXT}')"


def item(df: DataFrame) -> Column:
    """The counter inside an event's properties."""
    return F.get_json_object(df["props"], "$.k").cast("bigint")


ITEM_SQL = "CAST(props->>'k' AS BIGINT)"


def hex_id(number: Column, width: int) -> Column:
    """An id made of a key. Marked as never null, so that no join has to check that it is not."""
    return F.coalesce(F.lpad(F.lower(F.hex(number)), width, "0"), F.lit(""))


def line_id() -> Column:
    seed = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return F.coalesce(F.left(F.sha2(seed, 256), F.lit(16)), F.lit(""))


def hex_sql(number: str, width: int) -> str:
    return f"lpad(lower(to_hex({number})), {width}, '0')"


def measurements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timings: one transaction per event type."""
    return events(spark, sf_dir).select(
        F.col("event_type").alias("transaction_name"), F.lit("production").alias("environment"),
        F.lit(None).cast("string").alias("release"), "ts", (F.col("value") * 20).alias("duration_ms"),
    )


MEASUREMENTS_SQL = "SELECT event_type AS transaction_name, ts, value * 20 AS duration_ms FROM events"


def order_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Traces: an order is the root, its lines are the spans below it."""
    orders, lines = table(spark, sf_dir, "orders"), table(spark, sf_dir, "lineitem")
    root = orders.select(
        hex_id(F.col("o_orderkey") + 1, 32).alias("trace_id"), hex_id(F.col("o_orderkey") + 1, 16).alias("span_id"),
        F.lit(None).cast("string").alias("parent_span_id"), F.col("o_orderpriority").alias("name"),
        F.lit("controller").alias("kind"), F.col("o_orderdate").cast("timestamp").alias("started_at"),
        (F.col("o_totalprice") / 100).alias("duration_ms"), F.lit(0).cast("bigint").alias("seq"),
    )
    child = lines.select(
        hex_id(F.col("l_orderkey") + 1, 32).alias("trace_id"), line_id().alias("span_id"),
        hex_id(F.col("l_orderkey") + 1, 16).alias("parent_span_id"),
        F.concat(F.lit("line "), F.col("l_linenumber")).alias("name"), F.lit("service").alias("kind"),
        F.col("l_shipdate").cast("timestamp").alias("started_at"), (F.col("l_extendedprice") / 100).alias("duration_ms"),
        F.col("l_linenumber").cast("bigint").alias("seq"),
    )
    return root.unionByName(child).withColumns(
        {"environment": F.lit("production"), "release": F.lit(None).cast("string"), "data": F.lit("{}")}
    )


LINE_ID_SQL = "left(sha256(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 16)"
ORDER_SPANS_SQL = f"""
SELECT {hex_sql('o_orderkey + 1', 32)} AS trace_id, {hex_sql('o_orderkey + 1', 16)} AS span_id,
       NULL AS parent_span_id, o_orderpriority AS name, o_orderdate AS started_at,
       o_totalprice / 100 AS duration_ms, 0 AS seq
FROM orders
UNION ALL
SELECT {hex_sql('l_orderkey + 1', 32)}, {LINE_ID_SQL}, {hex_sql('l_orderkey + 1', 16)},
       'line ' || l_linenumber, l_shipdate, l_extendedprice / 100, l_linenumber
FROM lineitem"""
