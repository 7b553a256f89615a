"""The skew-proof plan shapes give what plain windows and brute force give."""

import os
import random

import pytest
import workload
from pyspark.sql import Window
from pyspark.sql import functions as F

from telemetry_spark.plans.asof import latest_as_of
from telemetry_spark.plans.caps import first_n, first_of, numbered
from telemetry_spark.operators.delivery import upload_order
from telemetry_spark.plans.running import _sliced, running, running_since


SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    """3000 rows, a third of them under one key, some under a null one."""
    rng = random.Random(7)
    keys = ["hot"] * 5 + [None, "b", "c"] + [f"k{i}" for i in range(7)]
    data = [(rng.choice(keys), i, rng.randint(-3, 5), rng.random() < 0.1) for i in range(3000)]
    return spark.createDataFrame(data, "k string, t int, v int, r boolean").repartition(4).cache()


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("width", [1, 40, 100000])
def test_running_matches_a_window(rows, width):
    order, by = [F.col("t")], F.floor(F.col("t") / width)
    marked = F.when(F.col("r"), F.col("v"))
    got = running(
        rows, ["k"], order, by, s=("sum", F.col("v")), m=("max", marked), b=("max_before", F.col("v")), l=("last", marked)
    )
    upto = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    want = rows.select(
        "*", F.sum("v").over(upto).alias("s"), F.max(marked).over(upto).alias("m"), F.max("v").over(before).alias("b"),
        F.last(marked, ignorenulls=True).over(upto).alias("l"),
    )
    assert same(got, want)


@pytest.mark.parametrize("width", [1, 40, 100000])
def test_running_since_starts_again_at_a_reset(rows, width):
    got = running_since(rows, ["k"], [F.col("t")], F.floor(F.col("t") / width), F.col("r"), F.col("v"), "since")
    upto = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.withColumn("e", F.sum(F.col("r").cast("int")).over(upto))
    inside = Window.partitionBy("k", "e").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    want = marked.withColumn("since", F.sum(F.when(F.col("r"), 0).otherwise(F.col("v"))).over(inside)).drop("e")
    assert same(got, want)


@pytest.mark.parametrize("salts", [1, 8])
def test_first_n_matches_a_window(rows, salts):
    got = first_n(rows, ["k"], [F.col("t").desc()], 7, salts)
    ranked = rows.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy(F.col("t").desc())))
    assert same(got, ranked.where("n <= 7").drop("n"))


def test_numbered_counts_from_one(rows):
    got = numbered(rows, ["k"], [F.col("t")], F.floor(F.col("t") / 50), "n")
    want = rows.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("t")).cast("bigint"))
    assert same(got, want)


def test_as_of_takes_the_latest_at_or_before(spark):
    rng = random.Random(3)
    lefts = [(rng.choice("ab"), rng.randint(0, 500), i) for i in range(200)]
    rights = [(rng.choice("ab"), rng.randint(0, 500), i) for i in range(60)]
    left = spark.createDataFrame(lefts, "k string, s int, id int").withColumn("at", F.timestamp_seconds("s"))
    right = spark.createDataFrame(rights, "k string, s int, v int").withColumn("at", F.timestamp_seconds("s"))
    got = latest_as_of(left, right, ["k"], F.col("at"), F.col("at"), F.col("v"), F.col("v"), "v", slice_seconds=60)
    want = {i: max(((s2, v) for k2, s2, v in rights if k2 == k and s2 <= s), default=(0, None))[1] for k, s, i in lefts}
    assert {r.id: r.v for r in got.collect()} == want


def test_a_hot_key_is_shared_between_tasks(spark, rows):
    """The window under ``running`` is keyed by key and slice, so no task holds a whole hot key."""
    plan = running(rows, ["k"], [F.col("t")], F.floor(F.col("t") / 10), s=("sum", F.col("v")))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__key" in text and "__slice" in text
    capped = first_n(rows, ["k"], [F.col("t")], 3)._jdf.queryExecution().executedPlan().toString()
    assert capped.count("WindowGroupLimit") == 4 and "Partial" in capped


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")
@pytest.mark.parametrize(("query", "scans"), [("inferred_parents", 4), ("error_trails", 2), ("errors_to_traces", 4), ("assembled_traces", 2)])
def test_inputs_are_not_read_again_and_again(spark, query, scans):
    plan = final_plan(workload.REGISTRY[query][0](spark, SF_DIR))
    assert plan.count("FileScan") <= scans


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")
def test_traces_are_assembled_in_two_exchanges(spark):
    plan = final_plan(workload.REGISTRY["assembled_traces"][0](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") <= 2


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")
@pytest.mark.parametrize("query", ["capped_spans", "assembled_traces", "trace_bodies"])
def test_traces_move_once_and_are_sorted_once_on_either_side(spark, query):
    plan = final_plan(workload.REGISTRY[query][0](spark, SF_DIR))
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("- Sort [") + plan.count("* Sort (") <= 2
    assert plan.count("WindowGroupLimit") + plan.count("* WindowGroupLimit (") >= 2


def test_first_of_is_the_same_in_every_run(rows):
    tied = rows.withColumn("t", F.col("t") % 3)
    want = first_of(tied, ["k"], [F.col("t")]).collect()
    assert sorted(map(str, want)) == sorted(map(str, first_of(tied.repartition(7), ["k"], [F.col("t")]).collect()))
    least = {r.k: r.t for r in tied.groupBy("k").agg(F.min("t").alias("t")).collect()}
    assert {r.k: r.t for r in want} == least


@pytest.fixture
def small_pieces(spark):
    """Ranges as many as asked for, also of little data."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_slices_by_rows_match_windows(rows, small_pieces):
    order, marked = [F.col("t")], F.when(F.col("r"), F.col("v"))
    got = running(rows, ["k"], order, s=("sum", F.col("v")), m=("max", marked), b=("max_before", F.col("v")), l=("last", marked))
    upto = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("k").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    want = rows.select(
        "*", F.sum("v").over(upto).alias("s"), F.max(marked).over(upto).alias("m"), F.max("v").over(before).alias("b"),
        F.last(marked, ignorenulls=True).over(upto).alias("l"),
    )
    assert same(got, want)
    since = running_since(rows, ["k"], order, None, F.col("r"), F.col("v"), "since")
    epochs = rows.withColumn("e", F.sum(F.col("r").cast("int")).over(upto))
    inside = Window.partitionBy("k", "e").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    assert same(since, epochs.withColumn("since", F.sum(F.when(F.col("r"), 0).otherwise(F.col("v"))).over(inside)).drop("e"))


@pytest.mark.parametrize("at", ["timestamp'2024-01-01'", "cast(null as timestamp)"])
def test_rows_of_one_moment_or_of_no_time_are_spread_evenly(spark, small_pieces, at):
    """One key, all rows in one second or without a time: no slice, and so no task, has much more than its share."""
    df = spark.range(8000).selectExpr("'hot' as k", f"{at} as at", "id")
    sliced = _sliced(df, ["k"], [F.col("at")], None)
    sizes = [r["count"] for r in sliced.groupBy("__slice").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 2 * 8000 / 8
    placed = numbered(df, ["k"], [F.col("at"), F.col("id")])
    assert placed.agg(F.count_distinct("position"), F.max("position")).first()[:] == (8000, 8000)
    per_task = numbered(df, ["k"], [F.col("at"), F.col("id")]).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(per_task) >= 4


def test_payloads_of_unknown_age_are_spread(spark, small_pieces):
    payloads = spark.range(4000).selectExpr("id as payload_id", "cast(null as timestamp) as created_at")
    got = upload_order(payloads)
    assert {(r.payload_id + 1) for r in got.collect()} == {r.position for r in got.collect()}
    assert all(r.position == r.payload_id + 1 for r in got.collect())
