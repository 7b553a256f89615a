"""What filters remove, alone and in every order, from sorted posting lists.

Method. A document that fails a filter is posted in that filter's list. Lists are kept per part and range of ids: a range holds up to
``range_rows`` failing documents of one part, sorted by id, and one list of places in it for each filter, as well as for good and toxic
documents. They are written as a table. For every range, unions of lists over all sets of filters and the differences between them come
from galloping merges of sorted lists; their sizes add up over ranges to those of a part, because a document is in one range only. What a
filter removes after others is the size of a difference, so 32 sizes say everything about 120 orders.

Only documents that fail a filter move: one narrow row each. Parts are cut by ids, so a part that holds a third of all rows is spread
over as many tasks as it has ranges; a text that a third of all documents share meets its smallest id in a join whose skewed side Spark splits.

Defined results: a null text is empty; a null source is the part of the empty one; documents without an id are counted but are copies
of nothing, nor is anything a copy of them; rows that repeat an id are documents each, and not copies of each other; labels that repeat an
id hold if any of them does; a part without failing documents has its rows, with zeros; no documents give no rows; other columns are not read.
"""

from __future__ import annotations

import itertools
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_spark.llm.common import written

FILTERS = "ABCDE"
SETS = 1 << len(FILTERS)
COPY = 1 << FILTERS.index("E")
RANGE_ROWS = 65_536
#: Needles that share one gallop through the other list.
GALLOP_LOT = 256
SPACE = r"[\x20\x09-\x0D]+"
LISTS = (*FILTERS, "good", "toxic")
POSTING_SCHEMA = "part string, ids array<bigint>, " + ", ".join(f"{name} array<int>" for name in LISTS)


def failures(text: Column) -> Column:
    """The filters that a text fails by itself, as bits: too short, repetitive, in capitals, with markup."""
    words = F.array_remove(F.split(text, SPACE), "")
    distinct = F.size(F.array_distinct(words))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    failed = [F.size(words) < 50, 100 * distinct < 65 * F.size(words), 100 * capitals > 5 * F.length(text), text.rlike("[#$%&*|]")]
    return sum((F.when(f, 1 << i).otherwise(0) for i, f in enumerate(failed)), F.lit(0)).cast("int")


def checked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """``doc_id, part, failed``: each document with the filters it fails, copies of a smaller id's text included. Texts are read once."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(part_col), F.lit("")).alias("part"),
        failures(text).alias("failed"), F.unhex(F.sha2(text, 256)).alias("digest"),
    )
    rows = written(rows, "audit-rows")
    # Of most texts there is one document: only those of several need to meet their rows again.
    firsts = rows.where("doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    met = rows.join(firsts.where("first < last").select("digest", "first"), "digest", "left")
    copy = F.when(F.col("doc_id") > F.col("first"), COPY).otherwise(0)
    return written(met.select("doc_id", "part", (F.col("failed") + copy).alias("failed")), "audit-failures")


def postings(found: DataFrame, labels: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """``part, ids, A ... E, good, toxic``: for each range of a part the ids of its failing documents and the places in it of those
    that fail each filter, are good and are toxic."""
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("bigint").alias("doc_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    failing = found.where("failed <> 0").join(marks, "doc_id", "left")
    # The last key only parts rows of one id, so that many of them do not make one task; sizes are the same wherever they are cut.
    dealt = failing.select(
        "part", "doc_id", (F.col("failed") + F.coalesce("good", F.lit(0)) * SETS + F.coalesce("toxic", F.lit(0)) * 2 * SETS).alias("bits"),
        F.xxhash64(F.monotonically_increasing_id()).alias("tie"),
    )
    dealt = written(dealt, "audit-dealt")
    ordered = dealt.repartitionByRange("part", "doc_id", "tie").sortWithinPartitions("part", "doc_id", "tie").select("part", "doc_id", "bits")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, bits = None, [], []
        for batch in batches:
            columns = [batch.column(i).to_pylist() for i in range(3)]
            for own, rows in itertools.groupby(zip(*columns, strict=True), key=lambda r: r[0]):
                if own != part:
                    yield from posted(part, ids, bits)
                    part, ids, bits = own, [], []
                for _, doc_id, set_bits in rows:
                    ids.append(doc_id)
                    bits.append(set_bits)
                    if len(ids) == range_rows:
                        yield from posted(part, ids, bits)
                        ids, bits = [], []
        yield from posted(part, ids, bits)

    return written(ordered.mapInArrow(run, POSTING_SCHEMA), "audit-postings")


def posted(part: str | None, ids: list, bits: list) -> Iterator[pa.RecordBatch]:
    """One range as a row of lists."""
    if ids:
        held = np.array(bits, np.int64)
        lists = [np.flatnonzero(held & (1 << i)).astype(np.int32) for i in range(len(LISTS))]
        columns = [pa.array([part], pa.string()), pa.array([ids], pa.list_(pa.int64())), *(pa.array([x], pa.list_(pa.int32())) for x in lists)]
        yield pa.RecordBatch.from_arrays(columns, ["part", "ids", *LISTS])


def gallop(values: np.ndarray, wanted: int, at: int) -> int:
    """The first place from ``at`` on whose value is not below ``wanted``: steps double until they have passed it."""
    step = 1
    while at + step < len(values) and values[at + step] < wanted:
        step *= 2
    end = min(len(values), at + step + 1)
    return at + int(np.searchsorted(values[at:end], wanted))


def difference(values: np.ndarray, taken: np.ndarray) -> np.ndarray:
    """Sorted values that are not among others, sorted too: lots of them gallop through the others together."""
    out, at = [], 0
    for begin in range(0, len(values), GALLOP_LOT):
        lot = values[begin : begin + GALLOP_LOT]
        at = gallop(taken, lot[0], at)
        end = gallop(taken, lot[-1] + 1, at)
        near = taken[at:end]
        place = np.searchsorted(near, lot)
        met = np.zeros(len(lot), bool)
        inside = place < len(near)
        met[inside] = near[place[inside]] == lot[inside]
        out.append(lot[~met])
        at = end
    return np.concatenate(out) if out else values


def merged(values: np.ndarray, more: np.ndarray) -> np.ndarray:
    """The union of two sorted lists without common values, sorted."""
    return np.insert(values, np.searchsorted(values, more), more)


def union_sizes(lists: list[np.ndarray]) -> np.ndarray:
    """The size of the union of every set of lists; bit i of a place stands for list i."""
    unions, sizes = [np.empty(0, np.int32)], np.zeros(1 << len(lists), np.int64)
    for subset in range(1, len(sizes)):
        top = subset.bit_length() - 1
        rest = unions[subset ^ (1 << top)]
        union = merged(rest, difference(lists[top], rest))
        unions.append(union)
        sizes[subset] = len(union)
    return sizes


def sizes(lists: DataFrame) -> DataFrame:
    """``part, failed_set, n, good, toxic``: how many documents of a part fail any filter of each set, in all and among the good and the toxic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                failed = [batch.column(1 + f)[i].values.to_numpy() for f in range(len(FILTERS))]
                marked = [batch.column(1 + len(FILTERS) + m)[i].values.to_numpy() for m in range(2)]
                counts = [union_sizes(failed)]
                for mark in marked:
                    outside = [difference(f, mark) for f in failed]
                    counts.append(union_sizes([difference(f, o) for f, o in zip(failed, outside, strict=True)]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([batch.column(0)[i].as_py()] * SETS, pa.string()), pa.array(range(SETS), pa.int32()), *(pa.array(c, pa.int64()) for c in counts)],
                    ["part", "failed_set", "n", "good", "toxic"],
                )

    each = lists.select("part", *LISTS).mapInArrow(run, "part string, failed_set int, n bigint, good bigint, toxic bigint")
    return each.groupBy("part", "failed_set").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def steps() -> list[dict]:
    """Every step of every order: the filter's place, and the sets of filters up to before and up to after it."""
    out = []
    for order in itertools.permutations(range(len(FILTERS))):
        before = 0
        for step, own in enumerate(order, 1):
            name = "".join(FILTERS[f] for f in order)
            out.append({"filter_order": name, "step": step, "own": own, "before": before, "after": before | 1 << own})
            before |= 1 << own
    return out


def orders_before(subset: int) -> int:
    """In how many orders exactly these filters come before a given other one."""
    n = subset.bit_count()
    return math.factorial(n) * math.factorial(len(FILTERS) - 1 - n)


def audit(found: DataFrame, lists: DataFrame) -> DataFrame:
    """``part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley`` for every step of every order."""
    totals = found.groupBy("part").agg(F.count(F.lit(1)).alias("documents"))
    entry = F.struct("failed_set", F.struct("n", "good", "toxic"))
    # At most one entry a set.
    known = sizes(lists).groupBy("part").agg(F.map_from_entries(F.collect_list(entry)).alias("sizes"))
    each = totals.join(known, "part", "left")

    def size(subset: Column, of: str = "n") -> Column:
        return F.coalesce(F.try_element_at("sizes", subset)[of], F.lit(0))

    every = range(SETS)
    each = each.withColumn("counts", F.array(*[size(F.lit(s)) for s in every]))
    shapley = [
        sum((orders_before(s) * (F.col("counts")[s | 1 << f] - F.col("counts")[s]) for s in every if not s & 1 << f), F.lit(0))
        for f in range(len(FILTERS))
    ]
    table = F.from_json(F.lit(json.dumps(steps())), "array<struct<filter_order:string,step:int,own:int,before:int,after:int>>")
    rows = each.withColumn("shapley", F.array(*shapley)).withColumn("s", F.explode(table))
    counts, own, before, after = F.col("counts"), F.col("s.own"), F.col("s.before"), F.col("s.after")
    alone = F.element_at(F.array(*[F.lit(1 << f) for f in range(len(FILTERS))]), own + 1)
    removed = F.get(counts, after) - F.get(counts, before)
    return rows.select(
        "part", "s.filter_order", "s.step", (F.col("documents") - F.get(counts, after)).alias("kept"), removed.alias("removed"),
        (F.get(counts, alone) - removed).alias("redundant"), (F.get(counts, F.lit(SETS - 1)) - F.get(counts, SETS - 1 - alone)).alias("unique_fails"),
        (size(after, "good") - size(before, "good")).alias("good_lost"), (size(after, "toxic") - size(before, "toxic")).alias("toxic_lost"),
        F.get("shapley", own).alias("shapley"),
    )
