"""Nearest neighbours with a permutation index.

Method. A bounded sample of rows serves as pivots. Every row is represented by its ``prefix`` nearest pivots in order, and posted under each
of them with its rank. A query walks the postings of its own nearest pivots and adds up how far the ranks are apart: the footrule
distance of the two orders, where a pivot that one side lacks counts as rank ``prefix``. The rows of least footrule distance are reranked
by their true distance in double precision.

The index is partitioned by rows: a cell holds the inverted files of up to ``block_rows`` rows, and every block of up to ``block_queries``
queries visits every cell, keeping its best k there; the best of all cells are merged. A cell reranks the ``candidate_share`` of its rows
with the least footrule distance, ties included, so the share of rows that is compared is the same at every size.

Only the k + 1 rows of smallest id can ever be among the k nearest of a vector that many rows have, so copies beyond those stay out of
the index; Spark ranks them within each task before it shuffles. All queries take part, copies as well.

Defined results: a vector that is null, zero, of another length than most, or has a null or non-finite component takes no part, nor does a row with a null id; ties
go to the smaller id; of rows that repeat an id and a vector one is found; if there are fewer candidates than k, all are returned.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetry_spark.llm.common import written
from telemetry_spark.plans.caps import first_n

PIVOTS, PREFIX = 256, 128
CANDIDATE_SHARE, LEAST_CANDIDATES = 0.1, 64
BLOCK_ROWS, BLOCK_QUERIES = 1024, 1024


def usable(vector: Column, length: int | None = None) -> Column:
    """Vectors that take part: finite, not zero, and of the given length."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    ok = vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)
    return F.coalesce(ok if length is None else ok & (F.size(vector) == length), F.lit(False))


def pivots_of(rows: DataFrame, count: int) -> np.ndarray:
    """The vectors of least hash, at most ``count``: a sample that does not depend on how rows are dealt out."""
    picked = rows.select(F.xxhash64("vector", F.lit(3)).alias("h"), "vector").orderBy("h").limit(count).collect()
    return np.unique(np.array([r["vector"] for r in picked], float), axis=0)


def orders(vectors: np.ndarray, pivots: np.ndarray, prefix: int) -> np.ndarray:
    """Each vector's nearest pivots, nearest first."""
    distance = (pivots**2).sum(axis=1) - 2 * vectors @ pivots.T
    return np.argsort(distance, axis=1, kind="stable")[:, :prefix]


def inverted_files(order: np.ndarray, pivots: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each pivot the rows that have it among their nearest, with its rank there."""
    rows, ranks = np.repeat(np.arange(len(order)), order.shape[1]), np.tile(np.arange(order.shape[1]), len(order))
    by_pivot = np.argsort(order.ravel(), kind="stable")
    ends = np.searchsorted(order.ravel()[by_pivot], np.arange(pivots + 1))
    return [(rows[by_pivot[a:b]], ranks[by_pivot[a:b]].astype(np.float32)) for a, b in zip(ends[:-1], ends[1:], strict=True)]


def footrule(query_order: np.ndarray, files: list[tuple[np.ndarray, np.ndarray]], rows: int, prefix: int) -> np.ndarray:
    """Footrule distances of one query to all rows of a cell, up to a constant.

    A row starts as if it had none of the query's pivots; each posting replaces a pivot's penalty on both sides.
    """
    sums = np.zeros(rows, np.float32)
    for rank, pivot in enumerate(query_order):
        place, ranks = files[pivot]
        sums[place] += np.abs(ranks - rank) - (prefix - ranks) - (prefix - rank)
    return sums


def search_cell(ids: np.ndarray, vectors: np.ndarray, queries: pd.DataFrame, pivots: np.ndarray, prefix: int, k: int, share: float) -> pd.DataFrame:
    """The k nearest rows that one cell has for each query."""
    prefix = min(prefix, len(pivots))
    files = inverted_files(orders(vectors, pivots, prefix), len(pivots))
    wanted = np.stack(queries["vector"].to_numpy()).astype(float)
    take = min(len(ids), max(LEAST_CANDIDATES, math.ceil(share * len(ids))))
    out = []
    for query, vector, order in zip(queries["query_id"], wanted, orders(wanted, pivots, prefix), strict=True):
        near = footrule(order, files, len(ids), prefix)
        tried = np.flatnonzero(near <= np.partition(near, take - 1)[take - 1])
        tried = tried[ids[tried] != query]
        score = np.sqrt(((vectors[tried] - vector) ** 2).sum(axis=1))
        best = np.lexsort((ids[tried], score))[:k]
        out += [(query, int(i), float(s)) for i, s in zip(ids[tried][best], score[best], strict=True)]
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"])


def nearest(
    vectors: DataFrame, is_query: Column, k: int = 10, pivots: int = PIVOTS, prefix: int = PREFIX, candidate_share: float = CANDIDATE_SHARE,
    block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES, id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``is_query`` names, its k nearest others."""
    rows = vectors.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"), is_query.alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & usable(F.col("vector")))
    sizes = rows.groupBy(F.size("vector").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    length = sizes[0]["n"] if sizes else 0
    # -0.0 and 0.0 are one value: adding 0.0 makes them equal to the hash as well.
    rows = rows.where(F.size("vector") == length).withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    distinct = first_n(rows.select("id", "vector", F.xxhash64("vector").alias("h")), ["h", "vector"], [F.col("id")], k + 1)
    index = written(distinct.select("id", "vector"), "permutation-index")
    asked = written(rows.where("asks").select("id", "vector").distinct(), "permutation-queries")
    n, q, points = index.count(), asked.count(), pivots_of(index, pivots)
    cells, lots = max(1, math.ceil(n / block_rows)), max(1, math.ceil(q / block_queries))
    schema = "query_id bigint, vec_id bigint, score double"

    def search(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        ids = left["id"].to_numpy(np.int64)
        order = np.argsort(ids)
        own = np.stack(left["vector"].to_numpy()).astype(float)[order]
        return search_cell(ids[order], own, right.rename(columns={"id": "query_id"}), points, prefix, k, candidate_share)

    # Every block of queries meets every cell of the index: cells go to all lots, lots to all cells.
    placed = index.select("id", "vector", F.pmod(F.xxhash64("id"), F.lit(cells)).cast("int").alias("cell"), F.explode(F.sequence(F.lit(0), F.lit(lots - 1))).alias("lot"))
    sent = asked.select("id", "vector", F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"),
                        F.pmod(F.xxhash64("id", F.lit(9)), F.lit(lots)).cast("int").alias("lot"))
    found = placed.groupBy("cell", "lot").cogroup(sent.groupBy("cell", "lot")).applyInPandas(search, schema)
    # k rows from each cell for each query.
    ranked = Window.partitionBy("query_id").orderBy("score", "vec_id")
    merged = found.distinct().withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    return merged.select("query_id", "rank", "vec_id", "score")

