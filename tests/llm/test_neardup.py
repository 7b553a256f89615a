import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetry_spark.llm import neardup
from telemetry_spark.llm.components import components


def brute_force(docs, size, percent):
    """Every pair of sets, by word tuples."""
    sets = {}
    for key, text in docs:
        words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
        own = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
        sets[key] = own
    label = {k: k for k in sets}

    def root(k):
        while label[k] != k:
            k = label[k]
        return k

    by_shingle = {}
    for k, own in sets.items():
        for s in own:
            by_shingle.setdefault(s, []).append(k)
    for k, own in sets.items():
        counts = {}
        for s in own:
            for other in by_shingle[s]:
                if other < k:
                    counts[other] = counts.get(other, 0) + 1
        for other, common in counts.items():
            if 100 * common >= percent * (len(own) + len(sets[other]) - common):
                a, b = sorted((root(k), root(other)))
                label[b] = a
    return {k: (len(own), root(k)) for k, own in sets.items()}


def result(frame):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in frame.collect()}


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_the_given_documents(spark, sf, size, percent):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = neardup.near_duplicates(docs, size, percent)
    assert result(found) == brute_force([tuple(r) for r in docs.select("doc_id", "text").collect()], size, percent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in found.collect())


def edited(rng, words, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def test_a_group_above_the_block_size(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(500)}" for _ in range(200)]
    docs = [(i, edited(rng, base, rng.randrange(0, 5))) for i in range(300)] + [(300 + i, edited(rng, base, 60)) for i in range(50)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(4)
    found = neardup.near_duplicates(frame, 3, 85, region_rows=32, block_rows=48)
    assert result(found) == brute_force(docs, 3, 85)


def test_odd_rows(spark, odd_documents):
    found = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in neardup.near_duplicates(odd_documents, 3, 85).collect()}
    assert {(1, 0, 1, True), (2, 0, 2, True), (3, 4, 3, True), (4, 4, 3, False), (None, 1, None, True), (5, 0, 5, True), (7, 1, 7, True)} <= found
    assert neardup.near_duplicates(odd_documents, 3, 85).count() == odd_documents.count()
    assert neardup.near_duplicates(odd_documents.limit(0)).count() == 0


def test_spanning_forest_keeps_what_agrees():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 256, (3, 96), dtype=np.uint8)
    rows = np.repeat(base, 5, axis=0)
    edges = neardup.spanning(rows, 70)
    assert len(edges) == 12 and all(a // 5 == b // 5 and n == 96 for a, b, n in edges)


def test_confirmed_counts_exactly():
    a, b, c = np.arange(100, dtype=np.uint64), np.arange(8, 100, dtype=np.uint64), np.arange(40, 140, dtype=np.uint64)
    assert neardup.confirmed([a, b, c], 92) == [(0, 1)] and neardup.confirmed([a, b, c], 93) == []


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, i) for i in range(1001, 1200)] + [(7, 7)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[i] for i in range(1000, 1200)} == {1000}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
    assert components(spark.range(3).select(F.col("id").alias("a"), F.col("id").alias("b"))).count() == 0
