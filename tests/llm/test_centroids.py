import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetry_spark.llm import centroids, queries

SCHEMA = "vec_id bigint, embedding array<float>, label int, distance string"


def brute(rows, k=16, rounds=3, length=64):
    """The contract in plain integers: rows of (vec_id, vector) to sorted (vec_id, cluster, distance), and the centroids."""
    kept = [(i, [math.floor(64 * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == length and all(x is not None and math.isfinite(x) for x in v)]
    named = sorted((hashlib.sha256(f"1:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    means = [v for _, v in named[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(means))

    for _ in range(rounds if means else 0):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        means = [[sum(c) // len(c) for c in zip(*groups[n], strict=True)] if n in groups else c for n, c in enumerate(means)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept] if means else []
    return sorted(found, key=str), means


def check(df, **options):
    found, means = centroids.cluster(df, **options)
    want, want_means = brute([(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()], options.get("k", 16))
    got = sorted(((r.vec_id, r.cluster, r.distance) for r in found.collect()), key=str)
    assert got == want and means.tolist() == want_means
    return found, means


def test_given_vectors_against_brute_force(spark, sf):
    found, means = check(spark.read.parquet(f"{sf}/embeddings.parquet"))
    rows = centroids.with_inertia(found, means).collect()
    assert {r.inertia for r in rows} == {sum(r.distance for r in rows)}
    for r in rows:
        assert r.cluster_inertia == sum(o.distance for o in rows if o.cluster == r.cluster)
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, means[r.cluster])).encode()).hexdigest()


def test_odd_rows(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=64)], 1, "x") for i in range(40)]
    rows += [(7, rows[3][1], 1, "x"), (7, rows[3][1], 2, None), (None, rows[4][1], None, "y"), (100, None, 1, "x"), (101, [0.0] * 63, 1, "x")]
    rows += [(102, [None] + [0.0] * 63, 1, "x"), (103, [float("nan")] + [0.0] * 63, 1, "x"), (104, [float("inf")] + [0.0] * 63, 1, "x")]
    rows += [(200 + i, [-0.0] * 64, 1, "x") for i in range(30)] + [(300, [1e5] * 32 + [-1e5] * 32, 1, "x"), (301, [-1e-9] * 64, 1, "x")]
    check(spark.createDataFrame(rows, SCHEMA).withColumn("cluster", F.lit("clash")))


def test_few_equal_or_no_vectors(spark):
    one = [float(i % 3) for i in range(64)]
    for rows in ([], [(1, None, 1, "x")], [(1, one, 1, "x")], [(i, one, 1, "x") for i in range(50)], [(None, one, 1, "x")]):
        found, means = centroids.cluster(spark.createDataFrame(rows, SCHEMA))
        want, want_means = brute([r[:2] for r in rows])
        assert means.tolist() == want_means and found.count() == len(want)
        assert {r.cluster for r in centroids.with_inertia(found, means).collect()} <= {0}


def test_vectors_whose_distances_leave_a_long_are_refused(spark):
    df = spark.createDataFrame([(1, [1e30] + [0.0] * 63, 1, "x")], SCHEMA)
    with pytest.raises(Exception, match="no longer exact"):
        centroids.cluster(df)


def test_bounds_never_rule_out_and_do_prune():
    """Clustered integer vectors, with many exact ties: bounds stay below the true distances, also where Ptolemy's is an equality."""
    rng = np.random.default_rng(11)
    centres = rng.integers(-400, 400, (16, 64))
    own = np.concatenate([(centres[rng.integers(0, 16, 3000)] + rng.integers(-20, 20, (3000, 64))), centres, np.zeros((5, 64), int)])
    big = np.concatenate([own * 100_000, own * 100_000 + 1])
    for vectors, scale in ((own, 1), (big, 100_000)):
        pivots = centres * scale
        to_pivots, exact = centroids.squared(vectors, pivots), None
        for means in (pivots, pivots[::-1].copy(), (pivots + rng.integers(-30, 30, pivots.shape) * scale)):
            assign = centroids.Assigner(pivots, means)
            bounds = centroids.lower_bounds(to_pivots, assign.theirs, assign.between, assign.pairs)
            exact = centroids.squared(vectors, means)
            assert (bounds <= exact).all()
            cluster, distance, measured = assign(vectors, to_pivots)
            assert (distance == exact.min(axis=1)).all() and (cluster == exact.argmin(axis=1)).all()
            assert measured.mean() < 4  # of 16


def test_the_query_reads_every_vector(spark, sf):
    assert queries.op11_centroid_clustering(spark, sf).count() == spark.read.parquet(f"{sf}/embeddings.parquet").count()
