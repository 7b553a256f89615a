import numpy as np
from pyspark.sql import functions as F

from telemetry_spark.llm import neighbours


def brute_force(rows, k=10):
    ok = {i: np.array(v, float) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)}
    out = {}
    for q, vector in ok.items():
        if q % 100 == 0:
            out[q] = sorted((float(np.sqrt(((v - vector) ** 2).sum())), i) for i, v in ok.items() if i != q)[:k]
    return out


def by_query(frame):
    found = {}
    for r in frame.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r["rank"] == len(found[r.query_id])
    return found


def test_recall_on_the_given_vectors(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [tuple(r) for r in table.select("vec_id", "embedding").collect()]
    want, found = brute_force(rows), by_query(neighbours.nearest(table, F.col("vec_id") % 100 == 0, block_rows=700, block_queries=16))
    hits = sum(len({i for _, i in want[q]} & {i for _, i in found[q]}) for q in want)
    assert found.keys() == want.keys() and hits >= 0.95 * sum(map(len, want.values()))
    exact = {i: np.array(v, float) for i, v in rows}
    for q, own in found.items():
        assert own == sorted(own)
        assert all(abs(s - np.sqrt(((exact[q] - exact[i]) ** 2).sum())) < 1e-12 for s, i in own)


def test_odd_rows(spark):
    one, two = [1.0, 0.0, 2.0], [0.5, 0.5, 0.5]
    rows = [(i, one) for i in range(50)] + [(100, one), (200, two), (201, two), (300, None), (301, [0.0, 0.0, 0.0]), (400, [1.0, None, 2.0]),
            (500, [float("nan"), 1.0, 1.0]), (600, [float("inf"), 1.0, 1.0]), (None, one), (200, two), (700, [-0.0, 0.0, 3.0]), (701, [0.0, 0.0, 3.0]), (800, [])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").withColumns({"vector": F.lit(1), "cell": F.lit(2), "id": F.lit(3)})
    assert by_query(neighbours.nearest(table, F.col("vec_id") % 100 == 0)) == brute_force([r for r in rows])
    assert neighbours.nearest(table.limit(0), F.col("vec_id") % 100 == 0).count() == 0
