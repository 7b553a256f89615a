import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from telemetry_spark.llm import toxicity


def segments_by_definition(scores):
    """Maximal-scoring segments by taking the best segment and going on left and right of it."""
    best = max(((sum(scores[a:b]), -a, -b) for a in range(len(scores)) for b in range(a + 1, len(scores) + 1)), default=(0, 0, 0))
    if best[0] <= 0:
        return []
    a, b = -best[1], -best[2]
    return segments_by_definition(scores[:a]) + [(a, b, best[0])] + [
        (x + b, y + b, s) for x, y, s in segments_by_definition(scores[b:])]


def test_scan_finds_the_maximal_segments():
    rng = random.Random(3)
    for _ in range(300):
        scores = [rng.choice([-5.0, -2.25, -1.0, -0.5, 0.75, 2.0, 3.5, 5.125]) + rng.random() for _ in range(rng.randrange(0, 14))]
        want = segments_by_definition(scores)
        found = toxicity.maximal_segments(np.array(scores))
        assert [(a, b) for a, b, _ in found] == [(a, b) for a, b, _ in want]
        assert [s for *_, s in found] == pytest.approx([s for *_, s in want])


def corpus(spark, n=600):
    rng, rows, labels = random.Random(5), [], []
    insults = [f"insult{i}" for i in range(4)]
    for i in range(n):
        words = [f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(rng.randrange(30, 200))]
        toxic = i % 5 == 0
        for _ in range(4 if toxic else 0):
            words.insert(rng.randrange(20) + 3, rng.choice(insults))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_held_out_accuracy_and_passages(spark):
    docs, labels = corpus(spark)
    found = toxicity.score(docs, toxicity.fit(docs, labels)).join(labels, "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)
    texts = {r.doc_id: r.text.split() for r in docs.collect()}
    for r in held:
        for p in r.passages if r.predicted else []:
            assert any(w.startswith("insult") for w in texts[r.doc_id][p.begin : p.end]) or p.chance > 0.001


def test_odd_rows(spark, odd_documents):
    labels = spark.createDataFrame([(3, 1), (3, 0), (4, None), (None, 1), (6, 0), (99, 1)], "doc_id bigint, toxic int").withColumn("text", F.lit("t"))
    for known in (labels, labels.limit(0)):
        found = toxicity.score(odd_documents, toxicity.fit(odd_documents, known)).collect()
        assert len(found) == odd_documents.count() and all(0 <= r.score < 0.7 and r.predicted == 0 for r in found if r.doc_id != 3)
    assert toxicity.score(odd_documents.limit(0), toxicity.fit(odd_documents.limit(0), labels)).count() == 0
