import hashlib
import re

from pyspark.sql import functions as F

from telemetry_spark.llm import decontamination

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute_force(docs, items, window=10):
    spans = {}
    for key, text in items:
        words = words_of(text)
        if key is not None and words:
            for i in range(max(1, len(words) - window + 1)):
                spans.setdefault(tuple(words[i : i + window]), set()).add(str(key))
    sizes, out = {len(s) for s in spans}, []
    for key, text in docs:
        words, hit, own = words_of(text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if found := spans.get(tuple(words[i : i + n])):
                    own |= found
                    hit.update(range(i, i + n))
        digest = hashlib.sha256(",".join(sorted(own)).encode()).hexdigest()
        out.append((str(key), len(words), len(hit), len(own), digest, bool(hit)))
    return sorted(out)


def rows_of(frame):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in frame.collect())


def test_the_given_tables(spark, sf):
    docs, items = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "benchmark"))
    found = decontamination.contamination(docs, items)
    want = brute_force([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in items.select("item_id", "text").collect()])
    assert rows_of(found) == want and any(r[5] for r in want)


def test_short_items_and_odd_rows(spark, odd_documents):
    items = [
        (1, "a b c"), (2, "A-B, c! D e f"), (3, None), (4, ""), (None, "x y z"), (5, "license"), (6, " ".join(f"w{i}" for i in range(10))),
        (7, " ".join(f"w{i}" for i in range(3, 40))), (1, "y z"), (8, "ZUG über 12"),
    ]
    texts = [(20, " ".join(f"W{i}" for i in range(50))), (21, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9"), (22, "w0 w1 w2 w3 w4 w5 w6 w7 w8 x9"), (23, "a b c a b c d e f")]
    docs = odd_documents.select("doc_id", "text", "key", F.lit(1).alias("marks")).unionByName(
        spark.createDataFrame(texts, "doc_id bigint, text string").withColumns({"key": F.lit(1), "marks": F.lit(2)}))
    bench = spark.createDataFrame(items, "item_id bigint, text string").withColumn("row", F.lit(0))
    want = brute_force([tuple(r) for r in docs.select("doc_id", "text").collect()], items)
    assert rows_of(decontamination.contamination(docs, bench)) == want
    # The same by the join that is taken for a benchmark too large to broadcast.
    assert rows_of(decontamination.contamination(docs, bench, broadcast_rows=0)) == want
    assert decontamination.contamination(docs.limit(0), bench).count() == 0
    assert not any(r[5] for r in rows_of(decontamination.contamination(docs, bench.limit(0))))


def test_a_text_of_hits_takes_time_in_proportion(spark):
    """Long texts made of benchmark passages: twice the words take about twice the time."""
    import time

    items = spark.createDataFrame([(i, " ".join(f"w{i}x{j}" for j in range(30))) for i in range(400)], "item_id bigint, text string").cache()
    passages = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(400)]

    def seconds(words):
        text = " ".join(passages[i % 400] for i in range(words // 30))
        docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
        started = time.perf_counter()
        row = decontamination.contamination(docs, items).first()
        assert row.n_hit == row.n_words and row.n_items == min(400, words // 30)
        return time.perf_counter() - started

    seconds(3000)
    assert seconds(160_000) < 2.5 * seconds(80_000)
