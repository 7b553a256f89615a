import itertools
import random
import re

import numpy as np
from pyspark.sql import functions as F

from telemetry_spark.llm import filter_audit


def brute(docs, labels):
    """The contract by walking through every order; documents as (doc_id, text, source), labels as (doc_id, quality, toxic)."""
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    first = {}
    for i, text, _ in docs:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    rows = []
    for i, text, source in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = ("A" * (len(words) < 50) + "B" * (100 * len(set(words)) < 65 * len(words))
                  + "C" * (100 * len(re.findall("[A-Z]", text)) > 5 * len(text)) + "D" * bool(re.search("[#$%&*|]", text))
                  + "E" * (i is not None and i > first[text]))
        rows.append((source or "", failed, i in good and i is not None, i in toxic and i is not None))
    out = {}
    for part in {r[0] for r in rows}:
        own, shapley = [r for r in rows if r[0] == part], dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone, stay = [r for r in left if f in r[1]], [r for r in left if f not in r[1]]
                fails = sum(f in r[1] for r in own)
                out[part, "".join(order), step] = [len(stay), len(gone), fails - len(gone), sum(r[1] == f for r in own),
                                                   sum(r[2] for r in gone), sum(r[3] for r in gone)]
                shapley[f] += len(gone)
                left = stay
        for order in itertools.permutations("ABCDE"):
            for step, f in enumerate(order, 1):
                out[part, "".join(order), step].append(shapley[f])
    return out


def check(spark, docs, labels, range_rows=filter_audit.RANGE_ROWS):
    found = filter_audit.checked(docs)
    lists = filter_audit.postings(found, labels, range_rows)
    got = {
        (r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
        for r in filter_audit.audit(found, lists).collect()
    }
    assert got == brute([tuple(r) for r in docs.select("doc_id", "text", "source").collect()], [tuple(r) for r in labels.collect()])
    return lists


def text_of(rng):
    kind = rng.randrange(6)
    words = [rng.choice(["alpha", "beta", "Gamma", "DELTA", "x", "ünï", "日本"]) + (str(rng.randrange(200)) if kind > 1 else "") for _ in range(rng.choice([3, 49, 50, 80]))]
    return rng.choice([" ", "\n", "\t ", " "]).join(words) + (" 5%" if kind == 3 else "")


def test_made_up_documents_against_brute_force(spark):
    rng = random.Random(4)
    texts = [text_of(rng) for _ in range(120)] + [None, "", " ", "A", "a|b"]
    docs = [(rng.randrange(500) if rng.random() < 0.95 else None, rng.choice(texts), rng.choice(["hot"] * 4 + [None, "", "b", "c d"])) for _ in range(600)]
    labels = [(rng.choice([*range(500), None]), rng.choice([0, 1, None]), rng.choice([0, 1, None])) for _ in range(300)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string").withColumns({"failed": F.lit("clash"), "part": F.lit(1)}).repartition(4)
    marks = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    lists = check(spark, frame, marks, range_rows=7)
    assert lists.selectExpr("max(size(ids)) as n").first().n <= 7
    for r in lists.collect():
        places = [p for name in "ABCDE" for p in r[name]]
        assert set(places) == set(range(len(r.ids))) and r.ids == sorted(r.ids, key=lambda i: -1 if i is None else i)
        assert all(list(r[name]) == sorted(set(r[name])) for name in filter_audit.LISTS)
    check(spark, frame, marks)


def test_given_documents_against_brute_force(spark, sf):
    check(spark, spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"), range_rows=50)


def test_odd_rows(spark, odd_documents, sf):
    labels = spark.createDataFrame([(4, 1, 1), (4, None, 0), (None, 1, 1), (6, 0, 1)], "doc_id bigint, quality int, toxic int")
    check(spark, odd_documents, labels)
    check(spark, odd_documents, labels.limit(0))
    none = filter_audit.checked(odd_documents.limit(0))
    assert filter_audit.audit(none, filter_audit.postings(none, labels)).count() == 0
    fine = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(60)), "s", 0)], "doc_id bigint, text string, source string, n_chars long")
    check(spark, fine, labels)


def test_merges_of_lists():
    rng = np.random.default_rng(3)
    for size, taken in ((0, 5), (5, 0), (1, 1), (900, 40), (40, 900), (5000, 5000), (3000, 20000)):
        a = np.sort(rng.choice(30000, size, replace=False)).astype(np.int32)
        b = np.sort(rng.choice(30000, taken, replace=False)).astype(np.int32)
        rest = filter_audit.difference(a, b)
        assert rest.tolist() == sorted(set(a.tolist()) - set(b.tolist()))
        assert filter_audit.merged(b, rest).tolist() == sorted(set(a.tolist()) | set(b.tolist()))
    lists = [np.sort(rng.choice(400, n, replace=False)).astype(np.int32) for n in (0, 30, 200, 399, 7)]
    for subset, n in enumerate(filter_audit.union_sizes(lists)):
        assert n == len(set().union(*(lists[i].tolist() for i in range(5) if subset >> i & 1)))


def test_a_hot_part_and_a_shared_id_are_cut_into_ranges(spark):
    """All rows of one part and one id: ranges stay bounded and no task holds them all."""
    docs = spark.range(20000).selectExpr("1L as doc_id", "concat('short ', id % 3) as text", "'hot' as source").repartition(8)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    lists = check(spark, docs, labels, range_rows=512)
    assert lists.selectExpr("max(size(ids)) as n").first().n <= 512
