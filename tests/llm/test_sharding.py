import zlib

from pyspark.sql import functions as F

from telemetry_spark.llm import sharding


def check(rows, docs, shards):
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in rows) == sorted(
        (str(k), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for k, t in docs)
    total, by_shard = sum(r.size for r in rows), {}
    for r in rows:
        by_shard.setdefault(r.shard, []).append(r)
    for number, own in by_shard.items():
        assert 0 <= number < shards and sorted(r.slot for r in own) == list(range(len(own)))
        assert abs(sum(r.size for r in own) - total / shards) <= 2 * max(r.size for r in rows)


def test_shards_are_even(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    check(sharding.shard(docs, 10).collect(), [tuple(r) for r in docs.select("doc_id", "text").collect()], 10)


def test_a_text_with_many_copies_is_subdivided(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("the same text")).otherwise(
        F.concat(F.lit("text "), F.col("id"))).alias("text"))
    check(sharding.shard(docs, 40).collect(), [tuple(r) for r in docs.collect()], 40)


def test_copies_stay_together(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 400).alias("text"))
    split = sharding.shard(docs, 8).groupBy("text_crc32").agg(F.countDistinct("shard").alias("n")).where("n > 1").count()
    assert split < 8  # a border cuts at most one text


def test_odd_rows(spark, odd_documents, scratch):
    check(sharding.shard(odd_documents, 2).collect(), [tuple(r) for r in odd_documents.select("doc_id", "text").collect()], 2)
    assert sharding.shard(odd_documents.limit(0)).count() == 0
    sharding.write_shards(odd_documents, f"{scratch}/shards", 2)
    assert spark.read.parquet(f"{scratch}/shards").count() == odd_documents.count()
