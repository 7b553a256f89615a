"""Registered queries of this subpackage: each operator over its whole table, and the pipeline."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_spark.llm import (
    centroids,
    decontamination,
    extraction,
    filter_audit,
    langid,
    licenses,
    neardup,
    neighbours,
    packing,
    piece_codec,
    sharding,
    toxicity,
    urls,
)


#: Rows that a Python worker gets at once. Texts are long, and a worker holds a whole batch of them.
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).drop("passages")


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.fit(docs, vocabulary("piece_bpe_32k.model")))


def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract_pages(table(spark, sf_dir, "pages")).drop("path")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"), with_ids=False
    )
    return pieces


#: Verdict, host and path of the url rules.
URL_RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES).drop("block_probability")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans", "row")


WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, {WORDS_SQL} AS w FROM documents),
b AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark WHERE item_id IS NOT NULL),
spans AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS span
          FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
runs AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS span
         FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM spans) WHERE len(w) >= n)),
hits AS (SELECT r, i, n, item_id FROM runs JOIN spans USING (n, span)),
places AS (SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM hits) GROUP BY r),
items AS (SELECT r, count(DISTINCT item_id::VARCHAR) AS n_items,
                 string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS list FROM hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(list, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN places USING (r) LEFT JOIN items USING (r)"""


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85).drop("text_hash")


NEAR_DUPLICATES_SQL = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS shingle
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y USING (shingle)
                            WHERE x.doc_id <> y.doc_id GROUP BY ALL)
          JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * c >= 85 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS node, doc_id AS seen FROM d UNION SELECT reach.node, links.b FROM reach JOIN links ON links.a = reach.seen)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(seen) AS component_id, doc_id = min(seen) AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN reach ON node = doc_id GROUP BY doc_id"""


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 40)


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.cluster(table(spark, sf_dir, "embeddings")))


def _round_sql(n: int) -> str:
    """Nearest centroids of round n, and the centroids that follow from them."""
    return f"""
a{n} AS MATERIALIZED (SELECT r, vec_id, v, min(o).k AS k, min(o).d AS d FROM (
  SELECT r, vec_id, v.v, {{'d': list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT, 'k': k}} AS o
  FROM v, c{n} c) GROUP BY r, vec_id, v),
m{n} AS MATERIALIZED (SELECT k, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS v FROM (
  SELECT k, i, sum(x) AS s, count(*) AS n FROM (SELECT k, unnest(range(1, 65)) AS i, unnest(v) AS x FROM a{n}) GROUP BY k, i) GROUP BY k),
c{n + 1} AS MATERIALIZED (SELECT c.k, coalesce(m.v, c.v) AS v FROM c{n} c LEFT JOIN m{n} m USING (k)),"""


CENTROIDS_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS k, v FROM v WHERE vec_id IS NOT NULL
  QUALIFY row_number() OVER (ORDER BY sha256('1:' || vec_id), v) <= 16),{"".join(map(_round_sql, range(4)))}
z AS (SELECT 1)
SELECT vec_id, k::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY k)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c3.v, ',')) AS centroid_sha256
FROM a3 JOIN c3 USING (k)"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = filter_audit.checked(table(spark, sf_dir, "documents"))
    return filter_audit.audit(found, filter_audit.postings(found, table(spark, sf_dir, "labels")))


FILTER_AUDIT_SQL = """
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t, min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first,
                  regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT part, good, toxic, (len(w) < 50)::INT + 2 * (100 * len(list_distinct(w)) < 65 * len(w))::INT
        + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
        + 16 * coalesce(doc_id > first, false)::INT AS failed
      FROM d LEFT JOIN l USING (doc_id)),
m AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM f GROUP BY ALL),
u AS (SELECT part, s, sum(n) AS total, coalesce(sum(n) FILTER (failed & s <> 0), 0) AS n, coalesce(sum(g) FILTER (failed & s <> 0), 0) AS g,
             coalesce(sum(x) FILTER (failed & s <> 0), 0) AS x FROM m, (SELECT unnest(range(32)) AS s) GROUP BY part, s),
i AS (SELECT unnest(range(5)) AS f),
o AS (SELECT [a.f, b.f, c.f, d.f, e.f] AS o FROM i a, i b, i c, i d, i e WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
s AS (SELECT array_to_string(list_transform(o, lambda f: chr((65 + f)::INT)), '') AS filter_order, step,
             1 << o[step] AS own, list_sum(list_transform(o[1:step], lambda f: 1 << f))::BIGINT AS after
      FROM (SELECT o, unnest(range(1, 6)) AS step FROM o)),
r AS (SELECT a.part, filter_order, step::INT AS step, own, a.total - a.n AS kept, a.n - b.n AS removed, p.n - (a.n - b.n) AS redundant,
             z.n - q.n AS unique_fails, a.g - b.g AS good_lost, a.x - b.x AS toxic_lost
      FROM s JOIN u a ON a.s = after JOIN u b ON b.part = a.part AND b.s = after - own JOIN u p ON p.part = a.part AND p.s = own
      JOIN u z ON z.part = a.part AND z.s = 31 JOIN u q ON q.part = a.part AND q.s = 31 - own)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM r"""


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    found = piece_codec.coded(docs, vocabulary("piece_bpe_32k.model"))
    digest = F.sha2(piece_codec.ids_text(F.col("coded.ids")), 256)
    return found.select(
        "doc_id", F.size("coded.ids").cast("bigint").alias("n_tokens"), digest.alias("ids_sha256"),
        F.sha2("coded.decoded", 256).alias("decoded_sha256"), "coded.agrees",
    )


#: Queries by name with the SQL that must agree, or None where SQL cannot say it.
REGISTRY = {
    "op1_toxicity": (op1_toxicity, None),
    "op2_language_id": (op2_language_id, None),
    "op3_html_extraction": (op3_html_extraction, None),
    "op4_license_scan": (op4_license_scan, None),
    "op5_packing": (op5_packing, None),
    "op6_nearest_neighbours": (op6_nearest_neighbours, None),
    "op7_url_filter": (op7_url_filter, None),
    "op8_decontamination": (op8_decontamination, DECONTAMINATION_SQL),
    "op9_near_duplicates": (op9_near_duplicates, NEAR_DUPLICATES_SQL),
    "op10_sharding": (op10_sharding, None),
    "op11_centroid_clustering": (op11_centroid_clustering, CENTROIDS_SQL),
    "op12_filter_audit": (op12_filter_audit, FILTER_AUDIT_SQL),
    "op13_sentencepiece": (op13_sentencepiece, None),
}
