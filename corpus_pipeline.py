"""The corpus pipeline: stages that each take what the one before kept, from documents to packed sequences.

A stage returns the columns of ``documents`` and decides by its operator which rows stay; the last returns the packed pieces. Nulls,
empty texts, repeated rows and empty tables are treated as each operator's docstring says: a text that is null or has no letter has no
language, so the first stage drops it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telemetry_spark.llm import decontamination, langid, neardup, packing, toxicity
from telemetry_spark.llm.common import written
from telemetry_spark.llm.queries import BATCH_ROWS, table, vocabulary

#: Least share of all languages' likelihood that the likeliest must have.
LEAST_LANGUAGE_SHARE = 0.5


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of no language, and those that no language is likelier for than all others together."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    model = langid.fit(docs, vocabulary("piece_bpe_32k.model"))
    found = langid.annotated(docs, model, "__language")
    kept = (F.col("__language.lang_pred") != "und") & (F.col("__language.score") >= LEAST_LANGUAGE_SHARE)
    return found.where(kept).select(*docs.columns)


def clean_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that are likely to be toxic."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    found = toxicity.annotated(docs, model, "__toxicity")
    return found.where(F.col("__toxicity.score") < toxicity.THRESHOLD).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group whose shingles of five words are alike by 0.8 or more."""
    return neardup.without_duplicates(docs, neardup.near_duplicates(docs)).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    found = decontamination.contamination(docs, table(spark, sf_dir, "benchmark"))
    return decontamination.without_contaminated(docs, found).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokenize what is left and pack it, neighbours along the curve next to each other."""
    return packing.pack(docs, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken"))


STAGES = [
    ("language_id", language_id),
    ("toxicity", clean_language),
    ("near_dedup", near_dedup),
    ("decontamination", decontaminate),
    ("packing", pack),
]

#: Model scoring, signatures and tokenizers are beyond SQL; the tests compare with brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
