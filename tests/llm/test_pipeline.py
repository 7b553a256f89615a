import pytest

import __spark_entry__
import corpus_pipeline
from test_neardup import brute_force as near_brute_force
from test_decontamination import brute_force as hits_brute_force

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def kept(spark, tmp_path_factory):
    """What each stage keeps of the given tables, written and read again."""
    sf, folder, out = "/root/testdata/sf0.001", tmp_path_factory.mktemp("pipeline"), {}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{folder}/{name}")
        out[name] = docs = spark.read.parquet(f"{folder}/{name}")
    return out


def texts(df):
    return [tuple(r) for r in df.select("doc_id", "text").collect()]


def test_stages_keep_the_columns_and_only_given_rows(kept):
    before = None
    for name, df in list(kept.items())[:-1]:
        assert df.columns == COLUMNS
        assert before is None or set(texts(df)) <= before
        before = set(texts(df))
    assert kept["language_id"].count() >= 0.98 * kept["documents"].count()


def test_one_document_of_each_group_stays(kept):
    groups = near_brute_force(texts(kept["toxicity"]), 5, 80)
    assert {k for k, _ in texts(kept["near_dedup"])} == {k for k, (_, component) in groups.items() if k == component}


def test_documents_with_benchmark_passages_go(spark, kept):
    items = texts(spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
    hit = {r[0] for r in hits_brute_force(texts(kept["near_dedup"]), items) if r[5]}
    assert hit and {str(k) for k, _ in texts(kept["decontamination"])} == {str(k) for k, _ in texts(kept["near_dedup"])} - hit


def test_all_that_is_left_is_packed(kept):
    starts = {r.doc_id for r in kept["packing"].where("start = 0").collect()}
    assert starts == {k for k, _ in texts(kept["decontamination"])}
    assert all(len(r.ids) == r.length for r in kept["packing"].collect())


def test_odd_rows_pass_every_stage(spark, sf, odd_documents):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = odd_documents.columns
        out = stage(spark, odd_documents, sf)
        assert out.columns == columns and out.count() <= odd_documents.count()
        assert stage(spark, odd_documents.limit(0), sf).count() == 0
    once = corpus_pipeline.near_dedup(spark, odd_documents, sf)
    assert sorted(str(r.doc_id) for r in once.collect()) == ["1", "2", "3", "5", "6", "7", "None"]


def test_the_pipeline_is_registered():
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    numbers = {name.split("_")[0] for name in __spark_entry__.queries() if name.startswith("op")}
    assert numbers == {f"op{n}" for n in range(1, 14)}
