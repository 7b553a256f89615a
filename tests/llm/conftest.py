import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"


@pytest.fixture
def sf():
    if not os.path.isdir(SF):
        pytest.skip("needs the given tables")
    return SF


@pytest.fixture
def odd_documents(spark):
    """Nulls, empty texts, ties, repeated rows, a long text and columns with names that operators use themselves."""
    rows = [
        (1, None, "en", "s", 0, 1), (2, "", "en", "s", 0, 1), (3, "a b c d e f", None, None, None, 1),
        (4, "a b c d e f", "en", "s", 11, 2), (4, "a b c d e f", "en", "s", 11, 2), (None, "x y z", "de", "s", 5, 3),
        (5, " \n\t ", "de", "s", 4, 4), (6, "Zug über 12 \U0001f600 " * 20000, "de", "s", 0, 5), (7, "MIT License", "fr", "s", 0, 6),
    ]
    return spark.createDataFrame(
        rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int"
    ).withColumns({"key": __import__("pyspark.sql.functions", fromlist=["lit"]).lit(1)})
