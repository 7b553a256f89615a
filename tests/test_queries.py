"""Every registered query against its SQL, on the smallest tables. ``tests/oracle.py`` does all at any size."""

import os
import subprocess
import sys

import pytest

import __spark_entry__ as registered
import workload
from oracle import compare, connect

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="needs the given tables")


@pytest.fixture(scope="module")
def tables():
    return connect(SF_DIR)


def test_registry():
    queries, sql = registered.queries(), registered.oracle_sql()
    assert set(sql) <= set(queries) and registered.FLAGSHIP in queries


@pytest.mark.parametrize("name", [n for n in registered.queries() if n in workload.REGISTRY])
def test_query_agrees_with_its_sql(spark, tables, name):
    sql = registered.oracle_sql().get(name)
    assert compare(spark, tables, registered.queries()[name], sql, SF_DIR) == ""


def test_entry(spark):
    assert registered.entry(spark).count() > 0


def test_the_entry_works_without_the_training_data_operators():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    blocked = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(len(e.queries()))"
    out = subprocess.run([sys.executable, "-c", blocked], cwd=root, capture_output=True, text=True, check=True)
    assert int(out.stdout.split()[-1]) == len(workload.REGISTRY)
