"""Compare registered queries with their SQL on the same tables, order-insensitively and value by value."""

import glob
import os
import sys
import time

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def connect(sf_dir):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def normal(value):
    if isinstance(value, float) and value == int(value):
        return f"f{int(value)}"
    return f"f{value!r}" if isinstance(value, float) else repr(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark, con, query, sql, sf_dir):
    """Empty text when both sides agree, else what differs."""
    df = query(spark, sf_dir)
    got_columns, got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if sql is None:
        return ""
    cursor = con.execute(sql)
    want_columns, want = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if got != want:
        extra, missing = sorted(set(got) - set(want)), sorted(set(want) - set(got))
        return f"rows {len(got)} vs {len(want)}; only ours {extra[:3]}; only SQL {missing[:3]}"
    return ""


if __name__ == "__main__":
    from pyspark.sql import SparkSession

    import __spark_entry__ as entry

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    spark = (
        SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8").config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    oracles, failed = entry.oracle_sql(), 0
    for name, query in entry.queries().items():
        if sys.argv[1:] and name not in sys.argv[1:]:
            continue
        started = time.time()
        try:
            problem = compare(spark, con, query, oracles.get(name), sf_dir)
        except Exception as error:  # report and go on with the next query
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        failed += bool(problem)
        mark = "FAIL" if problem else ("ok" if name in oracles else "rows")
        print(f"{mark:5}{name:34}{time.time() - started:7.2f}s {problem}", flush=True)
    sys.exit(1 if failed else 0)
