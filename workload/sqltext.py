"""SQL statements in errors and spans."""

from __future__ import annotations

from pyspark.sql import functions as F

from telemetry_spark.functions import sqltext as fn
from telemetry_spark.operators.issues import sql_object_counts
from workload.tables import table

Q = "''"


def line_statements(spark, sf):
    """Statements over every line, in the shapes an application sends."""
    number = F.col("l_linenumber")
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    flag = F.concat(F.lit("'"), "l_returnflag", F.lit("''s'"))
    statement = (
        F.when(number == 1, F.concat(F.lit("SELECT * FROM lineitem l JOIN public.orders o ON o.id = l.id WHERE l.price > "), price,
                                     F.lit(" AND l.flag = "), flag))
        .when(number == 2, F.concat(F.lit("INSERT INTO returns2 (id, flag) VALUES ("), F.col("l_orderkey"), F.lit(", "), flag, F.lit(")")))
        .when(number == 3, F.concat(F.lit("EXEC dbo.sp_refund @id = "), F.col("l_orderkey"), F.lit(", @note = "), flag))
        .when(number == 4, F.concat(F.lit("SELECT * FROM open_lines("), F.col("l_partkey"), F.lit(") x, t2")))
        .when(number == 5, F.concat(F.lit("update stock set n = n - "), F.col("l_suppkey"), F.lit(" where extract(year from d) = 0x1F")))
        .when(number == 6, F.concat(F.lit("SELECT refund_line("), F.col("l_orderkey"), F.lit(", 1.5e-3)")))
        .otherwise(F.concat(F.lit("  "), F.lit("explain "), F.col("l_shipdate").cast("date").cast("string")))
    )
    seed = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return table(spark, sf, "lineitem").select(seed.alias("id"), number.alias("shape"), statement.alias("statement"))


def masked_statements(spark, sf):
    return line_statements(spark, sf).select("id", fn.mask_sql(F.col("statement")).alias("masked"))


MASKED = {
    1: "SELECT * FROM lineitem l JOIN public.orders o ON o.id = l.id WHERE l.price > ? AND l.flag = ?",
    2: "INSERT INTO returns2 (id, flag) VALUES (?, ?)",
    3: "EXEC dbo.sp_refund @id = ?, @note = ?",
    4: "SELECT * FROM open_lines(?) x, t2",
    5: "update stock set n = n - ? where extract(year from d) = ?",
    6: "SELECT refund_line(?, ?)",
    7: "  explain ?-?-?",
}
SEED_SQL = "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)"
MASKED_CASE = "CASE l_linenumber " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in MASKED.items()) + " END"
MASKED_SQL = f"SELECT {SEED_SQL} AS id, {MASKED_CASE} AS masked FROM lineitem"

OBJECTS = {
    1: ("SELECT", "", "lineitem,public.orders"), 2: ("INSERT", "", "returns2"), 3: ("EXEC", "dbo.sp_refund", ""),
    4: ("SELECT", "open_lines", ""), 5: ("UPDATE", "", "stock"), 6: ("SELECT", "refund_line", ""),
}


def _case(position: int) -> str:
    return "CASE l_linenumber " + " ".join(f"WHEN {k} THEN '{v[position]}'" for k, v in OBJECTS.items()) + " END"


def statement_objects(spark, sf):
    found = line_statements(spark, sf).withColumn("objects", fn.sql_objects(fn.mask_sql(F.col("statement"))))
    return found.select(
        "id", F.col("objects.operation").alias("operation"),
        F.array_join("objects.procedures", ",").alias("procedures"),
        F.array_join("objects.relations", ",").alias("relations"),
    )


OBJECTS_SQL = f"""
SELECT {SEED_SQL} AS id, {_case(0)} AS operation, {_case(1)} AS procedures, {_case(2)} AS relations FROM lineitem"""


def sql_object_roll_up(spark, sf):
    events = line_statements(spark, sf).withColumn("sql_objects", fn.sql_objects(fn.mask_sql(F.col("statement"))))
    return sql_object_counts(events)


ROLL_UP_SQL = """
WITH o AS (SELECT unnest(CASE l_linenumber WHEN 1 THEN ['relation:lineitem:SELECT', 'relation:public.orders:SELECT']
    WHEN 2 THEN ['relation:returns2:INSERT'] WHEN 3 THEN ['procedure:dbo.sp_refund:EXEC']
    WHEN 4 THEN ['procedure:open_lines:SELECT'] WHEN 5 THEN ['relation:stock:UPDATE']
    WHEN 6 THEN ['procedure:refund_line:SELECT'] ELSE [] END) AS x FROM lineitem)
SELECT split_part(x, ':', 1) AS object_type, split_part(x, ':', 2) AS object_name, split_part(x, ':', 3) AS operation,
       count(*) AS statements FROM o GROUP BY ALL"""


def many_names(spark, sf):
    """Statements that touch more tables than are kept, some by names longer than is kept."""
    n = 4 + F.col("p_size") % 20
    name = lambda i: F.concat(F.lit("t"), i.cast("string"), F.repeat(F.lit("x"), (F.col("p_size") % 3 * 150).cast("int")))
    statement = F.concat(F.lit("SELECT 1 FROM "), F.array_join(F.transform(F.sequence(F.lit(1), n.cast("int")), name), " JOIN "))
    parts = table(spark, sf, "part").select("p_partkey", fn.sql_objects(statement).alias("o"))
    return parts.select("p_partkey", F.size("o.relations").alias("names"), F.element_at("o.relations", -1).alias("last"))


NAMES_SQL = """
SELECT p_partkey, CAST(least(10, 4 + p_size % 20) AS INTEGER) AS names,
       left('t' || least(10, 4 + p_size % 20) || repeat('x', p_size % 3 * 150), 200) AS last FROM part"""


def masked_documents(spark, sf):
    """Whole documents as string literals, as bare text cut at 4000 characters, and in double quotes, which one system
    reads as a literal and the other as a name."""
    text = F.col("text")
    escaped = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    quoted = F.concat(F.lit("INSERT INTO t (a) VALUES (E'"), F.replace(escaped, F.lit("'"), F.lit("''")), F.lit("', 7)"))
    words = F.concat(F.lit("SELECT "), F.regexp_replace(text, "[^A-Za-z ]", ""))
    double = F.concat(F.lit('SELECT "'), F.replace(escaped, F.lit('"'), F.lit('""')), F.lit('" FROM t'))
    name = F.concat(F.lit('SELECT "'), F.regexp_replace(text, "[^A-Za-z ]", ""), F.lit('" FROM t WHERE a = 12'))
    documents = table(spark, sf, "documents").select("doc_id", "text")
    return documents.withColumn("cut", fn.mask_sql(words)).select(
        "doc_id", fn.mask_sql(quoted).alias("literal"), F.md5("cut").alias("cut_md5"),
        F.length("cut").cast("bigint").alias("cut_length"), fn.mask_sql(double, F.lit("MariaDB")).alias("mysql"),
        F.md5(fn.mask_sql(name, F.lit("postgresql"))).alias("name_md5"),
    )


DOCUMENTS_SQL = """
WITH d AS (SELECT doc_id, 'SELECT ' || regexp_replace(text, '[^A-Za-z ]', '', 'g') AS w,
  'SELECT "' || regexp_replace(text, '[^A-Za-z ]', '', 'g') || '" FROM t WHERE a = ?' AS q FROM documents),
c AS (SELECT doc_id, CASE WHEN length(w) > 4000 THEN left(w, 4000) || '...' ELSE w END AS cut,
  CASE WHEN length(q) > 4000 THEN left(q, 4000) || '...' ELSE q END AS name FROM d)
SELECT doc_id, 'INSERT INTO t (a) VALUES (?, ?)' AS literal, md5(cut) AS cut_md5, length(cut) AS cut_length,
       'SELECT ? FROM t' AS mysql, md5(name) AS name_md5 FROM c"""


def found_statements(spark, sf):
    """The statement of an error: in its info, its text or a cause."""
    key, status = F.col("o_orderkey"), F.col("o_orderpriority")
    sql = F.concat(F.lit("SELECT * FROM orders WHERE id = "), key)
    info = F.when(status == "1-URGENT", F.create_map(F.lit("sql"), F.lit("  "), F.lit("query"), sql)).when(
        status == "2-HIGH", F.create_map(F.lit("note"), sql)
    )
    reason = F.when(status == "3-MEDIUM", F.concat(F.lit("no such table: t , while compiling: \n"), sql, F.lit(" \n"))).otherwise("boom")
    cause = F.struct(F.create_map(F.lit("statement"), sql).alias("info"), F.lit("inner").alias("reason"))
    causes = F.when(status == "4-NOT SPECIFIED", F.array(cause))
    return table(spark, sf, "orders").select(
        key, fn.statement_in(info, reason, causes).alias("statement"), fn.sqlite_statement(reason).alias("compiling")
    )


FOUND_SQL = """
SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT', '3-MEDIUM', '4-NOT SPECIFIED')
  THEN 'SELECT * FROM orders WHERE id = ' || o_orderkey END AS statement,
  CASE WHEN o_orderpriority = '3-MEDIUM' THEN 'SELECT * FROM orders WHERE id = ' || o_orderkey END AS compiling
FROM orders"""

QUERIES = {
    "masked_statements": (masked_statements, MASKED_SQL),
    "statement_objects": (statement_objects, OBJECTS_SQL),
    "sql_object_roll_up": (sql_object_roll_up, ROLL_UP_SQL),
    "many_names": (many_names, NAMES_SQL),
    "masked_documents": (masked_documents, DOCUMENTS_SQL),
    "found_statements": (found_statements, FOUND_SQL),
}
