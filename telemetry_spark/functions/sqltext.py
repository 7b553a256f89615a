"""SQL statements found in errors: literals masked, and the objects a statement touches."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetry_spark.functions.text import blank_to_null, chain, empty_to_null, is_blank, let, strip

# Limits, patterns and words that results must agree on.
MAX_STATEMENT = 4000
MAX_NAMES = 10
MAX_NAME_LENGTH = 200
MAX_CAUSE_DEPTH = 5
DOUBLE_QUOTE_SYSTEMS = ("mysql", "mariadb")
OPERATIONS = (
    "SELECT", "INSERT", "UPDATE", "DELETE", "MERGE", "WITH", "CALL", "EXEC", "EXECUTE", "CREATE", "ALTER", "DROP",
    "TRUNCATE",
)
BUILTINS = (
    "count", "sum", "min", "max", "avg", "now", "coalesce", "nullif", "lower", "upper", "length", "concat", "cast",
    "date_trunc", "current_timestamp", "current_date", "row_number", "rank", "json_build_object", "json_agg",
    "array_agg",
)
NOT_NAMES = ("select", "set", "values", "where", "lateral", "only", "unnest", "generate_series")
# Quoted bodies are possessive: they end at a lone quote or at the end of the text and never need to back up.
STRING = (
    r"(?:(?<![A-Za-z0-9_$])(?:[EeXxNnBb]|[Uu]&))?"
    r"'[^'\\]*+(?:(?:\\(?:.|\z)|'')[^'\\]*+)*+(?:'|\z)"
)
DOUBLE_QUOTED_STRING = r'"[^"\\]*+(?:(?:\\(?:.|\z)|"")[^"\\]*+)*+(?:"|\z)'
DOLLAR_QUOTED = r"(\$[A-Za-z_]*\$).*?(?:\1|\z)"
NUMBER = (
    r"(?<![A-Za-z0-9_$.])"
    r"(?:0[xX][0-9A-Fa-f]+|0[bB][01]+|(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+)(?:[eE][+-]?[0-9]+)?)(?![A-Za-z0-9_])"
)
# What every literal begins with, asked first: elsewhere no alternative is tried.
BEGINS = r"['$0-9.]|[EeXxNnBb]'|[Uu]&'"
LITERAL = f"(?s)(?={BEGINS})(?:{STRING}|{DOLLAR_QUOTED}|{NUMBER})"
LITERAL_WITH_DOUBLE_QUOTES = f'(?s)(?={BEGINS}|")(?:{STRING}|{DOUBLE_QUOTED_STRING}|{DOLLAR_QUOTED}|{NUMBER})'
NAME_PART = r'(?:[\w$#@]++|"[^"]++"|\[[^\]]++\]|`[^`]++`)'
NAME = rf"{NAME_PART}(?:\.{NAME_PART})*+"
PROCEDURE_CALL = (
    rf"(?Ui)(?=[CEP])\b(?:CALL|EXEC(?:UTE)?|PERFORM)\s+(?!IMMEDIATE\b|FUNCTION\b|PROCEDURE\b)({NAME})"
)
# The first letter is asked before the word's bounds, which cost more.
RELATION = rf"(?Ui)(?=[FJIUT])\b(FROM|JOIN|INTO|UPDATE|TABLE)\s+({NAME})(\s*\()?"
SELECT_FUNCTION = rf"(?Ui)\A\s*SELECT\s+({NAME})\s*\("
FROM_INSIDE_FUNCTION = r"(?Ui)(?=[ESTO])\b(?:EXTRACT|SUBSTRING|TRIM|OVERLAY)\s*\([^()]*\)"
COMPILING = r"(?s)while compiling:\s*+(.*)\z"
SPACE = " \t\n\x0b\f\r"


def sqlite_statement(reason: Column) -> Column:
    """The statement in an error text that ends in ``while compiling: ...``, null without one."""
    return empty_to_null(F.rtrim(F.regexp_extract(reason, COMPILING, 1), F.lit(SPACE)))


def statement_in(info: Column, reason: Column, causes: Column | None = None, keys=("sql", "statement", "query")):
    """The first statement in an error's info map, its text, then its causes (structs of ``info`` and ``reason``)."""

    def one(i: Column, r: Column) -> Column:
        named = [blank_to_null(F.try_element_at(i, F.lit(key))) for key in keys]
        return F.coalesce(*named, sqlite_statement(r))

    if causes is None:
        return one(info, reason)
    nested = F.transform(F.slice(causes, 1, MAX_CAUSE_DEPTH), lambda c: one(c["info"], c["reason"]))
    return F.coalesce(one(info, reason), F.get(F.filter(nested, lambda s: s.isNotNull()), F.lit(0)))


def mask_sql(statement: Column, system: Column | None = None) -> Column:
    """String, dollar-quoted and number literals as ``?``, cut at 4000 characters; null for blank text."""

    def mask(s: Column) -> Column:
        # Every literal holds a quote, a dollar sign or a digit; a statement without any is its own mask.
        plain = F.when(s.rlike("['$0-9]"), F.regexp_replace(s, LITERAL, "?")).otherwise(s)
        if system is None:
            return F.when(~is_blank(s), plain)
        quoted = F.lower(system).isin(*DOUBLE_QUOTE_SYSTEMS)
        fully = F.when(s.rlike("['\"$0-9]"), F.regexp_replace(s, LITERAL_WITH_DOUBLE_QUOTES, "?")).otherwise(s)
        return F.when(~is_blank(s), F.when(quoted, fully).otherwise(plain))

    def cut(m: Column) -> Column:
        return F.when(
            F.length(m) > MAX_STATEMENT, F.concat(F.left(m, F.lit(MAX_STATEMENT)), F.lit("..."))
        ).otherwise(m)

    return chain(statement, mask, cut)


def _clean_names(names: Column) -> Column:
    """Trimmed, cut and well-formed names in order of first appearance, ten at most."""
    trimmed = F.transform(names, lambda n: F.left(strip(n), F.lit(MAX_NAME_LENGTH)))
    return F.slice(F.array_distinct(F.filter(trimmed, lambda n: n.rlike(rf"(?U)\A{NAME}\z"))), 1, MAX_NAMES)


def sql_objects(masked: Column) -> Column:
    """Operation, procedures and relations of a masked statement; null when it names none."""

    def all_groups(sql: Column, pattern: str, group: int) -> Column:
        return F.regexp_extract_all(sql, F.lit(pattern), F.lit(group))

    def collect(sql: Column) -> Column:
        # A mention that ends in a parenthesis is a call, but after FROM and JOIN only: elsewhere it lists columns.
        mentions = F.transform(
            all_groups(sql, RELATION, 0),
            lambda mention: F.struct(
                F.regexp_extract(mention, RELATION, 2).alias("name"),
                (mention.endswith("(") & F.lower(F.left(mention, F.lit(4))).isin("from", "join")).alias("call"),
            ),
        )
        operation = F.upper(F.regexp_extract(sql, r"(?U)\A\s*(\w+)", 1))
        function = F.regexp_extract(sql, SELECT_FUNCTION, 1)
        bare = (function != "") & ~F.lower(function).isin(*BUILTINS) & ~sql.rlike(r"(?Ui)\bFROM\b")
        return F.struct(
            F.when(operation.isin(*OPERATIONS), operation).alias("operation"),
            all_groups(sql, PROCEDURE_CALL, 1).alias("called"),
            F.filter(mentions, lambda m: ~F.lower(m["name"]).isin(*NOT_NAMES)).alias("mentions"),
            F.when(bare, F.array(function)).otherwise(F.array().cast("array<string>")).alias("selected"),
        )

    def finish(found: Column) -> Column:
        functions = F.transform(F.filter(found["mentions"], lambda m: m["call"]), lambda m: m["name"])
        tables = F.transform(F.filter(found["mentions"], lambda m: ~m["call"]), lambda m: m["name"])
        return F.struct(
            found["operation"].alias("operation"),
            _clean_names(F.concat(found["called"], functions, found["selected"])).alias("procedures"),
            _clean_names(tables).alias("relations"),
        )

    def anything(objects: Column) -> Column:
        named = (F.size(objects["procedures"]) > 0) | (F.size(objects["relations"]) > 0)
        return F.when(named | objects["operation"].isNotNull(), objects)

    def parse(m: Column) -> Column:
        without_from = F.regexp_replace(m, FROM_INSIDE_FUNCTION, " ")
        return F.when(~is_blank(m), chain(without_from, collect, finish, anything))

    return let(masked, parse)
