"""Checks of SQL text against the generation rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean_sql

# The rules a generated join query must obey.
ONE_OF = ["COUNT", "MIN", "MAX", "AVG", "SUM", "DATE_TRUNC"]
MAX_LENGTH = 200
BANNED = {
    "regex": r"(?i)~|\bREGEXP",
    "similar_to": r"(?i)\bSIMILAR\s+TO\b",
    "ilike": r"(?i)\bILIKE\b",
    "json": r"(?i)\bJSONB?|->",
    "array": r"(?i)\bARRAY\b|\bARRAY_|\bUNNEST\b",
    "window": r"(?i)\bOVER\s*\(",
    "cte": r"(?i)^\s*WITH\b",
    "subquery": r"(?i)\(\s*SELECT\b",
}
TABLE_AFTER = r'(?iU)\b(?:FROM|JOIN)\s+([\w."`]+)'


def join_tables(sql) -> Column:
    """Distinct names after FROM and JOIN, outer quotes and schema prefix removed; case matters."""
    names = F.regexp_extract_all(sql, F.lit(TABLE_AFTER), F.lit(1))
    return F.array_distinct(F.transform(names, lambda n: F.substring_index(F.btrim(n, F.lit('`"')), ".", -1)))


def join_table_count(sql) -> Column:
    return F.size(join_tables(sql))


def min_joins(pairs: DataFrame, n: int = 2) -> DataFrame:
    """Pairs whose SQL names at least ``n`` tables."""
    return pairs.where(join_table_count(F.col("sql")) >= n)


def violations(sql) -> Column:
    """Names of the rules the SQL breaks."""
    calls = F.regexp_count(sql, F.lit(r"(?i)\b(?:" + "|".join(ONE_OF) + r")\s*\("))
    broken = [F.when(calls > 1, F.lit("functions"))]
    broken += [F.when(F.regexp_like(sql, F.lit(p)), F.lit(name)) for name, p in BANNED.items()]
    broken.append(F.when(F.length(sql) > MAX_LENGTH, F.lit("length")))
    return F.array_compact(F.array(*broken))


def lint_sql(pairs: DataFrame) -> DataFrame:
    """Adds ``violations`` of the cleaned SQL and ``ok``."""
    return (pairs.withColumn("sql", clean_sql(F.col("sql"))).withColumn("violations", violations(F.col("sql")))
            .withColumn("ok", F.size("violations") == 0))


def uses_function(sql, fn) -> Column:
    """Whether the SQL contains the function's name as a word; some functions take no parentheses."""
    return F.regexp_like(sql, F.concat(F.lit(r"(?i)\b"), fn if isinstance(fn, Column) else F.lit(fn), F.lit(r"\b")))


# FROM that is no clause: after DISTINCT, and between the arguments of some functions
NO_CLAUSE = [(r"(?i)\bDISTINCT\s+FROM\b", "DISTINCT"),
             (r"(?i)\b((?:EXTRACT|TRIM|SUBSTRING|OVERLAY)\s*\((?:[^()]|\([^()]*\))*?)\bFROM\b", "$1,")]
QUOTED = r"'(?:[^']|'')*'"
NAMED_QUERY = r'(?iU)(?:\bWITH\s+(?:RECURSIVE\s+)?|,\s*)"?([\w]+)"?\s*(?:\([^()]*\)\s*)?AS\s*(?:(?:NOT\s+)?MATERIALIZED\s*)?\('


def query_tables(sql) -> Column:
    """Lower-cased tables that the SQL reads: names after FROM and JOIN, but for those of its own WITH queries."""
    plain = F.regexp_replace(sql, QUOTED, "''")
    for pattern, instead in NO_CLAUSE:
        plain = F.regexp_replace(plain, pattern, instead)
    own = F.when(F.regexp_like(plain, F.lit(r"(?i)\bWITH\b")), F.regexp_extract_all(plain, F.lit(NAMED_QUERY), F.lit(1))).otherwise(F.array().cast("array<string>"))
    names = join_tables(F.translate(plain, '"`', ''))
    return F.array_except(F.transform(names, F.lower), F.transform(own, F.lower))


def unknown_tables(sql, names: list[str]) -> Column:
    """Tables of the SQL that the catalog lacks."""
    return F.array_except(query_tables(sql), F.array(*[F.lit(n.lower()) for n in names]))
