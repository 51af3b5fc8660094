"""Pairs that follow from metadata and profiles without asking a model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import say
from ..sources.catalog import Catalog, local_frame, union_all

# Templates by column family; {t} table, {c} column.
ONE_COLUMN = [
    ("COUNT", "any", "How many {t} rows have a {c}?", "SELECT COUNT({c}) FROM {t}"),
    ("COUNT", "any", "How many different {c} values does {t} hold?", "SELECT COUNT(DISTINCT {c}) FROM {t}"),
    ("MIN", "any", "What is the smallest {c} in {t}?", "SELECT MIN({c}) FROM {t}"),
    ("MAX", "any", "What is the largest {c} in {t}?", "SELECT MAX({c}) FROM {t}"),
    ("SUM", "number", "What is the total {c} of {t}?", "SELECT SUM({c}) FROM {t}"),
    ("AVG", "number", "What is the average {c} of {t}?", "SELECT AVG({c}) FROM {t}"),
    ("ROUND", "number", "What is the average {c} of {t}, rounded?", "SELECT ROUND(AVG({c}), 2) FROM {t}"),
    ("ABS", "number", "What is the largest absolute {c} in {t}?", "SELECT MAX(ABS({c})) FROM {t}"),
    ("LENGTH", "text", "How long is the longest {c} in {t}?", "SELECT MAX(LENGTH({c})) FROM {t}"),
    ("UPPER", "text", "Which {c} values of {t} are there in capitals?", "SELECT DISTINCT UPPER({c}) FROM {t}"),
    ("LOWER", "text", "Which {c} values of {t} are there in small letters?", "SELECT DISTINCT LOWER({c}) FROM {t}"),
    ("DATE_TRUNC", "time", "How many {t} rows are there per month of {c}?",
     "SELECT DATE_TRUNC('month', {c}), COUNT(*) FROM {t} GROUP BY 1"),
]
FEW_VALUES = ("How many {t} rows are there for each {c}?", "SELECT {c}, COUNT(*) FROM {t} GROUP BY {c}")
# Over one relationship t.c -> p.k, and over two in a row t.c -> p.k and p.d -> q.l.
JOIN = ("How many {t} rows belong to each {p}?",
        "SELECT b.{k}, COUNT(*) FROM {t} a JOIN {p} b ON a.{c} = b.{k} GROUP BY b.{k}")
CHAIN = ("How many {t} rows belong to each {q} by way of {p}?",
         "SELECT c.{l}, COUNT(*) FROM {t} a JOIN {p} b ON a.{c} = b.{k} JOIN {q} c ON b.{d} = c.{l} GROUP BY c.{l}")
# Questions and answers about the schema.
DOCS = {
    "size": ("How many columns does {t} have?", "{t} has {n} columns."),
    "key": ("What is the primary key of {t}?", "The primary key of {t} is {k}."),
    "type": ("What is the type of {t}.{c}?", "{t}.{c} has type {ty}."),
    "filled": ("Is {t}.{c} always filled?", "Yes, every row of {t} has a {c}."),
    "refers": ("What does {t}.{c} refer to?", "{t}.{c} refers to {p}.{k}."),
}

# Type families by printed type.
FAMILIES = {"BIGINT": "number", "INTEGER": "number", "SMALLINT": "number", "NUMERIC": "number", "REAL": "number",
            "DOUBLE PRECISION": "number", "TEXT": "text", "DATE": "time", "TIMESTAMP": "time"}


def _fill(template, **cols):
    """As ``say`` for a template that is itself a column."""
    out = template
    for key, value in cols.items():
        out = F.replace(out, F.lit("{" + key + "}"), value)
    return out


def _pair(kind: str, templates: tuple[str, str], **cols) -> list:
    question, sql = templates
    return [F.lit(kind).alias("kind"), cols["t"].alias("table"), say(question, **cols).alias("question"), say(sql, **cols).alias("sql")]


def template_pairs(catalog: Catalog, profile: DataFrame, rels: DataFrame | None = None, group_limit: int | None = None) -> DataFrame:
    """``kind, table, question, sql`` from column profiles and relationships.

    Columns are joined to templates on their type family; a column with repeated values also gets a grouping
    query (with ``group_limit``, only one of at most so many values), a relationship a query over its two tables, and two in a row one over three.  Columns
    without values get none.
    """
    spark = catalog.spark
    family = F.create_map(*[F.lit(x) for kv in FAMILIES.items() for x in kv])
    cols = (catalog.columns_df.select("table", F.col("name").alias("column"),
                                      F.element_at(family, F.substring_index("type", "(", 1)).alias("family"))
            .join(profile, ["table", "column"]).where("n_nonnull > 0 AND family IS NOT NULL"))
    t, c = F.col("table"), F.col("column")
    templates = local_frame(spark, ONE_COLUMN, "fn string, fam string, q string, s string")
    either = cols.select("*", F.explode(F.array(F.lit("any"), F.col("family"))).alias("fam"))
    parts = [either.join(templates, "fam").select(F.lit("column").alias("kind"), "table", _fill(F.col("q"), t=t, c=c).alias("question"),
                                                  _fill(F.col("s"), t=t, c=c).alias("sql")),
             cols.where((F.lit(True) if group_limit is None else F.col("n_distinct") <= group_limit) & (F.col("n_distinct") < F.col("n_rows"))).select(*_pair("group", FEW_VALUES, t=t, c=c))]
    if rels is not None:
        one = rels.select(F.col("child_table").alias("t"), F.col("child_col").alias("c"), F.col("parent_table").alias("p"), F.col("parent_col").alias("k"))
        two = rels.select(F.col("child_table").alias("p"), F.col("child_col").alias("d"), F.col("parent_table").alias("q"), F.col("parent_col").alias("l"))
        name = lambda names: {n: F.col(n) for n in names}
        parts.append(one.select(*_pair("join", JOIN, **name("tcpk"))))
        parts.append(one.join(two, "p").where("t <> q").select(*_pair("chain", CHAIN, **name("tcpkdql"))))
    return union_all(parts)


def schema_doc_pairs(catalog: Catalog, profile: DataFrame) -> DataFrame:
    """Factual question/answer pairs about tables, columns, keys and declared foreign keys."""
    def pairs(df, name, **cols):
        question, answer = DOCS[name]
        return df.select("table", say(question, **cols).alias("question"), say(answer, **cols).alias("answer"))

    t, c = F.col("table"), F.col("name")
    sizes = profile.groupBy("table").agg(F.count(F.lit(1)).alias("n_cols"))
    tables = sizes.join(catalog.tables_df.select("table", "primary_key"), "table")
    cols = catalog.columns_df.join(profile.select("table", F.col("column").alias("name"), "n_nonnull", "n_rows"), ["table", "name"])
    refs = catalog.fks_df.select("table", F.explode(F.arrays_zip("constrained", "referred")).alias("e"), "referred_table")
    return union_all([
        pairs(tables, "size", t=t, n=F.col("n_cols")),
        pairs(tables.where(F.col("primary_key").isNotNull()), "key", t=t, k=F.col("primary_key")),
        pairs(cols, "type", t=t, c=c, ty=F.col("type")),
        pairs(cols.where("n_rows > 0 AND n_nonnull = n_rows"), "filled", t=t, c=c),
        pairs(refs, "refers", t=t, c=F.col("e.constrained"), p=F.col("referred_table"), k=F.col("e.referred")),
    ])
