"""Catalogs: named DataFrames with their table, column and key metadata."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.hashing import digest

ARROW = {"int": pa.int32(), "long": pa.int64(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(),
         "string": pa.string(), "array<string>": pa.list_(pa.string())}

TABLES = "ordinal int, table string, primary_key string, comment string"
COLUMNS = "table string, ordinal int, name string, type string, comment string"
FKS = "table string, pos int, constrained array<string>, referred_table string, referred array<string>"


def local_frame(spark: SparkSession, rows: list[tuple], shape: str) -> DataFrame:
    """Metadata rows as a DataFrame whose size the optimizer knows; other than rows of Python objects, it needs no Python on the executors."""
    fields = [part.strip().split(" ") for part in shape.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return spark.createDataFrame(pa.table({n: pa.array(list(c), ARROW[t]) for (n, t), c in zip(fields, columns)}))

# Type names as a PostgreSQL inspector prints them, by Spark type.
TYPE_NAMES = {
    "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "tinyint": "SMALLINT",
    "double": "DOUBLE PRECISION", "float": "REAL", "string": "TEXT", "date": "DATE",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "binary": "BYTEA",
}


def type_name(spark_type: str) -> str:
    if spark_type.startswith("decimal"):
        return "NUMERIC" + spark_type[len("decimal"):]
    if spark_type.startswith("array<"):
        return type_name(spark_type[6:-1]) + "[]"
    return TYPE_NAMES.get(spark_type, spark_type.upper())


@dataclass
class Catalog:
    """Tables in order.  ``keys`` maps a table to its key column; ``fks`` lists declared keys as
    ``(table, [columns], referred table, [referred columns])``; ``types`` overrides the printed
    type of a column, so that a UUID kept in a string stays distinct from text; ``sizes`` holds row
    counts found on the way."""

    spark: SparkSession
    frames: dict[str, DataFrame]
    keys: dict[str, str] = field(default_factory=dict)
    fks: list[tuple] = field(default_factory=list)
    comments: dict = field(default_factory=dict)
    types: dict = field(default_factory=dict)
    sizes: dict[str, int] = field(default_factory=dict)

    @property
    def names(self) -> list[str]:
        return list(self.frames)

    def column_rows(self) -> list[tuple]:
        return [(t, i, f.name, self.types.get((t, f.name), type_name(f.dataType.simpleString())),
                 self.comments.get((t, f.name)) or f.metadata.get("comment"))
                for t, df in self.frames.items() for i, f in enumerate(df.schema.fields)]

    @property
    def tables_df(self) -> DataFrame:
        rows = [(i, t, self.keys.get(t), self.comments.get(t)) for i, t in enumerate(self.frames)]
        return local_frame(self.spark, rows, TABLES)

    @property
    def columns_df(self) -> DataFrame:
        return local_frame(self.spark, self.column_rows(), COLUMNS)

    @property
    def fks_df(self) -> DataFrame:
        rows = [(t, i, list(c), r, list(k)) for i, (t, c, r, k) in enumerate(self.fks)]
        return local_frame(self.spark, rows, FKS)

    def with_keys(self, keys: dict[str, str], sizes: dict[str, int] | None = None) -> "Catalog":
        return Catalog(self.spark, self.frames, keys, self.fks, self.comments, self.types, self.sizes | (sizes or {}))

    def subset(self, names: list[str]) -> "Catalog":
        frames = {t: self.frames[t] for t in names if t in self.frames}
        return Catalog(self.spark, frames, {t: k for t, k in self.keys.items() if t in frames},
                       [f for f in self.fks if f[0] in frames], self.comments, self.types,
                       {t: n for t, n in self.sizes.items() if t in frames})


def load_catalog(spark: SparkSession, sources, keys=None, fks=None, comments=None, types=None) -> Catalog:
    """Catalog over named DataFrames, parquet paths or the tables of a Spark database.

    ``sources`` is a dict of name to DataFrame or path, or the name of a database.  Of a composite
    key only the first column is kept.
    """
    comments = dict(comments or {})
    if isinstance(sources, str):
        found = [t for t in spark.catalog.listTables(sources) if not t.isTemporary]
        frames = {t.name: spark.table(f"`{sources}`.`{t.name}`") for t in found}
        comments = {t.name: t.description for t in found} | comments
    else:
        frames = {n: s if isinstance(s, DataFrame) else spark.read.parquet(s) for n, s in sources.items()}
    first = {t: (k if isinstance(k, str) else k[0]) for t, k in (keys or {}).items() if k}
    return Catalog(spark, frames, first, list(fks or []), comments, dict(types or {}))


def declared_keys(constraints: DataFrame, usage: DataFrame, references: DataFrame) -> tuple[dict, list]:
    """Keys and foreign keys from the views of an information schema, for ``load_catalog``.

    A constraint's name need only be unique within its table, so ``references`` should name the table too; without that,
    foreign keys of one name in several tables are mixed up.  Only metadata comes to the driver: one row per constraint.
    """
    own = [c for c in ("table_name", "constraint_name") if c in constraints.columns]
    cols = usage.join(constraints.select(*own, "constraint_type").distinct(), own)
    named = [c for c in ("table_name", "constraint_name") if c in references.columns]
    keys = cols.where("constraint_type = 'PRIMARY KEY' AND ordinal_position = 1").select("table_name", "column_name").collect()
    target = usage.select(F.col("constraint_name").alias("unique_constraint_name"), F.col("table_name").alias("referred_table"),
                          F.col("column_name").alias("referred"), F.col("ordinal_position").alias("position_in_unique_constraint"))
    fks = (cols.where("constraint_type = 'FOREIGN KEY'").join(references.select(*named, "unique_constraint_name"), named)
           .join(target, ["unique_constraint_name", "position_in_unique_constraint"])
           .groupBy("table_name", "constraint_name", "referred_table")
           .agg(F.array_sort(F.collect_list(F.struct("ordinal_position", "column_name", "referred"))).alias("cols"))
           .orderBy("table_name", "constraint_name").collect())
    return ({r.table_name: r.column_name for r in keys},
            [(r.table_name, [c.column_name for c in r.cols], r.referred_table, [c.referred for c in r.cols]) for r in fks])


# which unique constraint each foreign key of a schema refers to, with its table
REFERENCES = """SELECT t.relname AS table_name, f.conname AS constraint_name, u.conname AS unique_constraint_name
FROM pg_constraint f JOIN pg_class t ON t.oid = f.conrelid JOIN pg_namespace n ON n.oid = t.relnamespace
JOIN pg_constraint u ON u.conindid = f.conindid AND u.conrelid = f.confrelid AND u.contype IN ('p', 'u')
WHERE f.contype = 'f' AND n.nspname = '{schema}'"""


# the comments of a schema's tables and columns; a table's own has no column name
COMMENTS = """SELECT t.relname AS table_name, a.attname AS column_name, d.description AS comment
FROM pg_description d JOIN pg_class t ON t.oid = d.objoid AND d.classoid = 'pg_class'::regclass JOIN pg_namespace n ON n.oid = t.relnamespace
LEFT JOIN pg_attribute a ON a.attrelid = t.oid AND a.attnum = d.objsubid AND d.objsubid > 0 WHERE n.nspname = '{schema}'"""

# Printed names of a database's types where they differ from the upper-case name.
PRINTED = {"character varying": "VARCHAR", "character": "CHAR", "timestamp without time zone": "TIMESTAMP", "timestamp with time zone": "TIMESTAMP",
           "time without time zone": "TIME", "time with time zone": "TIME", "bit varying": "BIT VARYING"}
# Elements of arrays, by the short names of their types.
ELEMENTS = {"int2": "SMALLINT", "int4": "INTEGER", "int8": "BIGINT", "float4": "REAL", "float8": "DOUBLE PRECISION", "bool": "BOOLEAN", "bpchar": "CHAR",
            "timestamptz": "TIMESTAMP", "timetz": "TIME"}


def printed_type(named: Column, element: Column, length: Column, precision: Column, scale: Column) -> Column:
    """A column's type as an inspector prints it, from the fields of an information schema's view of columns.

    Only text, bit strings and exact numbers show a size, and only if one was declared.
    """
    known = lambda names, c: F.coalesce(F.element_at(F.create_map(*[F.lit(x) for kv in names.items() for x in kv]), c), F.upper(c))
    low = F.lower(named)
    sized = F.when(low.isin("character varying", "character", "bit", "bit varying") & length.isNotNull(), F.concat(F.lit("("), length.cast("string"), F.lit(")"))) \
        .when((low == "numeric") & precision.isNotNull(), F.concat(F.lit("("), precision.cast("string"), F.lit(", "), F.coalesce(scale, F.lit(0)).cast("string"), F.lit(")"))) \
        .otherwise("")
    array = F.concat(known(ELEMENTS, F.ltrim(element, F.lit("_"))), F.lit("[]"))
    return F.when(low == "array", array).when(low == "user-defined", F.upper(element)).otherwise(F.concat(known(PRINTED, low), sized))


def described(columns: DataFrame, comments: DataFrame) -> tuple[dict, dict]:
    """Comments and printed types for ``load_catalog`` from the view of columns and a table of comments.

    ``columns`` has the fields of an information schema's view, ``comments`` has ``table_name, column_name, comment``; without a
    column name a comment is the table's.  Empty comments are none.  One row per column comes to the driver.
    """
    kinds = columns.select("table_name", "column_name", printed_type(
        F.col("data_type"), F.col("udt_name"), F.col("character_maximum_length"), F.col("numeric_precision"), F.col("numeric_scale")).alias("type")).collect()
    said = comments.where("comment <> ''").collect()
    return ({r.table_name if r.column_name is None else (r.table_name, r.column_name): r.comment for r in said},
            {(r.table_name, r.column_name): r.type for r in kinds})


def key_ranges(key: str, low: int | None, high: int | None, parts: int) -> list[str]:
    """Conditions that split a table by a whole-number key into up to ``parts`` reads; each row meets exactly one."""
    if low is None or high <= low or parts < 2:
        return []
    name, width = '"' + key.replace('"', '""') + '"', high - low + 1
    edges = sorted({low + width * k // parts for k in range(1, parts)} - {low})
    if not edges:
        return []
    between = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(edges, edges[1:])]
    return [f"{name} < {edges[0]} OR {name} IS NULL", *between, f"{name} >= {edges[-1]}"]


def load_jdbc_catalog(spark: SparkSession, url: str, schema: str = "public", properties=None, parts: int = 1, **meta) -> Catalog:
    """The catalog of a database's tables with declared keys, comments and printed types; filters and column choices reach the database.

    With ``parts`` a table whose key is a whole number is read in that many ranges of it.
    """
    props = properties or {}
    inner = schema.replace("'", "''")
    view = lambda name: spark.read.jdbc(url, f"information_schema.{name}", properties=props)
    text = lambda sql: spark.read.jdbc(url, f"({sql}) AS r", properties=props)
    tables = view("tables").where((F.col("table_schema") == schema) & (F.col("table_type") == "BASE TABLE"))
    names = [r.table_name for r in tables.select("table_name").orderBy("table_name").collect()]
    here = lambda name: view(name).where(F.col("constraint_schema") == schema)
    keys, fks = declared_keys(here("table_constraints"), here("key_column_usage"), text(REFERENCES.format(schema=inner)))
    comments, types = described(view("columns").where(F.col("table_schema") == schema), text(COMMENTS.format(schema=inner)))

    def frame(name):
        table, key = f'"{schema}"."{name}"', keys.get(name)
        if parts > 1 and types.get((name, key)) in ("SMALLINT", "INTEGER", "BIGINT"):
            ends = text(f'SELECT min("{key}") AS low, max("{key}") AS high FROM {table}').first()
            if split := key_ranges(key, ends.low, ends.high, parts):
                return spark.read.jdbc(url, table, predicates=split, properties=props)
        return spark.read.jdbc(url, table, properties=props)

    found = {"keys": keys, "fks": fks, "comments": comments, "types": types}
    return load_catalog(spark, {n: frame(n) for n in names}, **(found | meta))


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def row_counts(catalog: Catalog) -> DataFrame:
    """``table, n_rows``; tables of known size are not counted again."""
    if set(catalog.frames) <= set(catalog.sizes):
        return local_frame(catalog.spark, [(t, catalog.sizes[t]) for t in catalog.frames], "table string, n_rows long")
    return union_all([df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(t).alias("table"), "n_rows")
                      for t, df in catalog.frames.items()])


def describe(catalog: Catalog) -> DataFrame:
    """One row per column with its table's key and row count."""
    cols = catalog.columns_df.join(catalog.tables_df.select("table", "primary_key"), "table")
    return (cols.join(row_counts(catalog), "table")
            .withColumn("is_key", F.col("name").eqNullSafe(F.col("primary_key"))).drop("primary_key"))


def table_objects(catalog: Catalog) -> DataFrame:
    """One row per table: ``ordinal, table, info`` with info holding columns, key, comment and foreign keys."""
    cols = (catalog.columns_df.groupBy("table")
            .agg(F.array_sort(F.collect_list(F.struct("ordinal", "name", "type", "comment"))).alias("cs"))
            .select("table", F.map_from_entries(F.transform("cs", lambda c: F.struct(
                c["name"].alias("key"), F.struct(c["type"].alias("type"), c["comment"].alias("comment")).alias("value")
            ))).alias("columns")))
    fks = (catalog.fks_df.groupBy("table")
           .agg(F.array_sort(F.collect_list(F.struct("pos", "referred_table", "constrained", "referred"))).alias("fs"))
           .select("table", F.transform("fs", lambda f: F.struct(
               f["referred_table"].alias("referred_table"), f["constrained"].alias("constrained_columns"),
               f["referred"].alias("referred_columns"))).alias("foreign_keys")))
    none = F.array().cast("array<struct<referred_table:string,constrained_columns:array<string>,referred_columns:array<string>>>")
    return (catalog.tables_df.join(cols, "table").join(fks, "table", "left")
            .select("ordinal", "table", F.struct(
                "columns", "primary_key", "comment",
                F.coalesce("foreign_keys", none).alias("foreign_keys")).alias("info")))


def table_json(catalog: Catalog) -> DataFrame:
    """``ordinal, table, json``: each table as a quoted name and its object, nulls kept."""
    name = F.replace(F.replace("table", F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    body = F.to_json("info", {"ignoreNullFields": "false"})
    return table_objects(catalog).select("ordinal", "table", F.concat(F.lit('"'), name, F.lit('":'), body).alias("json"))


def schema_json(catalog: Catalog, names: list[str] | None = None) -> DataFrame:
    """One row, ``schema_json``: the whole schema as JSON, tables in catalog order."""
    texts = table_json(catalog if names is None else catalog.subset(names))
    ordered = F.array_sort(F.collect_list(F.struct("ordinal", "json")))
    return texts.agg(F.concat(F.lit('{"tables":{'), F.array_join(F.transform(ordered, lambda t: t["json"]), ","), F.lit("}}"))
                     .alias("schema_json"))


def members(texts: dict[str, str], names) -> Column:
    """The JSON members of the named tables, joined; tables without an entry are left out."""
    known = F.create_map(*[F.lit(x) for kv in (texts or {"": ""}).items() for x in kv])
    return F.array_join(F.transform(names, lambda t: known[t]), ",")


# Tasks that share the rows of one list of tables, at most.
SALTS = 32


def with_schema(rows: DataFrame, catalog: Catalog, tables: str = "tables", out: str = "schema") -> DataFrame:
    """Adds the schema JSON of the tables in an array column, in its order; unknown names are ignored.

    The text is built once for each different list and joined; the catalog's texts never enter the plan.
    """
    # Spark does not look through a generator: a list that is the same for all rows would leave the join without a key, and all
    # rows would go to the task that has the text; the rows of a list are dealt over SALTS tasks by what else they hold
    hashed = [F.col(f"`{f.name}`") for f in rows.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    salt = F.pmod(F.xxhash64(*hashed), F.lit(SALTS)).cast("int")
    keyed = rows.select("*", salt.alias("_salt"), F.explode(F.array(tables)).alias("_key"))
    lists = keyed.select(F.col("_key").alias("_list")).distinct()
    texts = (lists.select("_list", F.posexplode("_list").alias("_at", "table")).join(table_json(catalog).select("table", "json"), "table")
             .groupBy("_list").agg(F.array_sort(F.collect_list(F.struct("_at", "json"))).alias("_parts"))
             .select("_list", F.array_join(F.col("_parts.json"), ",").alias("_members"), F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_of")))
    joined = keyed.join(texts, (F.col("_key") == F.col("_list")) & (F.col("_salt") == F.col("_of")), "left")
    return (joined.withColumn(out, F.concat(F.lit('{"tables":{'), F.coalesce("_members", F.lit("")), F.lit("}}")))
            .drop("_salt", "_key", "_list", "_members", "_of"))


def schema_markdown(catalog: Catalog) -> DataFrame:
    """One row per table: ``table, line`` with line ``- **t**: "c1", "c2"``."""
    return (catalog.columns_df.groupBy("table")
            .agg(F.array_sort(F.collect_list(F.struct("ordinal", "name"))).alias("cs"))
            .select("table", F.concat(F.lit("- **"), F.col("table"), F.lit("**: "), F.array_join(
                F.transform("cs", lambda c: F.concat(F.lit('"'), c["name"], F.lit('"'))), ", ")).alias("line")))


def sample_tables(catalog: Catalog, m: int, seed: int = 0) -> DataFrame:
    """Up to ``m`` tables in hash order of the seed: repeatable, unlike a random choice."""
    return (catalog.tables_df.orderBy(digest(seed, F.col("table")), "table").limit(m).select("table"))
