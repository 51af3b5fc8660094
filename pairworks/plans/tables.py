"""The driver tables, their catalog, and the registry of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from ..sources.catalog import Catalog, load_catalog

# Columns of the driver tables with the types a catalog prints for them.
SCHEMA = {
    "region": "r_regionkey INTEGER, r_name TEXT",
    "nation": "n_nationkey INTEGER, n_name TEXT, n_regionkey INTEGER",
    "customer": "c_custkey BIGINT, c_name TEXT, c_nationkey INTEGER, c_acctbal DOUBLE PRECISION, c_mktsegment TEXT",
    "supplier": "s_suppkey BIGINT, s_name TEXT, s_nationkey INTEGER, s_acctbal DOUBLE PRECISION",
    "part": "p_partkey BIGINT, p_name TEXT, p_brand TEXT, p_type TEXT, p_size INTEGER, p_retailprice DOUBLE PRECISION",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus TEXT, o_totalprice DOUBLE PRECISION, o_orderdate TIMESTAMP, "
              "o_orderpriority TEXT",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INTEGER, l_quantity DOUBLE PRECISION, "
                "l_extendedprice DOUBLE PRECISION, l_discount DOUBLE PRECISION, l_tax DOUBLE PRECISION, l_returnflag TEXT, "
                "l_linestatus TEXT, l_shipdate TIMESTAMP",
    "events": "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type TEXT, value DOUBLE PRECISION, props TEXT",
    "documents": "doc_id BIGINT, text TEXT, lang TEXT, source TEXT, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding REAL[], label INTEGER",
    "pages": "page_id BIGINT, url TEXT, html TEXT",
    "benchmark": "item_id BIGINT, text TEXT",
    "labels": "doc_id BIGINT, quality INTEGER, toxic INTEGER",
    "conversations": "conv_id BIGINT, turn BIGINT, role TEXT, text TEXT",
}
COLUMNS = {t: [tuple(c.split(" ", 1)) for c in cols.split(", ")] for t, cols in SCHEMA.items()}
NAMES = list(SCHEMA)

# Foreign keys as a user would declare them for these tables.
FOREIGN_KEYS = [
    ("nation", ["n_regionkey"], "region", ["r_regionkey"]),
    ("customer", ["c_nationkey"], "nation", ["n_nationkey"]),
    ("supplier", ["s_nationkey"], "nation", ["n_nationkey"]),
    ("orders", ["o_custkey"], "customer", ["c_custkey"]),
    ("lineitem", ["l_orderkey"], "orders", ["o_orderkey"]),
    ("lineitem", ["l_partkey"], "part", ["p_partkey"]),
    ("lineitem", ["l_suppkey"], "supplier", ["s_suppkey"]),
    ("labels", ["doc_id"], "documents", ["doc_id"]),
]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {n: table(spark, sf_dir, n) for n in NAMES}


def catalog(spark: SparkSession, sf_dir: str, fks: bool = False) -> Catalog:
    return load_catalog(spark, tables(spark, sf_dir), fks=FOREIGN_KEYS if fks else None)


def query(name: str, oracle: str | None = None):
    """Register a function of ``(spark, sf_dir)`` and, where SQL can say the same, its check."""
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return add


def feed(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """Run feed SQL, which names tables in braces, over the driver tables."""
    used = {n: table(spark, sf_dir, n) for n in NAMES if "{" + n + "}" in sql}
    return spark.sql(sql, **used)


def check_sql(sql: str) -> str:
    """The same feed for the checking engine."""
    return sql.format(**{n: n for n in NAMES})
