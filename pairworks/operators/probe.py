"""Trial runs of generated SQL."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_sql
from ..session import scratch_path
from ..sources.catalog import Catalog, local_frame
from .lint import unknown_tables

STATUS = "sql string, ok boolean, error string"


def probe_one(spark: SparkSession, sql: str, n: int = 5) -> tuple[str, bool, str | None]:
    """Run one query for ``n`` full rows.

    The query always runs as a sub-query, so that statements other than queries are syntax errors and
    never executed; all columns are read, for a pruned column would hide its run-time error.
    """
    try:
        spark.sql(f"SELECT * FROM ({sql}) AS _q LIMIT {int(n)}").collect()
        return sql, True, None
    except Exception as err:  # any failure marks the pair
        return sql, False, str(err)


def probe_queries(spark: SparkSession, pairs: DataFrame, n: int = 5, threads: int = 8, batch: int = 1000,
                  catalog: Catalog | None = None) -> DataFrame:
    """Adds ``ok`` and ``error`` to pairs by running each distinct SQL once as a Spark query.

    Texts come to the driver one partition at a time and their states are written batch by batch to the
    shared folder.  With a catalog, SQL that names unknown tables fails without a run.
    """
    cleaned = pairs.withColumn("sql", clean_sql(F.col("sql")))
    distinct = cleaned.select("sql").where("sql <> ''").distinct()
    if catalog is not None:
        distinct = distinct.where(F.size(unknown_tables(F.col("sql"), catalog.names)) == 0)
    path = scratch_path(spark, "probe")
    local_frame(spark, [], STATUS).write.mode("append").parquet(path)
    texts = (r.sql for r in distinct.toLocalIterator())
    with ThreadPoolExecutor(threads) as pool:
        while chunk := list(islice(texts, batch)):
            states = list(pool.map(lambda s: probe_one(spark, s, n), chunk))
            local_frame(spark, states, STATUS).write.mode("append").parquet(path)
    states = spark.read.schema(STATUS).parquet(path)
    return (cleaned.join(states, "sql", "left")
            .withColumn("error", F.when(F.col("ok").isNull(), "not run").otherwise(F.col("error")))
            .withColumn("ok", F.coalesce("ok", F.lit(False))))
