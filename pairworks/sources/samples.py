"""Sample rows of tables and masked fetches."""

from __future__ import annotations

import logging

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .catalog import Catalog, local_frame
from .jsonl import write_version
from ..operators.mask import mask

log = logging.getLogger(__name__)


def sample_rows(df: DataFrame, n: int = 5, order_by=None) -> DataFrame:
    """``n`` rows: any when no order is given, which stops reading early; else the first by that order.

    For a single key column the ``n`` smallest keys are found first, from that column alone, and then
    looked up, so the other columns are read only where the keys are.
    """
    if order_by is None:
        return df.limit(n)
    if not isinstance(order_by, str):
        return df.orderBy(*order_by).limit(n)
    least = [r[0] for r in df.select(order_by).where(F.col(order_by).isNotNull()).orderBy(order_by).limit(n).collect()]
    # rows without a key come last, so they are looked for where the keys are too few
    wanted = F.col(order_by).isin(least) if len(least) == n else F.col(order_by).isin(least) | F.col(order_by).isNull()
    return df.where(wanted).orderBy(F.asc_nulls_last(order_by)).limit(n)


def _texts(catalog: Catalog, n: int, change) -> DataFrame:
    """``table, row`` (JSON) of the first ``n`` rows of each table; the few rows are read now, so that a table that cannot be
    read is left out and not an error of all."""
    found = []
    for name, df in catalog.frames.items():
        try:
            top = change(sample_rows(df, n, catalog.keys.get(name)))
            found += [(name, r.row) for r in top.select(F.to_json(F.struct(*top.columns), {"ignoreNullFields": "false"}).alias("row")).collect()]
        except PySparkException as err:
            log.warning("no sample of %s: %s", name, err)
    return local_frame(catalog.spark, found, "table string, row string")


def sample_all(catalog: Catalog, n: int = 2) -> DataFrame:
    """``table, row`` (JSON) for the first ``n`` rows of every table; tables that cannot be read are skipped."""
    return _texts(catalog, n, lambda df: df)


def masked_samples(catalog: Catalog, n: int = 2, **rules) -> DataFrame:
    """As ``sample_all`` with every value masked."""
    return _texts(catalog, n, lambda df: mask(df, **rules))


def export_samples(catalog: Catalog, root: str, run_version: str, n: int = 2, **rules) -> str:
    """Write the masked samples of every table as one dataset version; returns its path."""
    return write_version(masked_samples(catalog, n, **rules), root, "sample_data", run_version)


def fetch(spark: SparkSession, sql: str, n: int = 5, **rules) -> DataFrame:
    """At most ``n`` masked rows of a query; of columns with one name the last is kept."""
    df = spark.sql(sql).limit(n)
    last = {name: i for i, name in enumerate(df.columns)}
    if len(last) < len(df.columns):
        numbered = df.toDF(*[f"c{i}" for i in range(len(df.columns))])
        df = numbered.select(*[F.col(f"c{i}").alias(name) for name, i in last.items()])
    return mask(df, **rules)
