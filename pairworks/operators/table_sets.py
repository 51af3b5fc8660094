"""Sets of tables that can be joined."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..sources.catalog import Catalog, union_all


def parse_table_sets(replies: DataFrame, names: list[str], min_joins: int = 2, n: int = 10,
                     text: str = "text", keep: tuple = ("task_id",)) -> DataFrame:
    """``keep, pos, tables`` from one JSON list or ``{"tables": [...]}`` per line.

    Unknown names are dropped, sets below ``min_joins`` tables too; the first ``n`` sets of a reply
    count, and a reply without any gives one set of all tables.
    """
    known = F.array(*[F.lit(t) for t in names])
    values = tx.json_values(F.transform(tx.lines(F.col(text)), tx.strip_bullet))
    lists = F.transform(values, lambda v: F.coalesce(F.try_variant_get(v, "$.tables", "array<variant>"),
                                                     F.try_variant_get(v, "$", "array<variant>")))
    tables = F.transform(F.filter(lists, lambda l: l.isNotNull()),
                         lambda l: F.filter(F.transform(l, lambda x: F.try_variant_get(x, "$", "string")),
                                            lambda t: F.array_contains(known, t)))
    good = F.slice(F.filter(tables, lambda t: F.size(t) >= min_joins), 1, n)
    read = replies.select(*keep, good.alias("sets"))
    return read.select(*keep, F.posexplode(F.when(F.size("sets") > 0, F.col("sets")).otherwise(F.array(known)))
                       .alias("pos", "tables"))


def joinable_sets(rels: DataFrame, size: int = 3, min_joins: int = 2, n: int | None = None) -> DataFrame:
    """Connected sets of ``min_joins`` to ``size`` tables over the relationships: ``tables, n_tables``.

    Each set is made once: it grows from its first table by neighbours that come later, and a neighbour once passed over is not
    taken again below that choice.  So no step compares the sets.  ``n`` keeps the best ones: those whose weakest table is tied
    to another one with the highest ``confidence``, then the larger, then by name.
    """
    sure = F.col("confidence") if "confidence" in rels.columns else F.lit(1.0)
    one = rels.select(F.col("child_table").alias("a"), F.col("parent_table").alias("b"), sure.alias("confidence"))
    edges = (one.unionByName(one.select(F.col("b").alias("a"), F.col("a").alias("b"), "confidence"))
             .where("a <> b").groupBy("a", "b").agg(F.max("confidence").alias("confidence")))
    near = edges.groupBy("a").agg(F.array_sort(F.collect_list("b")).alias("near"))
    later = lambda names: F.filter(names, lambda b: b > F.col("first"))
    # a set with what may still join it, and all that is in it or beside it
    grown = (near.withColumn("first", F.col("a"))
             .select("first", F.array("a").alias("tables"), later(F.col("near")).alias("open"), F.array_append("near", F.col("a")).alias("beside")))
    steps = []
    for _ in range(size - 1):
        grown = (grown.select("*", F.posexplode("open").alias("at", "a")).join(near, "a")
                 .select("first", F.array_append("tables", F.col("a")).alias("tables"),
                         F.concat(F.slice("open", F.col("at") + 2, F.size("open")), F.array_except(later(F.col("near")), F.col("beside"))).alias("open"),
                         F.array_union("beside", "near").alias("beside")))
        steps.append(grown.select(F.array_sort("tables").alias("tables")))
    sets = union_all(steps).withColumn("n_tables", F.size("tables")).where(F.col("n_tables") >= min_joins)
    if n is None:
        return sets
    ties = (sets.select("tables", "n_tables", F.explode("tables").alias("a")).join(edges, "a").where(F.array_contains("tables", F.col("b")))
            .groupBy("tables", "n_tables", "a").agg(F.max("confidence").alias("tie")))
    weakest = ties.groupBy("tables", "n_tables").agg(F.min("tie").alias("confidence"))
    return weakest.orderBy(F.desc("confidence"), F.desc("n_tables"), "tables").limit(n)


def table_slices(catalog: Catalog, workers: int | None = None) -> DataFrame:
    """One table per worker, in catalog order: ``worker, table``; all tables unless a number is given."""
    tables = catalog.tables_df.select(F.col("ordinal").alias("worker"), "table")
    return tables if workers is None else tables.where(F.col("worker") < workers)
