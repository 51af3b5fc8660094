"""Ranking functions for groups too large for one task.

A plain window sorts each group in one task.  Here rows are dealt by ranges of group and order together, so a group that
holds most rows lies in many ranges, whatever its values are; the range's number is written with the rows.  Only one row for
each group and range is ever ordered across a whole group.  Order is that of PostgreSQL, nulls last; null keys are a group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage

SPAN = 1_000_000


def ranged(df: DataFrame, key: list[str], order: list[str], span: int = SPAN) -> DataFrame:
    """``df`` with ``_key``, the key's columns as one value that is never null, and ``_part``, the number of the range.

    Ranges have about ``span`` rows.  Within a group a later range holds later rows.
    """
    whole = df.withColumn("_key", F.struct(*[F.col(c) for c in key]) if key else F.struct(F.lit(0)))
    parts = max(1, -(-df.count() // span))
    dealt = whole.repartitionByRange(parts, F.col("_key"), *[F.asc_nulls_last(c) for c in order])
    return cut_lineage(dealt.withColumn("_part", F.spark_partition_id()))


def starts(sizes: DataFrame, size: str, out: str) -> DataFrame:
    """``_key, _part, out``: the sum of ``size`` over the ranges of the group before each."""
    before = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select("_key", "_part", F.coalesce(F.sum(size).over(before), F.lit(0)).alias(out))


def inside(order: list[str], back: bool = False):
    """The rows of a group within a range, in order or from the end."""
    return Window.partitionBy("_key", "_part").orderBy(*[F.desc_nulls_first(c) if back else F.asc_nulls_last(c) for c in order])


def running_sum(df: DataFrame, key: list[str], order: list[str], value: str, out: str, span: int = SPAN) -> DataFrame:
    """Running sum of ``value`` per group; also adds ``_key`` and ``_part``."""
    cut = ranged(df, key, order, span)
    before = starts(cut.groupBy("_key", "_part").agg(F.sum(value).alias("_size")), "_size", "_start")
    local = F.sum(value).over(inside(order).rowsBetween(Window.unboundedPreceding, 0))
    return cut.join(before, ["_key", "_part"]).withColumn(out, F.col("_start") + local).drop("_start")


def row_number(df: DataFrame, key: list[str], leading: list[str], order: str, out: str, span: int = SPAN) -> DataFrame:
    cut, by = ranged(df, key, [*leading, order], span), [*leading, order]
    before = starts(cut.groupBy("_key", "_part").agg(F.count(F.lit(1)).alias("_size")), "_size", "_start")
    return (cut.join(before, ["_key", "_part"])
            .withColumn(out, F.col("_start") + F.row_number().over(inside(by))).drop("_start", "_key", "_part"))


def rank(df: DataFrame, key: list[str], by: list[str], out: str, span: int = SPAN) -> DataFrame:
    """Rank by the columns alone: rows with smaller values plus one, from counts per value."""
    whole = df.withColumn("_at", F.struct(F.struct(*[F.col(c) for c in key]) if key else F.struct(F.lit(0)), F.struct(*[F.col(c) for c in by])))
    counts = whole.groupBy(*dict.fromkeys([*key, *by]), "_at").agg(F.count(F.lit(1)).alias("_size"))
    summed = running_sum(counts, key, by, "_size", "_upto", span)
    ranks = summed.select(F.col("_at").alias("_value"), (F.col("_upto") - F.col("_size") + 1).alias("_rank"))
    return whole.join(ranks, F.col("_at") == F.col("_value")).withColumn(out, F.col("_rank")).drop("_at", "_value", "_rank")


def shift(df: DataFrame, key: list[str], leading: list[str], order: str, value: str, n: int, out: str,
          span: int = SPAN) -> DataFrame:
    """LAG for positive ``n``, LEAD for negative: inside the range, else from the nearest rows of its neighbours."""
    by = [*leading, order]
    cut = ranged(df, key, by, span)
    back, n = n > 0, abs(n)
    # the rows of each range that a neighbour may need, nearest first; every range of a group has at least one
    edge = (cut.withColumn("_at", F.row_number().over(inside(by, back))).where(F.col("_at") <= n)
            .groupBy("_key", "_part").agg(F.array_sort(F.collect_list(F.struct("_at", F.col(value).alias("_x")))).alias("_edge")))
    near = Window.partitionBy("_key").orderBy(F.desc("_part") if back else F.asc("_part")).rowsBetween(1, n)
    outside = edge.select("_key", "_part", F.slice(F.flatten(F.collect_list("_edge").over(near)), 1, n).alias("_near"))
    at = F.row_number().over(inside(by, not back))
    moved = (F.lag(value, n) if back else F.lead(value, n)).over(inside(by))
    placed = cut.join(outside, ["_key", "_part"]).withColumn("_at", at).withColumn("_moved", moved)
    return (placed.withColumn(out, F.when(F.col("_at") > n, F.col("_moved"))
                              .otherwise(F.get(F.col("_near"), F.lit(n) - F.col("_at"))["_x"]))
            .drop("_near", "_at", "_moved", "_key", "_part"))
