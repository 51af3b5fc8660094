"""Sharding by a k-d tree over metadata, leaves of equal bytes.

A node is split at the weighted median of its widest dimension, all nodes of a level at once.  The median is found by
histograms that grow finer only where it lies; nodes, searches and cuts are small tables joined with the rows, so a plan
does not grow with the shards, and what reaches the driver is a bin for each node and round.
Rows with the median's value are told apart by the hash of their text and then by their place in the input, so a group of
copies, however large, is cut where the bytes ask for it and otherwise stays together.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..sources.catalog import local_frame
from .common import cut, text_or_empty

BINS = 1024
FINE = 10_000
# nodes that are sent to all tasks, at most (under 100 bytes each), the levels after which rows are written, and the values told apart
MOST_SENT = 100_000
LEVELS = 5
WIDEST = 1 << 61


@dataclass
class Search:
    """Where a node's median is known to lie: the values of the keys before, the range of the current one, the bytes below."""
    node: int
    dimension: int
    target: float
    lo: int
    hi: int
    before: list[int] = field(default_factory=list)
    below: int = 0

    def row(self) -> tuple:
        step = max(1, -(-(self.hi - self.lo + 1) // BINS))
        return (self.node, self.dimension, len(self.before), *(self.before + [0, 0])[:2], self.lo, self.hi, step, self.below, self.target)


SEARCHED = "node bigint, dim int, stage int, b0 bigint, b1 bigint, lo bigint, hi bigint, step bigint, below bigint, target double"
# rows not above (value, hash, row) of the dimension go left; the last ones may be missing
CUT = "node bigint, dim int, v0 bigint, v1 bigint, v2 bigint"


def table(rows: DataFrame, of: list[tuple], shape: str) -> DataFrame:
    """A row for each node, to be joined; sent to all tasks while the nodes are few, else the join shuffles."""
    found = local_frame(rows.sparkSession, of, shape)
    return F.broadcast(found) if len(of) <= MOST_SENT else found


def cuts(rows: DataFrame, names: list[str], searches: list[Search], fine: float) -> list[tuple]:
    """The weighted median of each node as a row of `CUT`."""
    done = []
    value = F.get(F.array(*names), F.col("dim"))
    key = F.when(F.col("stage") == 0, value).when(F.col("stage") == 1, F.col("h")).otherwise(F.col("rid"))
    same = ((F.col("stage") == 0) | (value == F.col("b0"))) & ((F.col("stage") < 2) | (F.col("h") == F.col("b1")))
    while searches:
        at = table(rows, [s.row() for s in searches], SEARCHED)
        bins = rows.join(at, "node").where(same & key.between(F.col("lo"), F.col("hi"))) \
            .select("node", "below", "target", key.alias("key"), F.expr("(key - lo) div step").alias("b"), "size") \
            .groupBy("node", "below", "target", "b").agg(F.sum("size").alias("w"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        # the first bin that reaches the target, else the last one
        upto = F.col("below") + F.sum("w").over(W.partitionBy("node").orderBy("b"))
        bin_ = F.struct((F.col("upto") - F.col("w")).alias("below"), "w", "lo", "hi")
        found = bins.withColumn("upto", upto).groupBy("node").agg(
            F.coalesce(F.min_by(F.when(F.col("upto") >= F.col("target"), bin_), F.when(F.col("upto") >= F.col("target"), F.col("b"))), F.max_by(bin_, "b")).alias("at"))
        at = {r.node: r["at"] for r in found.collect()}
        following = []
        for s in searches:
            if s.node not in at:
                done.append((s, [*s.before, s.hi]))
                continue
            r = at[s.node]
            left = s.target - r.below < r.below + r.w - s.target
            if r.w <= fine or r.lo == r.hi and len(s.before) == 2:
                # the whole bin is small, or one row: take it or leave it, whichever is closer
                done.append((s, [*s.before, r.lo - 1 if left else r.hi]))
            elif r.lo == r.hi:
                following.append(Search(s.node, s.dimension, s.target, 0, (1 << 63) - 1 if s.before else (1 << 62) - 1, [*s.before, r.lo], r.below))
            else:
                following.append(Search(s.node, s.dimension, s.target, r.lo, r.hi, s.before, r.below))
        searches = following
    return [(s.node, s.dimension, *(v + [None, None])[:3]) for s, v in done]


def deal(rows: DataFrame, names: list[str], where: list[tuple]) -> DataFrame:
    """Rows of the nodes that are cut go to the node on their side; the others stay."""
    value = F.get(F.array(*names), F.col("dim"))
    last = F.when(F.col("v2").isNull(), F.lit(True)).otherwise(F.col("rid") <= F.col("v2"))
    left = (value < F.col("v0")) | ((value == F.col("v0")) & (F.col("v1").isNull() | (F.col("h") < F.col("v1")) | ((F.col("h") == F.col("v1")) & last)))
    node = F.when(F.col("dim").isNull(), F.col("node")).otherwise(2 * F.col("node") + F.when(left, 1).otherwise(2))
    return rows.join(table(rows, where, CUT), "node", "left").withColumn("node", node).drop("dim", "v0", "v1", "v2")


def assign(docs: DataFrame, dimensions: dict[str, Column], shards: int | None = None, target_bytes: int | None = None, text: str = "text",
           keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Columns `keep` with size, text_crc32, shard and slot of every row.

    `dimensions` are whole numbers of each row; null counts as 0, values beyond 2^61 as that.  Give the number of shards, or the bytes a
    shard should have.  Sizes are UTF-8 bytes of the text and 1 more, a null text has none.  The bytes of two shards differ by
    about the largest row, or a ten-thousandth of a shard if that is more.  Repeated rows are dealt like any others.  `slot`
    numbers a shard's rows from 0.  An empty table gives an empty result.
    """
    names = {f"x{k}": c for k, c in enumerate(dimensions.values())}
    t = text_or_empty(docs[text])
    rows = docs.select(
        F.struct(*(docs[k] for k in keep)).alias("row"), (F.octet_length(t) + 1).cast("long").alias("size"), F.crc32(t.cast("binary")).alias("crc"),
        F.shiftrightunsigned(F.xxhash64(t), 2).alias("h"), F.monotonically_increasing_id().alias("rid"),
        *(F.greatest(F.least(F.coalesce(c.cast("long"), F.lit(0)), F.lit(WIDEST)), F.lit(-WIDEST)).alias(n) for n, c in names.items()))
    rows = cut(rows, "rows")
    total = rows.agg(F.sum("size")).first()[0] or 0
    n = shards or max(1, math.ceil(total / target_bytes))
    fine = total / n / FINE
    whole = rows.agg(*(f(c).alias(f"{f.__name__}_{c}") for c in names for f in (F.min, F.max))).first()
    spread = {c: max(1, (whole[f"max_{c}"] or 0) - (whole[f"min_{c}"] or 0)) for c in names}
    leaves, level = {0: (0, n)}, 0
    placed = rows.withColumn("node", F.lit(0).cast("long"))
    while any(size > 1 for _, size in leaves.values()):
        if level and level % LEVELS == 0:
            placed = cut(placed, "level")
        level += 1
        ends = {r["node"]: r for r in placed.groupBy("node").agg(
            F.sum("size").alias("w"), *(f(c).alias(f"{f.__name__}_{c}") for c in names for f in (F.min, F.max))).collect()}
        searches, following = [], {}
        for k, (first, size) in leaves.items():
            if size == 1:
                following[k] = (first, 1)
                continue
            following[2 * k + 1], following[2 * k + 2] = (first, size // 2), (first + size // 2, size - size // 2)
            if k in ends:
                r = ends[k]
                widest = max(names, key=lambda c: (r[f"max_{c}"] - r[f"min_{c}"]) / spread[c])
                searches.append(Search(k, [*names].index(widest), r.w * (size // 2) / size, r[f"min_{widest}"], r[f"max_{widest}"]))
        if searches:
            placed = deal(placed, [*names], cuts(placed, [*names], searches, fine))
        leaves = following
    shard = table(rows, [(k, first) for k, (first, _) in leaves.items()], "node bigint, shard int")
    dealt = cut(placed.join(shard, "node").select("row", "size", "crc", "rid", "shard", F.shiftrightunsigned("rid", 33).alias("part")), "dealt")
    # a shard is numbered part by part, each part being what one task had read
    counts = dealt.groupBy("shard", "part").agg(F.count("*").alias("c"))
    offsets = counts.select("shard", "part", (F.sum("c").over(W.partitionBy("shard").orderBy("part")) - F.col("c")).alias("before"))
    place = F.row_number().over(W.partitionBy("shard", "part").orderBy("rid")) - 1
    return dealt.withColumn("place", place).join(offsets, ["shard", "part"]).select(
        "row.*", "size", F.col("crc").alias("text_crc32"), "shard", (F.col("before") + F.col("place")).cast("long").alias("slot"))


def report(docs: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document."""
    dimensions = {"size": F.octet_length(text_or_empty(docs["text"])), "source": F.crc32(docs["source"].cast("string")), "lang": F.crc32(docs["lang"].cast("string"))}
    return assign(docs, dimensions, shards).select(
        F.col("doc_id").cast("long").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
