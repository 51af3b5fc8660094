"""Shards of equal bytes."""

import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from pairworks.llm import sharding

SCHEMA = "doc_id long, text string, lang string, source string, size int"


def shards(rows):
    total, slots = defaultdict(int), defaultdict(list)
    for r in rows:
        total[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return total


def test_equal_bytes_with_a_large_group_of_copies(spark):
    rows = [(1, "same " * 100, "en", "a", 1)] * 500 + [(i, "é" * i, None, "b", 1) for i in range(100)] + [(None, None, None, None, None)] * 20
    got = sharding.report(spark.createDataFrame(rows, SCHEMA).repartition(4)).collect()
    total = shards(got)
    assert set(total) == set(range(8)) and max(total.values()) - min(total.values()) <= 2 * 501
    assert sorted((r.doc_id, r.size, r.text_crc32) for r in got if r.doc_id) == sorted(
        (r[0], len(r[1].encode()) + 1, zlib.crc32(r[1].encode())) for r in rows if r[0])
    assert {(r.size, r.text_crc32) for r in got if r.doc_id is None} == {(1, 0)}


def test_target_bytes_and_small_tables(spark):
    docs = spark.createDataFrame([(i, "x" * 99, "l", "s", 0) for i in range(100)], SCHEMA)
    got = sharding.assign(docs, {"id": F.col("doc_id")}, target_bytes=2500, keep=("doc_id", "lang"))
    assert got.columns == ["doc_id", "lang", "size", "text_crc32", "shard", "slot"]
    assert sorted(shards(got.collect()).values()) == [2500] * 4
    # one dimension: shards are ranges of it
    assert [r.d for r in got.groupBy("shard").agg((F.max("doc_id") - F.min("doc_id")).alias("d")).collect()] == [24] * 4
    assert len(sharding.report(docs.limit(3)).collect()) == 3 and sharding.report(docs.limit(0)).collect() == []


def test_many_shards(spark):
    docs = spark.createDataFrame([(i, "x" * (50 + i % 90), "l", str(i % 13), 0) for i in range(6000)] + [(i, "same " * 20, None, "hot", 0) for i in range(3000)], SCHEMA)
    dimensions = {"source": F.crc32("source"), "id": F.col("doc_id") * F.lit(1 << 50)}
    total = shards(sharding.assign(docs, dimensions, 300).collect())
    assert set(total) == set(range(300)) and max(total.values()) - min(total.values()) <= 4 * 141


def test_nodes_are_made_without_python_on_executors(spark, capsys):
    made = sharding.table(spark.range(1), [(0, 1, 2.5, None), (3, 4, 5, 1 << 61)], "node bigint, dim int, target double, v2 bigint")
    assert [tuple(r) for r in made.orderBy("node").collect()] == [(0, 1, 2.5, None), (3, 4, 5.0, 1 << 61)]
    made.explain()
    said = capsys.readouterr().out
    assert "LocalTableScan" in said and "ExistingRDD" not in said
