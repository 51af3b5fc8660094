"""Ranked search for the best documents of each query by the Best Position Algorithm.

Documents are dealt to shards; a shard holds one list for each query term, its documents by falling impact (what the term adds
to their score).  For a query the lists of its terms are read from the top.  Each new document is looked up in all lists at once
(direct access), which gives its score and its position in every list.  The best position of a list is the last one of the
unbroken run of seen positions from its top.  It reaches at least as far as the list has been read, and further where direct
accesses have seen what comes next, so the impacts at the best positions add up to a lower bar than those read last.  A document
not seen in any list scores at most that much.  Reading stops when that is strictly below the kth best score (a tie may go to a
smaller id).  The kth best carries over from shard to shard of a task.

Document frequencies, the number of documents and their length come from a pass over the whole table.  Queries are taken in blocks
of at most `BLOCK_BYTES` of text, each sent to all tasks; what comes back is `k` rows for each query and task.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Tokens, own, slices, text_or_empty, texts_of, tidied

TERMS = frozenset([*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)])
OTHERS = bytes(sorted(set(range(256)) - TERMS))
K = 10
SHARD_BYTES = 16 << 20
BLOCK_BYTES = 16 << 20
FIRST_READ = 16
SALTS = 64
# Fixed values of the score: the scale of an impact, the saturation of repeats and the share of the length in it.
SCALE, REPEATS, SATURATION, FLAT, LENGTH = 1_000_000_000, 1000, 8, 10, 90

STATS = "term int, n bigint"
FOUND = "query int, doc_id bigint, score bigint"


class Shard:
    """The terms of some documents that a vocabulary (sorted names) has: for each document and term, how often."""

    def __init__(self, batch: pa.RecordBatch, vocabulary: np.ndarray):
        texts = texts_of(batch)
        data = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        starts, _, names = Tokens(OTHERS, lower=True).of(data)
        doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), starts, side="right")
        self.lengths = np.bincount(doc, minlength=len(texts))
        at = np.minimum(np.searchsorted(vocabulary, names), max(len(vocabulary) - 1, 0))
        hit = vocabulary[at] == names if len(vocabulary) else np.zeros(len(names), dtype=bool)
        self.size = np.int64(max(len(vocabulary), 1))
        keys, self.times = np.unique(doc[hit].astype(np.int64) * self.size + at[hit], return_counts=True)
        self.keys, self.doc, self.term = keys, keys // self.size, keys % self.size


class Lists:
    """A shard's impact lists, one behind the other, and where each document lies in each."""

    def __init__(self, shard: Shard, weights: np.ndarray, m: np.ndarray):
        self.keys, self.size, self.docs = shard.keys, shard.size, len(shard.lengths)
        tf = shard.times.astype(np.int64)
        self.impact_by_key = weights[shard.term] * ((SCALE * tf) // (REPEATS * tf + SATURATION * m[shard.doc]))
        order = np.lexsort((shard.doc, -self.impact_by_key, shard.term))
        self.doc, self.impact = shard.doc[order], self.impact_by_key[order]
        self.place_by_key = np.empty(len(order), dtype=np.int64)
        self.place_by_key[order] = np.arange(len(order))
        self.begin = np.searchsorted(shard.term[order], np.arange(self.size + 1))

    def direct(self, docs: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores of documents, and the places of all their entries in the lists of `terms`."""
        wanted = docs[:, None] * self.size + terms
        at = np.minimum(np.searchsorted(self.keys, wanted), max(len(self.keys) - 1, 0))
        there = self.keys[at] == wanted
        return np.where(there, self.impact_by_key[at], 0).sum(axis=1), self.place_by_key[at[there]]


class Best:
    """The k best documents of a query so far."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids = k, np.zeros(0, np.int64), np.zeros(0, np.int64)

    @property
    def kth(self) -> int:
        """The kth best score; 0 as long as there are fewer, for a document without a score is not wanted."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 0

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        good = scores >= max(self.kth, 1)
        scores, ids = np.concatenate([self.scores, scores[good]]), np.concatenate([self.ids, ids[good]])
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.ids = scores[order], ids[order]


def best_positions(lists: Lists, ids: np.ndarray, terms: np.ndarray, best: Best, accesses: dict | None = None) -> None:
    """Adds a shard's documents to the best ones of the query with these terms.

    `ids` are the documents' ids by their number in the shard.  `accesses` counts the entries read in order, for tests.
    """
    begin, end = lists.begin[terms], lists.begin[terms + 1]
    terms, begin, end = terms[end > begin], begin[end > begin], end[end > begin]
    seen_doc = np.zeros(lists.docs, dtype=bool)
    # what has been seen of each list, with a mark behind its end that never is
    seen = [np.zeros(z - a + 1, dtype=bool) for a, z in zip(begin.tolist(), end.tolist(), strict=True)]
    reach = np.zeros(len(terms), dtype=np.int64)
    read, step = 0, FIRST_READ
    while True:
        # the impact at the best position; before the first read the top of the list, behind its end nothing
        bar = sum(int(lists.impact[a + max(r - 1, 0)]) if r < z - a else 0
                  for a, z, r in zip(begin.tolist(), end.tolist(), reach.tolist(), strict=True))
        if bar < max(best.kth, 1):
            return
        found = np.concatenate([lists.doc[a + read:min(a + read + step, z)] for a, z in zip(begin.tolist(), end.tolist(), strict=True)])
        if accesses is not None:
            accesses["sorted"] = accesses.get("sorted", 0) + len(found)
        read, step = read + step, step * 2
        fresh = np.unique(found[~seen_doc[found]])
        if not len(fresh):
            if read >= int((end - begin).max()):
                return
            continue
        seen_doc[fresh] = True
        scores, places = lists.direct(fresh, terms)
        best.add(scores, ids[fresh])
        which = np.searchsorted(begin, places, side="right") - 1
        order = np.argsort(which, kind="stable")
        cuts = np.searchsorted(which[order], np.arange(len(terms) + 1))
        for i in range(len(terms)):
            seen[i][places[order[cuts[i]:cuts[i + 1]]] - begin[i]] = True
            reach[i] += int(np.argmin(seen[i][reach[i]:]))


def query_terms(batches):
    for batch in batches:
        for text, i, n in zip(texts_of(batch), batch.column("item_id").to_pylist(), batch.column("block").to_pylist(), strict=True):
            names = np.unique(Tokens(OTHERS, lower=True).of(np.frombuffer(text + b"\n", dtype=np.uint8))[2])
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), pa.array([i], pa.int64()), pa.array([names.tobytes()], pa.binary())],
                                             names=["block", "item_id", "terms"])


def search_block(docs: DataFrame, queries: list[np.ndarray], k: int = K) -> DataFrame:
    """query (its place in `queries`), rank, doc_id, score: the k best documents for each set of term names."""
    vocabulary = np.unique(np.concatenate(queries)) if queries else np.zeros(0, np.uint64)

    def count(batches):
        for whole in batches:
            for batch in slices(whole, "text", SHARD_BYTES):
                s = Shard(batch, vocabulary)
                times = np.bincount(s.term, minlength=len(vocabulary))
                some = np.flatnonzero(times)
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.concatenate([[-2, -1], some]).astype(np.int32)),
                    pa.array(np.concatenate([[(s.lengths > 0).sum(), s.lengths.sum()], times[some]]).astype(np.int64))], names=["term", "n"])

    # a row for each term of the block at most
    known = {r.term: r.n for r in docs.mapInArrow(tidied(count), STATS).groupBy("term").agg(F.sum("n").alias("n")).collect()}
    number, length = known.get(-2, 0), known.get(-1, 0)
    weights = np.array([math.floor(1000 * math.log((2 * number + 2) / (2 * known.get(t, 0) + 1))) for t in range(len(vocabulary))], dtype=np.int64)
    terms = [np.searchsorted(vocabulary, q).astype(np.int64) for q in queries]

    def look(batches):
        best = [Best(k) for _ in terms]
        last = np.iinfo(np.int64).max
        for whole in batches:
            for batch in slices(whole, "text", SHARD_BYTES):
                shard = Shard(batch, vocabulary)
                m = np.array([FLAT + LENGTH * n * number // length if n else 0 for n in shard.lengths.tolist()], dtype=np.int64)
                lists = Lists(shard, weights, m)
                ids = batch.column("doc_id").fill_null(last).to_numpy(zero_copy_only=False)
                for t, b in zip(terms, best, strict=True):
                    best_positions(lists, ids, t, b)
        for i, b in enumerate(best):
            if len(b.ids):
                yield pa.RecordBatch.from_arrays([pa.array([i] * len(b.ids), pa.int32()), pa.array(b.ids, mask=b.ids == last), pa.array(b.scores)],
                                                 names=["query", "doc_id", "score"])

    def first(found, *keys):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    found = docs.mapInArrow(tidied(look), FOUND).withColumn("salt", F.spark_partition_id() % SALTS)
    return first(first(found, "query", "salt").drop("rank", "salt"), "query")


def search(docs: DataFrame, items: DataFrame, k: int = K, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """item_id, rank, doc_id, score: the k documents with the highest scores above 0 for each of `items` (item_id, text).

    Null texts have no terms; items without terms find nothing.  Equal scores go to the smaller doc_id, a document without an id
    comes last among them.  Repeated rows of `docs` are documents each.  Repeated rows of `items` are one; rows that share an id
    but not a text are ranked each for itself.  Either table may be empty.  Other columns are not read.
    """
    spark = docs.sparkSession
    rows = own(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text"))
    asked = own(items, "item_id", "text").select(F.col("item_id").cast("long").alias("item_id"), text_or_empty(F.col("text")).alias("text")).distinct()
    volume = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = volume // block_bytes + 1
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int"))
    parts = [spark.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")]
    for b in range(blocks):
        own_items = asked.where(F.col("block") == b).mapInArrow(query_terms, "block int, item_id bigint, terms binary").collect()
        queries = [(r.item_id, np.frombuffer(r.terms, dtype=np.uint64)) for r in own_items if r.terms]
        if not queries:
            continue
        found = search_block(rows, [q for _, q in queries], k)
        names = spark.createDataFrame([(i, q[0]) for i, q in enumerate(queries)], "query int, item_id bigint")
        parts.append(found.join(names, "query").select("item_id", "rank", "doc_id", "score"))
    return reduce(DataFrame.unionByName, parts)
