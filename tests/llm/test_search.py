"""Ranked search against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from pairworks.llm import search

DOCS = "doc_id long, text string, score int, query string"
ITEMS = "item_id long, text string, rank int"


def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items, k=10):
    tf = [Counter(terms(d[1])) for d in docs]
    n = [sum(c.values()) for c in tf]
    number, length = sum(x > 0 for x in n), sum(n)
    df = Counter(t for c in tf for t in c)
    out = []
    for item, text in {(i[0], i[1] or "") for i in items}:
        found = []
        for d, c, size in zip(docs, tf, n, strict=True):
            m = 10 + (90 * size * number // length if size else 0)
            score = sum(math.floor(1000 * math.log((2 * number + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if c[t])
            if score > 0:
                found.append((-score, d[0] is None, d[0] or 0, d[0]))
        out += [(item, i + 1, x[3], -x[0]) for i, x in enumerate(sorted(found)[:k])]
    return sorted(out, key=str)


def data():
    rnd = random.Random(11)
    vocab = ["Ünder", "über", "the", "The", "of", "a1", "b2", "x"] + [f"t{i}" for i in range(60)]
    text = lambda n: " ".join(rnd.choice(vocab) + rnd.choice(["", ",", "\n", "-"]) for _ in range(n))
    docs = [(i, text(rnd.choice([3, 20, 20, 80])), 1, "q") for i in range(300)]
    docs += [(None, docs[5][1], 1, "q"), (None, text(9), 1, "q"), (-4, docs[5][1], 0, ""), (7, docs[7][1], 0, ""), (900, None, 0, ""), (901, "", 0, ""), (902, "-- ,", 0, "")]
    docs += [(1000 + i, "tie tie breaker", 0, "") for i in range(30)] + [(2000, text(5000), 0, ""), (2001, "only", 0, "")]
    items = [(i, text(rnd.choice([1, 5, 40])), 0) for i in range(25)] + [(50, "tie", 0), (51, "", 0), (52, None, 0), (53, "unseen words", 0), (None, "breaker t3", 0),
                                                                     (54, "t1", 0), (54, "t1", 0), (54, "t2", 0), (55, "only", 0)]
    return docs, items


@pytest.mark.parametrize("shard,block", [(300, 100), (1 << 20, 1 << 20)])
def test_like_plain_scores(spark, monkeypatch, shard, block):
    monkeypatch.setattr(search, "SHARD_BYTES", shard)
    monkeypatch.setattr(search, "FIRST_READ", 2)
    docs, items = data()
    items = items if block > 1000 else items[:6] + items[-9:]
    got = search.search(spark.createDataFrame(docs, DOCS).repartition(3), spark.createDataFrame(items, ITEMS), block_bytes=block).collect()
    assert sorted(map(tuple, got), key=str) == plain(docs, items)


def test_empty_tables(spark):
    docs, items = data()
    none = lambda schema: spark.createDataFrame([], schema)
    assert search.search(none(DOCS), spark.createDataFrame(items[:3], ITEMS)).collect() == []
    assert search.search(spark.createDataFrame(docs[:3], DOCS), none(ITEMS)).collect() == []


def test_best_positions_stop_early():
    """With one list the first k entries and those that may tie are enough; the bar follows direct accesses, not the last read."""
    import pyarrow as pa
    texts = ["rare " * (i % 7 + 1) + "common " * 5 for i in range(2000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts), pa.array(range(2000))], names=["text", "doc_id"])
    names = np.unique(search.Tokens(search.OTHERS, lower=True).of(np.frombuffer(b"rare common\n", dtype=np.uint8))[2])
    shard = search.Shard(batch, names)
    lists = search.Lists(shard, np.array([500, 900]), np.full(2000, 100))
    best, count = search.Best(10), {}
    search.best_positions(lists, np.arange(2000), np.array([0, 1]), best, count)
    scores = lists.direct(np.arange(2000), np.array([0, 1]))[0]
    order = np.lexsort((np.arange(2000), -scores))[:10]
    assert best.ids.tolist() == order.tolist() and best.scores.tolist() == scores[order].tolist()
    assert count["sorted"] < len(lists.doc)
