"""Benchmark matches against a plain search of all windows."""

import hashlib
import random
import re

from pyspark.sql import functions as F

from pairworks.llm import decontaminate

DOCS, ITEMS = "doc_id long, text string, found int", "item_id long, text string, doc_id int"


def words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def plain(docs, items):
    out = []
    for doc, text, *_ in docs:
        w, hit, found = words(text), set(), set()
        for item, t, *_ in items:
            v = words(t)
            size = min(13, len(v))
            windows = {tuple(v[i:i + size]) for i in range(len(v) - size + 1)} if v else set()
            for i in range(len(w) - size + 1 if size else 0):
                if tuple(w[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    found.add("" if item is None else str(item))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def data():
    rnd = random.Random(2)
    vocabulary = [f"w{i}" for i in range(40)] + ["é", "ÀB", "x9"]
    text = lambda n: rnd.choice([" ", ", ", "\n"]).join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, text(rnd.choice([1, 2, 5, 13, 14, 40, 90]))) for i in range(1, 30)] + [(30, None), (31, " ."), (None, "only here so far"), (7, "a second text of seven")]
    docs = [(1, None), (2, ""), (3, "!?"), (None, "It was ONLY here, so far."), (4, text(5000))]
    for k in range(5, 60):
        item = rnd.choice(items)[1] or ""
        docs.append((k, text(rnd.randint(0, 300)) + " zz " + item.upper() + " zz " + text(rnd.randint(0, 30))))
    return [(*r, 1) for r in docs + docs[-2:]], [(*r, 1) for r in items]


def test_like_plain_search(spark):
    docs, items = data()
    got = decontaminate.report(spark.createDataFrame(docs, DOCS).repartition(4), spark.createDataFrame(items, ITEMS)).collect()
    assert sorted(map(tuple, got), key=str) == plain(docs, items)


def test_blocks_of_the_test_set(spark):
    docs, items = data()
    found = decontaminate.find_matches(spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS), block_bytes=400)
    assert found.columns == ["doc_id", "text", "found", "found_"]
    got = found.select("doc_id", "found_.n_words", "found_.n_hit", F.size("found_.items")).collect()
    assert sorted(map(tuple, got), key=str) == sorted((r[:4] for r in plain(docs, items)), key=str)


def test_longest_matches_and_removal(spark):
    item = " ".join(f"q{i}" for i in range(20))
    docs = spark.createDataFrame([(1, f"a b {item} c", 0), (2, "clean text", 0), (3, None, 0)], DOCS)
    items = spark.createDataFrame([(5, "x y " + item, 0)], ITEMS)
    match = decontaminate.find_matches(docs, items, into="m").where("doc_id = 1").first().m.matches
    assert [tuple(m) for m in match] == [("5", 2, 2, 20)]
    assert [tuple(r) for r in decontaminate.decontaminate(docs, items).orderBy("doc_id").collect()] == [(2, "clean text", 0), (3, None, 0)]
    assert decontaminate.report(docs.limit(0), items).collect() == []
    assert {r.n_hit for r in decontaminate.report(docs, items.limit(0)).collect()} == {0}


def test_blocks_are_halved_by_their_words(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_WORDS", 45)
    items = [(i, " ".join(f"w{i}x{j}" for j in range(20))) for i in range(7)] * 2
    docs = [(i, f"before {t} after") for i, t in items[:7]]
    assert len(decontaminate.blocks_of(items[:7], 13)) > 2
    found = decontaminate.find_matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), into="found").collect()
    assert {(r.doc_id, r.found.n_hit, tuple(r.found["items"])) for r in found} == {(i, 20, (str(i),)) for i in range(7)}
