"""Counts of texts against plain ones, and what the decision list learns."""

import random
import re
from collections import Counter

from pairworks.llm import rules

SCHEMA = "doc_id long, text string, counts int, quality_check int"


def plain(doc, text):
    t = text or ""
    w = re.findall("[^\x20\x09-\x0D]+", t)
    lines = [x for x in t.split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen, covered = Counter(windows), set()
    for i, x in enumerate(windows):
        if seen[x] > 1:
            covered |= {i, i + 1, i + 2}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return doc, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered), failed


def texts():
    rnd = random.Random(7)
    good = lambda: " ".join("".join(rnd.choice("abcdefg") for _ in range(rnd.randint(2, 8))) for _ in range(rnd.randint(60, 120)))
    junk = lambda: " ".join("".join(rnd.choice("abcdefg") for _ in range(4)) + rnd.choice(["***", "%%%"]) for _ in range(80))
    return [(i, junk() if i % 5 == 0 else good()) for i in range(200)]


def test_counts_like_plain_ones(spark):
    odd = [(1, None), (2, ""), (3, " \n\t"), (4, "a b c a b c a b c"), (4, "a b c a b c a b c"), (5, "x\n\nx\nx \n y"), (6, "# $ é" * 30), (None, "a"),
           (7, "b " * 20000), (8, "\x0b\x0ca\x0b\n\x1c\x85"), (9, "1 2 3 1 2 3 4 5 6 4 5"), (10, "same line here\n" * 30)]
    rows = [(*r, 1, 1) for r in odd + texts()]
    got = rules.report(spark.createDataFrame(rows, SCHEMA), spark.createDataFrame([], "doc_id long, quality int")).collect()
    assert sorted((tuple(r)[:7] for r in got), key=str) == sorted((plain(*r[:2]) for r in rows), key=str)
    assert all(r.kept == (not r.base_failed) for r in got)


def test_learned_list(spark):
    docs = spark.createDataFrame([(*r, 1, 1) for r in texts()], SCHEMA)
    labels = spark.createDataFrame([(i, int(i % 5 != 0)) for i in range(150)] + [(None, 0), (3, None), (1, 1), (1, 0), (1, 1)], "doc_id long, quality int")
    learned = rules.learn(docs, labels)
    assert learned and {c.feature for rule in learned for c in rule} <= set(rules.FEATURES)
    kept = {r.doc_id: r.quality_check_.kept for r in rules.judge(docs, learned).collect()}
    assert [i for i in kept if kept[i] != (i % 5 != 0)] == []
    assert sorted(r.doc_id for r in rules.good(docs, labels).collect()) == [i for i in range(200) if i % 5]
    assert rules.report(docs.limit(0), labels).collect() == []
    assert rules.learn(docs, labels.where("quality = 1")) == []
