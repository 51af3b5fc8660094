"""Collocations against plain counts of all phrases."""

import random
import re
from collections import Counter

import pytest

from pairworks.llm import collocations

SCHEMA = "text string, lang string, n long, p string, f int"


def lowered(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def plain(rows, least=30, top=2000):
    f, n, out = {}, Counter(), []
    for text, lang, *_ in rows:
        counts = f.setdefault(lang or "und", Counter())
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(w)
            counts.update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows_ = []
        for p, a in cands.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, b in cands.items()):
                continue
            score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            rows_.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for i, (s, a, p, x, y) in enumerate(sorted(rows_)[:top])]
    return sorted(out)


def rows():
    rnd = random.Random(7)
    vocab = ["New", "york", "city", "Ünder", "the", "THE", "a", "x\xa0y", "state", "of", "rare"]
    out = []
    for i in range(300):
        words = [rnd.choice(vocab) + rnd.choice(["", "", "", ",", ".", "\n", ":", "\t", "\r\n"]) for _ in range(rnd.randrange(60))]
        out.append((" ".join(words + [f"odd{i}"]), rnd.choice(["en", "fr", None, "und"]), 1, "p", 2))
    out += [("to be or not to be. To be or not to be", "en", 1, "p", 2)] * 40
    out += [("hot pair " + " ".join(f"w{rnd.randrange(5)}" for _ in range(3)), "de", 1, "", 0) for _ in range(500)]
    return [*out, (None, "en", 1, "p", 2), ("", None, 1, "p", 2), (" .,\t", "it", 1, "", 1), ("lone " * 2000, "xx", 1, "", 1)]


@pytest.mark.parametrize("size, numbered", [(500, 1 << 19), (1 << 20, 6), (500, 6), (1 << 20, 0)])
def test_like_plain_counts(spark, monkeypatch, size, numbered):
    monkeypatch.setattr(collocations, "SLICE_BYTES", size)
    monkeypatch.setattr(collocations, "NUMBERED", numbered)
    data = rows()
    got = collocations.collocations(spark.createDataFrame(data, SCHEMA).repartition(5), top=40).collect()
    assert sorted(map(tuple, got)) == plain(data, top=40)


def test_counts_that_fill_the_bitmap(spark, monkeypatch):
    monkeypatch.setattr(collocations, "BITMAP_BITS", 6)
    data = rows()[:150]
    got = collocations.collocations(spark.createDataFrame(data, SCHEMA), least=5, top=100).collect()
    assert sorted(map(tuple, got)) == plain(data, 5, 100)


def test_exact_arithmetic(spark):
    big = 1 << 60
    rows_ = [([1], big + 1), ([2], big), ([1, 2], big - 1)]
    got = collocations.scored(spark.createDataFrame(rows_, "p array<bigint>, f bigint")).first()
    assert got.score == 2_000_000 * (big - 1) // (2 * big + 1)
    kept = collocations.uncovered(spark.createDataFrame([([1, 2], big), ([1, 2, 3], big * 4 // 5), ([2, 3], big * 4 // 5 + 9)], "p array<bigint>, a bigint"))
    assert sorted(tuple(r.p) for r in kept.collect()) == [(1, 2), (1, 2, 3)]


def test_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    assert collocations.collocations(spark.createDataFrame([(None, None, 1, "", 1)], SCHEMA)).collect() == []
