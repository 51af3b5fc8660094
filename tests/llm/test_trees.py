"""Passages of earlier documents against a plain table of all windows."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from pairworks.llm import trees
from pairworks.llm.common import Tokens

SCHEMA = "doc_id long, text string, chunk int, Place string"


def plain(rows):
    n, first, out = trees.WINDOW, {}, []
    key = lambda d: (1 << 63) - 1 if d is None else d
    words = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in rows]
    for r, w in zip(rows, words, strict=True):
        for i in range(len(w) - n + 1):
            g = tuple(w[i:i + n])
            first[g] = min(first.get(g, key(r[0])), key(r[0]))
    for r, w in zip(rows, words, strict=True):
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i:i + n])] < key(r[0]):
                gone |= set(range(i, i + n))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def rows():
    rnd = random.Random(5)
    text = lambda n, v=40: " ".join(rnd.choice(["wörd", "The", "the", "a", "x\xa0y"]) + str(rnd.randrange(v)) for _ in range(n))
    shared = text(60)
    out = [(1, None), (2, ""), (3, " \t\n\v "), (None, shared), (None, shared + " end"), (4, text(20) + "\n" + shared + "\t" + text(5)), (5, text(12)),
           (6, shared.replace("The", "THE")), (7, "a " * 500), (8, "a " * 13), (9, "b"), (4, shared), (10, "a " * 12), (-3, shared[:120] + " " + text(30)),
           (11, text(4000)), (12, "x" * 70_000 + " " + shared), (13, shared), (13, shared), (14, text(13)), (1 << 60, shared[40:])]
    out += [(20 + i, text(i, 3) + " " + shared + " " + text(i, 3)) for i in range(40)]
    out += [(100 + i, " ".join(["hot", "pair"] + [f"w{rnd.randrange(9)}" for _ in range(14)] * 3)) for i in range(30)]
    return [(*r, 1, "p") for r in out]


@pytest.mark.parametrize("chunk", [2000, 1 << 20])
def test_like_plain_windows(spark, monkeypatch, chunk):
    monkeypatch.setattr(trees, "CHUNK_BYTES", chunk)
    data = rows()
    got = trees.report(spark.createDataFrame(data, SCHEMA).repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == plain(data)


def test_outputs_empty_and_catalog(spark):
    w = [f"w{i}" for i in range(20)]
    data = [(2, " ".join(["new", *w, "tail"]), 0, ""), (1, "  ".join(w), 0, "")]
    before = {t.name for t in spark.catalog.listTables()}
    got = trees.find_repeats(spark.createDataFrame(data, SCHEMA)).collect()
    assert sorted((r.doc_id, bytes(r.kept).decode(), [tuple(s) for s in r.spans]) for r in got) == [(1, " ".join(w), []), (2, "new tail", [(1, 21)])]
    assert trees.report(spark.createDataFrame([], SCHEMA)).collect() == []
    assert {t.name for t in spark.catalog.listTables()} == before


def test_words_cross_segments(monkeypatch):
    import numpy as np

    from pairworks.llm import common
    rnd = random.Random(1)
    blob = "".join(rnd.choice("ab \n") for _ in range(3000)).encode() + b"x" * 500 + b" y"
    whole = Tokens(b" \n").of(np.frombuffer(blob, dtype=np.uint8))
    monkeypatch.setattr(common, "SEGMENT", 64)
    parts = Tokens(b" \n").of(np.frombuffer(blob, dtype=np.uint8))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    assert [blob[a:z] for a, z in zip(*whole[:2], strict=True)] == blob.split()


def test_results_take_half_of_a_step_for_each_word():
    rnd = random.Random(2)
    texts = [" ".join(f"w{rnd.randrange(5000)}" for _ in range(n)).encode() for n in [0, 400, 0, 0, *[700] * 500, 1, 0]]
    blob, sizes, ids = b"".join(t + b"\n" for t in texts), np.array([len(t) for t in texts]), list(range(len(texts)))
    s = trees.Suffixes(blob, sizes, ids)
    gone = np.zeros(len(s.starts), dtype=bool)
    gone[300:1200] = gone[-701:] = True

    def seconds(run):
        begin = time.process_time()
        run()
        return time.process_time() - begin

    def one_by_one():
        return b" ".join(blob[a:z] for a, z in zip(s.starts[~gone].tolist(), s.stops[~gone].tolist(), strict=True))

    got = [r for b in trees.results({"blob": blob, "ids": ids}, s, gone) for r in b.to_pylist()]
    for r, text, a in zip(got, texts, s.bounds.tolist(), strict=False):
        w, g = text.split(), gone[a:a + r["n_words"]].tolist()
        assert (len(w), b" ".join(x for x, y in zip(w, g, strict=True) if not y)) == (r["n_words"], r["kept"])
        assert [i for x in r["spans"] for i in range(x["start"], x["end"])] == [i for i, y in enumerate(g) if y]
    assert len(got) == len(texts) and sum(len(r["spans"]) for r in got) == 5
    assert 2 * min(seconds(lambda: list(trees.results({"blob": blob, "ids": ids}, s, gone))) for _ in range(5)) < min(seconds(one_by_one) for _ in range(5))


def test_windows_of_one_first_range():
    rnd = np.random.default_rng(4)
    for n in (0, 1, 2, 500):
        key, whole = np.sort(rnd.integers(0, 60, n, dtype=np.uint64)), rnd.integers(0, 3, n, dtype=np.uint64)
        whole[key < 20] = 7
        order, new = trees.told_apart(np.arange(n), key.copy(), whole.copy())
        pairs = list(zip(key[order].tolist(), whole[order].tolist(), strict=True))
        assert sorted(order.tolist()) == list(range(n)) and pairs == sorted(pairs)
        assert [pairs[i] for i in new] == sorted(set(pairs))
