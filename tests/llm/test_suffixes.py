"""Verbatim repeats against a plain count of all strings."""

import hashlib
import random
from collections import Counter

import numpy as np
import pyarrow as pa

from pairworks.llm import suffixes

SCHEMA = "doc_id long, text string, ids int"


def plain(rows):
    texts, n, out = [(r[1] or "").encode() for r in rows], suffixes.LENGTH, []
    seen = Counter(t[i:i + n] for t in texts for i in range(len(t) - n + 1))
    for (doc, *_), t in zip(rows, texts, strict=True):
        gone = bytearray(len(t))
        for i in range(len(t) - n + 1):
            if seen[t[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        kept = bytes(b for b, x in zip(t, gone, strict=True) if not x)
        spans = sum(1 for i in range(len(t)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((doc, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def rows():
    rnd = random.Random(3)
    text = lambda n: "".join(rnd.choice("abcdé \n") for _ in range(n))
    shared = text(500)
    out = [(1, None), (2, ""), (None, shared), (3, text(300) + shared + text(10)), (4, text(17) + shared[40:450] + text(3)), (5, "a" * 401),
           (6, "a" * 900), (7, text(50) + shared[:399].replace("é", "e")), (8, shared[:300]), (9, text(3000)), (9, "xy" * 1000 + text(700)),
           (10, text(7) + shared[100:] + text(500) + shared[:380]), (11, text(400)), (12, "q" * 400)]
    out += [(20 + i, text(i) + shared + text(i)) for i in range(60)] + [(99, text(450))] * 2
    return [(*r, 1) for r in out]


def test_like_plain_count(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 5000)
    data = rows()
    got = suffixes.report(spark.createDataFrame(data, SCHEMA).repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == plain(data)


def test_outputs_and_empty(spark):
    text = "0123456789" * 30 + "x" * 200
    got = suffixes.find_repeats(spark.createDataFrame([(1, "left " + text, 0), (2, text + " right", 0)], SCHEMA)).collect()
    assert sorted((r.doc_id, bytes(r.kept), [tuple(s) for s in r.spans]) for r in got) == [(1, b"left ", [(5, 505)]), (2, b" right", [(0, 500)])]
    assert suffixes.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_cover_meets_every_distance():
    differences = [(a - b) % suffixes.PERIOD for a in suffixes.COVER for b in suffixes.COVER if a != b]
    assert sorted(differences) == list(range(1, suffixes.PERIOD))


def test_names_travel_packed():
    rnd = np.random.default_rng(1)
    volume = 4 << 20
    names = rnd.integers(0, 1 << 64, 320_000, dtype=np.uint64)
    for bits, most in ((np.uint64((1 << 64) - 1), 6.3), (suffixes.shortened(30 << 30), 4.3), (suffixes.shortened(volume), 3.3)):
        sent = suffixes.send(7, np.append(names & bits, names[:1000] & bits), 12)
        packed = sum(len(pa.compress(x, "lz4_raw", asbytes=True)) for x in sent.column("names").to_pylist())
        assert packed <= most * len(names)
        answers = suffixes.compare(pa.Table.from_batches([sent])).to_pylist()
        assert suffixes.receive(names & bits, 12, answers)[:1000].all()


def test_short_names_of_samples_lose_and_add_nothing(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 5000)
    monkeypatch.setattr(suffixes, "SPARE_BITS", -6)
    data = rows()
    assert int(suffixes.shortened(sum(len(r[1] or "") for r in data))).bit_count() == 8
    got = suffixes.report(spark.createDataFrame(data, SCHEMA)).collect()
    assert sorted(map(tuple, got), key=str) == plain(data)
