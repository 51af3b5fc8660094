"""Packing: an exact round trip, the mixture, and ids against the tokenizer."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from pairworks.llm import packing

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, source string, n int"


def data(n=120):
    rnd = random.Random(6)
    words = ["alpha", "été", "don't", "x1", "“q”", "日本", "!!", "\n\n", "  ", "<|endoftext|>"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 3, 50, 400]))), f"s{rnd.choice([0, 0, 1, 2])}") for i in range(n)]
    return [(*r, 1) for r in [*rows, (n, None, None), (n + 1, "", "s1"), (n + 2, "plain " * 9000, "s2")]]


def checked(rows, pieces, sequence):
    from tokenizers import Tokenizer

    tokenizer, found, sequences = Tokenizer.from_file(PATH), defaultdict(list), defaultdict(list)
    ids = {r[0]: tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [0] for r in rows}
    for p in pieces:
        own = ids[p.doc_id]
        assert p.doc_tokens == len(own)
        assert p.ids_crc32 == zlib.crc32(np.array(own[p.start:p.start + p.length], dtype="<u4").tobytes())
        found[p.doc_id].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts, whole in [*((found[d], len(ids[d])) for d in ids), *((s, None) for s in sequences.values())]:
        at = 0
        for start, length in sorted(parts):
            assert start == at and length > 0
            at += length
        assert at == whole if whole is not None else at <= sequence
    assert sorted(sequences) == list(range(len(sequences)))
    assert sum(sum(n for _, n in s) < sequence for s in sequences.values()) <= 1


@pytest.mark.parametrize("weights", [None, {"s0": 1, "s1": 6, "s2": 2}])
def test_round_trip(spark, weights):
    rows = data()
    pieces = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(4), PATH, weights=weights, sequence=256, window=1024)
    checked(rows, packing.with_checksums(pieces).collect(), 256)


def test_mixture_of_each_window(spark):
    rows = [(i, "one two three four five six", f"s{i % 2}", 0) for i in range(2000)]
    pieces = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(6), PATH, weights={"s0": 3, "s1": 1}, sequence=64, window=512).collect()
    windows = defaultdict(Counter)
    for p in pieces:
        windows[p.sequence_id * 64 // 512][p.doc_id % 2] += p.length
    for k in range(10):
        assert abs(windows[k][0] - 384) <= 1 and sum(windows[k].values()) == 512


def test_empty_and_many_sources(spark, monkeypatch):
    docs = spark.createDataFrame(data(5), SCHEMA)
    assert packing.report(docs.limit(0), PATH).collect() == []
    monkeypatch.setattr(packing, "MOST_SOURCES", 1)
    with pytest.raises(ValueError):
        packing.report(docs, PATH)


@pytest.mark.parametrize("most", [1, 10_000])
def test_many_small_sources(spark, monkeypatch, most):
    monkeypatch.setattr(packing, "MOST_SOURCES", most)
    monkeypatch.setattr(packing, "FOLDED", 8)
    rows = [(i, "one two three " * (300 if i % 50 == 0 else 1), "big" if i % 50 == 0 else f"host{i % 97}", 0) for i in range(400)]
    for weights in (None, {"big": 3, "host7": 5}):
        pieces = packing.pack(spark.createDataFrame(rows, SCHEMA).repartition(4), PATH, weights=weights, sequence=16, window=32, fold=True)
        checked(rows, packing.with_checksums(pieces).collect(), 16)


def test_ids_are_the_tokenizers():
    """All texts of a run at once, with few pieces remembered, against the tokenizer one by one."""
    rnd = random.Random(4)
    parts = ["a", "B", "é", "Ö", "×", "÷", "ª", "²", "¼", "1", "9", " ", "  ", "\n", "\t", "\r", "'", "'s", "'re", "'ll", "n't", '"', "“", "–", "…", ".", "-", "ɏ", "'T", " '", "日", "<|x"]
    encoder = packing.Encoder(PATH, remember=50)
    for _ in range(1500):
        texts = ["".join(rnd.choice(parts) for _ in range(rnd.randrange(14))) for _ in range(4)]
        got = [np.frombuffer(x, dtype=encoder.dtype).tolist() for x in encoder.encode_all(texts)]
        assert got == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
