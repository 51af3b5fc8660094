"""The pipeline on a few planted documents, and its stages on the driver's tables."""

import os
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from pairworks.llm import packing
from pairworks.llm.common import tidied_group

SF_DIR = "/root/testdata/sf0.001"


def words(k, n):
    return " ".join(f"{'abcdefgh'[(k * 7 + i * 3) % 8]}{'xyzuvw'[(k + i) % 6]}{'kmnpqr'[(k * i + i // 6) % 6]}o" for i in range(n))


def test_planted(spark, tmp_path):
    item = words(91, 40)
    rows = [(1, words(1, 120), "en", "s", 0), (2, words(1, 120), "en", "s", 0), (3, words(1, 119) + " changed", "en", "t", 0), (4, words(4, 80) + " mail me@you.org now", None, None, None),
            (5, words(5, 60) + " " + item, "en", "s", 0), (6, "12 34 !!", "en", "s", 0), (7, None, "en", "s", 0), (8, words(8, 90), "de", "t", 0), (8, words(8, 90), "de", "t", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, after = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES[:4]:
        before = docs.columns
        docs = corpus_pipeline.cut(stage(spark, docs, str(tmp_path)))
        assert docs.columns == before
        after[name] = sorted(r.doc_id for r in docs.collect())
    assert after == {"language_id": [1, 2, 3, 4, 5, 8, 8], "ngram_jaccard": [1, 4, 5, 8], "decontaminate": [1, 4, 8], "pii": [1, 4, 8]}
    fourth = docs.where("doc_id = 4").first()
    assert fourth.text.endswith(" mail <EMAIL> now") and fourth.n_chars == len(fourth.text)
    pieces = corpus_pipeline.run(spark, str(tmp_path)).collect()
    tokens = defaultdict(int)
    for p in pieces:
        tokens[p.doc_id] += p.length
    assert dict(tokens) == {p.doc_id: p.doc_tokens for p in pieces} and sorted(tokens) == [1, 4, 8]


def test_sequences_hold_the_tokens(spark, tmp_path):
    from tokenizers import Tokenizer

    texts = {1: words(1, 1500), 2: words(2, 40) + " 日本", 3: words(3, 300)}
    rows = [(i, t, "en", f"s{i % 2}", len(t)) for i, t in texts.items()]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, words(91, 40))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    tokenizer, found = Tokenizer.from_file(corpus_pipeline.tokenizer_path()), defaultdict(list)
    for p in sorted(corpus_pipeline.run(spark, str(tmp_path)).collect(), key=lambda p: p.start):
        ids = np.frombuffer(p.ids, dtype="<u2" if len(p.ids) == 2 * p.length else "<u4")
        assert len(ids) == p.length and p.ids_crc32 == zlib.crc32(ids.astype("<u4").tobytes())
        found[p.doc_id] += ids.tolist()
    assert found == {i: tokenizer.encode(t, add_special_tokens=False).ids + [0] for i, t in texts.items()}


def test_batches_of_a_stage_are_bounded(spark):
    docs = spark.range(0, 600, 1, 1).selectExpr("id doc_id", "repeat('word ', 4000) text", "'en' lang", "'s' source", "20000L n_chars")
    corpus_pipeline.STAGES[0][1](spark, docs, SF_DIR)
    sizes = docs.mapInArrow(lambda batches: (pa.RecordBatch.from_arrays([pa.array([b.nbytes])], names=["n"]) for b in batches), "n long").collect()
    assert sum(r.n for r in sizes) > 12_000_000 and max(r.n for r in sizes) < 5_000_000


def test_pieces_take_one_python_pass(spark, capsys):
    docs = spark.createDataFrame([(1, words(1, 30), "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.packed(spark, docs, SF_DIR)
    out.explain()
    assert capsys.readouterr().out.count("MapInArrow") == 1
    assert out.collect() == packing.with_checksums(out.drop("ids_crc32"), keep=True).collect()


def test_groups_give_their_memory_back():
    called = []
    assert tidied_group(lambda table: called.append(table) or table)(5) == 5 and called == [5]
    size = lambda: int(open("/proc/self/statm").read().split()[1]) * 4096
    before = size()

    def run(table):
        # small arrays lie between each other, and stay with the allocator when they go
        held = [np.full(12_000, 1.0) for _ in range(2000)]
        last = np.full(100, 2.0)
        del held
        return last
    tidied_group(run)(None)
    assert size() - before < 60_000_000


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")
def test_driver_tables(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:4]:
        docs = corpus_pipeline.cut(stage(spark, docs, SF_DIR))
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
