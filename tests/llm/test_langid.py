"""Language identification: held-out accuracy and odd rows."""

import os
import random

import pytest

from pairworks.llm import langid

SCHEMA = "doc_id long, text string, lang string, language int"


def data():
    rnd = random.Random(4)
    words = {"en": "the and of to in is that with".split(), "de": "der und ist nicht über ein mit für".split(), "fr": "le et les été dans que une à".split()}
    return [(i, " ".join(rnd.choice(words[k]) for _ in range(rnd.randint(3, 40))), k, 1) for i in range(600) for k in [rnd.choice(sorted(words))]]


def test_held_out_accuracy(spark):
    rows = data()
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in langid.report(docs).collect()}
    held = [r for r in rows if got[r[0]].held_out]
    assert len(got) == 600 and 60 < len(held) < 180
    assert sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_odd_rows(spark):
    model = langid.learn(spark.createDataFrame(data(), SCHEMA))
    odd = spark.createDataFrame([(1, None, None, 1), (2, "", "en", 1), (3, "12 !? \n", "en", 1), (None, "der und ist nicht", None, 1), (4, "the " * 30000, "de", 1),
                                 (4, "the " * 30000, "de", 1)], SCHEMA)
    found = langid.identify(odd, model)
    assert found.columns == [*odd.columns, "language_"]
    assert sorted(((r.doc_id, r.language_.lang) for r in found.collect()), key=str) == sorted(
        [(1, "und"), (2, "und"), (3, "und"), (None, "de"), (4, "en"), (4, "en")], key=str)
    nothing = langid.learn(odd.where("lang is null"))
    assert nothing.languages == [] and {r.language_.lang for r in langid.identify(odd, nothing).collect()} == {"und"}
    assert langid.identify(odd.limit(0), model).collect() == []


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.01"), reason="no driver tables")
def test_driver_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.report(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.99 * len(got)


def test_nothing_to_learn_from_rejects_no_text(spark):
    rows = [(1, "some words", None), (2, "12 !", None), (3, None, None), (4, "été", None)]
    assert sorted(r.doc_id for r in langid.known(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()) == [1, 4]
