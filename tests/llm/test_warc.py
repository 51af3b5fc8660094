"""Archives: round trip, roles, digests, and the same bytes again."""

import hashlib

import pytest

from pairworks.llm import warc

SCHEMA = "page_id long, url string, html string, payload string"


def rows():
    big = "x" * 1500
    out = [(1, "http://a/1", big), (2, "http://a/2", big), (5, None, big), (None, "http://n", big), (7, "u", "short"), (8, "u2", "short"), (9, "e", None),
           (10, "é\n b", ""), (11, "z", "é" * 600), (12, "z", "é" * 600), (12, "z", "é" * 600), (13, "p", "\r\n\r\n" * 400)]
    return [(*r, "p") for r in out]


def plain(data):
    out = []
    for page, _, html, _ in data:
        payload = (html or "").encode()
        same = [r[0] for r in data if (r[2] or "").encode() == payload and r[0] is not None]
        top = max(same, default=None) if len(payload) >= 1000 else None
        revisit = top is not None and page != top
        out.append((page, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", top if revisit else None))
    return sorted(out, key=str)


def test_round_trip(spark):
    got = warc.report(spark.createDataFrame(rows(), SCHEMA).repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == plain(rows())
    assert warc.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_files_are_the_same_again(spark):
    pages = spark.createDataFrame(rows(), SCHEMA)
    first, again = (sorted((r.name.rsplit("/", 1)[1], r.sha256) for r in warc.write(p, roll_bytes=300).collect()) for p in (pages, pages.repartition(5)))
    assert first == again
    many = [(i, f"http://h/{i}", "y" * (3000 + i), "") for i in range(200)]
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    try:
        manifest = warc.write(spark.createDataFrame(many, SCHEMA), roll_bytes=2000)
        assert manifest.where("number > 2").count() > 0 and manifest.agg({"records": "sum"}).first()[0] == 200
        assert warc.read(manifest).where("length(payload) <> payload_bytes").count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_revisit_names_the_record_it_repeats(spark):
    found = warc.read(warc.write(spark.createDataFrame(rows(), SCHEMA))).collect()
    ids = {r.record_id for r in found if r.record_type == "response"}
    assert all(r.refers_to_id in ids for r in found if r.record_type == "revisit")


def test_one_page_id_on_all_rows_is_split(spark):
    for page in (7, None):
        pages = spark.createDataFrame([(page, f"http://h/{i}", "y" * (2000 + i % 7), "") for i in range(400)], SCHEMA)
        manifest = warc.write(pages)
        sizes = [r.records for r in manifest.collect()]
        assert sum(sizes) == 400 and len(sizes) == 8 and max(sizes) < 120
        found = warc.read(manifest)
        assert found.rdd.getNumPartitions() == 8
        assert sorted(r.url for r in found.collect()) == sorted(f"http://h/{i}" for i in range(400))


def test_a_finished_folder_has_its_manifest(spark, tmp_path):
    root = f"{tmp_path}/archive"
    pages = spark.createDataFrame(rows(), SCHEMA)
    names = sorted(r.name for r in warc.write(pages, root).collect())
    assert (tmp_path / "archive" / "manifest" / "_SUCCESS").exists() and not (tmp_path / "archive" / "temporary").exists()
    assert names == sorted(str(x) for x in (tmp_path / "archive").glob("*.gz")) == sorted(r.name for r in warc.manifest_of(spark, root).collect())
    with pytest.raises(ValueError, match="finished"):
        warc.write(pages, root)
    with pytest.raises(ValueError, match="not finished"):
        warc.manifest_of(spark, f"{tmp_path}/none")
