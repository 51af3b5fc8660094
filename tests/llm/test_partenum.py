"""Groups of similar documents against all pairs."""

import random
import re
from collections import defaultdict

import numpy as np

from pairworks.llm import partenum

SCHEMA = "doc_id long, text string, family long, elements string"


def shingles(text, size):
    words = re.findall("[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1)) if len(words) >= size else frozenset([tuple(words)] if words else [])


def plain(rows, size=4, percent=85):
    sets, parent, seen = [shingles(r[1], size) for r in rows], {}, defaultdict(list)

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for k, s in enumerate(sets):
        if rows[k][0] is None:
            continue
        common = defaultdict(int)
        for x in s:
            for j in seen[x]:
                common[j] += 1
            seen[x].append(k)
        for j, c in common.items():
            if j != k and 100 * c >= percent * (len(s) + len(sets[j]) - c):
                a, b = root(rows[k][0]), root(rows[j][0])
                parent[max(a, b)] = min(a, b)
    return sorted(((r[0], len(s), None if r[0] is None else root(r[0])) for r, s in zip(rows, sets, strict=True)), key=str)


def rows():
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(3000)]
    out = [(1, None), (2, ""), (3, "a b"), (4, "A  b\n"), (5, "a b c"), (None, "a b"), (6, " "), (7, "hello"), (8, "hello"), (7, "other"), (9, "other")]
    n = 100
    for _ in range(50):
        base = [rnd.choice(words) for _ in range(rnd.choice([4, 5, 6, 7, 8, 9, 10, 12, 15, 20, 30, 50, 100, 300, 1000]))]
        for _ in range(rnd.choice([2, 5, 20])):
            t = list(base)
            for _ in range(rnd.randint(0, max(1, len(t) * 6 // 100))):
                t[rnd.randrange(len(t))] = rnd.choice(words)
            n += 1
            out.append((n, " ".join(t + [rnd.choice(words) for _ in range(rnd.choice([0, 0, 0, max(1, len(t) // 10)]))])))
    rnd.shuffle(out)
    return [(*r, 5, "x") for r in out]


def test_like_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(partenum, "BLOCK_SETS", 7)
    data = rows()
    got = partenum.report(spark.createDataFrame(data, SCHEMA).repartition(5)).collect()
    assert sorted(map(tuple, got), key=str) == plain(data)


def test_one_of_each_group_stays(spark):
    data = [r for r in rows() if r[0] is not None] + [(500000, "left alone in the whole table", 1, ""), (500000, "left alone in the whole table", 1, "")]
    kept = partenum.representatives(spark.createDataFrame(data, SCHEMA), 5, 80)
    assert kept.columns == ["doc_id", "text", "family", "elements"]
    # rows that share an id are documents each: one of those that are alike stays, with the smallest id
    named = [i for i, r in enumerate(data) if r[0] is not None]
    ids = sorted(named, key=lambda i: data[i][0])
    rank = {i: n for n, i in enumerate(ids)}
    firsts = {g for _, _, g in plain([(rank[i], *data[i][1:]) for i in named], 5, 80)}
    want = [data[ids[g]][0] for g in firsts] + [None for r in data if r[0] is None]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)
    apart = [(1, "one two three four five six", 0, ""), (1, "nothing like it at all my dear friend", 0, ""), (2, "one two three four five six", 0, "")]
    assert sorted((r.doc_id, r.text[:3]) for r in partenum.representatives(spark.createDataFrame(apart, SCHEMA), 5, 80).collect()) == [(1, "not"), (1, "one")]


def test_empty(spark):
    assert partenum.report(spark.createDataFrame([], SCHEMA)).collect() == []


def test_similar_sets_share_a_signature():
    rnd = random.Random(1)
    for _ in range(300):
        n = rnd.choice([1, 3, 6, 7, 9, 14, 30, 50, 200, 700])
        base = np.unique(np.array([rnd.getrandbits(64) for _ in range(n)], dtype=np.uint64))
        other = base.copy()
        for k in rnd.sample(range(len(base)), rnd.randint(0, len(base) * 8 // 100)):
            other[k] = rnd.getrandbits(64)
        other = np.unique(np.concatenate([other, np.array([rnd.getrandbits(64) for _ in range(rnd.randint(0, len(base) // 12))], dtype=np.uint64)]))
        common = len(np.intersect1d(base, other))
        if 100 * common >= 85 * (len(base) + len(other) - common):
            names, which = partenum.signatures([base, other])
            assert set(names[which == 0].tolist()) & set(names[which == 1].tolist())


def test_links_of_all_buckets_are_one_for_each_document():
    """A document that shares signatures in many buckets gives one link, not one for each of them."""
    import pyarrow as pa

    docs = np.array([-(1 << 62), 5, 9, 1 << 62], dtype=np.int64)
    packed = []
    for bucket in range(40):
        names = np.sort(np.arange(4, dtype=np.uint64) // np.uint64(4) + np.uint64(bucket))
        table = pa.table([[bucket], [partenum.gaps(names)], [partenum.apart(docs)], [docs[[1, 2]].tobytes()]], names=["bucket", "names", "docs", "copies"])
        packed.append(partenum.sharing(2)(table))
        assert packed[-1].num_rows <= 2
    both = pa.concat_tables(packed)
    found = [partenum.merged(both.filter(pa.compute.equal(both["range"], k))).to_pylist() for k in range(2)]
    assert sorted((r["a"], r["b"]) for rows in found for r in rows) == [(5, docs[0]), (9, docs[0]), (docs[3], docs[0])]
    alone = pa.table([[0], [partenum.gaps(np.arange(4, dtype=np.uint64))], [partenum.apart(docs)], [b""]], names=["bucket", "names", "docs", "copies"])
    assert partenum.sharing(2)(alone).num_rows == 0


def test_a_chain_of_unlike_texts_is_split(spark):
    """Texts that share a common line and little else are a family, but not compared as one: what links stays together, the others go."""
    rnd = random.Random(3)
    words = lambda n: [f"u{rnd.getrandbits(40)}" for _ in range(n)]
    line, data = words(12), []
    for k in range(40):
        own = words(30)
        data.append((k, " ".join(line + own)))
        if k < 6:
            data += [(100 * (k + 1) + j, " ".join(line + own[:-1] + words(1))) for j in range(4)]
    data += [(0, " ".join(line + words(30))), (None, "a b c d e")]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    sets = {i: shingles(t, 5) for i, t in data if i}
    every = partenum.members(docs.where("doc_id is not null"), docs.where("doc_id is not null").select("doc_id").distinct().withColumn("family", partenum.F.lit(0)), 5).dropDuplicates(["digest"])
    assert every.count() == len(data) - 1
    found = partenum.split(docs.where("doc_id is not null"), every, 5, 80).collect()
    family = {r.doc_id: r.family for r in found}
    # 24 copies and what they are copies of, each group for itself
    assert sorted(family) == sorted([*range(6), *(100 * (k + 1) + j for k in range(6) for j in range(4))])
    assert len(set(family.values())) == 6 and all(family[100 * (k + 1) + j] == family[k] for k in range(6) for j in range(4))
    assert all(100 * len(sets[a] & sets[b]) < 80 * len(sets[a] | sets[b]) or family.get(a) == family.get(b) is not None for a in sets for b in sets if a < b)
    assert sorted(map(tuple, partenum.report(docs).collect()), key=str) == plain(data)


def test_rows_without_the_named_ids(spark):
    data = [(k if k % 7 else None, k % 5, f"t{k}", k) for k in range(400)]
    docs = spark.createDataFrame(data, "doc_id int, bucket int, bits string, marked int")
    gone = spark.createDataFrame([(k,) for k in range(0, 500, 3)], "doc_id long")
    kept = partenum.without(docs, gone)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect()), key=str) == sorted((r for r in data if r[0] is None or r[0] % 3), key=str)
    assert partenum.without(docs, gone.limit(0)).count() == 400


def test_cut_tables_leave_no_shuffle_files(spark):
    """Shuffle files go with the query that wrote them, not when the driver happens to collect its garbage."""
    import os

    from pairworks.llm.common import cut

    folders = list(spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {f for top in folders for _, _, names in os.walk(top) for f in names if f.startswith("shuffle_") and f.endswith(".data")}
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was, before = spark.conf.get(setting, None), files()
    made = spark.range(0, 10_000, 1, 4).selectExpr("id % 100 k").groupBy("k").count()
    out = cut(made.join(made.withColumnRenamed("count", "c"), "k"))
    for _ in range(50):
        if not files() - before:
            break
        __import__("time").sleep(0.1)
    assert not files() - before and out.count() == 100 and spark.conf.get(setting, None) == was
