import random
import uuid

import pytest
from pyspark.sql import functions as F

from pairworks.functions.similarity import combined, cosine, name_similarity
from pairworks.operators import profile, relate, table_sets
from pairworks.sources import catalog as cat
from pairworks.sources import samples


def answers(df):
    return [r.answer for r in df.collect()]


def two_tables(spark, child, column="b_id", child_type="int", parent_type="int"):
    a = spark.createDataFrame([(v,) for v in child], f"{column} {child_type}")
    b = spark.createDataFrame([(i,) for i in range(1, 6)], f"id {parent_type}")
    return {"a": a, "b": b}


def test_declared_key_gives_both_directions(spark):
    c = cat.load_catalog(spark, two_tables(spark, [9]), fks=[("a", ["b_id"], "b", ["id"])])
    rows = relate.explicit_fks(c).collect()
    assert {r.answer for r in rows} == {"a.b_id -> b.id", "b.id -> a.b_id"}
    assert {r.confidence for r in rows} == {1.0}
    assert {r.question for r in rows} == {"How is a.b_id related to b.id?", "How is b.id related to a.b_id?"}


def test_composite_and_self_references(spark):
    c = cat.load_catalog(spark, two_tables(spark, [1]), fks=[("a", ["x", "y"], "b", ["p", "q"]), ("a", ["m"], "a", ["n"])])
    assert set(answers(relate.explicit_fks(c))) == {"a.x -> b.p", "b.p -> a.x", "a.y -> b.q", "b.q -> a.y", "a.m -> a.n", "a.n -> a.m"}


def test_heuristic_finds_pair(spark):
    c = cat.load_catalog(spark, two_tables(spark, [1, 1, 2, 2, 3, 3]), keys={"b": "id"}, comments={("a", "b_id"): "link to b"})
    found = relate.discover_relationships(c).collect()
    assert {r.answer for r in found} == {"a.b_id -> b.id", "b.id -> a.b_id"}
    assert all(r.confidence == 1.0 for r in found)  # all six votes, the comment among them


def test_orphan_or_unrelated_column_is_rejected(spark):
    for rows, column in (([1, 1, 9], "b_id"), ([70, 71, 72], "foo")):
        c = cat.load_catalog(spark, two_tables(spark, rows, column), keys={"b": "id"})
        assert answers(relate.discover_relationships(c)) == []


def test_verdicts_and_suggestions(spark):
    c = cat.load_catalog(spark, two_tables(spark, [1, 1, 2, 2]), keys={"b": "id"})
    verdicts = lambda v: spark.createDataFrame([("a", "b_id", "b", "id", v)], "child_table string, child_col string, parent_table string, parent_col string, verdict string")
    assert len(answers(relate.discover_relationships(c, verdicts(" Yes\n")))) == 2
    assert answers(relate.discover_relationships(c, verdicts("no"))) == []
    assert answers(relate.discover_relationships(c, verdicts("well"))) == []
    replies = spark.createDataFrame([("1. `SELECT 1 FROM a a JOIN b b ON a.b_id = b.id LIMIT 1;`\nSELECT 1 FROM zz a JOIN b b ON a.q = b.id",)], "text string")
    rows = relate.discover_relationships(c, verdicts("no"), replies).collect()
    assert {(r.answer, r.confidence, r.source) for r in rows} == {("a.b_id -> b.id", 0.5, 2), ("b.id -> a.b_id", 0.5, 2)}
    # an inferred relationship wins over the same suggestion
    assert {r.source for r in relate.discover_relationships(c, None, replies).collect()} == {1}


def test_wide_decimals_are_exact(spark):
    from decimal import Decimal as D

    base = 10**19
    frames = {"a": spark.createDataFrame([(D(base + 1), D("0.1"), 1e20), (D(base + 2), D("0.12345678901234567891"), 2.5)], "w decimal(38,0), f decimal(30,20), x double"),
              "b": spark.createDataFrame([(D(base + 3),), (D(base * 10),), (D(base + 2),)], "id decimal(38,0)"),
              "c": spark.createDataFrame([(0.1,), (0.12345678901234568,)], "id double")}
    c = cat.load_catalog(spark, frames, keys={"b": "id", "c": "id"})
    got = [(r.n_values, r.n_matched) for r in relate.match_counts(c, [("a", "w", "b", "id"), ("a", "x", "b", "id"), ("a", "f", "c", "id")]).orderBy("child_col").collect()]
    assert got == [(2, 1), (2, 1), (2, 1)]


def test_number_types_compare_and_text_does_not(spark):
    frames = {"n": spark.createDataFrame([(1.0, "1", 1), (2.0, "2", 2), (2.5, "3", 2)], "d double, t string, i int"),
              "p": spark.createDataFrame([(1,), (2,), (3,)], "id bigint"),
              "q": spark.createDataFrame([("1",)], "id string")}
    c = cat.load_catalog(spark, frames, keys={"p": "id", "q": "id"})
    got = {(r.child_col, r.parent_table): (r.n_values, r.n_matched) for r in relate.match_counts(
        c, [("n", "d", "p", "id"), ("n", "i", "p", "id"), ("n", "t", "q", "id")]).collect()}
    assert got == {("d", "p"): (3, 2), ("i", "p"): (2, 2), ("t", "q"): (3, 1)}
    assert not relate._comparable(c, ("n", "t", "p", "id"))


def test_decimals_match_whole_numbers(spark):
    frames = {"n": spark.sql("SELECT * FROM VALUES (1.00BD), (2.50BD), (3.00BD) AS t(x)"), "p": spark.range(1, 4)}
    c = cat.load_catalog(spark, frames, keys={"p": "id"})
    r = relate.match_counts(c, [("n", "x", "p", "id")]).first()
    assert (r.n_values, r.n_matched) == (3, 2)


def test_uuid_columns_stay_apart_from_text(spark):
    ids = [str(uuid.UUID(int=i)) for i in range(20)]
    frames = {"encounters": spark.createDataFrame([(ids[i], ids[i % 5], "x" * 80) for i in range(20)], "id string, patient string, note string"),
              "patients": spark.createDataFrame([(i, i) for i in ids[:5]], "id string, ssn string")}
    types = {("encounters", "id"): "UUID", ("encounters", "patient"): "UUID", ("patients", "id"): "UUID"}
    c = profile.with_inferred_keys(cat.load_catalog(spark, frames, types=types))
    assert c.keys == {"encounters": "id", "patients": "id"}
    assert "encounters.patient -> patients.id" in answers(relate.discover_relationships(c))
    assert "patients.ssn -> patients.id" not in answers(relate.discover_relationships(c))


def test_many_columns_need_several_words_and_passes(spark, monkeypatch):
    monkeypatch.setattr(relate, "MAX_COLUMNS", 70)
    wide = spark.range(50).select(*[(F.col("id") % (i + 1)).alias(f"c{i}") for i in range(150)])
    c = cat.load_catalog(spark, {"w": wide, "p": spark.range(100)}, keys={"p": "id"})
    pairs = [("w", f"c{i}", "p", "id") for i in range(150)]
    got = {r.child_col: (r.n_values, r.n_matched) for r in relate.match_counts(c, pairs).collect()}
    assert got == {f"c{i}": (min(i + 1, 50), min(i + 1, 50)) for i in range(150)}


def test_hot_value_does_not_change_counts(spark):
    child = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("p_id"))
    c = cat.load_catalog(spark, {"c": child, "p": spark.range(100)}, keys={"p": "id"})
    r = relate.match_counts(c, [("c", "p_id", "p", "id")]).first()
    values = {7 if i % 3 == 0 else i for i in range(30000)}
    assert (r.n_values, r.n_matched) == (len(values), len([v for v in values if v < 100]))


def test_discovery_agrees_with_single_checks(spark):
    rng = random.Random(5)
    parent = spark.createDataFrame([(i,) for i in range(50)], "pid bigint")
    child = spark.createDataFrame([(rng.randrange(60), rng.randrange(40), None if i % 4 == 0 else i % 9) for i in range(300)], "a bigint, b bigint, c bigint")
    c = cat.load_catalog(spark, {"child": child, "parent": parent}, keys={"parent": "pid"})
    for r in relate.match_counts(c, [("child", x, "parent", "pid") for x in "abc"]).collect():
        one = relate.value_overlap(child, r.child_col, parent, "pid").first()
        assert (r.n_values, r.n_matched) == (one.n_values, one.n_matched)
        assert relate.no_orphans(child, r.child_col, parent, "pid").first().ok == (r.n_values == r.n_matched)


def test_overlap_edges(spark):
    empty = spark.createDataFrame([(None,)], "x int")
    parent = spark.createDataFrame([(1,), (None,)], "k int")
    assert relate.value_overlap(empty, "x", parent, "k").first().overlap == 0.0
    child = spark.createDataFrame([(1,), (2,), (None,)], "x int")
    assert relate.value_overlap(child, "x", parent, "k").first().overlap == 0.5
    assert [tuple(r) for r in relate.orphans(child, "x", parent, "k").collect()] == [(2, 1)]
    assert relate.join_exists(child, "x", parent, "k").first().joined
    assert not relate.join_exists(empty, "x", parent, "k").first().joined
    assert relate.distinct_values(child, "x", 1).count() == 1
    a = relate.value_overlap(spark.range(1000), "id", spark.range(500), "id", 100)
    assert a.first().n_values == 100


def test_distinct_ratio_edges(spark):
    ratio = lambda rows: profile.distinct_ratio(spark.createDataFrame(rows, "x int"), "x").first()[0]
    assert ratio([]) == 0.0
    assert ratio([(None,)]) == 0.0
    assert ratio([(1,), (1,), (2,), (None,)]) == 0.5


def test_profile_covers_all_types(spark):
    df = spark.sql("""SELECT 1 AS i, CAST(1.5 AS double) AS d, 'x' AS s, DATE '2024-01-01' AS day, TIMESTAMP '2024-01-01 00:00:00' AS ts, true AS b,
        array(1, 2) AS a, map('k', 1) AS m, named_struct('f', 1) AS st, CAST(2 AS decimal(10,2)) AS n, repeat('y', 500) AS long, CAST(NULL AS int) AS missing""")
    got = {r.column: (r.n_rows, r.n_nonnull, r.n_distinct) for r in profile.profile_columns(cat.load_catalog(spark, {"t": df.union(df)})).collect()}
    assert got.pop("missing") == (2, 0, 0)
    assert set(got.values()) == {(2, 2, 1)} and len(got) == 11
    empty = profile.profile_columns(cat.load_catalog(spark, {"t": df.limit(0)})).collect()
    assert {(r.n_rows, r.distinct_ratio) for r in empty} == {(0, 0.0)}


def test_inferred_keys(spark):
    frames = {"plain": spark.createDataFrame([(1, 7, "a"), (2, 7, "b")], "id int, g int, t string"),
              "later": spark.createDataFrame([(1, 10), (1, 20)], "g int, id bigint"),
              "none": spark.createDataFrame([("a",), ("b",)], "t string"),
              "sparse": spark.createDataFrame([(5,), (5,), (1000,)], "x int"),
              "nulls": spark.createDataFrame([(1,), (None,)], "x int")}
    c = cat.load_catalog(spark, frames)
    assert {r.table: r.primary_key for r in profile.infer_primary_key(c).collect()} == {"plain": "id", "later": "id"}
    assert profile.with_inferred_keys(cat.load_catalog(spark, frames, keys={"plain": ("t", "id")})).keys == {"plain": "t", "later": "id"}


def test_names_types_and_vectors(spark):
    df = spark.createDataFrame([("o_custkey", "c_custkey"), ("A", "a"), (None, "x")], "a string, b string")
    assert [r[0] and round(r[0], 4) for r in df.select(name_similarity("a", "b")).collect()] == [0.8889, 1.0, None]
    assert [r[0] for r in spark.sql("SELECT 'VARCHAR(10)' a, 'varchar(20)' b UNION ALL SELECT 'INTEGER', 'BIGINT'").select(
        relate.same_type(F.col("a"), F.col("b"))).collect()] == [True, False]
    assert spark.sql("SELECT 'Address' t").select(relate.base_name(F.col("t"))).first()[0] == "addre"
    v = spark.sql("SELECT array(1f, 0f) a, array(1f, 1f) b, array(0f, 0f) z, CAST(NULL AS array<float>) n")
    a, b, z, n = v.select(*[cosine(F.col("a"), F.col(x)) for x in "abzn"]).first()
    assert (round(a, 6), round(b, 6), z, n) == (1.0, round(0.5 ** 0.5, 6), 0.0, 0.0)
    assert v.select(combined(F.col("a"), F.col("z"), F.col("b"), F.col("b"))).first()[0] == pytest.approx(0.5 ** 0.5)


def test_joinable_sets(spark):
    rels = spark.createDataFrame([("a", "b"), ("c", "b"), ("d", "c"), ("a", "a")], "child_table string, parent_table string")
    sets = {tuple(r.tables) for r in table_sets.joinable_sets(rels, 3, 3).collect()}
    assert sets == {("a", "b", "c"), ("b", "c", "d")}


def test_joinable_sets_come_once_and_best_first(spark):
    """Against all subsets of a random graph; no aggregate over the sets stands in the plan."""
    from itertools import combinations
    rnd = random.Random(5)
    names = [f"t{i}" for i in range(9)]
    edges = [(a, b, rnd.randrange(1, 7) / 6) for a, b in combinations(names, 2) if rnd.random() < 0.35]
    rels = spark.createDataFrame(edges, "child_table string, parent_table string, confidence double")
    tied = lambda s: [(a, b) for a, b, _ in edges if a in s and b in s]

    def connected(s):
        seen, todo = {s[0]}, [s[0]]
        while todo:
            t = todo.pop()
            for a, b in tied(s):
                for x, y in ((a, b), (b, a)):
                    if x == t and y not in seen:
                        seen.add(y)
                        todo.append(y)
        return len(seen) == len(s)

    want = [s for k in (2, 3, 4, 5) for s in combinations(names, k) if connected(s)]
    got = table_sets.joinable_sets(rels, 5)
    assert sorted(tuple(r.tables) for r in got.collect()) == sorted(want)
    weakest = lambda s: min(max(c for a, b, c in edges if t in (a, b) and a in s and b in s) for t in s)
    best = sorted(want, key=lambda s: (-weakest(s), -len(s), s))[:7]
    assert [tuple(r.tables) for r in table_sets.joinable_sets(rels, 5, n=7).collect()] == best


def test_catalog_texts(spark):
    df = spark.createDataFrame([(1, 1)], "id int, parent_id int")
    c = cat.load_catalog(spark, {"tbl": df, "parent": df}, keys={"tbl": "id"}, fks=[("tbl", ["parent_id"], "parent", ["id"])],
                         comments={"tbl": "tbl comment", ("tbl", "id"): "pk"})
    assert {r.line for r in cat.schema_markdown(c).collect()} == {'- **tbl**: "id", "parent_id"', '- **parent**: "id", "parent_id"'}
    text = cat.schema_json(c, ["tbl"]).first()[0]
    assert text == ('{"tables":{"tbl":{"columns":{"id":{"type":"INTEGER","comment":"pk"},"parent_id":{"type":"INTEGER","comment":null}},'
                    '"primary_key":"id","comment":"tbl comment","foreign_keys":[{"referred_table":"parent","constrained_columns":["parent_id"],"referred_columns":["id"]}]}}}')
    assert cat.sample_tables(c, 1).count() == 1


def test_catalog_of_a_database(spark, tmp_path):
    spark.sql("CREATE OR REPLACE TEMP VIEW unrelated AS SELECT 1")
    spark.sql(f"CREATE TABLE stored (x INT COMMENT 'a number') USING parquet LOCATION '{tmp_path}/stored' COMMENT 'a table'")
    c = cat.load_catalog(spark, "default")
    assert c.names == ["stored"] and c.tables_df.first().comment == "a table" and c.columns_df.first().comment == "a number"
    spark.sql("DROP TABLE stored")
    c = cat.load_catalog(spark, {"t": spark.createDataFrame([(1,)], "x int").withMetadata("x", {"comment": "from metadata"})})
    assert c.columns_df.first().comment == "from metadata"
    assert cat.type_name("decimal(10,2)") == "NUMERIC(10,2)" and cat.type_name("array<float>") == "REAL[]"


def test_keys_from_an_information_schema(spark):
    constraints = spark.createDataFrame([("pk_p", "PRIMARY KEY"), ("pk_c", "PRIMARY KEY"), ("fk", "FOREIGN KEY"), ("u", "UNIQUE")], "constraint_name string, constraint_type string")
    usage = spark.createDataFrame([("pk_p", "parent", "a", 1, None), ("pk_p", "parent", "b", 2, None), ("pk_c", "child", "id", 1, None),
                                   ("fk", "child", "y", 2, 1), ("fk", "child", "x", 1, 2), ("u", "child", "z", 1, None)],
                                  "constraint_name string, table_name string, column_name string, ordinal_position int, position_in_unique_constraint int")
    references = spark.createDataFrame([("fk", "pk_p")], "constraint_name string, unique_constraint_name string")
    keys, fks = cat.declared_keys(constraints, usage, references)
    assert keys == {"parent": "a", "child": "id"} and fks == [("child", ["x", "y"], "parent", ["b", "a"])]


def test_samples(spark):
    df = spark.createDataFrame([(3, "c"), (1, "a"), (2, None)], "id int, v string")
    assert [r.id for r in samples.sample_rows(df, 2, "id").collect()] == [1, 2]
    assert samples.sample_rows(df, 2).count() == 2
    unkeyed = spark.createDataFrame([(None, "a"), (None, "b"), (3, "c")], "id int, x string")
    assert sorted((r.id or 0) for r in samples.sample_rows(unkeyed, 3, "id").collect()) == [0, 0, 3]
    c = cat.load_catalog(spark, {"t": df, "u": df}, keys={"t": "id"})
    rows = samples.sample_all(c, 3).collect()
    assert len(rows) == 6 and '{"id":2,"v":null}' in {r.row for r in rows}
    df.createOrReplaceTempView("sample_view")
    twice = samples.fetch(spark, "SELECT id, v, id + 10 AS id FROM sample_view ORDER BY v NULLS LAST", 1)
    assert sorted(twice.columns) == ["id", "v"] and twice.first().id == 11


def test_foreign_keys_of_one_name(spark):
    constraints = spark.createDataFrame([("a", "a_pkey", "PRIMARY KEY"), ("b", "b_pkey", "PRIMARY KEY"), ("x", "fk", "FOREIGN KEY"), ("y", "fk", "FOREIGN KEY")],
                                        "table_name string, constraint_name string, constraint_type string")
    usage = spark.createDataFrame([("a", "a_pkey", "id", 1, None), ("b", "b_pkey", "id", 1, None), ("x", "fk", "a_id", 1, 1), ("y", "fk", "b_id", 1, 1)],
                                  "table_name string, constraint_name string, column_name string, ordinal_position int, position_in_unique_constraint int")
    references = spark.createDataFrame([("x", "fk", "a_pkey"), ("y", "fk", "b_pkey")], "table_name string, constraint_name string, unique_constraint_name string")
    keys, fks = cat.declared_keys(constraints, usage, references)
    assert keys == {"a": "id", "b": "id"} and fks == [("x", ["a_id"], "a", ["id"]), ("y", ["b_id"], "b", ["id"])]


def test_suggestions_take_the_spelling_of_the_catalog(spark):
    c = cat.load_catalog(spark, {"orders": spark.createDataFrame([(1, 1)], "id int, b_id int"), "b": spark.createDataFrame([(1,)], "id int")})
    replies = spark.createDataFrame([("SELECT 1 FROM Orders a JOIN B b ON a.B_ID = b.ID LIMIT 1;",)], "text string")
    assert {(r.child_table, r.child_col, r.parent_table, r.parent_col) for r in relate.parse_suggested(replies, catalog=c).collect()} == {
        ("orders", "b_id", "b", "id"), ("b", "id", "orders", "b_id")}


def test_comments_and_types_of_a_database(spark):
    shape = "table_name string, column_name string, data_type string, udt_name string, character_maximum_length int, numeric_precision int, numeric_scale int"
    view = spark.createDataFrame([
        ("t", "a", "integer", "int4", None, 32, 0), ("t", "b", "character varying", "varchar", 20, None, None), ("t", "c", "character varying", "varchar", None, None, None),
        ("t", "d", "numeric", "numeric", None, 12, 2), ("t", "e", "numeric", "numeric", None, None, None), ("t", "f", "timestamp with time zone", "timestamptz", None, None, None),
        ("t", "g", "ARRAY", "_int4", None, None, None), ("t", "h", "USER-DEFINED", "mood", None, None, None), ("u", "i", "uuid", "uuid", None, None, None),
        ("u", "j", "double precision", "float8", None, 53, None), ("u", "k", "ARRAY", "_text", None, None, None)], shape)
    said = spark.createDataFrame([("t", None, "a table"), ("t", "a", "the u it is in"), ("u", "i", "")], "table_name string, column_name string, comment string")
    comments, types = cat.described(view, said)
    assert comments == {"t": "a table", ("t", "a"): "the u it is in"}
    assert list(types.values()) == ["INTEGER", "VARCHAR(20)", "VARCHAR", "NUMERIC(12, 2)", "NUMERIC", "TIMESTAMP", "INTEGER[]", "MOOD", "UUID", "DOUBLE PRECISION", "TEXT[]"]
    assert cat.described(view.limit(0), said.limit(0)) == ({}, {})
    frames = {"t": spark.createDataFrame([(1, "x")], "a int, b string"), "u": spark.createDataFrame([("x", 1.0)], "i string, j double")}
    c = cat.load_catalog(spark, frames, comments=comments, types=types)
    assert [(r.type, r.comment) for r in c.columns_df.collect()] == [("INTEGER", "the u it is in"), ("VARCHAR(20)", None), ("UUID", None), ("DOUBLE PRECISION", None)]
    found = relate.metadata_signals(relate.candidates(c.with_keys({"u": "j"}))).collect()
    assert {r.child_col: r.s3 for r in found} == {"a": True, "b": False}


def test_ranges_of_a_key_hold_each_row_once(spark):
    rows = spark.createDataFrame([(k,) for k in [*range(-7, 30), None, 1000]], "k int")
    for parts in (2, 3, 8, 5000):
        split = cat.key_ranges("k", -7, 1000, parts)
        assert 1 < len(split) <= parts
        assert rows.count() == sum(rows.where(c.replace('"', "`")).count() for c in (split if parts < 100 else cat.key_ranges("k", -7, 1000, 9)))
    assert cat.key_ranges("k", None, None, 4) == cat.key_ranges("k", 3, 3, 4) == cat.key_ranges("k", 1, 9, 1) == []
