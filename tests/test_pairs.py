import json
import random

import pytest
from pyspark.sql import functions as F

from pairworks.functions import text as tx
from pairworks.operators import lint, pairs, prompts, table_sets, usage
from pairworks.sources import catalog as cat
from pairworks.sources import jsonl


def col(spark, values, expr):
    return [r[0] for r in spark.createDataFrame([(v,) for v in values], "x string").select(expr(F.col("x"))).collect()]


def test_clean_sql(spark):
    cases = {"SELECT 1;\n": "SELECT 1", "SELECT\n\t1": "SELECT 1", "SELECT 1;": "SELECT 1", "a   b ": "a b", "x;;": "x;",
             "a\\b": "ab", "  ;  ": "", "": "", "x ;": "x", "a b\x85c": "a b c", ";": ""}
    assert col(spark, list(cases), tx.clean_sql) == list(cases.values())
    assert col(spark, [None], tx.clean_sql) == [""]


def test_clean_sql_agrees_with_plain_python(spark):
    def plain(s):
        s = " ".join(s.replace("\\", "").split())
        return s[:-1].strip() if s.endswith(";") else s

    rng = random.Random(3)
    alphabet = "ab; \n\t\\ 　\x1c\x85'"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(25))) for _ in range(500)]
    assert col(spark, texts, tx.clean_sql) == [plain(t) for t in texts]


def test_clean_sql_can_keep_literals(spark):
    keep = lambda c: tx.clean_sql(c, preserve_literals=True)
    assert col(spark, ["SELECT  'a  \\d;'  ,\n'it''s  b' ;", "x 'open  end"], keep) == ["SELECT 'a  \\d;' , 'it''s  b'", "x 'open end"]


def test_strip_fence(spark):
    assert col(spark, ["```sql\nSELECT 1\n```", "SQL SELECT 2", "`x`"], tx.strip_fence) == ["\nSELECT 1\n"[1:], "SELECT 2", "x"]


def test_one_json_value(spark):
    is_one = lambda c: tx.one_json_value(c).isNotNull()
    assert col(spark, ['{"a":1}', '{"a":1}\n{"b":2}', '{"a":1},{"b":2}', '{"a":1} x', '{"a":1},', "", "[1]", "nope", None], is_one) == [
        True, False, False, False, False, False, True, False, False]


def parsed(spark, text):
    rows = pairs.parse_pairs(spark.createDataFrame([(1, text)], "task_id int, text string")).orderBy("pos").collect()
    return [(r.question, r.sql or r.answer) for r in rows]


A, B = '{"question": "Q1", "answer": "A1"}', '{"question": "Q2", "answer": "A2"}'
TWO = [("Q1", "A1"), ("Q2", "A2")]


@pytest.mark.parametrize("text, want", [
    (f"{A}\n{B}", TWO), (f"```json\n1. {A}\n- `{B}`\n```", TWO), (f"[{A}, {B}]", TWO), (f"Here you are:\n{A}\n\nand\n{B}", TWO),
    (f"{A},\n{B}", TWO[1:]), (f"{A} x", []), (f"[1, {B}]", TWO[1:]), (f'{{"pairs": [{A}, {B}]}}', TWO), ("", []), ("no json", []),
    (f"{A}\r\n{B}", TWO), (f"{A} {B}", TWO), ("{\n\"question\": \"Q\"\n}", []), (f"* {A}\n{{broken", TWO[:1]), ('{"pairs": 3, "question": "Q", "sql": "S"}', [("Q", "S")]),
])
def test_parse_pairs(spark, text, want):
    assert parsed(spark, text) == want


def test_parse_is_stable_under_noise(spark):
    rng = random.Random(1)
    noise = ["", "Sure!", "```", "   ", "note: 3 items"]
    for _ in range(5):
        lines = [A, B]
        for _ in range(4):
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(noise))
        assert parsed(spark, "\n".join(lines)) == TWO


def test_parse_answer(spark):
    rows = [("asked", '{"sql": "SELECT 1;", "rows": [{"a": 1}]}'), ("asked", '{"question": "own", "sql": 5}'), ("asked", "SELECT\n2;"),
            ("asked", "[1]"), ("asked", ""), ("asked", None)]
    got = pairs.parse_answer(spark.createDataFrame(rows, "question string, text string")).collect()
    assert [(r.question, r.sql, r.rows) for r in got] == [
        ("asked", "SELECT 1", '[{"a":1}]'), ("own", "", "[]"), ("asked", "SELECT 2", "[]"), ("asked", "[1]", "[]"), ("asked", "", "[]"), ("asked", "", "[]")]


def frame(spark, rows):
    return spark.createDataFrame([(t, p, q, s) for t, p, q, s in rows], "task_id int, pos int, question string, sql string")


def test_dedup_and_drop(spark):
    df = frame(spark, [(2, 0, "q", "S;"), (1, 1, "q2", " S"), (1, 0, "q", "FAIL"), (3, 0, "q", ""), (4, 0, "q", "S"), (5, 0, "q", None), (6, 0, "q", "fail")])
    assert {(r.task_id, r.sql) for r in pairs.drop_failures(df).collect()} == {(2, "S"), (1, "S"), (4, "S"), (6, "fail")}
    assert {(r.task_id, r.sql) for r in pairs.dedup_sql(df).collect()} == {(1, "S"), (6, "fail")}
    twice = frame(spark, [(1, 0, "q", "s"), (1, 1, "q", "s")])
    assert [tuple(r) for r in pairs.dedup_pair(twice).collect()] == [(1, 0, "q", "s")]


def test_hot_key_limits_before_the_shuffle(spark):
    df = spark.range(90000).select((F.col("id") % 3).alias("task_id"), F.col("id").alias("pos"), F.when(F.col("id") % 3 == 0, "q").otherwise(F.col("id").cast("string")).alias("question"),
                                   F.lit("s").alias("sql"))
    got = pairs.dedup_pair(df)
    assert "WindowGroupLimit" in got._jdf.queryExecution().executedPlan().toString()
    assert got.count() == 60001
    assert {r.task_id: r["count"] for r in pairs.quota(df, 25).groupBy("task_id").count().collect()} == {0: 25, 1: 25, 2: 25}


def test_large_quota_splits_groups(spark):
    df = spark.range(30000).select(F.lit(1).alias("task_id"), F.col("id").alias("pos"), F.col("id").alias("question"), F.col("id").cast("string").alias("sql"))
    got = pairs.quota(df, 2000)
    assert got.count() == 2000 and got.agg(F.max("pos")).first()[0] == 1999
    assert got.columns == df.columns


def test_quota_and_run_quota(spark):
    df = frame(spark, [(1, 0, "a", "FAIL"), (1, 1, "b", "s1"), (1, 2, "c", "s2"), (2, 0, "d", "s3")])
    assert {r.question for r in pairs.quota(df, 1, count_failures=True).collect()} == {"a", "d"}
    assert {r.question for r in pairs.quota(df, 1).collect()} == {"b", "d"}
    assert [r.question for r in pairs.run_quota(df, 2).collect()] == ["a", "b"]
    assert pairs.batch_size(800, 16) == 50 and pairs.batch_size(5, 2) == 3 and pairs.batch_size(5, 0) == 5


def test_tag_schema(spark):
    users = spark.createDataFrame([(1, "x")], "id int, name string")
    c = cat.load_catalog(spark, {"users": users, "part": users}, keys={"users": "id"})
    row = pairs.tag_schema(frame(spark, [(1, 0, "q", "SELECT * FROM USERS")]), c).first()
    assert row.tables == ["users"] and json.loads(row.schema)["tables"]["users"]["primary_key"] == "id"
    assert pairs.tag_schema(frame(spark, [(1, 0, "q", "SELECT l_partkey")]), c).first().tables == ["part"]
    assert pairs.tag_schema(frame(spark, [(1, 0, "q", "SELECT l_partkey")]), c, word_boundary=True).first().tables == []


def test_written_schema_is_an_object_and_empty_rewrites_clear(spark, tmp_path):
    c = cat.load_catalog(spark, {"t": spark.range(1)})
    rows = pairs.dataset_rows(frame(spark, [(1, 0, "q", "SELECT * FROM t")]), "joins", c)
    path = jsonl.write_version(rows, str(tmp_path), "joins", "v1")
    assert list(json.loads(spark.read.text(path).first().value)["schema"]["tables"]) == ["t"]
    jsonl.write_version(rows, str(tmp_path), "joins", "v2")
    jsonl.write_version(rows.limit(0), str(tmp_path), "joins", "v1")
    assert [jsonl.read_version(spark, str(tmp_path), "joins", v, "question string").count() for v in ("v1", "v2")] == [0, 1]


def test_first_of_each_for_large_n(spark):
    df = spark.range(6000).select((F.col("id") % 2).alias("task_id"), F.col("id").alias("pos"))
    got = pairs.first_of_each(df, ["task_id"], ("pos",), 1500)
    assert got.count() == 3000 and got.agg(F.max("pos")).first()[0] == 2999


def test_datasets_and_versions(spark, tmp_path):
    df = frame(spark, [(1, 0, "q", "SELECT * FROM t;"), (1, 1, "q2", "SELECT * FROM t"), (2, 0, "q", "FAIL")])
    rows = pairs.dataset_rows(df, "single_table", cat.load_catalog(spark, {"t": spark.range(1)}))
    for version in ("v1", "v2", "v1"):
        jsonl.write_version(rows, str(tmp_path), "single_table", version)
    for version in ("v1", "v2"):
        back = jsonl.read_version(spark, str(tmp_path), "single_table", version, "question string, sql string, schema string").collect()
        assert [(r.question, r.sql) for r in back] == [("q", "SELECT * FROM t")]
    qa = spark.createDataFrame([(1, 0, "q", "a"), (1, 1, "q", "a"), (1, 2, "q", "b")], "task_id int, pos int, question string, answer string")
    assert pairs.dataset_rows(qa, "schema_docs").count() == 2
    assert pairs.dataset_rows(frame(spark, [(1, 0, "q", "s"), (1, 1, "r", "s")]), "builtins").count() == 2


def test_jsonl_keeps_nulls(spark, tmp_path):
    df = spark.createDataFrame([(1, None)], "a int, b string")
    jsonl.write_jsonl(df, f"{tmp_path}/x")
    jsonl.append_jsonl(df, f"{tmp_path}/x")
    texts = [r.value for r in spark.read.text(f"{tmp_path}/x").collect()]
    assert texts == ['{"a":1,"b":null}'] * 2


def test_reviews(spark):
    df = frame(spark, [(1, 0, "q1", "s1"), (2, 0, "q2", "s2"), (3, 0, "q3", "s3"), (4, 0, "q4", "s4")])
    reviews = spark.createDataFrame([("q1", "s1", '{"score": 0.9, "fixed_sql": "SELECT 1;"}', 2), ("q1", "s1", "old", 1), ("q2", "s2", "bad", 1), ("q3", "s3", '{"reason": "fine"}', 1)],
                                    "question string, sql string, response string, seq int")
    got = {r.task_id: (r.sql, r.score) for r in pairs.apply_reviews(df, reviews).collect()}
    assert got == {1: ("SELECT 1", 0.9), 2: ("s2", 0.0), 3: ("s3", 0.0), 4: ("s4", None)}


def test_fix_rounds_allow_two_fixes(spark):
    step = {"a0": "a1", "a1": "ok", "b0": "b1", "b1": "b2", "b2": "ok"}
    review = lambda bad: bad.select("question", "sql", F.concat(F.lit('{"fixed_sql": "'), F.element_at(F.create_map(
        *[F.lit(x) for kv in step.items() for x in kv]), F.col("sql")), F.lit('"}')).alias("response"), F.lit(1).alias("seq"))
    check = lambda df: df.withColumn("ok", F.col("sql") == "ok")
    df = frame(spark, [(1, 0, "a", "a0"), (2, 0, "b", "b0"), (3, 0, "c", "ok")])
    assert {r.task_id for r in pairs.fix_rounds(df, check, review).collect()} == {1, 3}
    assert {r.task_id for r in pairs.fix_rounds(df, check, None).collect()} == {3}
    assert {r.task_id for r in pairs.fix_rounds(df, check, review, cut=False).collect()} == {1, 3}


def test_join_tables(spark):
    cases = {'SELECT * FROM a JOIN b': 2, 'FROM s.a JOIN "s"."b"': 2, "FROM a, b": 1, "FROM a JOIN A": 2, "SELECT 1": 0, "from `x` join\nx": 1}
    assert col(spark, list(cases), lint.join_table_count) == list(cases.values())
    assert col(spark, ['FROM "s"."b"'], lint.join_tables) == [['"b']]
    assert lint.min_joins(spark.createDataFrame([("FROM a JOIN b",), ("FROM a",)], "sql string"), 2).count() == 1


def test_lint(spark):
    cases = {"SELECT COUNT(*) FROM t": [], "SELECT COUNT(*), MAX(x) FROM t": ["functions"], "SELECT x ~ 'a'": ["regex"], "x SIMILAR TO 'y'": ["similar_to"], "x ilike 'y'": ["ilike"],
             "x::json": ["json"], "x->'a'": ["json"], "ARRAY[1]": ["array"], "RANK() OVER (ORDER BY x)": ["window"], "WITH a AS (SELECT 1) SELECT 1": ["cte", "subquery"],
             "SELECT (SELECT 1)": ["subquery"], "x" * 201: ["length"], "SELECT account(x), maximum FROM t": []}
    assert col(spark, list(cases), lint.violations) == list(cases.values())
    assert col(spark, ["SELECT current_date", "SELECT max_x"], lambda c: lint.uses_function(c, "CURRENT_DATE")) == [True, False]
    assert col(spark, ["FROM Orders JOIN zoo"], lambda c: lint.unknown_tables(c, ["orders"])) == [["zoo"]]
    texts = ["SELECT EXTRACT(YEAR FROM o_orderdate) FROM orders", "WITH x AS (SELECT 1), y(a) AS (SELECT 2 FROM zoo) SELECT * FROM x JOIN y ON x.a IS DISTINCT FROM y.a",
             'SELECT TRIM(BOTH lower(\'x\') FROM name), SUBSTRING(a FROM 2) FROM s."Part" WHERE t = \'from nowhere\'']
    assert col(spark, texts, lambda c: lint.unknown_tables(c, ["orders", "part"])) == [[], ["zoo"], []]


def test_table_sets(spark):
    def sets(text, **kw):
        df = spark.createDataFrame([(1, text)], "task_id int, text string")
        return [r.tables for r in table_sets.parse_table_sets(df, ["a", "b", "c"], **kw).orderBy("pos").collect()]

    assert sets('{"tables": ["b", "a"]}') == [["b", "a"]]
    assert sets('1. ["a","b"]\n- `["a","x"]`\nnoise\n["b","c"]', n=1) == [["a", "b"]]
    assert sets('["a"]') == [["a", "b", "c"]] and sets("") == [["a", "b", "c"]]
    assert sets('["a","b"]', min_joins=3) == [["a", "b", "c"]]


def greedy(costs, budget):
    spent, out = 0, []
    for c in costs:
        out.append(spent + c <= budget)
        spent += c if out[-1] else 0
    return out


def budgeted(spark, runs, budget, fn, span=7):
    # 200 input tokens cost a thousandth of a dollar
    rows = [(r, i, c * 200, 0) for r, costs in runs.items() for i, c in enumerate(costs)]
    got = fn(spark.createDataFrame(rows, "run_id int, seq long, in_tok long, out_tok long"), budget / 1000, span).orderBy("run_id", "seq").collect()
    return {r: [x.accepted for x in got if x.run_id == r] for r in runs}


def test_budget_example(spark):
    assert budgeted(spark, {1: [6, 5, 3]}, 9, usage.apply_budget) == {1: [True, False, True]}
    assert budgeted(spark, {1: [6, 5, 3]}, 9, usage.stop_at_budget) == {1: [True, False, False]}
    assert budgeted(spark, {None: [6, 5, 3], 1: [1]}, 9, usage.apply_budget) == {None: [True, False, True], 1: [True]}
    assert budgeted(spark, {None: [6, 5, 3]}, 9, usage.stop_at_budget) == {None: [True, False, False]}


def test_budget_against_brute_force(spark):
    rng = random.Random(7)
    runs = {r: [rng.choice([0, 1, 2, 5, 9, 17, 40, 120]) for _ in range(rng.randrange(1, 60))] for r in range(25)}
    runs[99] = [rng.randrange(1, 6) for _ in range(400)]
    for budget in (10, 100, 333):
        assert budgeted(spark, runs, budget, usage.apply_budget) == {r: greedy(c, budget) for r, c in runs.items()}


def test_cost_and_totals(spark):
    df = spark.createDataFrame([("a", 1, 1000, 1000), ("a", 2, 500, 0)], "run_id string, seq int, in_tok long, out_tok long")
    assert [round(r[0], 6) for r in df.select(usage.cost(F.col("in_tok"), F.col("out_tok"))).collect()] == [0.02, 0.0025]
    r = usage.remaining_budget(df, 1.0).first()
    assert (r.in_tok, r.out_tok, r.requests, r.cost_usd, r.budget_left) == (1500, 1000, 2, 0.0225, 0.9775)


def test_progress_credits_the_first_task(spark):
    df = frame(spark, [(1, 0, "q", "s"), (2, 0, "q", "s"), (2, 1, "r", "s"), (3, 0, "q", "s")])
    assert {tuple(r) for r in usage.progress(df).collect()} == {(1, 1, 1), (2, 2, 1), (3, 1, 0)}


def test_compact_log(spark):
    cases = {
        'x SCHEMA_JSON:\n{"tables": {"b": {"c": 1}, "a": {}}}\n\nrest': 'x SCHEMA_JSON:\n{\n  "tables": [\n    "b",\n    "a"\n  ]\n}\n\nrest',
        "SCHEMA_JSON:\nbroken\n\nrest": "SCHEMA_JSON:\n{}\n\nrest",
        'SCHEMA_JSON:\n{"x": 1}': 'SCHEMA_JSON:\n{\n  "tables": []\n}',
        'Schema: \n- a: x, y\n\n- b: z\nend\n- c: d': "Schema:\n- a\n\n- b\nend\n- c: d",
        "nothing here": "nothing here", "": "", None: "",
    }
    assert col(spark, list(cases), prompts.compact_log) == list(cases.values())


def test_many_table_names_in_one_pass(spark):
    """Five thousand names: the same tables as one search for each, a plan that does not grow with them, and equal schemas."""
    import random

    from pairworks.sources import catalog as cat
    rnd = random.Random(3)
    names = ["order", "orders", "orders_2", "Orders", "a.b", "a", "o$x", "x y", "(", "ders"]
    names += list({"t" + "".join(rnd.choice("abc_9") for _ in range(rnd.randrange(2, 9))) for _ in range(12000)})[:5000]
    texts = ["select * from Orders_2 join taa on 1", "orders", "no", None, "", "(a.b) o$x x y", "o.r.d.e.r"] + [
        " ".join(rnd.choice(names) for _ in range(rnd.randrange(6))) + rnd.choice(["", "x", "_"]) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "task_id int, sql string")
    for edges in (False, True):
        import re
        has = lambda t, n: re.search(rf"(?a)\b{re.escape(n.lower())}\b", t) is not None if edges else n.lower() in t
        found = df.select("task_id", pairs.extract_tables(F.col("sql"), names, edges).alias("tables"))
        assert {r.task_id: r.tables for r in found.collect()} == {i: [n for n in names if has((t or "").lower(), n)] for i, t in enumerate(texts)}
    short = [f"t{i}" for i in range(100)]
    assert df.select(pairs.extract_tables(F.col("sql"), names).alias("t"))._jdf.queryExecution().analyzed().expressions().size() == \
        df.select(pairs.extract_tables(F.col("sql"), short).alias("t"))._jdf.queryExecution().analyzed().expressions().size()
    one = spark.createDataFrame([(1,)], "id int")
    c = cat.load_catalog(spark, {"orders": one, "items": one, "none": one})
    rows = {r.task_id: r.schema for r in pairs.tag_schema(spark.createDataFrame([(1, "orders items"), (2, "x"), (3, "items ORDERS"), (4, None)], "task_id int, sql string"), c).collect()}
    assert list(json.loads(rows[1])["tables"]) == ["orders", "items"] and rows[1] == rows[3] and rows[2] == rows[4] == '{"tables":{}}'
