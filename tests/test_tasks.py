import json

import pytest
from pyspark.sql import functions as F

from pairworks.operators import batch, generate, probe, profile, prompts, run, tasks
from pairworks.sources import catalog as cat


def phases(spark, *rows):
    names = [p.split(" ")[0] for p in tasks.PHASES.split(", ")]
    return spark.createDataFrame([tuple({"phase_id": i, **r}.get(n) for n in names) for i, r in enumerate(rows)], tasks.PHASES)


def expand(spark, row, tables=("t1", "t_2", "t3"), **kw):
    return tasks.expand_tasks(phases(spark, row), list(tables), **kw).orderBy("phase_id", "pos").collect()


def test_sample_data_per_table(spark):
    rows = expand(spark, {"name": "sample_data", "n_rows": 2}, ("a", "b"))
    assert [r.question for r in rows] == ["Show me 2 sample rows from the a table.", "Show me 2 sample rows from the b table."]
    assert rows[0].metadata["n_rows"] == "2"
    assert expand(spark, {"name": "sample_data"}, ()) == []


@pytest.mark.parametrize("row, question, want", [
    ({"name": "schema_docs", "count": 7}, "Generate 7 unique question-answer pairs about the schema.", {"count": 7}),
    ({"name": "schema_docs"}, "Generate 1 unique question-answer pairs about the schema.", {"count": 1}),
    ({"name": "schema_relationship"}, "Generate relationship pairs between tables using sample rows.", {"n_rows": 5}),
    ({"name": "schema_relationship", "n_rows": 500, "question": "why"}, "why", {"n_rows": 500}),
    ({"name": "joins", "count": 3}, "Generate 3 question/SQL pairs requiring joins.", {"count": 3, "min_joins": 2}),
    ({"name": "complex_sqls", "min_joins": 4}, "Generate 1 complex question/SQL pairs requiring joins.", {"count": 1, "min_joins": 4}),
])
def test_single_tasks(spark, row, question, want):
    (r,) = expand(spark, row)
    assert r.question == question
    assert {k: r[k] for k in want} == want and all(r.metadata[k] == str(v) for k, v in want.items())


def test_single_table(spark):
    rows = expand(spark, {"name": "Single_Table", "count": 4}, defaults={"parallelism": "10"})
    assert [r.table for r in rows] == ["t1", "t_2", "t3"] and {r.parallelism for r in rows} == {3}
    assert rows[1].question.startswith("Create 4 unique natural language questions about the t 2 table.")
    assert {r.parallelism for r in expand(spark, {"name": "single_table"}, defaults={"parallelism": "2"})} == {2}
    assert {r.parallelism for r in expand(spark, {"name": "single_table", "parallelism": 1}, defaults={"parallelism": "2"})} == {1}
    (r,) = expand(spark, {"name": "single_table"}, ())
    assert r.table == "table_1" and r.question.startswith("Create a natural language question about the table 1 table.")


def test_listed_copies_and_functions(spark):
    assert [r.question for r in expand(spark, {"name": "x", "questions": ["a", "b"], "count": 9})] == ["a", "b"]
    assert [r.question for r in expand(spark, {"name": "x", "prompt_template": "t", "count": 2, "question": "q"})] == ["q", "q"]
    assert [r.question for r in expand(spark, {"name": "x", "prompt_template": "t"})] == [""]
    assert expand(spark, {"name": "x", "prompt_template": "t", "count": 0}) == []
    by_list = expand(spark, {"name": "builtins", "fns": ["MAX", "AVG"], "prompt_template": "t"})
    assert [r.fn for r in by_list] == ["MAX"] * 5 + ["AVG"] * 5
    assert len(expand(spark, {"name": "builtins", "fns": ["SUM", "MIN"], "count": 3})) == 6
    by_map = expand(spark, {"name": "builtins", "fn_counts": {"SUM": 2, "MIN": 0, "MAX": None}})
    assert sorted(r.fn for r in by_map) == ["MAX"] * 5 + ["MIN"] * 5 + ["SUM"] * 2
    assert expand(spark, {"name": "builtins", "fn_counts": {}}) == [] and expand(spark, {"name": "builtins", "fns": []}) == []
    fallback = expand(spark, {"name": "builtins", "count": 2}, ())
    assert [(r.fn, r.table) for r in fallback] == [("COUNT", "table_1"), ("COUNT", "table_2")]
    assert {r.fn for r in expand(spark, {"name": "b", "count": 30}, default_fns=["LAG", "LEAD"])} == {"LAG", "LEAD"}
    assert expand(spark, {"name": "b"}) == []


def test_random_tables_follow_the_seed(spark):
    draw = lambda seed: [r.table for r in expand(spark, {"name": "b", "fns": ["MAX"], "count": 40}, seed=seed)]
    assert draw(1) == draw(1) and draw(1) != draw(2) and set(draw(1)) == {"t1", "t_2", "t3"}


def test_metadata_and_phase_filter(spark):
    (r,) = expand(spark, {"name": "joins", "settings": {"k": "own"}, "prompt_template": "t"}, defaults={"k": "base", "d": "1"})
    assert r.metadata == {"k": "own", "d": "1", "count": "1", "min_joins": "2", "prompt_template": "t"}
    both = phases(spark, {"name": "joins"}, {"name": "schema_docs"})
    assert [x.phase for x in tasks.expand_tasks(both, ["a"], phase="joins").collect()] == ["joins"]
    assert tasks.expand_tasks(both, ["a"], phase="JOINS").count() == 0


def test_templates(spark):
    df = spark.createDataFrame([("q {{b}}", "S")], "q string, s string")
    row = prompts.render_prompts(df, "no role\n### role: system \n A {{s}}\r\n\n### role:user\n{{q}} {{x}}\n",
                                 {"s": F.col("s"), "q": F.col("q"), "b": F.lit("B")}).first()
    assert [tuple(m) for m in row.messages] == [("system", "A S"), ("user", "q B {{x}}")]
    assert prompts.render_prompts(df, "no roles at all", {}).first().messages == []


def test_default_prompt(spark):
    df = spark.createDataFrame([("how?", "COUNT", "Q: a\nA: b"), ("how?", None, None)], "q string, fn string, ex string")
    a, b = [r[0] for r in df.select(prompts.default_prompt(F.col("q"), F.lit('- **t**: "x"'), F.col("fn"), F.col("ex"))).collect()]
    assert a.splitlines()[0].startswith("You are a PostgreSQL expert.") and "Q: a\nA: b\n\nQuestion: how?\nSQL:" in a
    assert "function `COUNT`" in a and "Ensure" not in b and b.endswith('- **t**: "x"\n\nQuestion: how?\nSQL:')


def test_fewshot(spark):
    questions = spark.range(300).select(F.concat(F.lit("q"), "id").alias("question"))
    for n, want in ((0, 0), (1, 1), (3, 2), (500, 2)):
        examples = spark.range(n).select(F.concat(F.lit("e"), "id").alias("question"), F.lit("S").alias("sql"))
        got = prompts.fewshot(questions, examples)
        assert {r.examples.count("Q: ") for r in got.collect()} == {want}
        assert got.count() == 300
    assert len({r.examples for r in got.collect()}) > 20
    many = prompts.fewshot(spark.range(3000).select(F.col("id").cast("string").alias("question")), examples)
    assert len({b for r in many.collect() for b in r.examples.split("\n\n")}) > 450


def test_task_message(spark):
    df = tasks.expand_tasks(phases(spark, {"name": "builtins", "fns": ["MAX"], "count": 1}), ["t"])
    system, user = prompts.task_message(df, "- **t**", 3.5).first().messages
    assert "- **t** Return a JSON object with 'question' and 'sql'." in system.content
    assert json.loads(user.content)["budget_left"] == "3.5" and json.loads(user.content)["builtins"] == "MAX"


def test_retry():
    calls = []

    def flaky(x):
        calls.append(x)
        if len(calls) < 3:
            raise OSError("busy")
        return x

    assert batch.with_retry(flaky, 5, 0.0)(7) == 7 and calls == [7, 7, 7]
    with pytest.raises(ZeroDivisionError):
        batch.with_retry(lambda: 1 / 0, 2, 0.0)()


def ask_for(*columns):
    """A prompt function: the columns' values as the only message."""
    return lambda df: df.select("task_id", F.array(F.struct(F.lit("user").alias("role"), F.concat_ws(
        " ", *[F.col(c).cast("string") for c in columns]).alias("content"))).alias("messages"))


def test_rounds_stop_when_done_or_used_up(spark):
    def model(messages):
        task, asked = map(int, messages[0]["content"].split())
        turn = sum(m["role"] == "assistant" for m in messages)
        if turn:
            asked = int(messages[-1]["content"].split()[1])
        n = {0: asked + 4, 1: 1, 2: 0}[task]
        return "\n".join('{"question": "t%d r%d n%d", "sql": "S"}' % (task, turn, i) for i in range(n))

    df = spark.createDataFrame([(0,), (1,), (2,)], "task_id int")
    got = batch.run_rounds(df, ask_for("task_id", "asked"), model, 4, batch=3, rounds=3).collect()
    by_task = {t: sorted(r.question for r in got if r.task_id == t) for t in range(3)}
    # more pairs than asked for count up to what is missing
    assert len(by_task[0]) == 4 and {r.round for r in got if r.task_id == 0} == {0}
    assert by_task[1] == ["t1 r0 n0", "t1 r1 n0", "t1 r2 n0"] and by_task[2] == []


def test_each_prompt_is_sent_once(spark, tmp_path):
    seen = str(tmp_path / "calls")

    def model(messages):
        with open(seen, "a") as fh:
            fh.write(messages[0]["content"] + "\n")
        return '{"question": "q", "sql": "S"}'

    ask = lambda df: df.select("task_id", F.array(F.struct(F.lit("user").alias("role"), F.col("task_id").cast("string").alias("content"))).alias("messages"))
    got = batch.run_rounds(spark.range(20).withColumnRenamed("id", "task_id"), ask, model, 1)
    assert got.count() == 20 and got.count() == 20
    assert sorted(open(seen).read().split(), key=int) == [str(i) for i in range(20)]


def test_a_phase_from_tasks_to_dataset(spark, tmp_path):
    frames = {"orders": spark.sql("SELECT id, 'Ann' AS name FROM range(5)"), "items": spark.range(3)}
    for t, df in frames.items():
        df.createOrReplaceTempView(t)
    c = cat.load_catalog(spark, frames, keys={"orders": "id"})
    seen = str(tmp_path / "prompts")

    def model(messages):
        with open(seen, "a") as fh:
            fh.write(json.dumps(messages) + "\n")
        table, count = messages[0]["content"].split()
        n = ["SELECT COUNT(*) FROM %s;" % table, "SELECT nothing FROM %s" % table, "SELECT MAX(id) FROM %s" % table][:int(count)]
        return "\n".join(json.dumps({"question": "q " + s, "sql": s}) for s in n)

    todo = tasks.expand_tasks(phases(spark, {"name": "single_table", "count": 3}, {"name": "joins"}), list(frames))
    template = "### role: system\n{{table}} {{count}}\n### role: user\n{{schema_json}} {{sample_rows}} {{nl_question}}"
    path = run.run_phase(todo, c, template, model, f"{tmp_path}/out", "single_table", "v1", k=3, batch=3, n_rows=1, probe=True, tag=True)
    rows = spark.read.json(path).collect()
    assert {r.sql for r in rows} == {"SELECT COUNT(*) FROM orders", "SELECT MAX(id) FROM orders", "SELECT COUNT(*) FROM items", "SELECT MAX(id) FROM items"}
    assert all([t for t, info in r.schema.tables.asDict().items() if info] == [r.sql.split()[-1]] for r in rows)
    prompts_sent = [json.loads(l) for l in open(seen)]
    assert len(prompts_sent) == 2 and not any("Ann" in m[1]["content"] for m in prompts_sent)
    mine = next(m[1]["content"] for m in prompts_sent if m[0]["content"].startswith("orders"))
    assert '"tables":{"orders"' in mine and "items" not in mine and '{"orders":[{"id":0' in mine and "Create 3 unique" in mine


def test_prompts_for_table_sets(spark):
    c = cat.load_catalog(spark, {t: spark.range(1) for t in ("a", "b", "c")})
    df = tasks.expand_tasks(phases(spark, {"name": "joins"}), c.names).withColumn("asked", F.lit(2))
    ask = run.table_prompts(c, "### role: user\n{{schema_json}} {{count}} {{min_joins}}")
    text = lambda d: ask(d).first().messages[0].content
    assert [t in text(df) for t in ('"a"', '"b"', '"c"')] == [True] * 3 and text(df).endswith(" 2 2")
    narrow = text(df.withColumn("tables", F.array(F.lit("c"), F.lit("zz"), F.lit("a"))))
    assert list(json.loads(narrow.rsplit(" ", 2)[0])["tables"]) == ["c", "a"]


def test_probe(spark):
    spark.createDataFrame([(1, "x"), (2, "y")], "id int, v string").createOrReplaceTempView("probe_t")
    good = ["SELECT * FROM probe_t;", "WITH a AS (SELECT 1 AS x) SELECT * FROM a ORDER BY x", "SELECT id, id FROM probe_t", "SELECT * FROM probe_t WHERE id > 9"]
    bad = ["SELECT nothing FROM probe_t", "SELECT 1/0", "SELECT CAST(v AS int) FROM probe_t", "DROP VIEW probe_t", "SELEC 1", "SELECT 1 -- note", "FAIL"]
    df = spark.createDataFrame([(i, s) for i, s in enumerate(good + bad + ["", good[0]])], "task_id int, sql string")
    got = {r.task_id: r for r in probe.probe_queries(spark, df, batch=3).collect()}
    assert [got[i].ok for i in range(len(got))] == [True] * 4 + [False] * 8 + [True]
    assert spark.table("probe_t").count() == 2 and got[4].error and got[11].error == "not run"
    c = cat.load_catalog(spark, {"probe_t": spark.table("probe_t")})
    foreign = spark.createDataFrame([(0, good[0]), (1, good[1]), (2, "SELECT * FROM zoo")], "task_id int, sql string")
    assert [(r.ok, r.error) for r in probe.probe_queries(spark, foreign, catalog=c).orderBy("task_id").collect()] == [(True, None), (True, None), (False, "not run")]


def test_generated_pairs_run(spark):
    frames = {"orders": spark.sql("SELECT id, CAST(id % 3 AS bigint) AS customer_id, TIMESTAMP '2024-01-01 00:00:00' AS at, 'x' AS note, CAST(NULL AS int) AS gone FROM range(30)"),
              "customer": spark.sql("SELECT id, CAST(id % 2 AS bigint) AS region_id FROM range(3)"), "region": spark.sql("SELECT id FROM range(2)")}
    c = cat.load_catalog(spark, frames, keys={t: "id" for t in frames})
    rels = spark.createDataFrame([("orders", "customer_id", "customer", "id"), ("customer", "region_id", "region", "id")],
                                 "child_table string, child_col string, parent_table string, parent_col string")
    made = generate.template_pairs(c, profile.profile_columns(c), rels)
    kinds = {r.kind: r["count"] for r in made.groupBy("kind").count().collect()}
    assert kinds["join"] == 2 and kinds["chain"] == 1 and kinds["group"] >= 3
    assert made.where("sql LIKE '%gone%'").count() == 0
    for t, df in frames.items():
        df.createOrReplaceTempView(t)
    checked = probe.probe_queries(spark, made.withColumn("task_id", F.lit(1)))
    assert [r.sql for r in checked.where("NOT ok").collect()] == []
    docs = generate.schema_doc_pairs(c, profile.profile_columns(c))
    assert "The primary key of orders is id." in {r.answer for r in docs.collect()}


def test_conversations_grow_by_reply_and_remainder(spark, tmp_path):
    """What is sent, in tables: the remainder is what is missing; for documents what the last reply lacked."""
    sent = str(tmp_path / "sent")

    def model(messages):
        with open(sent, "a") as fh:
            fh.write(json.dumps(messages) + "\n")
        turn = len(messages) // 2
        return "\n".join('{"question": "r%d n%d", "answer": "A"}' % (turn, i) for i in range([1, 3, 3, 3][turn]))

    def contents(**settings):
        open(sent, "w").close()
        rounds = batch.converse(spark.range(1).withColumnRenamed("id", "task_id"), ask_for("asked"), model, 6, batch=3, follow="{n} more", **settings)
        assert rounds.unfinished.isEmpty() and rounds.pairs.count() == 6
        return [[(m["role"], m["content"]) for m in json.loads(line)] for line in open(sent)]

    plain = contents()
    assert [c[-1][1] for c in plain] == ["3", "3 more", "2 more"]
    assert plain[2] == [*plain[1], ("assistant", "\n".join('{"question": "r1 n%d", "answer": "A"}' % i for i in range(3))), ("user", "2 more")]
    assert [c[-1][1] for c in contents(shortfall=True)] == ["3", "2 more", "2 more"]


def test_pairs_wanted_by_task(spark):
    df = spark.createDataFrame([(1, 2), (2, None), (3, 0), (4, 3)], "task_id int, count int")
    model = lambda m: "\n".join(['{"question": "q%d", "sql": "S"}' % i for i in range(5)])
    got = batch.run_rounds(df, ask_for("asked"), model, F.coalesce("count", F.lit(1))).groupBy("task_id").count().collect()
    assert {tuple(r) for r in got} == {(1, 2), (2, 1), (4, 3)}


def test_a_run_stops_at_its_budget(spark):
    """Against a plain loop: admission by estimates in order, settled by what the calls cost, until nothing fits."""
    cost = lambda t: (3 * t % 50, 7 * t % 90)
    model = lambda m: ('{"question": "q", "sql": "S"}', *cost(int(m[0]["content"])))
    rows = [(i,) for i in range(1, 121)]
    left, open_, plain = 70_000, [r[0] for r in rows], []
    for turn in range(4):
        room, sent = left, []
        for t in open_:
            room -= -(-len(str(t)) // 4) * 5 + 100 * 15
            if room < 0:
                break
            sent.append(t)
        left -= sum(5 * cost(t)[0] + 15 * cost(t)[1] for t in sent)
        plain += [(t, turn) for t in sent]
        open_ = open_[len(sent):]
        if left <= 0:
            break
    run = batch.converse(spark.createDataFrame(rows, "task_id int"), ask_for("task_id"), model, 1, rounds=4, budget=0.07, span=25)
    assert sorted((r.task_id, r.turn) for r in run.usage.collect()) == plain
    assert sorted(r.task_id for r in run.unfinished.collect()) == open_ and open_
    assert sum(5 * r.in_tok + 15 * r.out_tok for r in run.usage.collect()) <= 70_000


def test_a_task_that_fails_midway_sends_nothing_twice(spark, tmp_path):
    calls, broken = str(tmp_path / "calls"), str(tmp_path / "broken")
    open(broken, "w").close()

    def model(messages):
        import os
        text = messages[0]["content"]
        if text == "13" and os.path.exists(broken):
            raise OSError("gone")
        with open(calls, "a") as fh:
            fh.write(text + "\n")
        return "reply " + text

    asked = ask_for("task_id")(spark.range(40).coalesce(2).withColumnRenamed("id", "task_id"))
    go = lambda **more: batch.complete_batch(asked, model, attempts=1, log=f"{tmp_path}/log", threads=3, **more)
    with pytest.raises(Exception, match="gone"):
        go().collect()
    first = open(calls).read().split()
    assert 0 < len(first) < 40
    lenient = {r.task_id: (r.text, r.error) for r in go(strict=False).collect()}
    assert lenient[13] == (None, "OSError: gone") and lenient[7] == ("reply 7", None) and len(lenient) == 40
    (tmp_path / "broken").unlink()
    assert {r.task_id: r.text for r in go().collect()} == {i: f"reply {i}" for i in range(40)}
    assert {r.text for r in go().collect()} == {f"reply {i}" for i in range(40)}
    assert sorted(open(calls).read().split(), key=int) == [str(i) for i in range(40)]


def test_single_objects_and_plain_sql(spark):
    rows = [(1, '{"question": "a", "sql": "SELECT 1;"}', "own"), (2, "SELECT 2", "own"), (3, '{"sql": ""}', "own"), (4, None, "own")]
    got = batch.single_pairs(spark.createDataFrame(rows, "task_id int, text string, question string")).collect()
    assert sorted((r.task_id, r.question, r.sql) for r in got) == [(1, "a", "SELECT 1"), (2, "own", "SELECT 2")]


def test_joins_are_checked_within_the_rounds(spark, tmp_path):
    """SQL that fails or names too few tables is asked for again; a review may mend it."""
    frames = {"orders": spark.range(5), "items": spark.sql("SELECT id, id AS oid FROM range(3)")}
    for t, df in frames.items():
        df.createOrReplaceTempView(t)
    c = cat.load_catalog(spark, frames)
    good = "SELECT o.id FROM orders o JOIN items i ON i.oid = o.id"
    replies = [[good, "SELECT id FROM orders", "SELECT nothing FROM orders JOIN items USING (id)"], ["SELECT 2 FROM items JOIN orders USING (id)"]]

    def model(messages):
        return "\n".join(json.dumps({"question": "q " + s, "sql": s}) for s in replies[len(messages) // 2 % 2])

    todo = tasks.expand_tasks(phases(spark, {"name": "joins", "count": 2}), list(frames))
    path = run.run_phase(todo, c, "### role: user\n{{count}}", model, f"{tmp_path}/a", "joins", "v1", batch=3)
    # the batch is cut to what is wanted, so only the first two of three count, one of them with one table
    assert {r.sql for r in spark.read.json(path).collect()} == {good, "SELECT 2 FROM items JOIN orders USING (id)"}
    review = lambda bad: bad.select("question", "sql", F.lit('{"fixed_sql": "SELECT 3 FROM items JOIN orders USING (id)"}').alias("response"), F.lit(1).alias("seq"))
    replies[0] = ["SELECT broken FROM orders", good]
    path = run.run_phase(todo, c, "### role: user\n{{count}}", model, f"{tmp_path}/b", "joins", "v1", batch=3, review=review)
    assert {r.sql for r in spark.read.json(path).collect()} == {good, "SELECT 3 FROM items JOIN orders USING (id)"}


def test_a_large_phase_is_made_in_ranges(spark):
    asked = phases(spark, {"name": "copies", "prompt_template": "t", "count": 1_000_001}, {"name": "b", "fns": ["MAX", None, "MIN"], "count": 3},
                   {"name": "b", "fn_counts": {"SUM": 20_000, "AVG": None, "MIN": -1}})
    made = tasks.expand_tasks(asked, ["a", "b"])
    assert made.rdd.getNumPartitions() >= 5
    counts = made.groupBy("phase_id").agg(F.count("*").alias("n"), F.countDistinct("pos").alias("d"), F.min("pos").alias("a"), F.max("pos").alias("z")).orderBy("phase_id").collect()
    assert [(r.n, r.d, r.a, r.z) for r in counts] == [(n, n, 0, n - 1) for n in (1_000_001, 9, 20_005)]
    spread = made.groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert len(spread) >= 3 and max(r["count"] for r in spread) < 700_000
    # each function's tasks lie together, in the order of the map
    runs = made.where("phase_id = 2").groupBy("fn").agg(F.count("*").alias("n"), (F.max("pos") - F.min("pos") + 1).alias("w")).collect()
    assert {(r.fn, r.n, r.w) for r in runs} == {("SUM", 20_000, 20_000), ("AVG", 5, 5)}


def test_reviews_are_asked_for(spark):
    from pairworks.operators import batch, pairs, prompts

    rows = [("q", "SELECT 1"), ("q", "SELECT 1"), ("bad", "SELECT 2"), (None, "SELECT 3")]
    df = spark.createDataFrame(rows, "question string, sql string")
    asked = {r.sql: r.messages for r in prompts.review_messages(df, "- **t**").collect()}
    assert asked["SELECT 2"][1].content == "Question: bad\nSQL Candidate:\nSELECT 2\n\nSchema:\n- **t**"
    assert asked["SELECT 3"][1].content.startswith("Question: \n") and asked["SELECT 3"][0].role == "system"

    def answer(messages):
        said = messages[-1]["content"]
        if "bad" in said:
            raise ValueError("no answer")
        return '{"score": 0.25, "reason": "", "fixed_sql": "SELECT 9;"}'

    done = pairs.apply_reviews(df.where("question IS NOT NULL"), batch.reviewer("s", answer, attempts=1)(df))
    assert sorted((r.question, r.sql, r.score) for r in done.collect()) == [("bad", "SELECT 2", None), ("q", "SELECT 9", 0.25), ("q", "SELECT 9", 0.25)]
    assert batch.reviewer("s", answer)(df.limit(0)).count() == 0
