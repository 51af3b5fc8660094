"""Rows are dealt over tasks by their keys, whatever the size of their files, and reach neither the driver nor one task."""

from pyspark.sql import functions as F

from pairworks.operators import batch, pairs
from pairworks.sources import catalog as cat


def ask(df):
    return df.select("task_id", F.array(F.struct(F.lit("user").alias("role"), F.col("task_id").cast("string").alias("content"))).alias("messages"))


def plan_of(df, capsys) -> str:
    capsys.readouterr()
    df.explain()
    return capsys.readouterr().out


def test_conversations_are_joined_without_broadcasts(spark, capsys):
    todo = spark.range(1000).withColumnRenamed("id", "task_id")
    run = batch.converse(todo, ask, lambda messages: '{"question": "q", "sql": "SELECT 1"}', 3, batch=1, rounds=2)
    assert run.unfinished.count() == 1000 and run.pairs.count() == 2000
    assert "Broadcast" not in plan_of(run.unfinished, capsys)
    reviews = spark.range(9).selectExpr("'q' || id AS question", "'SELECT ' || id AS sql", "'{}' AS response", "0 AS seq")
    assert "Broadcast" not in plan_of(pairs.apply_reviews(run.pairs.select("question", "sql"), reviews), capsys)


def test_one_file_of_tasks_is_asked_in_many(spark):
    def task_number(messages):
        from pyspark import TaskContext

        return f'{{"question": "{TaskContext.get().partitionId()}", "sql": "SELECT 1"}}'

    todo = spark.range(1000).coalesce(1).withColumnRenamed("id", "task_id")
    asked = batch.run_rounds(todo, ask, task_number, 1).select("question").distinct().count()
    assert asked > 4
    once = batch.complete_batch(ask(todo), task_number).select("text").distinct().count()
    assert once > 4


def test_replies_keep_what_is_carried(spark):
    rows = spark.range(3).select(F.col("id").alias("task_id"), F.when(F.col("id") > 0, F.array(F.lit("t"), F.lit(None))).alias("kept"),
                                 F.when(F.col("id") != 1, F.array(F.struct(F.lit("user").alias("role"), F.lit("x").alias("content")))).alias("messages"))
    got = batch.ask_all(rows, lambda messages: (messages[0]["content"], 1, 2.0), carry=("kept", "messages"), attempts=1).orderBy("task_id").collect()
    assert [(r.kept, r.text, r.in_tok, r.out_tok) for r in got] == [(None, "x", 1, 2), (["t", None], None, None, None), (["t", None], "x", 1, 2)]
    assert got[0].messages[0].content == "x" and got[1].messages is None and got[1].error.startswith("TypeError")


def test_one_list_of_tables_leaves_rows_in_their_tasks(spark, capsys):
    c = cat.load_catalog(spark, {"orders": spark.range(5), "items": spark.range(3)})
    rows = spark.range(0, 1000, 1, 4).withColumn("tables", F.array(F.lit("orders")))
    shown = cat.with_schema(rows, c)
    assert "NestedLoop" not in plan_of(shown, capsys)
    assert shown.where("schema LIKE '%\"orders\":%'").count() == 1000
    none = cat.with_schema(rows.withColumn("tables", F.lit(None).cast("array<string>")), c)
    assert [r.schema for r in none.select("schema").distinct().collect()] == ['{"tables":{}}'] and none.columns == ["id", "tables", "schema"]
