"""Expansion of generation phases into tasks.

A phase row has the columns of ``PHASES``; ``fns`` and ``fn_counts`` are the two ways to name functions,
``settings`` holds everything else.  A task row has ``phase_id, pos, phase, question``, the typed columns
``table, fn, count, n_rows, min_joins, parallelism`` and ``metadata``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import digest, draw, pick
from ..functions.text import say

PHASES = ("phase_id long, name string, question string, questions array<string>, count int, n_rows int, "
          "min_joins int, parallelism int, prompt_template string, fns array<string>, fn_counts map<string,int>, "
          "settings map<string,string>")

# Wording of the task questions, and the defaults of the phases.
FUNCTION_QUESTION = ("Create a natural language question about the {table} table that uses the {fn} function."
                     " Then provide the SQL query answering it as JSON with keys 'question' and 'sql'.")
TABLE_QUESTION = ("Create a natural language question about the {table} table."
                  " Then provide the SQL query answering it as JSON with keys 'question' and 'sql'.")
TABLE_QUESTIONS = ("Create {count} unique natural language questions about the {table} table."
                   " Provide the SQL answering each question. Return one JSON object per line with keys 'question' and 'sql'.")
SAMPLE_QUESTION = "Show me {n_rows} sample rows from the {table} table."
DOCS_QUESTION = "Generate {count} unique question-answer pairs about the schema."
RELATION_QUESTION = "Generate relationship pairs between tables using sample rows."
JOIN_QUESTION = "Generate {count} question/SQL pairs requiring joins."
COMPLEX_QUESTION = "Generate {count} complex question/SQL pairs requiring joins."
SAMPLE_ROWS, RELATION_ROWS, JOIN_TABLES, COMPLEX_TABLES, PER_FUNCTION = 2, 5, 2, 3, 5


TASK = "struct<question:string,table:string,fn:string,count:int,n_rows:int,min_joins:int,parallelism:int>"
# tasks made from one row, and about how many a Spark task makes
RANGE, SHARE = 10_000, 200_000


def spaced(table) -> Column:
    return F.replace(table, F.lit("_"), F.lit(" "))


def function_question(fn, table) -> Column:
    return say(FUNCTION_QUESTION, table=spaced(table), fn=F.upper(fn))


def table_question(table, count) -> Column:
    many = say(TABLE_QUESTIONS, table=spaced(table), count=count)
    return F.when(count <= 1, say(TABLE_QUESTION, table=spaced(table))).otherwise(many)


def overlay(base, over) -> Column:
    """Map union in which the second map wins."""
    return F.map_concat(F.map_filter(base, lambda k, _: ~F.map_contains_key(over, k)), over)


def _task(question, table=None, fn=None, count=None, n_rows=None, min_joins=None, parallelism=None) -> Column:
    part = lambda v, t, name: (F.lit(None) if v is None else v).cast(t).alias(name)
    return F.struct(question.alias("question"), part(table, "string", "table"), part(fn, "string", "fn"),
                    part(count, "int", "count"), part(n_rows, "int", "n_rows"),
                    part(min_joins, "int", "min_joins"), part(parallelism, "int", "parallelism"))


def _run(pos, n, way: str, task=None, fn=None) -> Column:
    """Tasks from place ``pos`` on: one that is written out, or ``n`` that are made from a function or from a drawn one."""
    return F.struct(F.lit(pos).cast("long").alias("pos"), F.greatest(F.lit(n).cast("long"), F.lit(0)).alias("n"), F.lit(way).alias("way"),
                    F.lit(fn).cast("string").alias("fn"), F.lit(task).cast(TASK).alias("task"))


def expand_tasks(phases: DataFrame, tables: list[str], defaults: dict[str, str] | None = None,
                 phase: str | None = None, seed: int = 0, default_fns: list[str] | None = None) -> DataFrame:
    """All tasks of the phases; random tables are drawn by hash of the seed.

    A phase becomes runs of equal tasks, whose places follow from the counts before them; a run is cut into number ranges and
    those into tasks, so no row ever holds a phase.  Ranges of more than ``SHARE`` tasks in all are dealt to several Spark tasks.
    """
    defaults, default_fns = defaults or {}, default_fns or ["COUNT"]
    if phase is not None:
        phases = phases.where(F.col("name") == phase)
    known = F.array(*[F.lit(t) for t in tables]) if tables else F.array(F.lit("table_1"))
    name, given = F.lower(F.col("name")), F.col("count")
    count = F.coalesce(given, F.lit(1))
    asked = lambda template: F.coalesce(F.col("question"), say(template, count=count))

    n_rows = F.coalesce("n_rows", F.lit(SAMPLE_ROWS))
    samples = F.transform(known if tables else F.array().cast("array<string>"), lambda t: _task(
        say(SAMPLE_QUESTION, n_rows=n_rows, table=t), table=t, n_rows=n_rows))
    docs = F.array(_task(asked(DOCS_QUESTION), count=count))
    relations = F.array(_task(asked(RELATION_QUESTION),
                              n_rows=F.coalesce("n_rows", F.lit(RELATION_ROWS))))
    workers = F.least(F.size(known), F.coalesce("parallelism", F.lit(defaults.get("parallelism")).cast("int"), F.size(known)))
    single = F.transform(known, lambda t: _task(table_question(t, count), table=t, count=count, parallelism=workers))
    joins = F.array(_task(asked(JOIN_QUESTION), count=count,
                          min_joins=F.coalesce("min_joins", F.lit(JOIN_TABLES))))
    complex_ = F.array(_task(asked(COMPLEX_QUESTION), count=count,
                             min_joins=F.coalesce("min_joins", F.lit(COMPLEX_TABLES))))
    listed = F.transform("questions", lambda q: _task(q))
    each = lambda found: F.transform(found, lambda t, i: _run(i, 1, "task", t))
    copies = F.array(_run(0, count, "task", _task(F.coalesce("question", F.lit("")))))

    def table_for(fn, i):
        if not tables:
            return F.concat(F.lit("table_"), i.cast("string"))
        return F.get(known, draw(digest(seed, F.col("phase_id"), fn, i), len(tables)).cast("int"))

    some = lambda n: F.greatest(F.coalesce(F.nullif(n, F.lit(0)), F.lit(PER_FUNCTION)), F.lit(0)).cast("long")
    entries = F.map_entries("fn_counts")
    before = lambda i: F.aggregate(F.slice(entries, F.lit(1), i), F.lit(0).cast("long"), lambda sum_, e: sum_ + some(e["value"]))
    by_map = F.transform(entries, lambda e, i: _run(before(i), some(e["value"]), "fn", fn=e["key"]))
    by_list = F.transform("fns", lambda f, i: _run(i * some(given), some(given), "fn", fn=f))
    fallback = F.array(_run(0, F.coalesce(given, F.lit(0)), "drawn"))
    default_fn = lambda i: pick(default_fns, digest(seed, F.col("phase_id"), F.lit("fn"), i))
    named = (F.size(F.coalesce("fns", F.array().cast("array<string>"))) > 0) | (
        F.size(F.map_keys(F.coalesce("fn_counts", F.create_map().cast("map<string,int>")))) > 0)

    forms = (F.when(name == "sample_data", each(samples)).when(name == "schema_docs", each(docs))
             .when(name == "schema_relationship", each(relations)).when(name == "single_table", each(single))
             .when(name == "joins", each(joins)).when(name == "complex_sqls", each(complex_))
             .when(F.size(F.coalesce("questions", F.array().cast("array<string>"))) > 0, each(listed))
             .when(F.col("prompt_template").isNotNull() & ~named, copies)
             .when(F.col("fn_counts").isNotNull(), by_map).when(F.col("fns").isNotNull(), by_list)
             .otherwise(fallback))

    given_map = lambda names: F.map_from_entries(F.filter(F.array(*[
        F.struct(F.lit(n).alias("key"), F.col(n).cast("string").alias("value")) for n in names]), lambda e: e["value"].isNotNull()))
    base = F.create_map(*[F.lit(x) for kv in defaults.items() for x in kv]).cast("map<string,string>")
    settings = overlay(F.coalesce("settings", F.create_map().cast("map<string,string>")),
                       given_map(["question", "n_rows", "min_joins", "parallelism", "prompt_template"]))
    runs = phases.select("phase_id", F.col("name").alias("phase"), overlay(base, settings).alias("base"), F.explode(forms).alias("run"))
    total = runs.agg(F.sum("run.n")).first()[0] or 0
    starts = F.when(F.col("run.n") > 0, F.sequence(F.lit(0).cast("long"), F.col("run.n") - 1, F.lit(RANGE).cast("long"))).otherwise(F.array().cast("array<long>"))
    ranges = runs.withColumn("start", F.explode(starts))
    if total > SHARE:
        ranges = ranges.repartition(-(-total // SHARE), "phase_id", "run.pos", "start")
    numbers = F.sequence(F.col("start"), F.least(F.col("start") + (RANGE - 1), F.col("run.n") - 1), F.lit(1).cast("long"))
    i = F.col("i") + 1
    out = ranges.withColumn("i", F.explode(numbers)).withColumn("pos", F.col("run.pos") + F.col("i"))
    out = out.withColumn("_fn", F.when(F.col("run.way") == "fn", F.col("run.fn")).when(F.col("run.way") == "drawn", default_fn(i)))
    out = out.withColumn("_table", F.when(F.col("run.way") != "task", table_for(F.col("_fn"), i)))
    made = _task(function_question(F.col("_fn"), F.col("_table")), table=F.col("_table"), fn=F.col("_fn"))
    out = out.withColumn("t", F.when(F.col("run.way") == "task", F.col("run.task")).otherwise(made))
    typed = ["table", "fn", "count", "n_rows", "min_joins", "parallelism"]
    own = F.map_from_entries(F.filter(F.array(*[
        F.struct(F.lit("builtins" if c == "fn" else c).alias("key"), F.col(f"t.{c}").cast("string").alias("value"))
        for c in typed]), lambda e: e["value"].isNotNull()))
    return out.select("phase_id", "pos", "phase", "t.question", *[F.col(f"t.{c}").alias(c) for c in typed],
                      overlay(F.col("base"), own).alias("metadata"))
