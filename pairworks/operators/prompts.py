"""Prompts: templates, default text, few-shot blocks and compact logs."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions.hashing import digest, draw
from ..session import cut_lineage
from .windows import row_number

# The mark that opens a message in a template, and the wording of untemplated prompts.
ROLE_MARK = "### role:"
DEFAULT_PROMPT = """You are a PostgreSQL expert. Given the database schema and a question,
output **only** the SQL query (no explanation) using valid PostgreSQL syntax.
{clause}

Schema:
{schema}

{examples}Question: {question}
SQL:"""
FUNCTION_CLAUSE = "Ensure the SQL **includes** the function `{fn}`."
EXAMPLE = "Q: {question}\nA: ```SQL\n{sql}\n```"
AGENT = "You are a data-engineer agent. Here is the schema:\n"
ASK_FUNCTION = (" Return a JSON object with 'question' and 'sql'. Come up with a question that demonstrates the given builtin function"
                " and use the tools to generate the SQL.")
ASK_SQL = " Return a JSON object with only a 'sql' field containing the valid query."


def fill(template: str | Column, values: dict[str, Column]) -> Column:
    """The template with every ``{{key}}`` replaced in the given order; unknown keys stay."""
    out = template if isinstance(template, Column) else F.lit(template)
    for key, value in values.items():
        out = F.replace(out, F.lit("{{" + key + "}}"), F.coalesce(value, F.lit("")))
    return out


def messages(text) -> Column:
    """``array<struct<role,content>>`` of the blocks; text before the first one is dropped."""
    flat = F.regexp_replace(text, tx.LINE_END, "\n")
    blocks = F.split(F.concat(F.lit("\n"), flat), "\n" + re.escape(ROLE_MARK))
    blocks = F.slice(blocks, F.lit(2), F.greatest(F.size(blocks) - 1, F.lit(0)))
    head = lambda b: F.substring_index(b, "\n", 1)
    return F.transform(blocks, lambda b: F.struct(
        tx.strip(head(b)).alias("role"),
        tx.strip(F.right(b, F.length(b) - F.length(head(b)))).alias("content")))


def render_prompts(tasks: DataFrame, template: str | Column, values: dict[str, Column]) -> DataFrame:
    return tasks.withColumn("messages", messages(fill(template, values)))


def default_prompt(question, markdown, fn=None, examples=None) -> Column:
    """Prompt text where no template is set, with optional required function and example block."""
    none = F.lit("")
    clause = none if fn is None else F.coalesce(tx.say(FUNCTION_CLAUSE, fn=fn), none)
    block = none if examples is None else F.coalesce(F.concat(F.nullif(examples, none), F.lit("\n\n")), none)
    return tx.say(DEFAULT_PROMPT, clause=clause, schema=markdown, examples=block, question=question)


def fewshot(questions: DataFrame, examples: DataFrame, k: int = 2, seed: int = 0) -> DataFrame:
    """Adds ``examples``: up to ``k`` example pairs as ``Q:``/``A:`` blocks.

    The distinct examples are numbered in the order of their hash; a question draws a number and takes the ``k`` examples from
    there on, the first following the last, so every example can be drawn.  Without examples the text is empty; a question
    that is null draws none and gets null.
    """
    h = digest(seed, F.col("question"), F.col("sql"))
    block = tx.say(EXAMPLE, question=F.col("question"), sql=F.col("sql"))
    hashed = examples.select("question", "sql").distinct().select(h.alias("h"), block.alias("block")).where("h IS NOT NULL")
    numbered = cut_lineage(row_number(hashed, [], [], "h", "number"))
    n = numbered.count()
    if not n:
        return questions.withColumn("examples", F.when(F.col("question").isNotNull(), ""))
    # an example is the first of the list of its own number, the second of the number before, and so on
    places = F.transform(F.sequence(F.lit(0), F.lit(min(k, n) - 1)), lambda j: F.struct(j.alias("j"), F.pmod(F.col("number") - 1 - j, F.lit(n)).alias("drawn")))
    listed = numbered.select("block", F.explode(places).alias("p")).groupBy(F.col("p.drawn").alias("_drawn")).agg(
        F.array_sort(F.collect_list(F.struct("p.j", "block"))).alias("bs"))
    lists = listed.select("_drawn", F.array_join(F.transform("bs", lambda b: b["block"]), "\n\n").alias("examples"))
    asked = questions.withColumn("_drawn", draw(digest(seed, "question", F.col("question")), n))
    return asked.join(lists, "_drawn", "left").drop("_drawn")


def task_message(tasks: DataFrame, markdown: str, budget_left: float) -> DataFrame:
    """Adds ``messages``: the system text with the schema, and the task with its metadata as JSON.

    A question in the metadata, which is the phase's own, goes before the task's.
    """
    ask = F.when(F.col("phase") == "builtins", ASK_FUNCTION).otherwise(ASK_SQL)
    system = F.concat(F.lit(AGENT + markdown), ask)
    user = F.to_json(F.map_concat(
        F.create_map(F.lit("phase"), F.col("phase"), F.lit("question"), F.coalesce(F.col("metadata")["question"], "question")),
        F.map_filter("metadata", lambda k, _: ~k.isin("phase", "question", "budget_left")),
        F.create_map(F.lit("budget_left"), F.lit(str(budget_left)))), {"ignoreNullFields": "false"})
    return tasks.withColumn("messages", F.array(F.struct(F.lit("system").alias("role"), system.alias("content")),
                                                F.struct(F.lit("user").alias("role"), user.alias("content"))))


# What a reviewer is told and shown.
REVIEWER = ("Critic persona: Review SQL for correctness, index usage, security. "
            "Respond with a JSON object: {'score': 0-1, 'reason': str, 'fixed_sql': str}.")
REVIEWED = "Question: {question}\nSQL Candidate:\n{sql}\n\nSchema:\n{schema}"


def review_messages(pairs: DataFrame, markdown: str) -> DataFrame:
    """Adds ``messages``, which ask for a review of each ``question, sql`` against the schema; nulls are shown as empty."""
    shown = lambda c: F.coalesce(F.col(c), F.lit(""))
    user = tx.say(REVIEWED, question=shown("question"), sql=shown("sql"), schema=F.lit(markdown))
    return pairs.withColumn("messages", F.array(F.struct(F.lit("system").alias("role"), F.lit(REVIEWER).alias("content")),
                                                F.struct(F.lit("user").alias("role"), user.alias("content"))))


# a schema line without what trails it; the items of a listing, each from the line before on, cut at their first colon
LISTING_HEAD = r"(?imU)^([^\S\n]*schema:[^\n]*?)[^\S\n]++$"
LISTING_ITEM = (r"(?imU)((?:^[^\S\n]*schema:[^\n]*|\G(?!\A))(?:\n(?:-[^:\n]*(?=\n|\z)|[^\S\n]*(?=\n|\z)))*+"
                r"\n-[^:\n]*):[^\n]*")


def short_listings(text) -> Column:
    """Cut the items of every ``schema:`` listing at their first colon."""
    flat = F.regexp_replace(F.regexp_replace(text, tx.LINE_END, "\n"), r"\n\z", "")
    return F.regexp_replace(F.regexp_replace(flat, LISTING_HEAD, "$1"), LISTING_ITEM, "$1")


def compact_log(text) -> Column:
    """Prompt text with schema details removed: JSON schemas keep table names, listings keep item names."""
    text = F.coalesce(text, F.lit(""))
    at = F.instr(text, "SCHEMA_JSON:")
    before = F.when(at > 0, F.left(text, at - 1)).otherwise(text)
    after = F.when(at > 0, F.ltrim(F.right(text, F.length(text) - at - 11), F.lit(tx.BLANKS))).otherwise("")
    gap = F.instr(after, "\n\n")
    body = F.when(gap > 0, F.left(after, gap - 1)).otherwise(after)
    tail = F.when(gap > 0, F.right(after, F.length(after) - gap - 1)).otherwise("")
    value = tx.one_json_value(body)
    names = F.coalesce(F.json_object_keys(F.get_json_object(body, "$.tables")),
                       F.try_variant_get(value, "$.tables", "array<string>"), F.array().cast("array<string>"))
    listed = F.when(F.size(names) > 0, F.concat(F.lit('{\n  "tables": [\n    "'), F.array_join(names, '",\n    "'),
                                                F.lit('"\n  ]\n}'))).otherwise(F.lit('{\n  "tables": []\n}'))
    short = F.when(tx.is_object(value), listed).otherwise(F.lit("{}"))
    whole = F.concat(before, F.lit("SCHEMA_JSON:\n"), short, F.when(tail != "", F.concat(F.lit("\n\n"), tail)).otherwise(""))
    text = F.when(F.contains(F.lower(text), F.lit("schema_json:")), whole).otherwise(text)
    return F.when(F.contains(F.lower(text), F.lit("schema:")), short_listings(text)).otherwise(text)
