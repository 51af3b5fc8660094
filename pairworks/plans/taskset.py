"""Queries on tasks, prompts, batches and prompt logs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import BLANKS
from ..operators import batch, pairs, prompts, run, tasks
from ..session import scratch_path
from ..sources import catalog as cat
from ..sources import jsonl
from . import checks as ck
from .pairsets import P, PAIRS
from .tables import COLUMNS, NAMES, catalog, feed, query, table

KNOWN = "[" + ", ".join(f"'{n}'" for n in NAMES) + "]"
DEFAULTS = {"parallelism": "10", "tag_schema_json": "true"}

# ---------------------------------------------------------------- phases, one per part

FORMS = ["sample_data", "schema_docs", "schema_relationship", "single_table", "joins", "complex_sqls", "listed", "copies", "builtins", "builtins"]


def phases(spark, sf_dir):
    part, form = table(spark, sf_dir, "part"), F.col("p_partkey") % 10
    only = lambda n, value: F.when(form == n, value)
    size = F.col("p_size")
    mapped = (form == 9) & (size <= 25)
    return part.select(
        F.col("p_partkey").alias("phase_id"),
        F.element_at(F.array(*[F.lit(f) for f in FORMS]), (form + 1).cast("int")).alias("name"),
        F.when(form == 5, F.col("p_name")).when(form == 7, F.col("p_type")).alias("question"),
        only(6, F.array(F.concat(F.lit("about "), "p_name"), F.concat(F.lit("about "), "p_brand"))).alias("questions"),
        F.when(form.isin(1, 4), size).when(form.isin(3, 8, 9), size % 3).when(form == 7, size % 4).alias("count"),
        F.when(form.isin(0, 2) & (size % 2 == 0), size).alias("n_rows"),
        only(5, size % 5 + 2).alias("min_joins"), F.when((form == 3) & (size % 2 == 0), size).alias("parallelism"),
        only(7, F.lit("t.txt")).alias("prompt_template"),
        only(8, F.array(F.lit("max"), F.lit("AVG"))).alias("fns"),
        F.when(mapped, F.create_map(F.lit("SUM"), size % 4, F.lit("MIN"), F.lit(None).cast("int"))).alias("fn_counts"),
        F.create_map(F.lit("dataset_output_file_dir"), F.concat(F.lit("out/"), "p_brand")).alias("settings"))


ONE = " Then provide the SQL query answering it as JSON with keys ''question'' and ''sql''."
MANY = " Provide the SQL answering each question. Return one JSON object per line with keys ''question'' and ''sql''."
FN_QUESTION = f"'Create a natural language question about the ' || replace({{t}}, '_', ' ') || ' table that uses the ' || upper({{f}}) || ' function.{ONE}'"
TABLE_QUESTION = (f"CASE WHEN {{n}} <= 1 THEN 'Create a natural language question about the ' || replace({{t}}, '_', ' ') || ' table.{ONE}' "
                  f"ELSE 'Create ' || {{n}} || ' unique natural language questions about the ' || replace({{t}}, '_', ' ') || ' table.{MANY}' END")
DRAWN = f"({KNOWN})[{ck.hex_draw(chr(34) + 'h' + chr(34), len(NAMES))} + 1]"

# Columns: phase_id, pos, phase, question, table, fn, count, n_rows, min_joins, parallelism.
EXPANDED = f"""k(pos, t) AS ({ck.values(list(enumerate(NAMES)))}),
fns AS (
  SELECT p_partkey AS id, fpos, fn, coalesce(nullif(p_size % 3, 0), 5) AS n FROM part, (VALUES (0, 'max'), (1, 'AVG')) f(fpos, fn) WHERE p_partkey % 10 = 8
  UNION ALL SELECT p_partkey, fpos, fn, CASE fn WHEN 'SUM' THEN coalesce(nullif(p_size % 4, 0), 5) ELSE 5 END FROM part, (VALUES (0, 'SUM'), (1, 'MIN')) f(fpos, fn) WHERE p_partkey % 10 = 9 AND p_size <= 25
  UNION ALL SELECT p_partkey, 0, 'COUNT', p_size % 3 FROM part WHERE p_partkey % 10 = 9 AND p_size > 25),
each AS (SELECT id, fpos, fn, i, md5('0|' || id || '|' || fn || '|' || i) AS h FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM fns)),
per AS (SELECT id, row_number() OVER (PARTITION BY id ORDER BY fpos, i) - 1 AS pos, fn, {DRAWN} AS t FROM each),
tasks(phase_id, pos, phase, question, "table", fn, "count", n_rows, min_joins, parallelism) AS (
SELECT p_partkey, pos, 'sample_data', 'Show me ' || CASE WHEN p_size % 2 = 0 THEN p_size ELSE 2 END || ' sample rows from the ' || t || ' table.', t, NULL, NULL,
  CASE WHEN p_size % 2 = 0 THEN p_size ELSE 2 END, NULL, NULL FROM part, k WHERE p_partkey % 10 = 0
UNION ALL SELECT p_partkey, 0, 'schema_docs', 'Generate ' || p_size || ' unique question-answer pairs about the schema.', NULL, NULL, p_size, NULL, NULL, NULL FROM part WHERE p_partkey % 10 = 1
UNION ALL SELECT p_partkey, 0, 'schema_relationship', 'Generate relationship pairs between tables using sample rows.', NULL, NULL, NULL, CASE WHEN p_size % 2 = 0 THEN p_size ELSE 5 END, NULL, NULL FROM part WHERE p_partkey % 10 = 2
UNION ALL SELECT p_partkey, pos, 'single_table', {TABLE_QUESTION.format(n='(p_size % 3)', t='t')}, t, NULL, p_size % 3, NULL, NULL, least(14, CASE WHEN p_size % 2 = 0 THEN p_size ELSE 10 END) FROM part, k WHERE p_partkey % 10 = 3
UNION ALL SELECT p_partkey, 0, 'joins', 'Generate ' || p_size || ' question/SQL pairs requiring joins.', NULL, NULL, p_size, NULL, 2, NULL FROM part WHERE p_partkey % 10 = 4
UNION ALL SELECT p_partkey, 0, 'complex_sqls', p_name, NULL, NULL, 1, NULL, p_size % 5 + 2, NULL FROM part WHERE p_partkey % 10 = 5
UNION ALL SELECT p_partkey, 0, 'listed', 'about ' || p_name, NULL, NULL, NULL, NULL, NULL, NULL FROM part WHERE p_partkey % 10 = 6
UNION ALL SELECT p_partkey, 1, 'listed', 'about ' || p_brand, NULL, NULL, NULL, NULL, NULL, NULL FROM part WHERE p_partkey % 10 = 6
UNION ALL SELECT p_partkey, unnest(range(0, p_size % 4)), 'copies', p_type, NULL, NULL, NULL, NULL, NULL, NULL FROM part WHERE p_partkey % 10 = 7
UNION ALL SELECT id, pos, 'builtins', {FN_QUESTION.format(t='t', f='fn')}, t, fn, NULL, NULL, NULL, NULL FROM per)"""


def _tasks(name, where=None):
    @query(name, f"WITH {EXPANDED} SELECT * FROM tasks" + (f" WHERE phase IN ({where})" if where else ""))
    def run(spark, sf_dir):
        rows = phases(spark, sf_dir)
        if where:
            rows = rows.where(f"name IN ({where})")
        return tasks.expand_tasks(rows, NAMES, DEFAULTS).drop("metadata")


_tasks("tasks_all")
_tasks("tasks_per_table", "'sample_data', 'single_table'")
_tasks("tasks_single", "'schema_docs', 'schema_relationship', 'joins', 'complex_sqls'")
_tasks("tasks_builtins", "'builtins'")


@query("tasks_phase", f"""WITH {EXPANDED} SELECT phase_id, pos, question, 'count=' || "count" || ',dataset_output_file_dir=out/' || p_brand
|| ',min_joins=2,parallelism=10,tag_schema_json=true' AS metadata FROM tasks JOIN part ON p_partkey = phase_id WHERE phase = 'joins'""")
def tasks_phase(spark, sf_dir):
    found = tasks.expand_tasks(phases(spark, sf_dir), NAMES, DEFAULTS, phase="joins")
    pairs = F.transform(F.map_entries("metadata"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return found.select("phase_id", "pos", "question", F.array_join(F.array_sort(pairs), ",").alias("metadata"))


@query("task_questions", f"""SELECT p_partkey, {FN_QUESTION.format(t="replace(p_name, ' ', '_')", f='p_type')} AS by_function,
{TABLE_QUESTION.format(t="replace(p_name, ' ', '_')", n='p_size')} AS by_table FROM part""")
def task_questions(spark, sf_dir):
    name = F.replace("p_name", F.lit(" "), F.lit("_"))
    return table(spark, sf_dir, "part").select("p_partkey", tasks.function_question(F.col("p_type"), name).alias("by_function"),
                                               tasks.table_question(name, F.col("p_size")).alias("by_table"))


# ---------------------------------------------------------------- prompts

TEMPLATE = """dropped text
### role: system
You write SQL for {{role}}. Unknown {{keys}} stay.

### role: user
SCHEMA_JSON:
{{schema_json}}

{{nl_question}}
"""
LINES = r"\r\n|[\n\x0b\f\r\x1c-\x1e\x85\x{2028}\x{2029}]"


@query("render_prompts", f"""SELECT conv_id, turn, 'system|user' AS roles, 'You write SQL for ' || role || '. Unknown {{{{keys}}}} stay.' AS system,
md5(trim('SCHEMA_JSON:' || chr(10) || '{{"tables":{{}}}}'::VARCHAR || chr(10) || chr(10) || regexp_replace(text, '{LINES}', chr(10), 'g'), '{BLANKS}')) AS user
FROM conversations""")
def render_prompts(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    done = prompts.render_prompts(turns, TEMPLATE, {"schema_json": F.lit('{"tables":{}}'), "nl_question": F.col("text"), "role": F.col("role")})
    at = lambda i: F.element_at("messages", i)
    return done.select("conv_id", "turn", F.array_join(F.transform("messages", lambda m: m["role"]), "|").alias("roles"),
                       at(1)["content"].alias("system"), F.md5(at(2)["content"]).alias("user"))


MARKDOWN = '- **events**: "event_id", "ts"\n- **part**: "p_partkey"'


@query("default_prompt", f"""SELECT conv_id, turn, md5('You are a PostgreSQL expert. Given the database schema and a question,' || chr(10)
|| 'output **only** the SQL query (no explanation) using valid PostgreSQL syntax.' || chr(10)
|| CASE role WHEN 'user' THEN 'Ensure the SQL **includes** the function `COUNT`.' ELSE '' END || chr(10) || chr(10) || 'Schema:' || chr(10) || '{MARKDOWN}'
|| chr(10) || chr(10) || 'Question: ' || text || chr(10) || 'SQL:') AS digest FROM conversations""")
def default_prompt(spark, sf_dir):
    made = prompts.default_prompt(F.col("text"), F.lit(MARKDOWN), fn=F.when(F.col("role") == "user", "COUNT"))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", F.md5(made).alias("digest"))


@query("fewshot", f"""WITH {P}, d AS (SELECT DISTINCT question, sql FROM p),
e AS (SELECT md5('0|' || question || '|' || sql) AS h, 'Q: ' || question || chr(10) || 'A: ```SQL' || chr(10) || sql || chr(10) || '```' AS block FROM d),
r AS (SELECT block, row_number() OVER (ORDER BY h) - 1 AS i FROM e), n AS (SELECT count(*) AS n FROM r),
lists AS (SELECT a.i, a.block || chr(10) || chr(10) || b.block AS examples FROM n, r a JOIN r b ON b.i = (a.i + 1) % n.n)
SELECT conv_id, turn, md5(examples) AS examples FROM n, conversations JOIN lists ON lists.i = {ck.hex_draw("md5('0|question|' || text)", "n.n")}""")
def fewshot(spark, sf_dir):
    questions = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("text").alias("question"))
    return prompts.fewshot(questions, feed(spark, sf_dir, PAIRS)).select("conv_id", "turn", F.md5("examples").alias("examples"))


LISTING = chr(10).join(sorted(f"- **{t}**: " + ", ".join(f'"{c}"' for c, _ in COLUMNS[t]) for t in NAMES))


@query("task_message", f"""WITH {EXPANDED} SELECT phase_id, pos, md5('{prompts.AGENT}{LISTING}' || CASE phase WHEN 'builtins' THEN '{prompts.ASK_FUNCTION.replace("'", "''")}'
ELSE '{prompts.ASK_SQL.replace("'", "''")}' END) AS system, phase, question, '49.5' AS budget_left, 'out/' || p_brand AS dir, "table", "count"::VARCHAR AS "count",
fn AS builtins, n_rows::VARCHAR AS n_rows FROM tasks JOIN part ON p_partkey = phase_id""")
def task_message(spark, sf_dir):
    found = tasks.expand_tasks(phases(spark, sf_dir), NAMES, DEFAULTS)
    listing = "\n".join(r.line for r in cat.schema_markdown(catalog(spark, sf_dir)).orderBy("table").collect())
    made = prompts.task_message(found, listing, 49.5)
    at = lambda i: F.element_at("messages", i)["content"]
    said = lambda k, name=None: F.get_json_object(at(2), f"$.{k}").alias(name or k)
    return made.select("phase_id", "pos", F.md5(at(1)).alias("system"), said("phase"), said("question"), said("budget_left"),
                       said("dataset_output_file_dir", "dir"), said("table"), said("count"), said("builtins"), said("n_rows"))


LOGS = """SELECT doc_id, 'Prompt' || chr(10) || 'SCHEMA_JSON:' || chr(10) || '{{"tables": {{"t' || CAST(doc_id AS STRING) || '": {{"columns": {{}}}}, "b": {{}}}}}}' || chr(10) || chr(10)
|| 'SAMPLE_ROWS:' || chr(10) || text || chr(10) || 'Schema:  ' || chr(10) || '- **x**: "c", "d: e"' || chr(10) || chr(10) || '- y' || chr(10) || 'End: - not: cut' || chr(10) || '- a: b' AS text FROM {documents}"""


@query("compact_log", f"""SELECT doc_id, md5('Prompt' || chr(10) || 'SCHEMA_JSON:' || chr(10) || '{{' || chr(10) || '  "tables": [' || chr(10) || '    "t' || doc_id || '",' || chr(10) || '    "b"' || chr(10) || '  ]' || chr(10) || '}}' || chr(10) || chr(10)
|| 'SAMPLE_ROWS:' || chr(10) || regexp_replace(text, '{LINES}', chr(10), 'g') || chr(10) || 'Schema:' || chr(10) || '- **x**' || chr(10) || chr(10) || '- y' || chr(10) || 'End: - not: cut' || chr(10) || '- a: b') AS digest
FROM documents""")
def compact_log(spark, sf_dir):
    return feed(spark, sf_dir, LOGS).select("doc_id", F.md5(prompts.compact_log(F.col("text"))).alias("digest"))


@query("review_messages", """SELECT conv_id, turn, 'system|user' AS roles,
md5('Question: ' || coalesce(role, '') || chr(10) || 'SQL Candidate:' || chr(10) || coalesce(text, '') || chr(10) || chr(10) || 'Schema:' || chr(10) || '- **t**') AS user
FROM conversations""")
def review_messages(spark, sf_dir):
    asked = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.col("role").alias("question"), F.col("text").alias("sql"))
    asked = prompts.review_messages(asked, "- **t**")
    return asked.select("conv_id", "turn", F.array_join(F.transform("messages", lambda m: m["role"]), "|").alias("roles"),
                        F.md5(F.element_at("messages", -1)["content"]).alias("user"))


def critic(messages):
    """Mends what names a price, gives nonsense for what names a status, else keeps the SQL by giving no fix."""
    said = messages[-1]["content"]
    sql = said.split("SQL Candidate:\n")[1].split("\n\nSchema:")[0]
    if "price" in sql:
        return '{"score": 0.5, "reason": "r", "fixed_sql": "' + sql.replace("price", "o_totalprice") + '"}'
    return "no JSON" if "status" in sql else '{"score": 1}'


@query("reviewed", """WITH p AS (SELECT o_orderkey, (['price', 'status', 'o_custkey'])[(o_orderkey % 3 + 1)::INT] AS c FROM orders)
SELECT 'q' || o_orderkey AS question, 'SELECT ' || CASE c WHEN 'price' THEN 'o_totalprice' ELSE c END || ' FROM orders' AS sql,
CASE c WHEN 'price' THEN 0.5 WHEN 'status' THEN 0.0 ELSE 1.0 END::DOUBLE AS score FROM p""")
def reviewed(spark, sf_dir):
    column = F.element_at(F.array(F.lit("price"), F.lit("status"), F.lit("o_custkey")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    asked = table(spark, sf_dir, "orders").select(F.concat(F.lit("q"), F.col("o_orderkey").cast("string")).alias("question"),
                                                  F.concat(F.lit("SELECT "), column, F.lit(" FROM orders")).alias("sql"))
    return pairs.apply_reviews(asked, batch.reviewer("- **orders**", critic)(asked)).select("question", "sql", "score")


# ---------------------------------------------------------------- batches and rounds

def echo(messages):
    return "echo: " + messages[-1]["content"]


@query("complete_batch", "SELECT conv_id, turn, md5('echo: ' || text) AS digest FROM conversations")
def complete_batch(spark, sf_dir):
    asked = table(spark, sf_dir, "conversations").withColumn(
        "messages", F.array(F.struct(F.lit("system").alias("role"), F.lit("Be brief.").alias("content")), F.struct(F.col("role"), F.col("text").alias("content"))))
    return batch.complete_batch(asked, echo, ("conv_id", "turn")).select("conv_id", "turn", F.md5("text").alias("digest"))


def eager_or_slow(messages):
    """Even tasks answer in full, odd ones with a single pair per round; a conversation that is not whole gets no pair."""
    task, asked = map(int, messages[0]["content"].split("|"))
    turn, reply = len(messages) // 2, lambda t, n: "\n".join(f'{{"question": "q{t}-{i}", "sql": "SELECT {i}"}}' for i in range(n))
    amount = lambda n: n if task % 2 == 0 else 1
    for t in range(turn):
        said, follow = messages[2 * t + 1], messages[2 * t + 2]
        if said != {"role": "assistant", "content": reply(t, amount(asked))} or follow["role"] != "user":
            return "the history is broken"
        asked = int(follow["content"].removeprefix("Generate ").split()[0])
    return reply(turn, amount(asked))


def _numbers_prompt(*columns):
    """A prompt function: the columns' values, parted by bars, as the only message."""
    return lambda df: df.select("task_id", F.array(F.struct(F.lit("user").alias("role"), F.concat_ws(
        "|", *[F.col(c).cast("string") for c in columns]).alias("content"))).alias("messages"))


@query("run_rounds", """SELECT o_orderkey AS task_id, round, 'q' || round || '-' || i AS question FROM orders,
(VALUES (0, 0, 0), (0, 0, 1), (0, 1, 0), (1, 0, 0), (1, 1, 0), (1, 2, 0)) v(odd, round, i) WHERE o_orderkey % 2 = odd""")
def run_rounds(spark, sf_dir):
    """Three pairs per order, at most two per reply; each round sends what was said before."""
    open_ = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task_id"))
    return batch.run_rounds(open_, _numbers_prompt("task_id", "asked"), eager_or_slow, 3, batch=2).select("task_id", "round", "question")


RUN_BUDGET = 1.0


def counted(messages):
    """A pair with the tokens it took: fewer than were reckoned with."""
    key = int(messages[0]["content"].split("|")[0]) - 100_000_000
    return '{"question": "q", "sql": "S"}', 2, 10 * (key % 7)


@query("run_budget", f"""WITH o AS (SELECT o_orderkey AS task_id, row_number() OVER (ORDER BY o_orderkey) AS i,
2 * 5 + 10 * (o_orderkey % 7) * 15 AS cost FROM orders),
r0 AS (SELECT *, {round(RUN_BUDGET * 1e6)} // (3 * 5 + 100 * 15) AS n FROM o),
l AS (SELECT {round(RUN_BUDGET * 1e6)} - sum(cost) AS l FROM r0 WHERE i <= n),
r1 AS (SELECT r0.*, l // (3 * 5 + 100 * 15) AS m FROM r0, l)
SELECT task_id, CASE WHEN i <= n THEN 0 ELSE 1 END AS turn, 2::BIGINT AS in_tok, 10 * (task_id % 7) AS out_tok FROM r1 WHERE i <= n + m""")
def run_budget(spark, sf_dir):
    """One pair per order until the money is gone: what the first round left of its estimates pays for the second, of two."""
    open_ = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("task_id"), (F.col("o_orderkey") + 100_000_000).alias("number"))
    run = batch.converse(open_, _numbers_prompt("number", "asked"), counted, 1, rounds=2, budget=RUN_BUDGET)
    return run.usage.select("task_id", "turn", "in_tok", "out_tok")


def one_answer(messages):
    """One JSON object, or plain SQL for every third customer; every seventh fails."""
    fn, name, question = messages[1]["content"].split("|")
    key = int(question.split()[-1])
    sql = f"SELECT {fn}(*) FROM {name} WHERE o_custkey = {key};"
    if key % 7 == 0:
        return '{"question": "none", "sql": "FAIL"}'
    return sql if key % 3 == 0 else f'{{"question": "Orders of {key}?", "sql": "{sql}", "rows": []}}'


@query("run_phase_builtins", """SELECT CASE WHEN c_custkey % 3 = 0 THEN 'How many orders has ' || c_custkey ELSE 'Orders of ' || c_custkey || '?' END AS question,
'SELECT COUNT(*) FROM orders WHERE o_custkey = ' || c_custkey AS sql FROM customer WHERE c_custkey % 7 <> 0""")
def run_phase_builtins(spark, sf_dir):
    """A phase whose replies are single objects, from tasks to the written dataset."""
    asked = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("phase_id"), F.lit(0).alias("pos"), F.lit("builtins").alias("phase"), F.concat_ws(" ", F.lit("How many orders has"), F.col("c_custkey").cast("string")).alias("question"),
        F.lit("orders").alias("table"), F.lit("COUNT").alias("fn"), F.lit(None).cast("int").alias("count"), F.lit(None).cast("int").alias("min_joins"), F.lit(None).cast("string").alias("metadata"))
    template = "### role: system\nAnswer with one object.\n### role: user\n{{builtin}}|{{table}}|{{nl_question}}"
    root = scratch_path(spark, "phase")
    run.run_phase(asked, catalog(spark, sf_dir), template, one_answer, root, "builtins", "v1")
    return jsonl.read_version(spark, root, "builtins", "v1", "question string, sql string")
