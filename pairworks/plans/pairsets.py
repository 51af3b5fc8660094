"""Queries on pairs: reading replies, cleaning, linting, deduplicating, tagging, reviewing, budgets."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as tx
from ..operators import lint, pairs, probe, table_sets, usage
from ..session import scratch_path
from ..sources import jsonl
from ..streaming import ingest
from . import checks as ck
from .tables import NAMES, catalog, check_sql, feed, query, table

# ---------------------------------------------------------------- feeds derived from the tables

# Candidate pairs: one per event, with line breaks, closing marks, failures and repeats.
PAIRS = """SELECT user_id AS task_id, event_id AS pos,
'What about ' || event_type || ' ' || CAST(user_id % 40 AS STRING) || '?' AS question,
'Answer ' || CAST(user_id % 20 AS STRING) AS answer,
CASE event_type
WHEN 'click' THEN 'SELECT COUNT(*)' || chr(10) || '  FROM events' || chr(9) || 'WHERE user_id = ' || CAST(user_id AS STRING) || ' ;'
WHEN 'view' THEN 'SELECT AVG(value), MAX(value) FROM events JOIN customer ON user_id = c_custkey WHERE c_nationkey = ' || CAST(user_id % 25 AS STRING) || ';;'
WHEN 'purchase' THEN 'SELECT MAX(o_totalprice) FROM orders o JOIN public.customer c ON o.o_custkey = c.c_custkey JOIN "nation" n ON c.c_nationkey = n.n_nationkey WHERE n.n_name = ''NATION_'
  || CAST(user_id % 25 AS STRING) || ''' AND o.o_orderstatus = ''F'' AND o.o_totalprice > ' || CAST(user_id AS STRING) || ';'
WHEN 'signup' THEN 'WITH x AS (SELECT user_id FROM sessions) SELECT COUNT(*) FROM x WHERE user_id = ' || CAST(user_id AS STRING)
WHEN 'error' THEN CASE WHEN user_id % 2 = 0 THEN 'FAIL' ELSE '   ' END END AS sql
FROM {events}"""

# Model replies: one per event, in every shape the reader must handle.
REPLIES = """SELECT event_id AS task_id, CASE event_type
WHEN 'click' THEN 'Here are the pairs:' || chr(10) || '1. {{"question": "q' || CAST(user_id AS STRING) || '", "sql": "SELECT ' || CAST(user_id % 9 AS STRING) || ';"}}' || chr(10)
  || '2. {{"question": "r' || CAST(event_id % 31 AS STRING) || '", "sql": "SELECT value FROM events"}}'
WHEN 'view' THEN '```json' || chr(10) || '[{{"question": "q' || CAST(user_id AS STRING) || '", "answer": "a' || CAST(event_id AS STRING) || '"}},' || chr(10) || '{{"question": "s", "answer": "b"}}, 7]' || chr(10) || '```'
WHEN 'purchase' THEN '{{"pairs": [{{"question": "p' || CAST(user_id AS STRING) || '", "sql": "SELECT 1"}}, {{"sql": "SELECT 2"}}, [1]]}}'
WHEN 'signup' THEN '- {{"question": "u' || CAST(user_id AS STRING) || '", "sql": "SELECT 3"}},' || chr(10) || '* `{{"question": "v' || CAST(event_id % 17 AS STRING) || '", "sql": "FAIL"}}`' || chr(10) || '{{broken' || chr(10) || 'done.'
ELSE '{{' || chr(10) || '"question": "w", "sql": "SELECT 4"' || chr(10) || '}}' END AS text
FROM {events}"""

# Single answers: JSON objects around whole documents, plain text otherwise.
ANSWERS = """SELECT doc_id AS task_id, 'asked ' || source AS question, CASE doc_id % 4
WHEN 0 THEN '{{"sql": "SELECT ' || CAST(n_chars AS STRING) || ' ;", "rows": [{{"a": 1}}, {{"a": 2}}]}}'
WHEN 1 THEN '{{"question": "own ' || lang || '", "sql": "SELECT' || chr(92) || 'n' || CAST(doc_id AS STRING) || '"}}'
WHEN 2 THEN '{{"question": "no sql"}}' ELSE text END AS text FROM {documents}"""

CHECKED_LINES = f"""lines AS (SELECT task_id, list_filter(list_transform(list_filter(list_transform(string_split(text, chr(10)), lambda l: trim(l)),
lambda l: l <> '' AND NOT starts_with(l, '```')), lambda l: {ck.bare('l')}), lambda l: l <> '' AND left(l, 1) IN ('[', '{{', ']', '}}')) AS ls
FROM ({check_sql(REPLIES)}))"""

CHECKED_PAIRS = f"""{CHECKED_LINES},
whole AS (SELECT task_id, ls, CASE WHEN json_valid(array_to_string(ls, chr(10))) THEN array_to_string(ls, chr(10))::JSON END AS j FROM lines),
items AS (SELECT task_id, CASE WHEN j IS NULL THEN list_transform(list_filter(ls, lambda l: json_valid(l)), lambda l: l::JSON)
WHEN json_type(j, '$.pairs') = 'ARRAY' THEN json_extract(j, '$.pairs[*]') WHEN json_type(j) = 'ARRAY' THEN json_extract(j, '$[*]') ELSE [j] END AS xs FROM whole),
flat AS (SELECT task_id, unnest(xs) AS x, generate_subscripts(xs, 1) - 1 AS pos FROM items),
parsed AS (SELECT task_id, row_number() OVER (PARTITION BY task_id ORDER BY pos) - 1 AS pos, x->>'$.question' AS question, x->>'$.sql' AS sql, x->>'$.answer' AS answer FROM flat
WHERE json_type(x) = 'OBJECT' AND x->>'$.question' IS NOT NULL)"""

P = f"p AS ({check_sql(PAIRS)}), c AS (SELECT task_id, pos, question, answer, {ck.clean('sql')} AS sql FROM p)"
GOOD = "g AS (SELECT * FROM c WHERE sql NOT IN ('FAIL', ''))"


def firsts(source, key, order="task_id, pos", n=1):
    return f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn FROM {source}) WHERE rn <= {n}"


# ---------------------------------------------------------------- cleaning and reading

@query("clean_sql", f"""SELECT doc_id, md5({ck.clean("text || ' ;;'")}) AS digest FROM documents""")
def clean_sql(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(tx.clean_sql(F.concat("text", F.lit(" ;;")))).alias("digest"))


@query("strip_fence", """SELECT doc_id, md5(regexp_replace(trim(trim('```sql' || chr(10) || text || ' ```', chr(10) || ' '), '`'), '(?i)^sql\\s*', '')) AS digest FROM documents""")
def strip_fence(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.md5(tx.strip_fence(F.concat(F.lit("```sql\n"), "text", F.lit(" ```")))).alias("digest"))


@query("parse_pairs", f"WITH {CHECKED_PAIRS} SELECT task_id, pos::BIGINT AS pos, question, sql, answer FROM parsed")
def parse_pairs(spark, sf_dir):
    return pairs.parse_pairs(feed(spark, sf_dir, REPLIES)).withColumn("pos", F.col("pos").cast("long"))


@query("parse_answer", f"""WITH a AS ({check_sql(ANSWERS)}), j AS (SELECT *, CASE WHEN json_valid(text) THEN CASE WHEN json_type(text::JSON) = 'OBJECT' THEN text::JSON END END AS v FROM a)
SELECT task_id, md5({ck.clean("CASE WHEN v IS NULL THEN text ELSE v->>'$.sql' END")}) AS sql, coalesce(v->>'$.question', question) AS question,
coalesce(json_array_length(v, '$.rows'), 0)::BIGINT AS n_rows FROM j""")
def parse_answer(spark, sf_dir):
    read = pairs.parse_answer(feed(spark, sf_dir, ANSWERS))
    return read.select("task_id", F.md5("sql").alias("sql"), "question", F.json_array_length("rows").cast("long").alias("n_rows"))


# ---------------------------------------------------------------- dropping and deduplicating

@query("drop_fail", f"WITH {P}, {GOOD} SELECT task_id, pos, sql FROM g")
def drop_fail(spark, sf_dir):
    return pairs.drop_failures(feed(spark, sf_dir, PAIRS)).select("task_id", "pos", "sql")


@query("dedup_qa", f"WITH {P} SELECT task_id, pos, question, answer FROM ({firsts('p', 'question, answer')})")
def dedup_qa(spark, sf_dir):
    return pairs.dedup_qa(feed(spark, sf_dir, PAIRS)).select("task_id", "pos", "question", "answer")


@query("dedup_sql", f"WITH {P}, {GOOD} SELECT task_id, pos, question, sql FROM ({firsts('g', 'sql')})")
def dedup_sql(spark, sf_dir):
    return pairs.dedup_sql(feed(spark, sf_dir, PAIRS)).select("task_id", "pos", "question", "sql")


@query("dedup_pair", f"WITH {P} SELECT task_id, pos, question, sql FROM ({firsts('p', 'question, sql')})")
def dedup_pair(spark, sf_dir):
    return pairs.dedup_pair(feed(spark, sf_dir, PAIRS)).select("task_id", "pos", "question", "sql")


@query("quota", f"WITH {P}, {GOOD} SELECT task_id, pos, sql FROM ({firsts('g', 'task_id', 'pos', 20)})")
def quota(spark, sf_dir):
    return pairs.quota(feed(spark, sf_dir, PAIRS), 20).select("task_id", "pos", "sql")


@query("run_quota", f"WITH {P} SELECT task_id, pos, question FROM p ORDER BY task_id, pos LIMIT 200")
def run_quota(spark, sf_dir):
    goal = pairs.batch_size(800, 16)
    return pairs.run_quota(feed(spark, sf_dir, PAIRS), goal, per_task=True, tasks=4).select("task_id", "pos", "question")


@query("progress", f"""WITH {P}, d AS (SELECT DISTINCT task_id, question, sql FROM p),
f AS (SELECT question, sql, min(task_id) AS task_id FROM d GROUP BY 1, 2)
SELECT d.task_id, count(*) AS n_distinct, (SELECT count(*) FROM f WHERE f.task_id = d.task_id) AS n_new FROM d GROUP BY d.task_id""")
def progress(spark, sf_dir):
    return usage.progress(feed(spark, sf_dir, PAIRS))


# ---------------------------------------------------------------- tables named by SQL

KNOWN = "[" + ", ".join(f"'{n}'" for n in NAMES) + "]"
TABLES_OF = """list_distinct(list_transform(regexp_extract_all({x}, '(?i)\\b(?:FROM|JOIN)\\s+([\\w."`]+)', 1),
lambda t: list_extract(string_split(trim(t, '`"'), '.'), -1)))"""


@query("extract_tables", f"""SELECT page_id, array_to_string(list_filter({KNOWN}, lambda t: contains(lower(html), t)), ',') AS tables FROM pages""")
def extract_tables(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.array_join(pairs.extract_tables(F.col("html"), NAMES), ",").alias("tables"))


TEXTS = f"MAP {{{', '.join(repr(n) + ': ' + repr(ck.table_json(n)) for n in NAMES)}}}"


@query("tag_schema", f"""WITH {P}, {GOOD}, t AS (SELECT task_id, pos, list_filter({KNOWN}, lambda t: contains(lower(sql), t)) AS ts FROM g),
s AS (SELECT DISTINCT ts FROM t), m AS (SELECT {TEXTS} AS texts),
j AS (SELECT ts, md5('{{"tables":{{' || array_to_string(list_transform(ts, lambda t: texts[t]), ',') || '}}}}') AS tagged FROM s, m)
SELECT task_id, pos, array_to_string(t.ts, ',') AS tables, tagged FROM t JOIN j ON j.ts = t.ts""")
def tag_schema(spark, sf_dir):
    tagged = pairs.tag_schema(pairs.drop_failures(feed(spark, sf_dir, PAIRS)), catalog(spark, sf_dir, fks=True))
    return tagged.select("task_id", "pos", F.array_join("tables", ",").alias("tables"), F.md5("schema").alias("tagged"))


@query("join_table_count", f"WITH {P} SELECT task_id, pos, len({TABLES_OF.format(x='sql')})::BIGINT AS n FROM c")
def join_table_count(spark, sf_dir):
    cleaned = feed(spark, sf_dir, PAIRS).withColumn("sql", tx.clean_sql(F.col("sql")))
    return cleaned.select("task_id", "pos", lint.join_table_count(F.col("sql")).cast("long").alias("n"))


@query("min_joins", f"WITH {P} SELECT task_id, pos, sql FROM c WHERE len({TABLES_OF.format(x='sql')}) >= 2")
def min_joins(spark, sf_dir):
    cleaned = feed(spark, sf_dir, PAIRS).withColumn("sql", tx.clean_sql(F.col("sql")))
    return lint.min_joins(cleaned, 2).select("task_id", "pos", "sql")


# ---------------------------------------------------------------- lint

BROKEN = " || ".join(
    [f"CASE WHEN len(regexp_extract_all(sql, '(?i)\\b(?:{'|'.join(lint.ONE_OF)})\\s*\\(')) > 1 THEN 'functions,' ELSE '' END"]
    + [f"CASE WHEN regexp_matches(sql, '{p}') THEN '{name},' ELSE '' END" for name, p in lint.BANNED.items()]
    + [f"CASE WHEN length(sql) > {lint.MAX_LENGTH} THEN 'length,' ELSE '' END"])


@query("lint_sql", f"WITH {P} SELECT task_id, pos, rtrim({BROKEN}, ',') AS violations, ({BROKEN}) = '' AS ok FROM c")
def lint_sql(spark, sf_dir):
    return lint.lint_sql(feed(spark, sf_dir, PAIRS)).select("task_id", "pos", F.array_join("violations", ",").alias("violations"), "ok")


@query("lint_required", f"WITH {P} SELECT task_id, pos, regexp_matches(sql, '(?i)\\bMAX\\b') AS has_max, regexp_matches(sql, '(?i)\\bCOUNT\\b') AS has_count FROM c")
def lint_required(spark, sf_dir):
    sql = tx.clean_sql(F.col("sql"))
    return feed(spark, sf_dir, PAIRS).select("task_id", "pos", lint.uses_function(sql, "MAX").alias("has_max"),
                                             lint.uses_function(sql, F.lit("COUNT")).alias("has_count"))


@query("lint_unknown_table", f"""WITH {P}, u AS (SELECT task_id, pos, list_filter(list_transform({TABLES_OF.format(x='sql')}, lambda t: lower(t)),
lambda t: NOT list_contains({KNOWN}, t) AND NOT contains(lower(sql), 'with ' || t || ' as')) AS us FROM c) SELECT task_id, pos, array_to_string(list_sort(us), ',') AS unknown FROM u WHERE len(us) > 0""")
def lint_unknown_table(spark, sf_dir):
    cleaned = feed(spark, sf_dir, PAIRS).withColumn("sql", tx.clean_sql(F.col("sql")))
    unknown = cleaned.select("task_id", "pos", F.array_sort(lint.unknown_tables(F.col("sql"), NAMES)).alias("u"))
    return unknown.where(F.size("u") > 0).select("task_id", "pos", F.array_join("u", ",").alias("unknown"))


# ---------------------------------------------------------------- reviews and probes

# Reviews: two per pair, the later one counts; some are no JSON, and signups have none.
REVIEWED = f"(SELECT DISTINCT question, sql FROM ({PAIRS}) AS a WHERE question NOT LIKE '%signup%') AS p"
REVIEWS = f"""SELECT question, sql, 1 AS seq, '{{{{"score": 0.1}}}}' AS response FROM {REVIEWED}
UNION ALL SELECT question, sql, 2 AS seq, CASE length(question) % 3
WHEN 0 THEN '{{{{"score": 0.75, "reason": "ok", "fixed_sql": "SELECT COUNT(*) FROM events WHERE event_id = ' || CAST(length(sql) AS STRING) || ';"}}}}'
WHEN 1 THEN 'looks fine' ELSE '{{{{"fixed_sql": "SELECT 1"}}}}' END AS response FROM {REVIEWED}"""


@query("apply_reviews", f"""WITH {P}, r AS ({check_sql(REVIEWS)}), l AS (SELECT question, sql, arg_max(response, seq) AS response FROM r GROUP BY 1, 2),
j AS (SELECT p.*, l.response, CASE WHEN json_valid(l.response) THEN l.response::JSON END AS v FROM p LEFT JOIN l ON l.question = p.question AND l.sql = p.sql)
SELECT task_id, pos, CASE WHEN v IS NULL THEN sql ELSE {ck.clean("coalesce(v->>'$.fixed_sql', sql)")} END AS sql,
CASE WHEN response IS NULL THEN NULL WHEN v IS NULL THEN 0.0::DOUBLE ELSE coalesce((v->>'$.score')::DOUBLE, 0.0::DOUBLE) END AS score FROM j""")
def apply_reviews(spark, sf_dir):
    fixed = pairs.apply_reviews(feed(spark, sf_dir, PAIRS), feed(spark, sf_dir, REVIEWS))
    return fixed.select("task_id", "pos", "sql", "score")


@query("fix_rounds", f"""WITH {P}, k AS (SELECT task_id, pos, ({BROKEN}) = '' AND sql <> '' AS ok, sql FROM c)
SELECT task_id, pos, CASE WHEN ok THEN sql ELSE 'SELECT COUNT(*) FROM events WHERE event_id = ' || task_id END AS sql FROM k WHERE ok OR task_id % 3 = 0""")
def fix_rounds(spark, sf_dir):
    """Pairs that break a rule are fixed once for every third user and stay broken for the others."""
    def check(df):
        return lint.lint_sql(df).withColumn("ok", F.col("ok") & (F.col("sql") != ""))

    def review(bad):
        fix = F.concat(F.lit('{"fixed_sql": "SELECT COUNT(*) FROM events WHERE event_id = '), F.col("task_id").cast("string"), F.lit('"}'))
        return bad.select("question", "sql", F.when(F.col("task_id") % 3 == 0, fix).otherwise("no idea").alias("response"),
                          F.lit(1).alias("seq"))

    # the review belongs to one pair, so the question carries the task here
    own = feed(spark, sf_dir, PAIRS).withColumn("question", F.concat_ws(" ", "question", F.col("task_id").cast("string"), F.col("pos").cast("string")))
    return pairs.fix_rounds(own, check, review).select("task_id", "pos", "sql")


PROBED = """SELECT c_custkey AS task_id, 0 AS pos, CASE c_custkey % 4
WHEN 0 THEN 'SELECT o_orderstatus, COUNT(*) FROM pw_orders GROUP BY o_orderstatus;'
WHEN 1 THEN 'SELECT c_custkey, 1 / (c_custkey - c_custkey) AS x FROM pw_customer WHERE c_mktsegment = ''' || c_mktsegment || ''''
WHEN 2 THEN 'SELECT nothing FROM pw_customer'
ELSE 'SELECT c_name FROM pw_customer JOIN pw_orders ON o_custkey = c_custkey WHERE c_mktsegment = ''' || c_mktsegment || '''' END AS sql FROM {customer}"""


def _probed(spark, sf_dir):
    table(spark, sf_dir, "orders").createOrReplaceTempView("pw_orders")
    table(spark, sf_dir, "customer").createOrReplaceTempView("pw_customer")
    return probe.probe_queries(spark, feed(spark, sf_dir, PROBED))


@query("probe", f"SELECT task_id, sql NOT LIKE '%nothing%' AND sql NOT LIKE '%1 / %' AS ok FROM ({check_sql(PROBED)})")
def probe_query(spark, sf_dir):
    """Which queries fail is known from how they were made: a division by zero and a missing column."""
    return _probed(spark, sf_dir).select("task_id", "ok")


@query("mark_failures", f"""SELECT task_id, CASE WHEN sql LIKE '%nothing%' OR sql LIKE '%1 / %' THEN 'FAIL' ELSE rtrim(sql, ';') END AS sql FROM ({check_sql(PROBED)})""")
def mark_failures(spark, sf_dir):
    return pairs.mark_failures(_probed(spark, sf_dir)).select("task_id", "sql")


# ---------------------------------------------------------------- datasets and streams

@query("dataset_joins", f"""WITH {P}, {GOOD}, d AS ({firsts('g', 'sql')})
SELECT question, sql, array_to_string(list_filter({KNOWN}, lambda t: contains(lower(sql), t)), ',') AS tagged FROM d""")
def dataset_joins(spark, sf_dir):
    """Filter, deduplicate, tag, write one version and read it back."""
    rows = pairs.dataset_rows(feed(spark, sf_dir, PAIRS), "joins", catalog(spark, sf_dir, fks=True))
    root = scratch_path(spark, "dataset")
    jsonl.write_version(rows, root, "joins", "v1")
    back = jsonl.read_version(spark, root, "joins", "v1", "question string, sql string, schema string")
    keys = F.json_object_keys(F.get_json_object("schema", "$.tables"))
    return back.select("question", "sql", F.array_join(keys, ",").alias("tagged"))


@query("stream_ingest", f"""WITH {CHECKED_PAIRS}, k AS (SELECT task_id, pos, question, {ck.clean('sql')} AS sql FROM parsed)
SELECT DISTINCT question, sql FROM k WHERE sql NOT IN ('', 'FAIL')""")
def stream_ingest(spark, sf_dir):
    """The replies arrive as files in two portions; the second adds only what the first lacked."""
    root = scratch_path(spark, "stream")
    replies = feed(spark, sf_dir, REPLIES)
    for part in (0, 1):
        jsonl.append_jsonl(replies.where(F.col("task_id") % 2 == part), f"{root}/in")
        ingest.stream_ingest(spark, f"{root}/in", f"{root}/out", f"{root}/state").awaitTermination()
    return ingest.read_pairs(spark, f"{root}/out").select("question", "sql")


# ---------------------------------------------------------------- table sets

SETS = """SELECT o_orderkey AS task_id, CASE WHEN o_orderkey % 5 = 0 THEN 'I cannot think of any.' ELSE
'1. {{"tables": ["orders", "customer", "t' || CAST(o_custkey AS STRING) || '"]}}' || chr(10) || '- ["lineitem", "part"]' || chr(10) || '`["region"]`' || chr(10)
|| '["nation", "customer", "supplier"' || CASE WHEN o_orderstatus = 'F' THEN ', "region"]' ELSE ']' END || chr(10) || '{{"tables": "part"}}' || chr(10)
|| '["pages", "documents"]' END AS text FROM {orders}"""


@query("table_sets", f"""WITH l AS (SELECT task_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM ({check_sql(SETS)})),
b AS (SELECT task_id, i, {ck.bare('line')} AS line FROM l),
j AS (SELECT task_id, i, CASE WHEN json_type(line, '$.tables') = 'ARRAY' THEN json_extract_string(line, '$.tables[*]') WHEN json_type(line) = 'ARRAY' THEN json_extract_string(line, '$[*]') END AS ts
FROM b WHERE json_valid(line)),
f AS (SELECT task_id, i, list_filter(ts, lambda t: list_contains({KNOWN}, t)) AS ts FROM j WHERE ts IS NOT NULL),
s AS (SELECT task_id, row_number() OVER (PARTITION BY task_id ORDER BY i) AS rn, ts FROM f WHERE len(ts) >= 2),
q AS (SELECT * FROM s WHERE rn <= 3)
SELECT task_id, (rn - 1)::BIGINT AS pos, array_to_string(ts, ',') AS tables FROM q
UNION ALL SELECT o_orderkey, 0, array_to_string({KNOWN}, ',') FROM orders WHERE o_orderkey NOT IN (SELECT task_id FROM q)""")
def sets_query(spark, sf_dir):
    sets = table_sets.parse_table_sets(feed(spark, sf_dir, SETS), NAMES, 2, 3)
    return sets.select("task_id", F.col("pos").cast("long").alias("pos"), F.array_join("tables", ",").alias("tables"))


# ---------------------------------------------------------------- usage and budgets

USAGE = """SELECT user_id AS run_id, event_id AS seq, CAST(round(value * 100) AS BIGINT) AS in_tok, event_id * 7919 % 2000 AS out_tok FROM {events}"""
U = f"u AS ({check_sql(USAGE)}), m AS (SELECT *, in_tok * 5 + out_tok * 15 AS micros FROM u)"


@query("usage_totals", f"""WITH {U} SELECT run_id, sum(in_tok)::BIGINT AS in_tok, sum(out_tok)::BIGINT AS out_tok, count(*) AS requests,
round(sum(micros) / 1e6::DOUBLE, 6) AS cost_usd, round(50 - sum(micros) / 1e6::DOUBLE, 6) AS budget_left FROM m GROUP BY run_id""")
def usage_totals(spark, sf_dir):
    return usage.remaining_budget(feed(spark, sf_dir, USAGE), 50.0).withColumn("cost_usd", F.round("cost_usd", 6))


@query("usage_cost", f"WITH {U} SELECT run_id, seq, round(in_tok * 5e-6::DOUBLE + out_tok * 1.5e-5::DOUBLE, 9) AS cost_usd FROM u")
def usage_cost(spark, sf_dir):
    return feed(spark, sf_dir, USAGE).select("run_id", "seq", F.round(usage.cost(F.col("in_tok"), F.col("out_tok")), 9).alias("cost_usd"))


BUDGET = 0.2


@query("budget_prefix", f"""WITH {U} SELECT run_id, seq, sum(micros) OVER (PARTITION BY run_id ORDER BY seq) <= {round(BUDGET * 1e6)} AS accepted FROM m""")
def budget_prefix(spark, sf_dir):
    return usage.stop_at_budget(feed(spark, sf_dir, USAGE), BUDGET, span=1000).select("run_id", "seq", "accepted")


@query("budget_accept", f"""WITH RECURSIVE {U}, o AS (SELECT *, row_number() OVER (PARTITION BY run_id ORDER BY seq) AS i FROM m),
fold AS (SELECT run_id, seq, i, CASE WHEN micros <= {round(BUDGET * 1e6)} THEN micros ELSE 0 END AS spent, micros <= {round(BUDGET * 1e6)} AS accepted FROM o WHERE i = 1
UNION ALL SELECT o.run_id, o.seq, o.i, f.spent + CASE WHEN f.spent + o.micros <= {round(BUDGET * 1e6)} THEN o.micros ELSE 0 END, f.spent + o.micros <= {round(BUDGET * 1e6)}
FROM fold f JOIN o ON o.run_id = f.run_id AND o.i = f.i + 1)
SELECT run_id, seq, accepted FROM fold""")
def budget_accept(spark, sf_dir):
    return usage.apply_budget(feed(spark, sf_dir, USAGE), BUDGET, span=1000).select("run_id", "seq", "accepted")
