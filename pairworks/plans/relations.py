"""Queries on catalogs, profiles and relationships."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.similarity import cosine
from ..operators import generate, pairs, profile, relate, table_sets
from ..operators.mask import FIRST, LAST, WORDS, mask
from ..session import scratch_path
from ..sources import catalog as cat
from ..sources import jsonl, samples
from . import checks as ck
from .tables import COLUMNS, FOREIGN_KEYS, NAMES, catalog, check_sql, feed, query, table

SIX = lambda c: F.round(F.col(c), 6).alias(c)


def keyed(spark, sf_dir, fks=False):
    return profile.with_inferred_keys(catalog(spark, sf_dir, fks))


# ---------------------------------------------------------------- catalogs and samples

@query("catalog_columns", f"""WITH {ck.KEYS}, {ck.ROWS}, cols(t, ordinal, c, ty) AS ({ck.values(
    [(t, i, c, ty) for t in NAMES for i, (c, ty) in enumerate(COLUMNS[t])])})
SELECT cols.t AS "table", ordinal, c AS name, ty AS type, NULL::VARCHAR AS comment, n.n AS n_rows, coalesce(c = keys.k, false) AS is_key
FROM cols JOIN n ON n.t = cols.t LEFT JOIN keys ON keys.t = cols.t""")
def catalog_columns(spark, sf_dir):
    return cat.describe(keyed(spark, sf_dir))


@query("schema_json", f"""WITH {ck.KEYS}, o(i, t, body) AS ({ck.values([(i, t, ck.table_json(t, '<key>')) for i, t in enumerate(NAMES)])})
SELECT '{{"tables":{{' || string_agg(replace(body, '<key>', coalesce('"' || keys.k || '"', 'null')), ',' ORDER BY i) || '}}}}' AS schema_json
FROM o LEFT JOIN keys ON keys.t = o.t""")
def schema_json(spark, sf_dir):
    return cat.schema_json(keyed(spark, sf_dir, fks=True))


@query("schema_markdown", f"""WITH {ck.ROWS}, cols(t, i, c) AS ({ck.values([(t, i, c) for t in NAMES for i, (c, _) in enumerate(COLUMNS[t])])})
SELECT cols.t AS "table", '- **' || cols.t || '**: ' || string_agg('"' || c || '"', ', ' ORDER BY i) AS line, any_value(n.n) AS n_rows
FROM cols JOIN n ON n.t = cols.t GROUP BY cols.t""")
def schema_markdown(spark, sf_dir):
    c = catalog(spark, sf_dir)
    return cat.schema_markdown(c).join(cat.row_counts(c), "table")


@query("schema_sample", f"""WITH {ck.ROWS} SELECT t AS "table", n AS n_rows FROM n ORDER BY md5('1|' || t) LIMIT 8""")
def schema_sample(spark, sf_dir):
    c = catalog(spark, sf_dir)
    return cat.sample_tables(c, 8, seed=1).join(cat.row_counts(c), "table")


@query("sample_rows", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""")
def sample_rows(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return samples.sample_rows(orders, 5, [F.desc("o_totalprice"), "o_orderkey"])


SAMPLED = " UNION ALL ".join(
    f"""SELECT '{t}' AS "table", (SELECT count(*) FROM (SELECT 1 FROM {t} LIMIT 3)) AS n,
    coalesce((SELECT string_agg(CAST(x AS VARCHAR), ',' ORDER BY x) FROM (SELECT {COLUMNS[t][0][0]} AS x FROM {t} ORDER BY 1 LIMIT 3)), '') AS ids"""
    if t not in ("lineitem", "conversations") else
    f"""SELECT '{t}' AS "table", (SELECT count(*) FROM (SELECT 1 FROM {t} LIMIT 3)) AS n, '' AS ids""" for t in NAMES)


def _sample_ids(rows, keys):
    known = F.create_map(*[F.lit(x) for kv in keys.items() for x in kv])
    ids = F.array_sort(F.collect_list(F.call_function("get_json_object", F.col("row"), F.concat(F.lit("$."), F.element_at(known, F.col("table")))).cast("long")))
    return rows.groupBy("table").agg(F.count(F.lit(1)).alias("n"), F.array_join(ids.cast("array<string>"), ",").alias("ids"))


@query("sample_all", SAMPLED)
def sample_all(spark, sf_dir):
    c = keyed(spark, sf_dir)
    return _sample_ids(samples.sample_all(c, 3), c.keys)


@query("masked_samples", SAMPLED)
def masked_samples(spark, sf_dir):
    """Keys are numbers, which masking keeps, so they identify the masked rows."""
    c = keyed(spark, sf_dir)
    return _sample_ids(samples.masked_samples(c, 3, salt="s", as_of="2029-12-31", decade_start="2020-01-01"), c.keys)


def _pick(words, h, slot=0):
    return f"([{', '.join(repr(w) for w in words)}])[{ck.hex_draw(h, len(words), slot)} + 1]"


def _h(kind, col):
    return f"md5('s|{kind}|' || {col})"


def _day(h):
    return f"strftime(DATE '2020-01-01' + {ck.hex_draw(h, 3653)}::INT, '%Y-%m-%d')"


def _clock(h):
    part = lambda n, slot: f"lpad({ck.hex_draw(h, n, slot)}::VARCHAR, 2, '0')"
    return f"{part(24, 1)} || ':' || {part(60, 2)} || ':' || {part(60, 3)}"


@query("fetch_masked", f"""SELECT o_orderkey, o_totalprice, {_pick(WORDS, _h('word', 'o_orderpriority'))} AS o_orderpriority
FROM orders ORDER BY o_totalprice DESC, orders.o_orderkey LIMIT 5""")
def fetch_masked(spark, sf_dir):
    sql = f"SELECT o_orderkey, o_totalprice, o_orderpriority FROM parquet.`{sf_dir}/orders.parquet` ORDER BY o_totalprice DESC, o_orderkey"
    return samples.fetch(spark, sql, 5, salt="s")


@query("mask_rules", f"""SELECT o_orderkey AS id, o_totalprice AS amount,
{_day(_h('datetime', "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"))} || ' ' || {_clock(_h('datetime', "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"))} AS at,
{_day(_h('date', "strftime(o_orderdate, '%Y-%m-%d')"))} AS day,
lower({_pick(FIRST, _h('email', 'c_name'))}) || '.' || lower({_pick(LAST, _h('email', 'c_name'), 1)}) || {ck.hex_draw(_h('email', 'c_name'), 10000, 2)}::VARCHAR || '@example.org' AS user_email,
{_pick(FIRST, _h('name', 'c_name'))} || ' ' || {_pick(LAST, _h('name', 'c_name'), 1)} AS username,
{_day(_h('date_text', 'o_orderstatus'))} AS datetime_txt,
{_clock(_h('time_text', 'o_orderstatus'))} AS time_txt,
{_pick(WORDS, _h('word', 'o_orderpriority'))} AS priority,
CASE WHEN o_orderstatus <> 'F' THEN {_pick(WORDS, _h('word', 'o_orderstatus'))} END AS status,
o_orderkey % 2 = 0 AS flag,
{_pick(FIRST, _h('name', 'c_name'))} || ' ' || {_pick(LAST, _h('name', 'c_name'), 1)} || '|' || o_custkey || '|' || {_pick(WORDS, _h('word', 'o_orderstatus'))} AS person,
CASE WHEN o_orderstatus <> 'F' THEN {_pick(WORDS, _h('word', 'o_orderpriority'))} || '|' || {_pick(WORDS, _h('word', 'c_mktsegment'))} END AS tags
FROM orders JOIN customer ON o_custkey = c_custkey""")
def mask_rules(spark, sf_dir):
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    rows = orders.join(customer.select("c_custkey", "c_name", "c_mktsegment"), orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.col("o_orderdate").alias("at"),
        F.col("o_orderdate").cast("date").alias("day"), F.col("c_name").alias("user_email"), F.col("c_name").alias("username"),
        F.col("o_orderstatus").alias("datetime_txt"), F.col("o_orderstatus").alias("time_txt"),
        F.col("o_orderpriority").alias("priority"), F.nullif("o_orderstatus", F.lit("F")).alias("status"),
        (F.col("o_orderkey") % 2 == 0).alias("flag"),
        F.struct(F.col("c_name").alias("fullname"), F.col("o_custkey").alias("number"), F.struct(F.col("o_orderstatus").alias("code")).alias("more")).alias("person"),
        F.when(F.col("o_orderstatus") != "F", F.array("o_orderpriority", "c_mktsegment")).alias("tags"))
    out = mask(rows, salt="s", decade_start="2020-01-01", as_of="2029-12-31")
    told = F.concat_ws("|", "person.fullname", F.col("person.number").cast("string"), "person.more.code")
    return out.withColumn("person", told).withColumn("tags", F.array_join("tags", "|"))


@query("jsonl_roundtrip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, nullif(c_mktsegment, 'BUILDING') AS c_mktsegment FROM customer")
def jsonl_roundtrip(spark, sf_dir):
    df = table(spark, sf_dir, "customer").withColumn("c_mktsegment", F.nullif("c_mktsegment", F.lit("BUILDING")))
    path = scratch_path(spark, "jsonl")
    jsonl.write_jsonl(df, path)
    return jsonl.read_jsonl(spark, path, df.schema)


# ---------------------------------------------------------------- single checks

@query("distinct_values", "SELECT DISTINCT l_partkey AS value FROM lineitem WHERE l_partkey IS NOT NULL")
def distinct_values(spark, sf_dir):
    return relate.distinct_values(table(spark, sf_dir, "lineitem"), "l_partkey")


@query("distinct_ratio", "SELECT count(DISTINCT l_orderkey)::DOUBLE / nullif(count(*), 0) AS distinct_ratio FROM lineitem")
def distinct_ratio(spark, sf_dir):
    return profile.distinct_ratio(table(spark, sf_dir, "lineitem"), "l_orderkey")


# Child and parent columns of the single checks: contained, partly contained, foreign.
PAIRS = [("lineitem", "l_orderkey", "orders", "o_orderkey"), ("lineitem", "l_partkey", "supplier", "s_suppkey"),
         ("events", "user_id", "customer", "c_custkey"), ("orders", "o_custkey", "nation", "n_nationkey")]


def _each_pair(spark, sf_dir, fn):
    return cat.union_all([fn(table(spark, sf_dir, a), c, table(spark, sf_dir, b), k).withColumn("pair", F.lit(f"{a}.{c}>{b}.{k}"))
                          for a, c, b, k in PAIRS])


def _pair_sql(sql):
    return " UNION ALL ".join(sql.format(a=a, c=c, b=b, k=k, pair=f"'{a}.{c}>{b}.{k}'") for a, c, b, k in PAIRS)


OVERLAP = ("SELECT {pair} AS pair, count(*) AS n_values, count(p.{k}) AS n_matched, count(p.{k}) / count(*)::DOUBLE AS overlap{more} "
           "FROM (SELECT DISTINCT {c} FROM {a} WHERE {c} IS NOT NULL) x LEFT JOIN (SELECT DISTINCT {k} FROM {b}) p ON x.{c} = p.{k}")


@query("value_overlap", _pair_sql(OVERLAP.replace("{more}", "")))
def value_overlap(spark, sf_dir):
    return _each_pair(spark, sf_dir, relate.value_overlap)


@query("values_contained", _pair_sql(OVERLAP.replace("{more}", ", count(p.{k}) / count(*)::DOUBLE >= 0.95 AS contained")))
def values_contained(spark, sf_dir):
    return _each_pair(spark, sf_dir, relate.values_contained)


@query("orphans", _pair_sql("SELECT {pair} AS pair, {c}::BIGINT AS value, count(*) AS n_rows FROM {a} "
                            "WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {b}) GROUP BY {c}"))
def orphans(spark, sf_dir):
    return _each_pair(spark, sf_dir, relate.orphans)


@query("no_orphans", _pair_sql("SELECT {pair} AS pair, count(*) AS orphan_rows, count(*) = 0 AS ok FROM {a} "
                               "WHERE {c} IS NOT NULL AND {c} NOT IN (SELECT {k} FROM {b})"))
def no_orphans(spark, sf_dir):
    return _each_pair(spark, sf_dir, relate.no_orphans)


@query("join_exists", _pair_sql("SELECT {pair} AS pair, EXISTS (SELECT 1 FROM {a} JOIN {b} ON {a}.{c} = {b}.{k}) AS joined"))
def join_exists(spark, sf_dir):
    return _each_pair(spark, sf_dir, relate.join_exists)


# ---------------------------------------------------------------- profiles and discovery

@query("profile", f"""WITH {ck.PROFILE} SELECT t AS "table", c AS "column", n_rows, n_nonnull, n_distinct,
round(n_distinct / greatest(n_rows, 1)::DOUBLE, 6) AS distinct_ratio FROM prof""")
def profile_query(spark, sf_dir):
    return profile.profile_columns(catalog(spark, sf_dir)).withColumn("distinct_ratio", SIX("distinct_ratio"))


@query("infer_pk", f'WITH {ck.KEYS} SELECT t AS "table", k AS primary_key FROM keys')
def infer_pk(spark, sf_dir):
    return profile.infer_primary_key(catalog(spark, sf_dir))


@query("explicit_fks", "WITH fk AS (" + " UNION ALL ".join(
    f"SELECT '{t}' AS t, '{c[0]}' AS c, '{p}' AS p, '{k[0]}' AS k, count(DISTINCT {t}.{c[0]}) AS n_values, "
    f"count(DISTINCT {t}.{c[0]}) FILTER ({t}.{c[0]} IN (SELECT {k[0]} FROM {p})) AS n_matched FROM {t}" for t, c, p, k in FOREIGN_KEYS)
    + """), e AS (SELECT *, 1 AS fwd FROM fk UNION ALL SELECT p, k, t, c, n_values, n_matched, 0 FROM fk)
SELECT 'How is ' || t || '.' || c || ' related to ' || p || '.' || k || '?' AS question, t || '.' || c || ' -> ' || p || '.' || k AS answer,
1.0::DOUBLE AS confidence, CASE fwd WHEN 1 THEN n_values END AS n_values, CASE fwd WHEN 1 THEN n_matched END AS n_matched FROM e""")
def explicit_fks(spark, sf_dir):
    """Declared keys in both directions, the declared direction with the values behind it."""
    c = catalog(spark, sf_dir, fks=True)
    counts = relate.match_counts(c, [(t, cs[0], p, ks[0]) for t, cs, p, ks in FOREIGN_KEYS])
    return relate.explicit_fks(c).join(counts, relate.ENDS, "left").select("question", "answer", "confidence", "n_values", "n_matched")


CANDIDATE_COLUMNS = "t AS child_table, c AS child_col, p AS parent_table, k AS parent_col"


@query("candidates", f"WITH {ck.CANDIDATES} SELECT {CANDIDATE_COLUMNS}, ty AS child_type, kty AS parent_type FROM cand")
def candidates(spark, sf_dir):
    return relate.candidates(keyed(spark, sf_dir)).drop("comment")


@query("name_similarity", f"WITH {ck.CANDIDATES} SELECT {CANDIDATE_COLUMNS}, round(name_score, 6) AS name_score FROM cand")
def name_similarity(spark, sf_dir):
    return relate.name_scores(relate.candidates(keyed(spark, sf_dir))).select(*relate.ENDS, SIX("name_score"))


@query("name_signal", f"WITH {ck.CANDIDATES} SELECT {CANDIDATE_COLUMNS}, s1 FROM cand")
def name_signal(spark, sf_dir):
    return relate.name_scores(relate.candidates(keyed(spark, sf_dir))).select(*relate.ENDS, "s1")


@query("relationship_score", f"WITH {ck.SCORED} SELECT {CANDIDATE_COLUMNS}, n_values, n_matched, s1, s2, s3, s4, s5, s6, score FROM scored")
def relationship_score(spark, sf_dir):
    scored = relate.score_candidates(keyed(spark, sf_dir))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return scored.select(*relate.ENDS, zero("n_values"), zero("n_matched"), "s1", "s2", "s3", "s4", "s5", "s6", "score")


# what a database would say about some columns: a referred table, one in other letters and its singular, one that fits no type, none
SAID = {("orders", "o_custkey"): "Who placed it: a CUSTOMER", ("lineitem", "l_suppkey"): "the supplier that ships", ("orders", "o_orderdate"): "day of the event",
        ("lineitem", "l_partkey"): "", ("customer", "c_nationkey"): "home (nation)", ("nation", "n_name"): "as in the regional list of the region"}
MENTIONED = "contains(lower(CASE " + " ".join(f"WHEN cand.t = '{t}' AND cand.c = '{c}' THEN '{text}'" for (t, c), text in SAID.items()) + \
            " ELSE '' END), rtrim(lower(cand.p), 's'))"


def commented(spark, sf_dir):
    c = keyed(spark, sf_dir)
    return cat.load_catalog(spark, c.frames, keys=c.keys, comments=SAID)


@query("comment_signal", f"WITH {ck.CANDIDATES} SELECT {CANDIDATE_COLUMNS}, {MENTIONED} AS s3 FROM cand")
def comment_signal(spark, sf_dir):
    return relate.metadata_signals(relate.candidates(commented(spark, sf_dir))).select(*relate.ENDS, "s3")


@query("commented_score", f"WITH {ck.SCORED.replace('false AS s3', MENTIONED + ' AS s3')} SELECT {CANDIDATE_COLUMNS}, s3, score FROM scored")
def commented_score(spark, sf_dir):
    return relate.score_candidates(commented(spark, sf_dir)).select(*relate.ENDS, "s3", "score")


FOUND = """SELECT 'How is ' || t || '.' || c || ' related to ' || p || '.' || k || '?' AS question,
t || '.' || c || ' -> ' || p || '.' || k AS answer, round(confidence, 6) AS confidence FROM both_ways"""


@query("relationships", f"WITH {ck.SCORED}, {ck.BOTH_WAYS.format(src='accepted')} {FOUND}")
def relationships(spark, sf_dir):
    return relate.discover_relationships(keyed(spark, sf_dir)).select("question", "answer", SIX("confidence"))


@query("dataset_relationships", f"WITH {ck.SCORED}, {ck.BOTH_WAYS.format(src='accepted')} SELECT question, answer FROM ({FOUND})")
def dataset_relationships(spark, sf_dir):
    """Written without the confidence, and read back."""
    found = relate.discover_relationships(keyed(spark, sf_dir)).withColumns({"task_id": F.lit(0), "pos": F.lit(0)})
    root = scratch_path(spark, "dataset")
    jsonl.write_version(pairs.dataset_rows(found, "schema_relationship"), root, "schema_relationship", "v1")
    return jsonl.read_version(spark, root, "schema_relationship", "v1", "question string, answer string")


@query("export_samples", SAMPLED)
def export_samples(spark, sf_dir):
    c, root = keyed(spark, sf_dir), scratch_path(spark, "dataset")
    samples.export_samples(c, root, "v1", 3, salt="s", as_of="2029-12-31", decade_start="2020-01-01")
    return _sample_ids(jsonl.read_version(spark, root, "sample_data", "v1", "table string, row string"), c.keys)


NAMED_ONLY = f"{ck.SCORED}, nm AS (SELECT * FROM accepted WHERE s1)"


@query("relationships_named", f"WITH {NAMED_ONLY}, {ck.BOTH_WAYS.format(src='nm')} {FOUND}")
def relationships_named(spark, sf_dir):
    return relate.discover_relationships(keyed(spark, sf_dir), require_name=True).select("question", "answer", SIX("confidence"))


@query("joinable_sets", f"""WITH RECURSIVE {NAMED_ONLY},
e AS (SELECT t AS a, p AS b FROM nm UNION SELECT p, t FROM nm),
grow(tables) AS (SELECT DISTINCT list_sort([a, b]) FROM e
UNION SELECT list_sort(list_append(g.tables, e.b)) FROM grow g JOIN e ON list_contains(g.tables, e.a) AND NOT list_contains(g.tables, e.b) WHERE len(g.tables) < 4)
SELECT array_to_string(tables, ',') AS tables, len(tables)::BIGINT AS n_tables FROM grow""")
def joinable_sets(spark, sf_dir):
    rels = relate.heuristic_relationships(keyed(spark, sf_dir), require_name=True)
    return table_sets.joinable_sets(rels, size=4).select(F.array_join("tables", ",").alias("tables"), F.col("n_tables").cast("long").alias("n_tables"))


@query("doc_slices", f"""WITH {ck.ROWS}, o(worker, t) AS ({ck.values(list(enumerate(NAMES)))})
SELECT worker::BIGINT AS worker, o.t AS "table", n.n AS n_rows FROM o JOIN n ON n.t = o.t WHERE worker < 5""")
def doc_slices(spark, sf_dir):
    c = catalog(spark, sf_dir)
    return table_sets.table_slices(c, 5).join(cat.row_counts(c), "table").withColumn("worker", F.col("worker").cast("long"))


# ---------------------------------------------------------------- verdicts, suggestions, vectors

VERDICTS = """SELECT event_id AS o_orderkey, CASE event_type WHEN 'click' THEN ' YES ' WHEN 'view' THEN 'no'
WHEN 'purchase' THEN 'Unsure' ELSE 'perhaps' END AS verdict FROM {events} WHERE event_type <> 'error'"""


@query("verdicts", f"""WITH v AS ({check_sql(VERDICTS)})
SELECT o.o_orderkey, CASE WHEN v.verdict IS NULL THEN 'yes' WHEN lower(trim(v.verdict)) IN ('yes', 'no', 'unsure') THEN lower(trim(v.verdict))
ELSE 'unsure' END AS verdict FROM orders o LEFT JOIN v ON v.o_orderkey = o.o_orderkey""")
def verdicts(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey")
    return relate.apply_verdicts(orders, feed(spark, sf_dir, VERDICTS), ["o_orderkey"], keep=True)


SUGGESTIONS = """SELECT o_orderkey AS task_id, 'Here are some:' || chr(10) || '1. `SELECT 1 FROM orders_' || CAST(o_custkey AS STRING)
|| ' a JOIN customer b ON a.o_custkey = b.c_custkey LIMIT 1;`' || chr(10) || '- select 1 from t' || CAST(o_orderkey % 100 AS STRING)
|| ' a join ' || lower(o_orderstatus) || '_status b on a.code=b.id limit 1;' || chr(10) || 'UPDATE x SET y = 1;' AS text FROM {orders}"""


@query("suggested", f"""WITH l AS (SELECT unnest(string_split(text, chr(10))) AS line FROM ({check_sql(SUGGESTIONS)})),
s AS (SELECT trim(rtrim({ck.bare('line')}, ';')) AS sql FROM l),
m AS (SELECT regexp_extract(sql, '(?i)SELECT\\s+1\\s+FROM\\s+(\\w+)\\s+a\\s+JOIN\\s+(\\w+)\\s+b\\s+ON\\s+a\\.(\\w+)\\s*=\\s*b\\.(\\w+)', ['t', 'p', 'c', 'k']) AS g
FROM s WHERE lower(sql) LIKE 'select%'),
r AS (SELECT DISTINCT g.t AS t, g.c AS c, g.p AS p, g.k AS k FROM m WHERE g.t <> ''),
e AS (SELECT t, c, p, k FROM r UNION SELECT p, k, t, c FROM r)
SELECT 'How is ' || t || '.' || c || ' related to ' || p || '.' || k || '?' AS question, t || '.' || c || ' -> ' || p || '.' || k AS answer,
0.5::DOUBLE AS confidence FROM e""")
def suggested(spark, sf_dir):
    return relate.parse_suggested(feed(spark, sf_dir, SUGGESTIONS)).select("question", "answer", "confidence")


PROPOSED = """SELECT c_custkey AS task_id, CASE c_custkey % 4 WHEN 0 THEN 'select 1 from ORDERS a join customer b on a.O_CUSTKEY = b.c_custkey limit 1'
WHEN 1 THEN '- SELECT 1 FROM customer a JOIN nation b ON a.c_name = b.n_nationkey LIMIT 1;' WHEN 2 THEN 'SELECT 1 FROM customer a JOIN part b ON a.c_custkey = b.p_partkey LIMIT 1'
ELSE 'SELECT 1 FROM customer a JOIN nothing b ON a.c_custkey = b.id LIMIT 1' END AS text FROM {customer}"""


@query("suggested_checked", """WITH p(t, c, p, k) AS (VALUES ('orders', 'o_custkey', 'customer', 'c_custkey'), ('customer', 'c_custkey', 'part', 'p_partkey')),
n AS (SELECT 'orders' AS t, 'customer' AS p, count(DISTINCT o_custkey) AS n, count(DISTINCT o_custkey) FILTER (o_custkey IN (SELECT c_custkey FROM customer)) AS m FROM orders
UNION ALL SELECT 'customer', 'orders', count(DISTINCT c_custkey), count(DISTINCT c_custkey) FILTER (c_custkey IN (SELECT o_custkey FROM orders)) FROM customer
UNION ALL SELECT 'customer', 'part', count(DISTINCT c_custkey), count(DISTINCT c_custkey) FILTER (c_custkey IN (SELECT p_partkey FROM part)) FROM customer
UNION ALL SELECT 'part', 'customer', count(DISTINCT p_partkey), count(DISTINCT p_partkey) FILTER (p_partkey IN (SELECT c_custkey FROM customer)) FROM part),
e AS (SELECT t, c, p, k FROM p UNION ALL SELECT p, k, t, c FROM p)
SELECT t || '.' || c || ' -> ' || e.p || '.' || k AS answer, n AS n_values, m AS n_matched FROM e JOIN n USING (t, p)""")
def suggested_checked(spark, sf_dir):
    """Proposals against the data: other spelling is found, text against numbers and unknown tables are out."""
    got = relate.check_suggested(feed(spark, sf_dir, PROPOSED), catalog(spark, sf_dir))
    return got.select(F.concat(F.concat_ws(".", "child_table", "child_col"), F.lit(" -> "), F.concat_ws(".", "parent_table", "parent_col")).alias("answer"), "n_values", "n_matched")


@query("embedding_cosine", """SELECT a.vec_id, round(list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS similarity
FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""")
def embedding_cosine(spark, sf_dir):
    a = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    b = a.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other"))
    return a.join(b, "vec_id").select("vec_id", F.round(cosine(F.col("embedding"), F.col("other")), 6).alias("similarity"))


@query("wide_keys", """SELECT count(DISTINCT o_custkey) AS n_values,
count(DISTINCT o_custkey) FILTER (o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)) AS n_matched FROM orders""")
def wide_keys(spark, sf_dir):
    """Keys too wide for a long or a double to tell apart."""
    wide = lambda c: (F.col(c).cast("decimal(38,0)") + F.lit(str(10**19)).cast("decimal(38,0)")).cast("decimal(38,0)").alias(c)
    frames = {"orders": table(spark, sf_dir, "orders").select(wide("o_custkey")),
              "customer": table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(wide("c_custkey"))}
    c = cat.load_catalog(spark, frames, keys={"customer": "c_custkey"})
    return relate.match_counts(c, [("orders", "o_custkey", "customer", "c_custkey")]).select("n_values", "n_matched")


# ---------------------------------------------------------------- pairs from metadata

ONE = generate.ONE_COLUMN
KIND_OF = {ty: generate.FAMILIES.get(ty) for ty in ("BIGINT", "INTEGER", "DOUBLE PRECISION", "TEXT", "TIMESTAMP")}


def _fill_sql(template):
    return "replace(replace('" + template.replace("'", "''") + "', '{t}', t), '{c}', c)"


@query("template_pairs", f"""WITH {NAMED_ONLY}, fam(ty, fam) AS ({ck.values(list(KIND_OF.items()))}),
tpl(fam, q, s) AS ({ck.values([(f, q, s) for _, f, q, s in ONE])}),
typed AS (SELECT cols.t, cols.c, fam.fam, n_distinct, n_rows FROM cols JOIN fam ON fam.ty = cols.ty JOIN prof ON prof.t = cols.t AND prof.c = cols.c WHERE n_nonnull > 0)
SELECT 'column' AS kind, t AS "table", replace(replace(q, '{{t}}', t), '{{c}}', c) AS question, replace(replace(s, '{{t}}', t), '{{c}}', c) AS sql
FROM typed JOIN tpl ON tpl.fam = typed.fam OR tpl.fam = 'any'
UNION ALL SELECT 'group', t, {_fill_sql(generate.FEW_VALUES[0])}, {_fill_sql(generate.FEW_VALUES[1])} FROM typed WHERE n_distinct < n_rows
UNION ALL SELECT 'join', t, 'How many ' || t || ' rows belong to each ' || p || '?',
'SELECT b.' || k || ', COUNT(*) FROM ' || t || ' a JOIN ' || p || ' b ON a.' || c || ' = b.' || k || ' GROUP BY b.' || k FROM nm
UNION ALL SELECT 'chain', x.t, 'How many ' || x.t || ' rows belong to each ' || y.p || ' by way of ' || x.p || '?',
'SELECT c.' || y.k || ', COUNT(*) FROM ' || x.t || ' a JOIN ' || x.p || ' b ON a.' || x.c || ' = b.' || x.k || ' JOIN ' || y.p || ' c ON b.' || y.c || ' = c.' || y.k || ' GROUP BY c.' || y.k
FROM nm x JOIN nm y ON x.p = y.t AND x.t <> y.p""")
def template_pairs(spark, sf_dir):
    c = keyed(spark, sf_dir)
    return generate.template_pairs(c, profile.profile_columns(c), relate.heuristic_relationships(c, require_name=True))


@query("schema_docs", f"""WITH {ck.KEYS}, {ck.COLS}, {ck.PROFILE}, fk(t, c, p, k) AS ({ck.values([(t, c[0], p, k[0]) for t, c, p, k in FOREIGN_KEYS])})
SELECT t AS "table", 'How many columns does ' || t || ' have?' AS question, t || ' has ' || count(*) || ' columns.' AS answer FROM cols GROUP BY t
UNION ALL SELECT t, 'What is the primary key of ' || t || '?', 'The primary key of ' || t || ' is ' || k || '.' FROM keys
UNION ALL SELECT t, 'What is the type of ' || t || '.' || c || '?', t || '.' || c || ' has type ' || ty || '.' FROM cols
UNION ALL SELECT t, 'Is ' || t || '.' || c || ' always filled?', 'Yes, every row of ' || t || ' has a ' || c || '.' FROM prof WHERE n_rows > 0 AND n_rows = n_nonnull
UNION ALL SELECT t, 'What does ' || t || '.' || c || ' refer to?', t || '.' || c || ' refers to ' || p || '.' || k || '.' FROM fk""")
def schema_docs(spark, sf_dir):
    c = keyed(spark, sf_dir, fks=True)
    return generate.schema_doc_pairs(c, profile.profile_columns(c))
