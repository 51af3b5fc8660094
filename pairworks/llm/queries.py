"""The registered queries of this subpackage and the SQL that checks them where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import configure
from ..sources.catalog import local_frame
from . import collocations, decontaminate, langid, packing, partenum, pii, rules, search, sharding, suffixes, trees, urls, warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# The letters that are lowered.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The tokenizer file of the packing query; every machine has it at the same place."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op5_decontaminate"] = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM bw),
dw AS (
  SELECT doc_id, i, size, array_to_string(w[i:i + size - 1], ' ') AS g
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM d, sizes WHERE len(w) >= size)),
m AS (SELECT doc_id, item_id, i, dw.size FROM dw JOIN bw USING (size, g)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS l
       FROM (SELECT DISTINCT doc_id, cast(item_id AS VARCHAR) AS s FROM m) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(hit.n, 0) AS n_hit, coalesce(it.n, 0) AS n_items,
  sha256(coalesce(it.l, '')) AS items_sha256, coalesce(hit.n, 0) > 0 AND 20 * coalesce(hit.n, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)"""


@query
def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.report(table(spark, sf_dir, "documents"))


@query
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return partenum.report(table(spark, sf_dir, "documents"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.report(table(spark, sf_dir, "documents"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.report(table(spark, sf_dir, "documents"), tokenizer_path(), fold=True)


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


ORACLES["op3_warc"] = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS d FROM pages),
t AS (SELECT d, max(page_id) AS top FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, cast(n AS BIGINT) AS payload_bytes, p.d AS payload_digest,
  CASE WHEN top <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN top <> page_id THEN top END AS refers_to
FROM p LEFT JOIN t ON p.d = t.d AND p.n >= 1000"""

# The rules of the URL query, in the order given.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query
def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = local_frame(spark, URL_RULES, "host string, path string, verdict string")
    return urls.report(table(spark, sf_dir, "pages"), given)


ORACLES["op8_url_filter"] = f"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (
  SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(substr(coalesce(rest, ''), length(regexp_extract(coalesce(rest, ''), '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
r(host, path, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
b AS (
  SELECT page_id, arg_max(r.host || r.path, length(r.host || r.path)) AS rule, arg_max(verdict, length(r.host || r.path)) AS verdict
  FROM h JOIN r ON (h.host = r.host OR ends_with(h.host, '.' || r.host)) AND starts_with(h.path, r.path) GROUP BY page_id)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM h LEFT JOIN b USING (page_id)"""


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


@query
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.report(table(spark, sf_dir, "documents"))


@query
def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trees.report(table(spark, sf_dir, "documents"))


ORACLES["op11_substring_dedup"] = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)),
f AS (SELECT g, min(doc_id) AS first FROM g GROUP BY g),
x AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(i, i + 13)) AS p FROM g JOIN f USING (g) WHERE first < doc_id) GROUP BY doc_id)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, cast(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN x USING (doc_id)"""


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


ORACLES["op12_collocations"] = f"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM t),
n AS (SELECT lang, cast(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, range(1, 5) AS r(k) WHERE len(w) >= k),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS p, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
c AS (SELECT lang, k, p, f AS a, string_split(p, ' ') AS w FROM f WHERE k > 1),
s AS (
  SELECT c.lang, c.p, c.a, x.f AS l, y.f AS r, j, (2000000 * c.a::HUGEINT) // (x.f + y.f) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
  JOIN f x ON x.lang = c.lang AND x.p = array_to_string(c.w[1:j], ' ')
  JOIN f y ON y.lang = c.lang AND y.p = array_to_string(c.w[j + 1:c.k], ' ')),
b AS (SELECT lang, p, a, l, r, score FROM s QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, j) = 1),
sub AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS p, max(a) AS longer
  FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM c, range(2, 4) AS q(m) WHERE m < k) GROUP BY ALL),
o AS (
  SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank
  FROM b LEFT JOIN sub USING (lang, p) WHERE longer IS NULL OR 100 * longer::HUGEINT < 80 * a::HUGEINT)
SELECT lang, rank, p AS phrase, a, l, r, n, cast(score AS BIGINT) AS score FROM o JOIN n USING (lang) WHERE rank <= 2000"""


@query
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLES["op13_ranked_search"] = f"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
s AS (SELECT count(*) FILTER (len(w) > 0) AS n, cast(sum(len(w)) AS BIGINT) AS l FROM d),
tf AS (SELECT doc_id, t, len, count(*) AS tf FROM (SELECT doc_id, len(w) AS len, unnest(w) AS t FROM d) GROUP BY ALL),
w AS (SELECT t, cast(floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT t, count(*) AS df FROM tf GROUP BY t), s),
q AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
  FROM benchmark),
f AS (
  SELECT item_id, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * len * n) // l)))) AS BIGINT) AS score
  FROM q JOIN tf USING (t) JOIN w USING (t), s GROUP BY ALL)
SELECT item_id, cast(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM f WHERE score > 0 QUALIFY rank <= 10"""
