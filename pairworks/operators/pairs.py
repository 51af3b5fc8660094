"""Refinement of question/SQL and question/answer pairs.

A pair is a row with ``task_id, pos`` and ``question`` with ``sql`` or ``answer``; ``(task_id, pos)``
is the order in which pairs count as having come in.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..session import by_key, cut_lineage
from ..sources.catalog import Catalog, with_schema
from .windows import row_number

FAIL = "FAIL"
ORDER = ("task_id", "pos")
EARLY_LIMIT = 1000


# ---------------------------------------------------------------- reading model replies

def json_lines(col) -> Column:
    """Lines of a reply that may hold JSON, without blanks, fences, bullets, ticks and chatter."""
    trimmed = F.filter(F.transform(tx.lines(col), tx.strip), lambda l: (l != "") & ~l.startswith("```"))
    bare = F.transform(trimmed, tx.strip_bullet)
    return F.filter(bare, lambda l: F.left(l, F.lit(1)).isin("[", "{", "]", "}"))


def text_field(variant, name: str) -> Column:
    """A member that is a JSON string; other kinds give null."""
    member = F.try_variant_get(variant, f"$.{name}", "variant")
    return F.when(F.schema_of_variant(member) == "STRING", tx.field(variant, name))


def parse_pairs(replies: DataFrame, text: str = "text", keep: tuple = ("task_id",)) -> DataFrame:
    """Pairs found in replies: ``keep, pos, question, sql, answer``.

    A reply that is one JSON value gives its objects, those of its ``pairs`` list, or itself; any other
    reply gives the objects found line by line.  Objects without a question are dropped; ``pos`` counts the rest.
    """
    keep = list(keep)
    lined = replies.select(*keep, json_lines(F.col(text)).alias("ls"))
    listed = lined.select(*keep, "ls", tx.as_list(F.array_join("ls", "\n")).alias("values"))
    whole = listed.select(*keep, "ls", tx.only_member(F.col("values")).alias("whole"))
    found = F.when(F.col("whole").isNotNull(), tx.as_items(F.col("whole"))).otherwise(tx.json_values(F.col("ls")))
    asked = F.filter(found, lambda x: tx.field(x, "question").isNotNull())
    item = F.col("item")
    return (whole.select(*keep, F.posexplode(asked).alias("pos", "item"))
            .select(*keep, "pos", tx.field(item, "question").alias("question"),
                    text_field(item, "sql").alias("sql"), tx.field(item, "answer").alias("answer")))


def parse_answer(replies: DataFrame, text: str = "text", question: str = "question") -> DataFrame:
    """One object per reply: adds ``sql``, ``question`` (the task's by default) and ``rows`` (JSON list).

    A reply that is no JSON object is taken as SQL.
    """
    body = F.coalesce(F.nullif(F.col(text), F.lit("")), F.lit("{}"))
    read = replies.withColumn("v", tx.as_list(body)).withColumn("v", tx.only_member(F.col("v")))
    read = read.withColumn("v", F.when(tx.is_object(F.col("v")), F.col("v")))
    v, plain = F.col("v"), F.col("v").isNull()
    rows = F.try_variant_get(v, "$.rows", "array<variant>")
    return (read.withColumn("sql", tx.clean_sql(F.when(plain, body).otherwise(text_field(v, "sql"))))
            .withColumn("rows", F.coalesce(F.to_json(rows), F.lit("[]")))
            .withColumn("question", F.coalesce(tx.field(v, "question"), F.col(question)))
            .drop("v"))


# ---------------------------------------------------------------- dropping, deduplicating, limiting

def drop_failures(pairs: DataFrame) -> DataFrame:
    """Rows with usable SQL: neither failed nor blank once cleaned."""
    return (pairs.withColumn("sql", tx.clean_sql(F.col("sql"))).where(~F.col("sql").isin(FAIL, "")))


def mark_failures(pairs: DataFrame, ok: str = "ok") -> DataFrame:
    """``FAIL`` as the SQL of every pair that did not pass."""
    return pairs.withColumn("sql", F.when(F.col(ok), F.col("sql")).otherwise(FAIL))


def first_of_each(pairs: DataFrame, key: list[str], order: tuple = ORDER, n: int = 1) -> DataFrame:
    """The first ``n`` rows per key.  The limit also applies before the shuffle, so a key that holds
    most rows sends at most ``n`` per task."""
    if n > EARLY_LIMIT:
        # Spark limits groups before the shuffle only up to this size; beyond it groups are numbered range by range
        return row_number(pairs, key, list(order[:-1]), order[-1], "rn").where(F.col("rn") <= n).drop("rn")
    w = Window.partitionBy(*key).orderBy(*order)
    return pairs.withColumn("rn", F.row_number().over(w)).where(F.col("rn") <= n).drop("rn")


def dedup_qa(pairs: DataFrame) -> DataFrame:
    return first_of_each(pairs, ["question", "answer"])


def dedup_sql(pairs: DataFrame) -> DataFrame:
    """One question per cleaned SQL; failed and blank SQL is dropped."""
    return first_of_each(drop_failures(pairs), ["sql"])


def dedup_pair(pairs: DataFrame) -> DataFrame:
    return first_of_each(pairs, ["question", "sql"])


def quota(pairs: DataFrame, k: int, count_failures: bool = False) -> DataFrame:
    """At most ``k`` pairs per task, in order; failed pairs are dropped first unless they are to count."""
    return first_of_each(pairs if count_failures else drop_failures(pairs), ["task_id"], ("pos",), k)


def run_quota(pairs: DataFrame, goal: int, per_task: bool = False, tasks: int = 1) -> DataFrame:
    """The first ``goal`` pairs of the run, or ``goal`` times ``tasks`` where the goal is per task."""
    return pairs.orderBy(*ORDER).limit(goal * tasks if per_task else goal)


def batch_size(goal: int, workers: int) -> int:
    """Pairs asked of each worker so that all together reach the goal."""
    return -(-goal // max(workers, 1))


# ---------------------------------------------------------------- schema tags

# up to so many names, one search for each is quicker than the pattern of all
FEW_NAMES = 64


def extract_tables(sql, names: list[str], word_boundary: bool = False) -> Column:
    """Names from the catalog that occur in the text, in catalog order.

    Many names are looked for in one pass by the pattern of their letters.
    """
    lower = F.lower(F.coalesce(sql, F.lit("")))
    if len(names) > FEW_NAMES:
        spelled: dict[str, list[str]] = {}
        for n in names:
            spelled.setdefault(n.lower(), []).append(n)
        found = tx.words_found(lower, [n.lower() for n in names], word_boundary)
        if all(same == [low] for low, same in spelled.items()):
            return found
        by_lower = tx.literal_map({low: [{"i": names.index(n), "n": n} for n in same] for low, same in spelled.items()}, "map<string,array<struct<i:int,n:string>>>")
        return F.transform(F.array_sort(F.flatten(F.transform(F.array_distinct(found), lambda low: F.element_at(by_lower, low)))), lambda e: e["n"])

    def holds(name):
        if word_boundary:
            return F.regexp_like(lower, F.lit(rf"\b\Q{name.lower()}\E\b"))
        return F.contains(lower, F.lit(name.lower()))

    return F.array_compact(F.array(*[F.when(holds(n), F.lit(n)) for n in names]))


def tag_schema(pairs: DataFrame, catalog: Catalog, word_boundary: bool = False) -> DataFrame:
    """Adds ``tables`` and ``schema``, the JSON of the tables the SQL mentions."""
    tagged = pairs.withColumn("tables", extract_tables(F.col("sql"), catalog.names, word_boundary))
    return with_schema(tagged, catalog)


# ---------------------------------------------------------------- reviews

def apply_reviews(pairs: DataFrame, reviews: DataFrame) -> DataFrame:
    """Replace SQL by its review's fix and add ``score``.

    ``reviews`` has ``question, sql, response, seq``; the last review of a pair counts.  A reply that is
    no JSON object scores 0.0 and keeps the candidate; a pair without review has no score.
    """
    last = reviews.groupBy("question", "sql").agg(F.max_by("response", "seq").alias("response"))
    read = pairs.join(by_key(last), ["question", "sql"], "left").withColumn("v", tx.as_list(F.col("response")))
    read = read.withColumn("v", tx.only_member(F.col("v")))
    v = F.col("v")
    ok = v.isNotNull() & tx.is_object(v)
    fixed = tx.clean_sql(F.coalesce(tx.field(v, "fixed_sql"), F.col("sql")))
    score = F.coalesce(F.try_variant_get(v, "$.score", "double"), F.lit(0.0))
    return (read.withColumn("score", F.when(F.col("response").isNull(), F.lit(None)).when(ok, score).otherwise(F.lit(0.0)))
            .withColumn("sql", F.when(ok, fixed).otherwise(F.col("sql"))).drop("v", "response"))


def fix_rounds(pairs: DataFrame, check: Callable[[DataFrame], DataFrame],
               review: Callable[[DataFrame], DataFrame] | None, fixes: int = 2, cut: bool = True) -> DataFrame:
    """Check pairs, review those that fail, and check again; pairs still failing are dropped.

    ``check`` adds a boolean ``ok``; ``review`` returns reviews for failing pairs, none means no fixing.
    Each round is checkpointed, so that no check runs twice; ``cut=False`` keeps everything lazy.
    """
    columns = pairs.columns
    passed, open_ = None, pairs
    for turn in range(fixes + 1):
        checked = check(open_)
        checked = cut_lineage(checked) if cut else checked
        good = checked.where("ok").select(*columns)
        passed = good if passed is None else passed.unionByName(good)
        if review is None or turn == fixes:
            break
        bad = checked.where(~F.coalesce(F.col("ok"), F.lit(False))).select(*columns)
        open_ = apply_reviews(bad, review(bad)).select(*columns)
    return passed


# ---------------------------------------------------------------- datasets

# The key that must be unique in a phase's dataset; other phases use question and SQL.
PHASE_KEYS = {
    "schema_docs": ["question", "answer"], "schema_relationship": ["question", "answer"],
    "single_table": ["sql"], "joins": ["sql"], "complex_sqls": ["sql"],
}


# the tables of a schema tag, in their order
SCHEMA_TAG = ("struct<tables:map<string,struct<columns:map<string,struct<type:string,comment:string>>,primary_key:string,comment:string,"
              "foreign_keys:array<struct<referred_table:string,constrained_columns:array<string>,referred_columns:array<string>>>>>>")


def dataset_rows(pairs: DataFrame, phase: str, catalog: Catalog | None = None) -> DataFrame:
    """The rows of a phase's dataset; with a catalog, tagged with the schema of the tables mentioned."""
    key = PHASE_KEYS.get(phase, ["question", "sql"])
    if "answer" in key:
        return first_of_each(pairs, key).select("question", "answer")
    kept = first_of_each(drop_failures(pairs), key)
    if catalog is None:
        return kept.select("question", "sql")
    # an object in the written line, not its text
    return tag_schema(kept, catalog).select("question", "sql", F.from_json("schema", SCHEMA_TAG).alias("schema"))
