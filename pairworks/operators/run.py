"""A generation phase from tasks to its dataset."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import by_key
from ..sources.catalog import Catalog, members, with_schema
from ..sources.jsonl import write_version
from ..sources.samples import masked_samples
from .batch import FOLLOW_DOCS, FOLLOW_SQL, MAX_ROUNDS, converse, single_pairs
from .lint import join_table_count
from .pairs import PHASE_KEYS, dataset_rows, drop_failures, fix_rounds, mark_failures, parse_pairs
from .probe import probe_queries
from .prompts import render_prompts


def table_prompts(catalog: Catalog, template: str, n_rows: int = 0, **mask_rules) -> Callable[[DataFrame], DataFrame]:
    """A prompt function for ``converse``: the template with each task's schema, question and sample rows.

    A task sees the tables of its ``tables`` list if it has one, else its ``table``, else the whole schema.
    ``{{count}}`` is the number of pairs asked for now.
    """
    rows: dict[str, list[str]] = {}
    if n_rows:
        for r in masked_samples(catalog, n_rows, **mask_rules).collect():
            rows.setdefault(r.table, []).append(r.row)
    samples = {t: f'"{t}":[{",".join(found)}]' for t, found in rows.items()}

    def prompt(tasks: DataFrame) -> DataFrame:
        own = F.when(F.col("table").isNotNull(), F.array("table"))
        if "tables" in tasks.columns:
            own = F.coalesce("tables", own)
        names = F.coalesce(own, F.lit(catalog.names))
        shown = with_schema(tasks.withColumn("_shown", names), catalog, "_shown", "_schema")
        return render_prompts(shown, template, {
            "schema_json": F.col("_schema"), "nl_question": F.col("question"),
            "builtin": F.col("fn"), "table": F.col("table"),
            "sample_rows": F.concat(F.lit("{"), members(samples, F.col("_shown")), F.lit("}")),
            "count": F.col("asked").cast("string"), "min_joins": F.col("min_joins").cast("string")})

    return prompt


# The phases whose replies hold many pairs, those that are checked by running them, and the tables a join needs.
LISTS = {"schema_docs", "single_table", "joins", "complex_sqls", "schema_relationship"}
CHECKED = {"joins": 2, "complex_sqls": 3}


def valid_joins(tasks: DataFrame, catalog: Catalog, least: int, review: Callable[[DataFrame], DataFrame] | None = None) -> Callable[[DataFrame], DataFrame]:
    """A check for ``converse``: pairs whose SQL runs, after up to two fixes by ``review``, and names enough tables.

    How many are enough is a task's ``min_joins``, else ``least``.
    """
    needs = tasks.select("task_id", F.coalesce("min_joins", F.lit(least)).alias("needs"))

    def runs(pairs: DataFrame) -> DataFrame:
        return probe_queries(catalog.spark, pairs, catalog=catalog).drop("error")

    def check(pairs: DataFrame) -> DataFrame:
        good = fix_rounds(drop_failures(pairs), runs, review)
        return good.join(by_key(needs), "task_id").where(join_table_count(F.col("sql")) >= F.col("needs")).select(*pairs.columns)

    return check


def run_phase(tasks: DataFrame, catalog: Catalog, template: str, completer: Callable, root: str, phase: str, run_version: str,
              k: int | None = None, batch: int | None = None, n_rows: int = 0, probe: bool | None = None, tag: bool = False,
              check: Callable[[DataFrame], DataFrame] | None = None, rounds: int = MAX_ROUNDS,
              review: Callable[[DataFrame], DataFrame] | None = None, **more) -> str:
    """Ask for the pairs of each task, refine them and replace one version of the phase's dataset; returns its path.

    ``tasks`` come from ``expand_tasks``; a ``tables`` column, as from table sets, narrows their schema.  A task wants ``k`` pairs,
    else its ``count``, else one; in phases whose replies are single objects, one.  Joins and complex queries are checked within
    each round unless ``probe`` is off: SQL that fails is fixed by ``review`` or asked for again, as are pairs with too few tables.
    In other phases ``probe`` runs the SQL once at the end and drops what fails.  All SQL runs over tables registered under their
    names.  ``check`` keeps acceptable pairs within each round.  ``more`` goes to ``converse``: budget, reply log, threads.
    """
    numbered = tasks.where(F.col("phase") == phase).withColumn("task_id", F.concat_ws("-", "phase_id", "pos")).drop("pos", "metadata")
    single = phase not in LISTS
    wanted = F.lit(k) if k else F.lit(1) if single else F.coalesce(F.col("count"), F.lit(1))
    if check is None and phase in CHECKED and probe is not False:
        check = valid_joins(numbered, catalog, CHECKED[phase], review)
    docs = phase == "schema_docs"
    found = converse(numbered, table_prompts(catalog, template, n_rows), completer, wanted, batch, check or (lambda p: p), rounds,
                     follow=FOLLOW_DOCS if docs else FOLLOW_SQL, shortfall=docs, read=single_pairs if single else parse_pairs, **more)
    pairs = found.pairs.withColumn("pos", F.struct("round", "pos"))
    if probe and phase not in CHECKED:
        pairs = mark_failures(probe_queries(catalog.spark, drop_failures(pairs)))
    answers = "answer" in PHASE_KEYS.get(phase, [])
    return write_version(dataset_rows(pairs, phase, catalog if tag and not answers else None), root, phase, run_version)
