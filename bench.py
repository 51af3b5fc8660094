"""Time the headline queries: one JSON line on stdout.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the cores.  ``BENCH_NAIVE=1`` also times the discovery
with one overlap query per candidate, beside the single pass.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pairworks.operators import profile, relate  # noqa: E402
from pairworks.plans import QUERIES  # noqa: E402
from pairworks.plans.tables import catalog  # noqa: E402
from pairworks.session import build_session  # noqa: E402

HEADLINE = ["relationships", "relationships_named", "infer_pk", "profile", "value_overlap", "parse_pairs", "clean_sql",
            "dedup_sql", "tag_schema", "dataset_joins", "mask_rules", "usage_totals", "budget_prefix", "tasks_all",
            "render_prompts", "fn_sum", "fn_row_number", "budget_accept", "run_rounds", "fix_rounds", "probe", "stream_ingest",
            "compact_log", "template_pairs", "fn_lag"]
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def naive(spark, sf_dir: str) -> int:
    """One overlap query per comparable candidate with two metadata votes."""
    c = profile.with_inferred_keys(catalog(spark, sf_dir))
    cands = relate.metadata_signals(relate.candidates(c)).where("cast(s1 AS int) + cast(s2 AS int) + cast(s3 AS int) + cast(s6 AS int) >= 2")
    pairs = [tuple(r) for r in cands.select(*relate.ENDS).collect()]
    pairs = [p for p in pairs if relate.family(c, *p[:2]) == relate.family(c, *p[2:])]
    return sum(relate.value_overlap(c.frames[a], x, c.frames[b], k).first().overlap >= 0.95 for a, x, b, k in pairs)


def timed(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, **{
        "spark.ui.enabled": "false", "spark.driver.memory": "16g", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("OFF")
    seconds = {}
    for name in HEADLINE:
        run = lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        run()
        seconds[name] = round(statistics.median(timed(run) for _ in range(RUNS)), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
    if os.environ.get("BENCH_NAIVE"):
        print(f"naive discovery {timed(lambda: naive(spark, sf_dir)):.1f}", file=sys.stderr)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
