"""Token usage, cost and budgets.

``usage`` rows have ``run_id, seq, in_tok, out_tok``; ``seq`` is unique within a run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut_lineage
from .windows import SPAN, running_sum, starts

# Price in USD per 1,000 tokens in and out.
IN_PRICE, OUT_PRICE = 0.005, 0.015

MICROS = 1_000_000
LAST = (1 << 63) - 1


def cost(in_tok, out_tok) -> Column:
    """USD of one request."""
    return in_tok * F.lit(IN_PRICE / 1000) + out_tok * F.lit(OUT_PRICE / 1000)


def cost_micros(in_tok, out_tok) -> Column:
    """The same in whole millionths, so that sums do not depend on their order."""
    return (in_tok * round(IN_PRICE * 1000) + out_tok * round(OUT_PRICE * 1000)).cast("long")


def usage_totals(usage: DataFrame) -> DataFrame:
    """Per run: tokens in and out, requests and cost."""
    micros = F.sum(cost_micros(F.col("in_tok"), F.col("out_tok")))
    return usage.groupBy("run_id").agg(F.sum("in_tok").alias("in_tok"), F.sum("out_tok").alias("out_tok"),
                                       F.count(F.lit(1)).alias("requests"), (micros / MICROS).alias("cost_usd"))


def remaining_budget(usage: DataFrame, budget: float) -> DataFrame:
    totals = usage_totals(usage)
    return totals.withColumn("budget_left", F.round(F.lit(budget) - F.col("cost_usd"), 6))


def stop_at_budget(usage: DataFrame, budget: float, span: int = SPAN) -> DataFrame:
    """Adds ``accepted``: the requests before the first that would exceed the budget."""
    priced = usage.withColumn("micros", cost_micros(F.col("in_tok"), F.col("out_tok")))
    run = running_sum(priced, ["run_id"], ["seq"], "micros", "spent", span)
    return run.withColumn("accepted", F.col("spent") <= round(budget * MICROS)).drop("micros", "spent", "_key", "_part")


def _first_event(rows: DataFrame) -> DataFrame:
    """Per run, the first request that halves what is left: ``_key, at, spent``.

    ``rows`` are undecided and affordable.  Small requests, up to half of ``left``, are accepted as long as
    more than half is left; the event is the small one that ends this, or the first larger one that fits.
    """
    small = F.when(F.col("micros") * 2 <= F.col("left"), F.col("micros")).otherwise(0)
    cut = rows.withColumn("small", small)
    before = Window.partitionBy("_key", "_part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    local = cut.withColumn("prior", F.coalesce(F.sum("small").over(before), F.lit(0)))
    # what must have been spent at most before the range for a large request in it to fit
    need = F.when(F.col("small") == 0, F.col("micros") + F.col("prior"))
    parts = local.groupBy("_key", "_part").agg(F.first("left").alias("left"), F.sum("small").alias("part"), F.min(need).alias("need"))
    parts = parts.join(starts(parts, "part", "start"), ["_key", "_part"])
    hit = ((F.col("start") + F.col("part")) * 2 >= F.col("left")) | (F.col("start") + F.col("need") <= F.col("left"))
    first = parts.where(hit).groupBy("_key").agg(F.min_by(F.struct("_part", "start"), "_part").alias("s"))
    hits = cut.join(first.select("_key", F.col("s._part").alias("_part"), F.col("s.start").alias("start")), ["_key", "_part"])
    inside = (hits.withColumn("prior", F.col("start") + F.coalesce(F.sum("small").over(before), F.lit(0)))
              .withColumn("spent", F.col("prior") + F.col("micros")))
    event = F.when(F.col("small") > 0, F.col("spent") * 2 >= F.col("left")).otherwise(F.col("spent") <= F.col("left"))
    return inside.where(event).groupBy("_key").agg(F.min(F.struct("at", "spent")).alias("e")).select("_key", "e.at", "e.spent")


def apply_budget(usage: DataFrame, budget: float, span: int = SPAN) -> DataFrame:
    """Adds ``accepted``: each request in turn passes if it still fits; one that does not costs nothing.

    This is not a prefix of the run: a cheaper request may pass after a refused one.  A running sum finds
    the first refusal of every run; from there on each round finds, for all runs at once, the request at
    which what is left at least halves.  So the number of rounds is at most the logarithm of the dearest
    over the cheapest request, each over fewer rows, and no run is ever gathered in one task.  Requests
    without a run are a run of their own; one without ``seq`` comes last in its run.
    """
    total = round(budget * MICROS)
    # a run as a value that is never null, and the place in it
    priced = (usage.withColumn("micros", cost_micros(F.col("in_tok"), F.col("out_tok")))
              .withColumn("_key", F.struct("run_id")).withColumn("at", F.coalesce(F.col("seq").cast("long"), F.lit(LAST))))
    fits = priced.where((F.col("micros") > 0) & (F.col("micros") <= total)).select("run_id", "at", "micros")
    summed = cut_lineage(running_sum(fits, ["run_id"], ["at"], "micros", "spent", span))
    over = F.col("spent") > total
    stops = cut_lineage(summed.groupBy("_key").agg(
        F.min(F.when(over, F.col("at"))).alias("stop"),
        (F.lit(total) - F.coalesce(F.max(F.when(~over, F.col("spent"))), F.lit(0))).alias("left")))
    open_ = cut_lineage(summed.join(stops, "_key").where((F.col("at") > F.col("stop")) & (F.col("micros") <= F.col("left")))
                        .select("_key", "_part", "at", "micros", "left"))
    events = stops.limit(0).select("_key", F.col("stop").alias("at"), F.col("left").alias("spent"))
    while True:
        found = cut_lineage(_first_event(open_))
        if found.isEmpty():
            break
        events = events.unionByName(found)
        marks = found.select("_key", F.col("at").alias("mark"), "spent")
        open_ = cut_lineage(open_.join(marks, "_key").where(F.col("at") > F.col("mark"))
                            .withColumn("left", F.col("left") - F.col("spent")).where(F.col("micros") <= F.col("left"))
                            .select("_key", "_part", "at", "micros", "left"))
    # the events of a run cut what follows its first refusal into stretches, each with what was left at its start
    by_run = events.groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("at", "spent"))).alias("es"))
    judged = priced.join(stops.join(by_run, "_key", "left"), "_key", "left")
    before = F.filter("es", lambda e: e["at"] < F.col("at"))
    left = F.col("left") - F.coalesce(F.aggregate(before, F.lit(0).cast("long"), lambda acc, e: acc + e["spent"]), F.lit(0))
    is_event = F.coalesce(F.exists("es", lambda e: e["at"] == F.col("at")), F.lit(False))
    late = is_event | (F.col("micros") * 2 <= left)
    early = F.col("stop").isNull() | (F.col("at") < F.col("stop"))
    accepted = (F.when(F.col("micros") == 0, True).when(F.col("micros") > total, False).when(early, True)
                .when(F.col("at") == F.col("stop"), False).otherwise(late))
    return judged.withColumn("accepted", accepted).drop("micros", "es", "stop", "left", "at", "_key")


def progress(pairs: DataFrame) -> DataFrame:
    """Per task: distinct pairs, and those no earlier task had."""
    own = pairs.select("task_id", "question", "sql").distinct()
    firsts = own.groupBy("question", "sql").agg(F.min("task_id").alias("task_id"), F.count(F.lit(1)).alias("n"))
    distinct = own.groupBy("task_id").agg(F.count(F.lit(1)).alias("n_distinct"))
    new = firsts.groupBy("task_id").agg(F.count(F.lit(1)).alias("n_new"))
    return (distinct.join(new, "task_id", "left").select("task_id", "n_distinct", F.coalesce("n_new", F.lit(0)).alias("n_new")))
