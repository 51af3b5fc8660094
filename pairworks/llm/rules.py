"""Quality rules: counts of each text, and a decision list learned from labelled documents.

All counts are column expressions.  The list is learned by sequential covering: a conjunction of thresholds is grown on two
thirds of the labelled rows by information gain, pruned on the rest, and what it covers is set aside; the rules that hold up
become one ordered conditional expression.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name, settled, text_or_empty

# What separates words, and the symbols that are counted.
BLANKS, SYMBOLS = " \t\n\x0b\x0c\r", "#*$%&|<>"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LEAST_WORDS, MOST_REPEATED = 50, 50
MOST_ROWS, MOST_RULES, MOST_CONDITIONS, THRESHOLDS = 20_000, 12, 4, 24
LEAST_PRECISION = 0.8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["n_words", "mean_word", "symbols", "dup_lines", "repeat_words", "distinct_words", "capitals", "marks"]


def removed(text: Column, letters: str) -> Column:
    """How many characters of `text` are among `letters`."""
    return F.length(text) - F.length(F.translate(text, letters, ""))


def word_list(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, r"[\x20\x09-\x0D]+"))


def with_counts(docs: DataFrame, text: str = "text", into: str = "counts") -> DataFrame:
    """`docs` with one more column, a struct of the counts and features.

    A null text is empty and counts 0 throughout.  Windows of three words are compared by a 64-bit hash of the words.
    """
    into, n = free_name(docs, into), {k: free_name(docs, f"{into}_{k}") for k in ("text", "words", "windows", "lines", "ranked", "places", "counts")}
    t, w, g, lines, r, p, c = (F.col(f"`{x}`") for x in n.values())
    out = settled(docs, {n["text"]: text_or_empty(docs[text])})
    out = settled(out, {n["words"]: word_list(t), n["lines"]: F.filter(F.split(t, "\n"), lambda x: F.btrim(x, F.lit(BLANKS)) != "")})
    out = settled(out, {n["windows"]: F.transform(F.slice(w, F.lit(1), F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2)))})
    # only texts that repeat a window at all sort theirs
    out = settled(out, {n["ranked"]: F.when(F.size(F.array_distinct(g)) < F.size(g), F.sort_array(F.transform(g, lambda x, i: F.struct(x.alias("x"), i.alias("i")))))})
    out = settled(out, {n["places"]: F.sort_array(F.transform(
        F.filter(r, lambda e, j: (e.x == F.get(r, j - 1).x) | (e.x == F.get(r, j + 1).x)), lambda e: e.i))})
    covered = F.aggregate(
        F.transform(p, lambda x, j: F.when(j == 0, F.lit(3)).otherwise(F.least(F.lit(3), x - F.get(p, j - 1)))), F.lit(0), lambda a, x: a + x)
    out = settled(out, {n["counts"]: F.struct(
        F.size(w).cast("long").alias("n_words"), F.length(F.translate(t, BLANKS, "")).cast("long").alias("word_chars"),
        removed(t, SYMBOLS).cast("long").alias("n_symbols"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"), F.size(lines).alias("n_lines"), F.size(F.array_distinct(w)).alias("n_distinct"),
        removed(t, CAPITALS).alias("n_capitals"), removed(t, "!?.,;:").alias("n_marks"))})
    per = lambda a, b: F.when(c[b] > 0, c[a] / c[b]).otherwise(F.lit(0.0)).cast("double")
    return out.withColumn(into, F.struct(
        *(c[x].alias(x) for x in COUNTS), per("word_chars", "n_words").alias("mean_word"), per("n_symbols", "word_chars").alias("symbols"),
        per("n_dup_lines", "n_lines").alias("dup_lines"), per("n_repeat_words", "n_words").alias("repeat_words"),
        per("n_distinct", "n_words").alias("distinct_words"), per("n_capitals", "word_chars").alias("capitals"),
        per("n_marks", "n_words").alias("marks"))).drop(*n.values())


def base_failed(c: Column) -> Column:
    return (c["n_words"] < LEAST_WORDS) | (100 * c["n_repeat_words"] > MOST_REPEATED * c["n_words"])


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.threshold if self.above else row[self.feature] <= self.threshold

    def column(self, c: Column) -> Column:
        return c[self.feature] > F.lit(self.threshold) if self.above else c[self.feature] <= F.lit(self.threshold)


def gain(p0: int, n0: int, p1: int, n1: int) -> float:
    """How much a condition tells about the rows of the class that it keeps."""
    return p1 * (math.log2(p1 / (p1 + n1)) - math.log2(p0 / (p0 + n0))) if p1 else 0.0


def thresholds(rows: list[dict], feature: str) -> list[float]:
    """Middles between distinct values at quantiles of all rows and of the bad ones."""
    picks = set()
    for values in (sorted(r[feature] for r in rows), sorted(r[feature] for r in rows if r["bad"])):
        picks |= {values[len(values) * k // THRESHOLDS] for k in range(THRESHOLDS)} | {values[-1]}
    picks = sorted(picks)
    return [(a + b) / 2 for a, b in zip(picks, picks[1:])]


def grow(rows: list[dict]) -> list[Condition]:
    rule: list[Condition] = []
    while len(rule) < MOST_CONDITIONS and len({r["bad"] for r in rows}) == 2:
        positives = sum(r["bad"] for r in rows)
        best, most = None, 1e-9
        for feature in FEATURES:
            # rows in order of the feature give all counts below a threshold in one walk
            ordered = sorted(rows, key=lambda r: r[feature])
            k = low = 0
            for value in thresholds(rows, feature):
                while k < len(ordered) and ordered[k][feature] <= value:
                    low += ordered[k]["bad"]
                    k += 1
                for above, p, n in ((False, low, k - low), (True, positives - low, len(rows) - k - positives + low)):
                    g = gain(positives, len(rows) - positives, p, n)
                    if g > most:
                        best, most = Condition(feature, above, value), g
        if best is None:
            break
        rule.append(best)
        rows = [r for r in rows if best.holds(r)]
    return rule


def worth(rule: list[Condition], rows: list[dict]) -> tuple[float, int]:
    """Precision and number of rows of the class that a rule covers."""
    covered = [r["bad"] for r in rows if all(c.holds(r) for c in rule)]
    return (sum(covered) + 1) / (len(covered) + 2), sum(covered)


def prune(rule: list[Condition], rows: list[dict]) -> list[Condition]:
    """The beginning of the rule that does best on rows it was not grown on."""
    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (round(worth(r, rows)[0], 6), worth(r, rows)[1], -len(r)))


def cover(rows: list[dict]) -> list[list[Condition]]:
    """The decision list; each row has the features, `bad` and `prunes`."""
    out: list[list[Condition]] = []
    while len(out) < MOST_RULES:
        growing, pruning = [r for r in rows if not r["prunes"]], [r for r in rows if r["prunes"]]
        if not any(r["bad"] for r in growing) or not any(r["bad"] for r in pruning):
            break
        rule = grow(growing)
        if not rule:
            break
        rule = prune(rule, pruning)
        precision, found = worth(rule, pruning)
        if precision < LEAST_PRECISION or not found:
            break
        out.append(rule)
        rows = [r for r in rows if not all(c.holds(r) for c in rule)]
    return out


def learn(docs: DataFrame, labels: DataFrame, most_rows: int = MOST_ROWS) -> list[list[Condition]]:
    """Learn which documents are of quality 0 from at most `most_rows` labelled ones, those with the least hash of the id.

    Null labels and ids are left out; a document labelled more than once is bad if more labels say so than not; of rows with
    the same doc_id one is read.  Documents that fail the fixed rules are left out, as the list is only asked about others.
    Without labels of both kinds there is no rule.
    """
    given = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg("quality") < 0.5).alias("bad"))
    picked = given.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most_rows)
    # at most `most_rows` rows of two small columns
    rows = with_counts(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")) \
        .where(~base_failed(F.col("counts"))).select("doc_id", "bad", (F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(3)) == 0).alias("prunes"),
                *(F.col(f"counts.{f}").alias(f) for f in FEATURES)).dropDuplicates(["doc_id"])
    return cover(sorted((r.asDict() for r in rows.collect()), key=lambda r: r["doc_id"]))


def verdict(rules: list[list[Condition]], c: Column) -> Column:
    """The decision list as an ordered conditional expression: the number of the first rule that rejects, else null."""
    out = None
    for k, rule in enumerate(rules):
        test = rule[0].column(c)
        for condition in rule[1:]:
            test = test & condition.column(c)
        out = F.when(test, F.lit(k)) if out is None else out.when(test, F.lit(k))
    return F.lit(None).cast("int") if out is None else out


def judge(docs: DataFrame, rules: list[list[Condition]], text: str = "text", into: str = "quality_check") -> DataFrame:
    """`docs` with one more column, a struct of the counts, features, base_failed, rule and kept.

    All rows and columns stay; if `into` is taken, underscores are added to it.
    """
    into = free_name(docs, into)
    out, c = with_counts(docs, text, into), F.col(into)
    failed, rule = base_failed(c), verdict(rules, c)
    return out.withColumn(into, F.struct(*(c[x].alias(x) for x in dict.fromkeys([*COUNTS, *FEATURES])), failed.alias("base_failed"), rule.alias("rule"),
                                         (~failed & rule.isNull()).alias("kept")))


def good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are kept, same columns."""
    name = free_name(docs, "quality_check")
    return judge(docs, learn(docs, labels), into=name).where(F.col(name)["kept"]).select(*(F.col(f"`{c}`") for c in docs.columns))


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, the counts, base_failed and kept of every document."""
    found = judge(docs.select("doc_id", "text"), learn(docs, labels))
    return found.select("doc_id", *(f"quality_check.{x}" for x in [*COUNTS, "base_failed", "kept"]))
