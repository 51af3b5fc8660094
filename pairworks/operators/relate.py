"""Relationship discovery: which columns refer to which keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.similarity import name_similarity
from ..functions.text import lines, say, strip, strip_bullet
from ..sources.catalog import Catalog, local_frame, row_counts, union_all
from .profile import INTEGRAL, long_form, profile_columns, short_text

# Acceptance score, containment share, similarity and distinct-ratio limits, suggestion confidence,
# wording of a relationship and the form of a suggested probe.
ACCEPT_SCORE = 4
CONTAINED = 0.95
SIMILAR = 0.8
REPEATED = 0.8
SUGGESTED = 0.5
QUESTION, ANSWER = "How is {a} related to {b}?", "{a} -> {b}"
SUGGESTION = r"(?i)SELECT\s+1\s+FROM\s+(\w+)\s+a\s+JOIN\s+(\w+)\s+b\s+ON\s+a\.(\w+)\s*=\s*b\.(\w+)"

ENDS = ["child_table", "child_col", "parent_table", "parent_col"]
WORD = 62          # columns per bit word
MAX_COLUMNS = 992  # columns per pass: sixteen words


# ---------------------------------------------------------------- single checks

def distinct_values(df: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Distinct non-null values; a limit takes them in hash order so that it is repeatable."""
    vals = df.select(F.col(column).alias("value")).where(F.col("value").isNotNull()).distinct()
    return vals if limit is None else vals.orderBy(F.xxhash64("value"), "value").limit(limit)


def value_overlap(child: DataFrame, c: str, parent: DataFrame, k: str, limit: int | None = None) -> DataFrame:
    """``n_values, n_matched, overlap``: the share of the child's distinct values the parent holds."""
    left = distinct_values(child, c, limit)
    right = distinct_values(parent, k).select(F.col("value").alias("key"))
    joined = left.join(right, F.col("value") == F.col("key"), "left")
    return (joined.agg(F.count("value").alias("n_values"), F.count("key").alias("n_matched"))
            .withColumn("overlap", F.coalesce(F.try_divide(F.col("n_matched").cast("double"), F.col("n_values")), F.lit(0.0))))


def values_contained(child: DataFrame, c: str, parent: DataFrame, k: str, limit: int | None = None) -> DataFrame:
    return value_overlap(child, c, parent, k, limit).withColumn("contained", F.col("overlap") >= CONTAINED)


def orphans(child: DataFrame, c: str, parent: DataFrame, k: str) -> DataFrame:
    """``value, n_rows``: child values the parent lacks, counted before the join so a hot value is one row."""
    counted = (child.where(F.col(c).isNotNull()).groupBy(F.col(c).alias("value"))
               .agg(F.count(F.lit(1)).alias("n_rows")))
    return counted.join(parent.select(F.col(k).alias("key")), F.col("value") == F.col("key"), "left_anti")


def no_orphans(child: DataFrame, c: str, parent: DataFrame, k: str) -> DataFrame:
    """One row, ``orphan_rows, ok``."""
    return (orphans(child, c, parent, k).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("orphan_rows"))
            .withColumn("ok", F.col("orphan_rows") == 0))


def join_exists(child: DataFrame, c: str, parent: DataFrame, k: str) -> DataFrame:
    """One row, ``joined``: whether any child value meets a parent key."""
    met = distinct_values(child, c).join(parent.select(F.col(k).alias("key")), F.col("value") == F.col("key"), "left_semi")
    return met.limit(1).agg((F.count(F.lit(1)) > 0).alias("joined"))


# ---------------------------------------------------------------- declared keys

def _sentences(df: DataFrame) -> DataFrame:
    """Question and answer text for the four ends."""
    a = F.concat_ws(".", "child_table", "child_col")
    b = F.concat_ws(".", "parent_table", "parent_col")
    return df.withColumn("question", say(QUESTION, a=a, b=b)).withColumn("answer", say(ANSWER, a=a, b=b))


def both_ways(rels: DataFrame) -> DataFrame:
    """Each relationship and its reverse as ``ENDS, confidence, source, question, answer``; one row per answer.

    Earlier sources win, then the higher confidence.
    """
    kept = rels.select(*ENDS, "confidence", "source")
    back = kept.select(F.col("parent_table").alias("child_table"), F.col("parent_col").alias("child_col"),
                       F.col("child_table").alias("parent_table"), F.col("child_col").alias("parent_col"),
                       "confidence", "source")
    best = (kept.unionByName(back).groupBy(*ENDS)
            .agg(F.min(F.struct("source", (-F.col("confidence")).alias("minus"))).alias("best"))
            .select(*ENDS, (-F.col("best.minus")).alias("confidence"), F.col("best.source").alias("source")))
    return _sentences(best)


def _declared(catalog: Catalog) -> DataFrame:
    pairs = F.arrays_zip(F.col("constrained").alias("c"), F.col("referred").alias("r"))
    return (catalog.fks_df.where(F.col("referred_table").isNotNull())
            .select(F.col("table").alias("child_table"), F.explode(pairs).alias("p"), "referred_table")
            .where(F.col("p.c").isNotNull() & F.col("p.r").isNotNull())
            .select("child_table", F.col("p.c").alias("child_col"), F.col("referred_table").alias("parent_table"),
                    F.col("p.r").alias("parent_col"), F.lit(1.0).alias("confidence"), F.lit(0).alias("source")))


def explicit_fks(catalog: Catalog) -> DataFrame:
    """Declared foreign keys in both directions, confidence 1.0."""
    return both_ways(_declared(catalog))


# ---------------------------------------------------------------- candidates and their signals

def candidates(catalog: Catalog) -> DataFrame:
    """Every column beside the key of every other table: ``ENDS, child_type, parent_type, comment``.

    The keys ride along as one literal list, at most one entry per table of the catalog.
    """
    types = {(t, n): ty for t, _, n, ty, _ in catalog.column_rows()}
    keys = [(t, k, types[(t, k)]) for t, k in catalog.keys.items()]
    if not keys:
        return local_frame(catalog.spark, [], ", ".join(f"{c} string" for c in [*ENDS, "child_type", "parent_type", "comment"]))
    known = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(k).alias("k"), F.lit(ty).alias("ty")) for t, k, ty in keys])
    return (catalog.columns_df.withColumn("key", F.explode(known)).where(F.col("table") != F.col("key.t"))
            .select(F.col("table").alias("child_table"), F.col("name").alias("child_col"),
                    F.col("key.t").alias("parent_table"), F.col("key.k").alias("parent_col"),
                    F.col("type").alias("child_type"), F.col("key.ty").alias("parent_type"), "comment"))


def base_name(table) -> Column:
    """Lower-cased table name without trailing ``s``."""
    return F.regexp_replace(F.lower(table), "s+$", "")


def same_type(a, b) -> Column:
    """Base type names agree; the part from ``(`` on is ignored."""
    base = lambda t: F.lower(F.substring_index(t, "(", 1))
    return base(a) == base(b)


def name_scores(cands: DataFrame) -> DataFrame:
    """``name_score``: the best of five similarities; ``s1``: it is high, or the column contains the table's base name."""
    base, col, pk = base_name(F.col("parent_table")), F.col("child_col"), F.col("parent_col")
    others = [pk, F.concat_ws("_", "parent_table", pk), F.concat_ws("_", base, pk), F.col("parent_table"), base]
    scored = cands.withColumn("name_score", F.greatest(*[name_similarity(col, o) for o in others]))
    return scored.withColumn("s1", (F.col("name_score") >= SIMILAR) | F.contains(F.lower("child_col"), base))


def metadata_signals(cands: DataFrame) -> DataFrame:
    """s1 name, s2 type, s3 comment mention, s6 not called ``id``."""
    return (name_scores(cands)
            .withColumn("s2", same_type(F.col("child_type"), F.col("parent_type")))
            .withColumn("s3", F.contains(F.lower(F.coalesce("comment", F.lit(""))), base_name(F.col("parent_table"))))
            .withColumn("s6", F.lower("child_col") != "id"))


def _votes(*names) -> Column:
    return sum((F.col(n).cast("int") for n in names), F.lit(0))


# ---------------------------------------------------------------- one pass for all candidates

def family(catalog: Catalog, table: str, column: str) -> str | None:
    """Values are comparable within a family only; numbers of every type are one family."""
    kind = catalog.frames[table].schema[column].dataType
    if isinstance(kind, (*INTEGRAL, T.FloatType, T.DoubleType, T.DecimalType)):
        return "num"
    if isinstance(kind, T.BooleanType):
        return "bool"
    if isinstance(kind, T.DateType):
        return "date"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "ts"
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        return "uuid" if catalog.types.get((table, column)) == "UUID" else "text"
    return None


def value_form(catalog: Catalog, table: str, column: str) -> Column:
    """Comparable form of a column: text, or ``struct<l,d,x>`` with whole numbers as long, others as double, and as text what
    neither holds exactly: wider whole numbers, and decimals that no double equals."""
    kind, col = catalog.frames[table].schema[column].dataType, F.col(f"`{column}`")
    exact = lambda e: F.struct(e.cast("long").alias("l"), F.lit(None).cast("double").alias("d"), F.lit(None).cast("string").alias("x"))
    wide = lambda: col.try_cast("decimal(38,0)").cast("string")
    if isinstance(kind, INTEGRAL):
        return exact(col)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        small = F.abs(col) < F.lit(9.0e18)
        whole = (col == F.floor(col)) & small
        large = ~small & (F.abs(col) < F.lit(1.0e38))
        return F.struct(F.when(whole, col.try_cast("long")).alias("l"), F.when(~whole & ~large, col.cast("double")).alias("d"), F.when(large, wide()).alias("x"))
    if isinstance(kind, T.DecimalType):
        whole, small = col == F.floor(col), F.abs(col) < F.lit(9 * 10**18).cast("decimal(38,0)")
        same = col.cast("double").try_cast(kind) == col
        return F.struct(F.when(whole & small, col.try_cast("long")).alias("l"), F.when(~whole & same, col.cast("double")).alias("d"),
                        F.when(whole & ~small, wide()).when(~whole & ~F.coalesce(same, F.lit(False)), F.regexp_replace(col.cast("string"), "0+$", "")).alias("x"))
    if isinstance(kind, T.BooleanType):
        return exact(col.cast("int"))
    if isinstance(kind, T.DateType):
        return exact(F.unix_date(col))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return exact(F.unix_micros(col.cast("timestamp")))
    return short_text(col)


FAMILY_IDS = {"num": 0, "bool": 1, "date": 2, "ts": 3, "text": 4, "uuid": 5}


def _passes(pairs: list[tuple]) -> list[list[tuple]]:
    """Groups of pairs that name at most MAX_COLUMNS columns, kept together by parent key."""
    groups, current, used = [], [], set()
    for p in sorted(pairs, key=lambda p: p[2:]):
        ends = {p[:2], p[2:]}
        if current and len(used | ends) > MAX_COLUMNS:
            groups.append(current)
            current, used = [], set()
        current.append(p)
        used |= ends
    return groups + ([current] if current else [])


def match_counts(catalog: Catalog, pairs: list[tuple]) -> DataFrame:
    """``ENDS, n_values, n_matched`` for all pairs of comparable columns at once.

    Each column has a bit.  One aggregation per value collects the bits of the columns that hold it;
    a second one counts the values of each bit pattern.  A value is shuffled once however many
    columns and keys hold it, and no pair of columns is ever joined.
    """
    return union_all([_match_pass(catalog, group) for group in _passes(pairs)])


def _match_pass(catalog: Catalog, pairs: list[tuple]) -> DataFrame:
    columns = sorted({e for p in pairs for e in (p[:2], p[2:])})
    bit = {c: i for i, c in enumerate(columns)}
    n_words = (len(columns) - 1) // WORD + 1
    words = [f"w{i}" for i in range(n_words)]

    by_kind: dict[str, list[DataFrame]] = {"number": [], "text": []}
    families = {c: family(catalog, *c) for c in columns}
    for t in sorted({c[0] for c in columns}):
        for kind in by_kind:
            mine = [c for c in columns if c[0] == t and (families[c] in ("text", "uuid")) == (kind == "text")]
            if mine:
                by_kind[kind].append(long_form(catalog.frames[t], {bit[c]: value_form(catalog, *c) for c in mine}))

    fam_of_bit = F.array(*[F.lit(FAMILY_IDS[families[c]]) for c in columns])
    patterns = []
    for kind, frames in by_kind.items():
        if not frames:
            continue
        rows = union_all(frames)
        if kind == "number":
            value = [F.col(f"v.{k}").alias(k) for k in "ldx"]
            rows = rows.where(F.col("v.l").isNotNull() | F.col("v.d").isNotNull() | F.col("v.x").isNotNull())
        else:
            value = [F.col("v").alias("s")]
            rows = rows.where(F.col("v").isNotNull())
        flags = [F.when(F.call_function("div", F.col("id"), F.lit(WORD)) == i, _bit(F.col("id")))
                 .otherwise(F.lit(0).cast("long")).alias(w) for i, w in enumerate(words)]
        keyed = rows.select(F.get(fam_of_bit, F.col("id")).alias("fam"), *value, *flags)
        names = [c for c in keyed.columns if c not in words]
        patterns.append(keyed.groupBy(*names).agg(*[F.bit_or(w).alias(w) for w in words])
                        .groupBy(*words).agg(F.count(F.lit(1)).alias("n")))

    held = F.array(*words)
    has = lambda b: F.get(held, F.call_function("div", b, F.lit(WORD)).cast("int")).bitwiseAND(_bit(b)) != 0
    ends = local_frame(catalog.spark, [(*p, bit[p[:2]], bit[p[2:]]) for p in pairs],
                       ", ".join(f"{c} string" for c in ENDS) + ", cbit int, pbit int")
    hits = (union_all(patterns)
            .withColumn("cbit", F.explode(F.filter(F.sequence(F.lit(0), F.lit(len(columns) - 1)), has)))
            .join(ends.select("cbit", "pbit").distinct(), "cbit")
            .groupBy("cbit", "pbit")
            .agg(F.sum("n").alias("n_values"), F.sum(F.when(has(F.col("pbit")), F.col("n")).otherwise(0)).alias("n_matched")))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return ends.join(hits, ["cbit", "pbit"], "left").select(*ENDS, zero("n_values"), zero("n_matched"))


def _bit(b) -> Column:
    """The mask of a column within its word."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), b % WORD)


def _comparable(catalog: Catalog, pair: tuple) -> bool:
    kind = family(catalog, *pair[:2])
    return kind is not None and kind == family(catalog, *pair[2:])


def _empty_counts(catalog: Catalog) -> DataFrame:
    return local_frame(catalog.spark, [], ", ".join(f"{c} string" for c in ENDS) + ", n_values long, n_matched long")


def _overlap() -> Column:
    return F.coalesce(F.try_divide(F.col("n_matched").cast("double"), F.col("n_values")), F.lit(0.0))


def _score(df: DataFrame) -> DataFrame:
    return (df.withColumn("overlap", _overlap())
            .withColumn("s4", F.col("overlap") >= CONTAINED)
            .withColumn("s5", F.col("distinct_ratio") < REPEATED)
            .withColumn("score", _votes("s1", "s2", "s3", "s4", "s5", "s6")))


def score_candidates(catalog: Catalog) -> DataFrame:
    """All candidates with the six signals, their score and the counts behind them."""
    cands = metadata_signals(candidates(catalog))
    pairs = [p for p in _metadata_pairs(candidates(catalog)) if _comparable(catalog, p)]
    counts = match_counts(catalog, pairs) if pairs else _empty_counts(catalog)
    ratios = profile_columns(catalog).select(F.col("table").alias("child_table"), F.col("column").alias("child_col"),
                                             "distinct_ratio")
    return _score(cands.join(counts, ENDS, "left").join(ratios, ["child_table", "child_col"]))


def _metadata_pairs(cands: DataFrame) -> list[tuple]:
    """Candidate ends on the driver, where the scan is planned: at most columns times keys of the catalog."""
    return [tuple(r) for r in cands.select(*ENDS).collect()]


def heuristic_relationships(catalog: Catalog, verdicts: DataFrame | None = None, require_name: bool = False) -> DataFrame:
    """Accepted candidates: ``ENDS, score, confidence``.

    A candidate needs four of six votes and no orphans.  The two votes that read data can add at most
    two, so only candidates with two metadata votes are checked against the data.  Without orphans
    every sample of child values is contained, so a sample limit cannot change the outcome.
    """
    cands = metadata_signals(candidates(catalog))
    open_ = cands.where(_votes("s1", "s2", "s3", "s6") + 2 >= ACCEPT_SCORE)
    if require_name:
        open_ = open_.where("s1")
    checked = [r for r in open_.select(*ENDS, "s1", "s2", "s3", "s6").collect()
               if _comparable(catalog, (r.child_table, r.child_col, r.parent_table, r.parent_col))]
    shape = ", ".join(f"{c} string" for c in ENDS)
    if not checked:
        return local_frame(catalog.spark, [], f"{shape}, score int, confidence double, source int")
    signals = local_frame(catalog.spark, [tuple(r) for r in checked],
                                            f"{shape}, s1 boolean, s2 boolean, s3 boolean, s6 boolean")
    counts = match_counts(catalog, [tuple(r)[:4] for r in checked])
    sizes = row_counts(catalog.subset(sorted({r.child_table for r in checked}))).withColumnRenamed("table", "child_table")
    scored = _score(signals.join(counts, ENDS).join(sizes, "child_table")
                    .withColumn("distinct_ratio", F.coalesce(F.try_divide(F.col("n_values").cast("double"), F.col("n_rows")), F.lit(0.0))))
    accepted = scored.where((F.col("score") >= ACCEPT_SCORE) & (F.col("n_matched") == F.col("n_values")))
    if verdicts is not None:
        accepted = apply_verdicts(accepted, verdicts, ENDS)
    return accepted.select(*ENDS, "score", (F.col("score") / 6).alias("confidence"), F.lit(1).alias("source"))


# ---------------------------------------------------------------- verdicts and suggestions

def apply_verdicts(cands: DataFrame, verdicts: DataFrame, on: list[str], keep: bool = False) -> DataFrame:
    """Keep candidates whose verdict is yes.  No verdict counts as yes, any other text as unsure.

    ``keep`` returns every row with its ``verdict`` instead.
    """
    word = F.lower(strip(F.col("reply")))
    told = verdicts.select(*on, F.col("verdict").alias("reply"), F.lit(True).alias("asked"))
    judged = (cands.join(told, on, "left")
              .withColumn("verdict", F.when(F.col("asked").isNull(), "yes")
                          .when(word.isin("yes", "no", "unsure"), word).otherwise("unsure"))
              .drop("reply", "asked"))
    return judged if keep else judged.where("verdict = 'yes'").drop("verdict")


def parse_suggested(replies: DataFrame, text: str = "text", catalog: Catalog | None = None) -> DataFrame:
    """Relationships proposed as probe queries, one per line, in both directions at confidence 0.5.

    With a catalog, names take its spelling, and proposals whose tables or columns do not exist are dropped.
    """
    line = F.rtrim(strip_bullet(F.col("line")))
    sql = strip(F.rtrim(line, F.lit(";")))
    found = (replies.select(F.explode(lines(F.col(text))).alias("line")).select(sql.alias("sql"))
             .where(F.lower("sql").startswith("select") & F.regexp_like("sql", F.lit(SUGGESTION))))
    part = lambda i: F.regexp_extract("sql", SUGGESTION, i)
    rels = found.select(part(1).alias("child_table"), part(3).alias("child_col"), part(2).alias("parent_table"),
                        part(4).alias("parent_col")).distinct()
    if catalog is not None:
        for side in ("child", "parent"):
            known = catalog.columns_df.select(F.col("table").alias("t"), F.col("name").alias("c"))
            same = (F.lower(f"{side}_table") == F.lower("t")) & (F.lower(f"{side}_col") == F.lower("c"))
            rels = rels.join(known, same).withColumns({f"{side}_table": F.col("t"), f"{side}_col": F.col("c")}).drop("t", "c").distinct()
    return both_ways(rels.select(*ENDS, F.lit(SUGGESTED).alias("confidence"), F.lit(2).alias("source")))


def column_families(catalog: Catalog) -> DataFrame:
    """``table, col, family`` of all columns whose values can be compared."""
    rows = [(t, n, family(catalog, t, n)) for t, _, n, _, _ in catalog.column_rows()]
    return local_frame(catalog.spark, [r for r in rows if r[2]], "table string, col string, family string")


def comparable_suggestions(suggestions: DataFrame, catalog: Catalog, text: str = "text") -> DataFrame:
    """Proposals of ``parse_suggested`` whose columns exist and hold values of one family, so that their probe would run."""
    kinds = column_families(catalog)
    rels = parse_suggested(suggestions, text, catalog).select(*ENDS, "confidence", "source")
    for side in ("child", "parent"):
        own = kinds.select(F.col("table").alias(f"{side}_table"), F.col("col").alias(f"{side}_col"), F.col("family").alias(f"{side}_family"))
        rels = rels.join(own, [f"{side}_table", f"{side}_col"])
    return rels.where("child_family = parent_family").select(*ENDS, "confidence", "source")


def check_suggested(suggestions: DataFrame, catalog: Catalog, text: str = "text") -> DataFrame:
    """Proposals as candidates of the one pass over the data: ``ENDS, confidence, n_values, n_matched, overlap``.

    Names that the catalog lacks and columns of different families are out.  What reaches the driver is the proposals that
    are left, at most the pairs of columns of the catalog.
    """
    rels = comparable_suggestions(suggestions, catalog, text)
    pairs = [tuple(r) for r in rels.select(*ENDS).distinct().collect()]
    counts = match_counts(catalog, pairs) if pairs else _empty_counts(catalog)
    return rels.drop("source").join(counts, ENDS).withColumn("overlap", _overlap())


def discover_relationships(catalog: Catalog, verdicts: DataFrame | None = None, suggestions: DataFrame | None = None,
                           require_name: bool = False) -> DataFrame:
    """Declared, inferred and suggested relationships, one row per answer, best confidence first."""
    parts = [_declared(catalog), heuristic_relationships(catalog, verdicts, require_name).drop("score")]
    if suggestions is not None:
        parts.append(comparable_suggestions(suggestions, catalog))
    return both_ways(union_all([p.select(*ENDS, "confidence", "source") for p in parts])).orderBy(F.desc("confidence"), "answer")
