"""Column profiles and key inference in few passes over the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.catalog import Catalog, local_frame, union_all

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
LONG_TEXT = 64


def short_text(col):
    """Text itself when short, else its digest, so that long texts are never shuffled."""
    return F.when(F.length(col) > LONG_TEXT, F.concat(F.lit("#"), F.sha2(col, 256))).otherwise(col)


def storage(field: T.StructField) -> tuple[str, object]:
    """``(kind, expression)``: a value with the same equality held as long, double or text."""
    col, kind = F.col(f"`{field.name}`"), field.dataType
    if isinstance(kind, INTEGRAL):
        return "long", col.cast("long")
    if isinstance(kind, T.BooleanType):
        return "long", col.cast("int").cast("long")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "long", F.unix_micros(col.cast("timestamp"))
    if isinstance(kind, T.DateType):
        return "long", F.unix_date(col).cast("long")
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return "double", col.cast("double")
    if isinstance(kind, T.MapType):
        col = F.to_json(F.array_sort(F.map_entries(col)))
    elif isinstance(kind, T.StructType):
        col = F.to_json(col)
    return "text", short_text(col.cast("string"))


def long_form(df: DataFrame, exprs: dict[int, object]) -> DataFrame:
    """``id, v``: one row per row and expression, ids as given."""
    flat = df.select(*[e.alias(str(i)) for i, e in exprs.items()])
    names = [F.col(f"`{i}`") for i in exprs]
    return flat.unpivot([], names, "id", "v").select(F.col("id").cast("int").alias("id"), "v")


def profile_columns(catalog: Catalog) -> DataFrame:
    """``table, column, n_rows, n_nonnull, n_distinct, distinct_ratio`` for every column.

    Values are counted per column before the shuffle, so a hot value is one row per task; the
    three storage kinds keep numbers out of text.
    """
    ids, parts = [], {"long": [], "double": [], "text": []}
    for t, df in catalog.frames.items():
        by_kind: dict[str, dict] = {}
        for f in df.schema.fields:
            kind, expr = storage(f)
            by_kind.setdefault(kind, {})[len(ids)] = expr
            ids.append((len(ids), t, f.name))
        for kind, exprs in by_kind.items():
            parts[kind].append(long_form(df, exprs))
    rolled = [union_all(p).groupBy("id", "v").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("id").agg(F.sum("n").alias("n_rows"),
                                 F.sum(F.when(F.col("v").isNotNull(), F.col("n")).otherwise(0)).alias("n_nonnull"),
                                 F.count("v").alias("n_distinct"))
              for p in parts.values() if p]
    names = local_frame(catalog.spark, ids, "id int, table string, column string")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return (names.join(union_all(rolled), "id", "left")
            .select("table", "column", zero("n_rows"), zero("n_nonnull"), zero("n_distinct"),
                    F.coalesce(F.try_divide(F.col("n_distinct").cast("double"), F.col("n_rows")), F.lit(0.0))
                    .alias("distinct_ratio")))


def distinct_ratio(df: DataFrame, column: str) -> DataFrame:
    """Distinct values over rows; nulls count as rows only, no rows give 0.0."""
    counts = (df.groupBy(F.col(column).alias("v")).agg(F.count(F.lit(1)).alias("n"))
              .agg(F.count("v").alias("d"), F.sum("n").alias("rows")))
    return counts.select(F.coalesce(F.try_divide(F.col("d").cast("double"), F.col("rows")), F.lit(0.0))
                         .alias("distinct_ratio"))


def key_columns(catalog: Catalog) -> dict[str, list[str]]:
    """Columns that may be keys: integers and UUIDs."""
    return {t: [f.name for f in df.schema.fields
                if isinstance(f.dataType, INTEGRAL) or catalog.types.get((t, f.name)) == "UUID"]
            for t, df in catalog.frames.items()}


def _first_pass(catalog: Catalog) -> tuple[dict[str, list[str]], dict[str, int]]:
    """Columns one cheap pass cannot rule out as keys, and the row counts.

    A column with a null is no key; neither is an integer column whose range is narrower than its
    row count, for some value must then repeat.  The result holds one row per table.
    """
    parts = []
    for t, cols in key_columns(catalog).items():
        df, n = catalog.frames[t], F.count(F.lit(1))
        checks = []
        for c in cols:
            full = F.count(F.col(f"`{c}`")) == n
            if isinstance(df.schema[c].dataType, INTEGRAL):
                full = full & (F.max(f"`{c}`").cast("decimal(20,0)") - F.min(f"`{c}`").cast("decimal(20,0)") + 1 >= n)
            checks.append(F.when(full, F.lit(c)))
        left = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
        parts.append(df.agg(left.alias("cols"), n.alias("n")).select(F.lit(t).alias("table"), "cols", "n"))
    found = union_all(parts).collect()
    return {r.table: r.cols for r in found}, {r.table: r.n for r in found}


def infer_primary_key(catalog: Catalog) -> DataFrame:
    """``table, primary_key``: the first unique, non-null integer or UUID column; tables without one are left out."""
    return _unique_columns(catalog, _first_pass(catalog)[0])


def _unique_columns(catalog: Catalog, left: dict[str, list[str]]) -> DataFrame:
    spark = catalog.spark
    ids, numbers, texts = [], [], []
    for t in catalog.frames:
        df, nums, strs = catalog.frames[t], {}, {}
        for pos, f in enumerate(df.schema.fields):
            if f.name not in left.get(t, []):
                continue
            number = isinstance(f.dataType, INTEGRAL)
            (nums if number else strs)[len(ids)] = F.col(f"`{f.name}`").cast("long" if number else "string")
            ids.append((len(ids), t, pos, f.name))
        numbers += [long_form(df, nums)] if nums else []
        texts += [long_form(df, strs)] if strs else []
    if not ids:
        return local_frame(spark, [], "table string, primary_key string")
    unique = [union_all(p).groupBy("id", "v").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("id").agg(F.max("n").alias("most")).where("most = 1")
              for p in (numbers, texts) if p]
    names = local_frame(spark, ids, "id int, table string, pos int, column string")
    return (names.join(union_all(unique), "id").groupBy("table")
            .agg(F.min_by("column", "pos").alias("primary_key")))


def with_inferred_keys(catalog: Catalog) -> Catalog:
    """The catalog with a key for every table that has one; declared keys win.  At most one row per table is fetched."""
    missing = catalog.subset([t for t in catalog.frames if t not in catalog.keys])
    if not missing.frames:
        return catalog
    left, sizes = _first_pass(missing)
    found = {r.table: r.primary_key for r in _unique_columns(missing, left).collect()}
    return catalog.with_keys({t: catalog.keys.get(t) or found.get(t) for t in catalog.frames
                              if catalog.keys.get(t) or found.get(t)}, sizes)
