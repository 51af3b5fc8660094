"""Masking of rows by column kind, inside the JVM."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.hashing import digest, draw, pick

FIRST = ["Ada", "Ben", "Cora", "Dan", "Elsa", "Finn", "Gina", "Hugo", "Iris", "Jon", "Kira", "Leo",
         "Mona", "Nils", "Olga", "Paul", "Rosa", "Sven", "Tina", "Uwe", "Vera", "Wim", "Yara", "Zeno"]
LAST = ["Abbot", "Baker", "Carver", "Dyer", "Elder", "Fisher", "Glover", "Hunter", "Irving", "Joiner",
        "Keeler", "Lister", "Mason", "Naylor", "Ostler", "Potter", "Ryder", "Sawyer", "Tanner", "Usher",
        "Voss", "Weaver", "Yeoman", "Zeller"]
WORDS = ["amber", "basin", "cedar", "delta", "ember", "field", "grove", "harbor", "island", "jade",
         "kettle", "lantern", "meadow", "north", "orchard", "prairie", "quartz", "river", "summit",
         "timber", "upland", "valley", "willow", "yonder"]

# Name parts that choose the kind of a text column, first match wins.
KINDS = ["email", "name", "date", "time"]

KEPT = (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType)


def column_kind(field: T.StructField) -> str:
    """keep, datetime, date, time, email, name, date_text, time_text, word, nested or text."""
    kind = field.dataType
    if isinstance(kind, KEPT):
        return "keep"
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return "datetime"
    if isinstance(kind, T.DateType):
        return "date"
    if isinstance(kind, T.TimeType):
        return "time"
    if isinstance(kind, (T.StringType, T.CharType, T.VarcharType)):
        hit = next((k for k in KINDS if k in field.name.lower()), "word")
        return {"date": "date_text", "time": "time_text"}.get(hit, hit)
    if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)):
        return "nested"
    return "text"


def _clock(h: Column) -> Column:
    two = lambda n, slot: F.lpad(draw(h, n, slot).cast("string"), 2, "0")
    return F.concat(two(24, 1), F.lit(":"), two(60, 2), F.lit(":"), two(60, 3))


def _day(h: Column, decade_start: str, as_of) -> Column:
    """A day between the start of the decade and ``as_of``."""
    start = F.lit(decade_start).cast("date")
    span = F.datediff(as_of, start) + 1
    return F.date_format(F.date_add(start, draw(h, span.cast("long")).cast("int")), "yyyy-MM-dd")


def mask_value(col: Column, kind: str, salt: str, decade_start: str, as_of: Column) -> Column:
    """A fake made of one digest per value, which is null for null and so makes the fake null."""
    h = digest(salt, kind, col)
    fake = {
        "keep": lambda: col,
        "text": lambda: col.cast("string"),
        "datetime": lambda: F.concat(_day(h, decade_start, as_of), F.lit(" "), _clock(h)),
        "date": lambda: _day(h, decade_start, as_of),
        "date_text": lambda: _day(h, decade_start, as_of),
        "time": lambda: _clock(h),
        "time_text": lambda: _clock(h),
        "email": lambda: F.concat(F.lower(pick(FIRST, h)), F.lit("."), F.lower(pick(LAST, h, 1)),
                                  draw(h, 10000, 2).cast("string"), F.lit("@example.org")),
        "name": lambda: F.concat(pick(FIRST, h), F.lit(" "), pick(LAST, h, 1)),
        "word": lambda: pick(WORDS, h),
        "key": lambda: h,
    }
    return fake[kind]()


def _mask_field(col: Column, field: T.StructField, path: str, choose, salt: str, decade_start: str, as_of: Column) -> Column:
    """The masked value of a field; inside structs, arrays and maps every value at the bottom is masked by its own kind.

    A struct's members go by their names, the elements of an array and the values of a map by the name of the field that holds
    them.  The keys of a map are names and stay.
    """
    kind, inner = field.dataType, lambda f, c, p: _mask_field(c, f, p, choose, salt, decade_start, as_of)
    chosen = choose(field, path)
    if chosen != "nested":
        return mask_value(col, chosen, salt, decade_start, as_of)
    if isinstance(kind, T.StructType):
        return F.when(col.isNotNull(), F.struct(*[inner(f, col.getField(f.name), f"{path}.{f.name}").alias(f.name) for f in kind.fields]))
    if isinstance(kind, T.ArrayType):
        element = T.StructField(field.name, kind.elementType)
        return F.transform(col, lambda x: inner(element, x, path))
    value = T.StructField(field.name, kind.valueType)
    return F.transform_values(col, lambda _, x: inner(value, x, path))


def mask(df: DataFrame, salt: str = "", rules: dict[str, str] | None = None, strict: bool = False,
         keys: tuple = (), decade_start: str | None = None, as_of=None) -> DataFrame:
    """Masked copy.  Nulls stay null; the kind of each column comes from its type and name or from ``rules``.

    Equal (kind, value, salt) give equal fakes, so joins on masked columns still work.  Values inside structs, arrays and maps are
    masked where they are; ``rules`` and ``keys`` name them by path, as ``address.email``.  Numbers pass through; ``strict`` also
    replaces the columns in ``keys`` and values of other types by a digest, for which it wants a ``salt``: without one, digests of
    short keys can be undone by trying.
    """
    if strict and not salt:
        raise ValueError("strict masking needs a salt")
    as_of = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    if decade_start is None:
        year = datetime.now(timezone.utc).year
        decade_start = f"{year - year % 10}-01-01"

    def choose(field: T.StructField, path: str) -> str:
        kind = (rules or {}).get(path) or column_kind(field)
        return "key" if strict and (path in keys or kind == "text") else kind

    return df.select(*[_mask_field(F.col(f"`{f.name}`"), f, f.name, choose, salt, decade_start, as_of).alias(f.name) for f in df.schema.fields])
