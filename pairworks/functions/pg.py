"""SQL functions with PostgreSQL meaning where Spark's own differ.

COUNT, SUM, MIN, MAX, COALESCE, NULLIF, LENGTH, LOWER, UPPER, REPLACE, DATE_TRUNC, CEIL,
FLOOR, ABS, MOD and the ranking functions agree with Spark and need no wrapper.
"""

from __future__ import annotations

from pyspark.sql import Column, Window
from pyspark.sql import functions as F

from .pictures import is_number_picture, number_to_char

def concat(*cols) -> Column:
    """CONCAT skips nulls."""
    return F.concat_ws("", *[c.cast("string") for c in cols])


def substring(text, start, size=None) -> Column:
    """SUBSTRING counts from 1; a start below 1 uses up length before the text begins."""
    start = start if isinstance(start, Column) else F.lit(start)
    first = F.greatest(start, F.lit(1))
    if size is None:
        return F.substring(text, first, F.lit(2147483647))
    size = size if isinstance(size, Column) else F.lit(size)
    return F.substring(text, first, F.greatest(size + F.least(start - 1, F.lit(0)), F.lit(0)))


def trim(text) -> Column:
    """TRIM removes blanks (U+0020) only."""
    return F.btrim(text, F.lit(" "))


def extract(part: str, ts) -> Column:
    part, year, second = part.lower(), F.year(ts), F.extract(F.lit("second"), ts)
    own = {
        "epoch": lambda: F.unix_micros(ts.cast("timestamp")) / F.lit(1e6),
        "dow": lambda: F.dayofweek(ts) - 1,
        "isodow": lambda: F.weekday(ts) + 1,
        "isoyear": lambda: F.extract(F.lit("yearofweek"), ts),
        "decade": lambda: F.floor(year / 10).cast("int"),
        "century": lambda: F.ceil(year / 100).cast("int"),
        "millennium": lambda: F.ceil(year / 1000).cast("int"),
        "milliseconds": lambda: (second * 1000).cast("double"),
        "microseconds": lambda: (second * 1_000_000).cast("long"),
    }
    return own[part]() if part in own else F.extract(F.lit(part), ts)


def round_double(x) -> Column:
    """ROUND of a double goes to the even neighbour of a half; ROUND of a numeric, as Spark's, away from zero."""
    return F.rint(x)


DAY_MICROS = 86_400_000_000


def age(later, earlier) -> Column:
    """AGE as whole months, remaining days and the rest: ``struct<months,days,micros>``.

    A borrowed month has the length of the earlier date's month; negative ages mirror positive ones.
    """
    later, earlier = later.cast("timestamp"), earlier.cast("timestamp")
    swap = later < earlier
    hi, lo = F.when(swap, earlier).otherwise(later), F.when(swap, later).otherwise(earlier)
    clock = lambda ts: F.unix_micros(ts) - F.unix_micros(F.date_trunc("day", ts))
    micros = clock(hi) - clock(lo)
    days = F.dayofmonth(hi) - F.dayofmonth(lo) - F.when(micros < 0, 1).otherwise(0)
    months = (F.year(hi) - F.year(lo)) * 12 + F.month(hi) - F.month(lo) - F.when(days < 0, 1).otherwise(0)
    days = F.when(days < 0, days + F.dayofmonth(F.last_day(lo))).otherwise(days)
    sign = F.when(swap, F.lit(-1)).otherwise(F.lit(1))
    return F.struct((months * sign).alias("months"), (days * sign).alias("days"), (F.pmod(micros, F.lit(DAY_MICROS)) * sign).alias("micros"))


def _fields(ts) -> dict:
    """PostgreSQL's date and time fields: a number with its width, or a name by its Spark letters with the width it is padded to."""
    year, hour = F.year(ts), F.hour(ts)
    micros = F.pmod(F.unix_micros(ts.cast("timestamp")), F.lit(1_000_000))
    return {
        "YYYY": (year, 4), "YYY": (year % 1000, 3), "YY": (year % 100, 2), "Y": (year % 10, 1), "IYYY": (F.extract(F.lit("yearofweek"), ts), 4),
        "CC": (F.ceil(year / 100), 2), "Q": (F.quarter(ts), 1), "MM": (F.month(ts), 2), "MONTH": ("MMMM", 9), "MON": ("MMM", 3),
        "IW": (F.weekofyear(ts), 2), "WW": (F.floor((F.dayofyear(ts) - 1) / 7) + 1, 2), "W": (F.floor((F.dayofmonth(ts) - 1) / 7) + 1, 1),
        "DDD": (F.dayofyear(ts), 3), "DD": (F.dayofmonth(ts), 2), "DAY": ("EEEE", 9), "DY": ("E", 3), "D": (F.dayofweek(ts), 1), "ID": (F.weekday(ts) + 1, 1),
        "HH24": (hour, 2), "HH12": (F.pmod(hour - 1, F.lit(12)) + 1, 2), "HH": (F.pmod(hour - 1, F.lit(12)) + 1, 2), "MI": (F.minute(ts), 2),
        "SSSSS": (hour * 3600 + F.minute(ts) * 60 + F.second(ts), 5), "SS": (F.second(ts), 2), "MS": (F.floor(micros / 1000), 3), "US": (micros, 6),
        "AM": ("a", 2), "PM": ("a", 2)}


def to_char(value, pattern: str) -> Column:
    """TO_CHAR of a date, a timestamp or a number with a PostgreSQL pattern; which it is follows from the pattern.

    Fields of dates are found in either case; names take the case of the field, blank-padded unless FM stands before it; quoted
    text and marks stay.  ``number_to_char`` says what patterns of numbers may hold.  Other letters raise ValueError.
    """
    if is_number_picture(pattern):
        return number_to_char(value, pattern)
    ts = value
    fields, out, i = _fields(ts), [], 0
    longest_first = sorted(fields, key=len, reverse=True)
    while i < len(pattern):
        if pattern[i] == '"':
            end = pattern.find('"', i + 1)
            if end < 0:
                raise ValueError(f"no closing quote in {pattern!r}")
            out.append(F.lit(pattern[i + 1:end]))
            i = end + 1
            continue
        bare = pattern[i:i + 2].upper() == "FM"
        at = i + 2 if bare else i
        name = next((f for f in longest_first if pattern[at:at + len(f)].upper() == f), None)
        if name is None:
            if bare or pattern[i].isalnum():
                raise ValueError(f"no such field in {pattern!r}: {pattern[i:]!r}")
            out.append(F.lit(pattern[i]))
            i += 1
            continue
        value, width = fields[name]
        written = pattern[at:at + len(name)]
        if isinstance(value, str):
            text = F.date_format(ts, value)
            text = F.upper(text) if written.isupper() else F.lower(text) if written.islower() else text
            out.append(text if bare else F.rpad(text, width, " "))
        else:
            text = value.cast("string")
            out.append(text if bare else F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text))
        i = at + len(name)
    return F.concat(*out) if out else F.when(ts.isNotNull(), "")


def integer_divide(a, b) -> Column:
    """``/`` between integers truncates."""
    return F.call_function("div", a, b)


def ordered(partition: list, *order) -> Window:
    """Window with PostgreSQL null order: ascending puts nulls last, descending first."""
    keys = [o if not isinstance(o, str) else F.col(o).asc_nulls_last() for o in order]
    return Window.partitionBy(*partition).orderBy(*keys)
