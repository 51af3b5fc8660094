"""TO_CHAR of numbers: PostgreSQL's pictures compiled to column expressions."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

# The parts of a picture, longest first, and roman numerals by decimal place.
TOKEN = re.compile(r'"[^"]*"|EEEE|FM|MI|PL|PR|RN|TH|9|0|\.|,|D|G|S|V', re.IGNORECASE)
ROMAN = [["", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"], ["", "X", "XX", "XXX", "XL", "L", "LX", "LXX", "LXXX", "XC"],
         ["", "C", "CC", "CCC", "CD", "D", "DC", "DCC", "DCCC", "CM"], ["", "M", "MM", "MMM"]]
ROMAN_WIDTH = 15
MOST_DIGITS = 38


@dataclass
class Picture:
    """A picture read: the places before and after the point, and what stands around them."""

    whole: list[str] = field(default_factory=list)   # 9, 0 and commas, left to right
    part: list[str] = field(default_factory=list)    # 9 and 0
    point: bool = False
    fill: bool = True                                # FM not given
    sign: str = ""                                   # S before, S after, MI, PL, PR
    shift: int = 0                                   # digits behind V
    suffix: str = ""                                 # th or TH
    roman: str = ""
    scientific: bool = False
    before: str = ""
    after: str = ""


def read_picture(text: str) -> Picture:
    p, at, behind_v = Picture(), 0, False
    while at < len(text):
        m = TOKEN.match(text, at)
        if m is None:
            raise ValueError(f"no such part in {text!r}: {text[at:]!r}")
        raw, tok = m[0], m[0].upper()
        digits = p.whole or p.part or p.point
        if raw[0] == '"':
            if digits:
                p.after += raw[1:-1]
            else:
                p.before += raw[1:-1]
        elif p.after and tok in "90,.DGV":
            raise ValueError(f"text between digits in {text!r}")
        elif tok in "90":
            if behind_v:
                p.shift += 1
                p.whole.append(tok)
            else:
                (p.part if p.point else p.whole).append(tok)
        elif tok in ",G":
            if p.point or behind_v:
                raise ValueError(f"a comma behind the point in {text!r}")
            p.whole.append(",")
        elif tok in ".D":
            if p.point or behind_v:
                raise ValueError(f"two points in {text!r}")
            p.point = True
        elif tok == "V":
            behind_v = True
        elif tok == "FM":
            p.fill = False
        elif tok in ("S", "MI", "PL", "PR"):
            if p.sign:
                raise ValueError(f"two signs in {text!r}")
            p.sign = {"S": "S after" if digits else "S before", "MI": "MI after" if digits else "MI before", "PL": "PL after" if digits else "PL before"}.get(tok, tok)
        elif tok == "TH":
            p.suffix = raw
        elif tok == "RN":
            p.roman = raw
        elif tok == "EEEE":
            p.scientific = True
        at = m.end()
    if p.roman and (p.whole or p.part):
        raise ValueError(f"RN stands alone: {text!r}")
    if sum(t != "," for t in p.whole) + len(p.part) > MOST_DIGITS:
        raise ValueError(f"more than {MOST_DIGITS} digits in {text!r}")
    return p


def is_number_picture(text: str) -> bool:
    """Whether a pattern is that of a number: it has a digit place or RN and every part of it belongs to numbers."""
    try:
        p = read_picture(text)
    except ValueError:
        return False
    return bool(p.whole or p.part or p.roman)


def _roman(value: Column, p: Picture) -> Column:
    n = F.round(value).cast("int")
    digits = [F.get(F.array(*[F.lit(x) for x in ROMAN[i]]), F.pmod(F.floor(n / 10**i), F.lit(10)).cast("int")) for i in (3, 2, 1, 0)]
    text = F.when((n < 1) | (n > 3999), "#" * ROMAN_WIDTH).otherwise(F.concat(*[F.coalesce(d, F.lit("")) for d in digits]))
    text = F.lower(text) if p.roman.islower() else text
    return F.lpad(text, ROMAN_WIDTH, " ") if p.fill else text


def _ordinal(text: Column, p: Picture) -> Column:
    """The English ending of a whole number."""
    last, tens = F.right(text, F.lit(1)), F.right(text, F.lit(2))
    end = (F.when(tens.isin("11", "12", "13"), "th").when(last == "1", "st").when(last == "2", "nd").when(last == "3", "rd").otherwise("th"))
    return F.upper(end) if p.suffix.isupper() else end


def _whole_part(digits: Column, p: Picture) -> Column:
    """The places before the point, one by one: digits, zeros from the first 0 on, blanks before, commas once a digit stands."""
    places = sum(t != "," for t in p.whole)
    first_zero = next((i for i, t in enumerate(t for t in p.whole if t != ",") if t == "0"), places)
    padded = F.lpad(digits, places, " ") if places else F.lit("")
    out, i = [], 0
    for t in p.whole:
        if t == ",":
            begun = F.lit(True) if i > first_zero else F.length(digits) > places - i
            out.append(F.when(begun, ",").otherwise(" "))
            continue
        here = F.substring(padded, i + 1, 1)
        out.append(F.when(here == " ", "0").otherwise(here) if i >= first_zero else here)
        i += 1
    return F.concat(*out) if out else F.lit("")


def _signed(text: Column, negative: Column, p: Picture) -> Column:
    """Blanks, the sign, the digits: the sign stands at the first digit unless the picture gives it a place."""
    body, blanks = F.ltrim(text), F.length(text) - F.length(F.ltrim(text))
    pad = F.repeat(F.lit(" "), blanks) if p.fill else F.lit("")
    choose = lambda minus, plus: F.when(negative, minus).otherwise(plus)
    blank = " " if p.fill else ""
    if p.sign == "PR":
        return F.concat(pad, choose("<", blank), body, choose(">", blank))
    if p.sign == "S before":
        return F.concat(pad, choose("-", "+"), body)
    if p.sign == "S after":
        return F.concat(pad, body, choose("-", "+"))
    if p.sign == "MI before":
        return F.concat(choose("-", blank), pad, body)
    if p.sign == "MI after":
        return F.concat(pad, body, choose("-", blank))
    if p.sign.startswith("PL"):
        mark = choose(blank, "+")
        plain = F.concat(pad, choose("-", blank), body)
        return F.concat(mark, plain) if p.sign == "PL before" else F.concat(plain, mark)
    return F.concat(pad, choose("-", blank), body)


def _scientific(value: Column, p: Picture) -> Column:
    n = len(p.part)
    size = F.abs(value.cast("double"))
    power = F.when(size == 0, 0).otherwise(F.floor(F.log10(size)).cast("int"))
    lead = F.round(size / F.pow(F.lit(10.0), power), n)
    up = lead >= 10
    lead, power = F.when(up, lead / 10).otherwise(lead), F.when(up, power + 1).otherwise(power)
    mantissa = F.round(lead.cast(f"decimal(38,{n + 2})"), n).cast(f"decimal(38,{n})").cast("string")
    two = F.abs(power).cast("string")
    text = F.concat(mantissa, F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.when(F.length(two) < 2, F.lpad(two, 2, "0")).otherwise(two))
    return F.concat(F.when(value < 0, "-").otherwise("+" if p.sign.startswith("S") else " " if p.fill else ""), text)


def number_to_char(value, picture: str) -> Column:
    """TO_CHAR of a number.

    Knows 9 0 . , D G S MI PL PR FM TH V EEEE RN and quoted text before or behind the digits; point and comma are those of the C
    locale.  Numbers are rounded half away from zero; one that does not fit gives ``#`` in every place.  Null gives null.
    """
    p = read_picture(picture)
    around = lambda text: F.concat(F.lit(p.before), text, F.lit(p.after))
    if p.roman:
        return F.when(value.isNotNull(), around(_roman(value, p)))
    if p.scientific:
        return F.when(value.isNotNull(), around(_scientific(value, p)))
    scaled = value.cast("decimal(38,10)") * F.lit(10**p.shift).cast(f"decimal({p.shift + 1},0)") if p.shift else value.cast("decimal(38,10)")
    places, n = sum(t != "," for t in p.whole), len(p.part)
    rounded = F.round(scaled, n)
    negative = rounded < 0
    text = F.abs(rounded).cast(f"decimal(38,{n})").cast("string")
    whole = F.regexp_replace(F.substring_index(text, ".", 1), "^0+", "")
    # without a point a zero shows
    shown = F.when((whole == "") & F.lit(not p.part), "0").otherwise(whole)
    before = _whole_part(shown, p)
    if p.part:
        least = max((i + 1 for i, t in enumerate(p.part) if t == "0"), default=0)
        digits = F.substring_index(text, ".", -1)
        if not p.fill:
            digits = F.concat(F.substring(digits, 1, least), F.regexp_replace(F.substring(digits, least + 1, n), "0+$", ""))
        made = F.concat(before, F.lit("."), digits)
    else:
        made = F.concat(before, F.lit("." if p.point else ""))
    too_long = F.length(shown) > places
    marks = F.lit(re.sub("[90]", "#", "".join(p.whole)) + ("." if p.point else "") + "#" * n)
    out = _signed(F.when(too_long, marks).otherwise(made), negative, p)
    if p.suffix:
        out = F.concat(out, F.when(negative, "").otherwise(_ordinal(F.when(whole == "", "0").otherwise(whole), p)))
    return F.when(value.isNotNull(), around(out))
