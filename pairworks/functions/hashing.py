"""Hash draws that any SQL engine with md5 can repeat."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def digest(*parts) -> Column:
    """md5 of the parts joined by ``|``; null if a part is."""
    cols = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.md5(F.concat(*[x for c in cols for x in (F.lit("|"), c)][1:]))


def draw(md5_hex: Column, n, slot: int = 0) -> Column:
    """An integer in ``[0, n)`` from the ``slot``-th group of eight hex digits (0 to 3)."""
    bits = F.conv(F.substring(md5_hex, slot * 8 + 1, 8), 16, 10).cast("long")
    return F.pmod(bits, n if isinstance(n, Column) else F.lit(n).cast("long"))


def pick(values: list[str], md5_hex: Column, slot: int = 0) -> Column:
    # element_at would give the last member for a null index
    return F.get(F.array(*[F.lit(v) for v in values]), draw(md5_hex, len(values), slot).cast("int"))
