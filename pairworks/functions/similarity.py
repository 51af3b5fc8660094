"""Similarity of names (difflib ratio) and of vectors (cosine)."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(a: str, b: str) -> float:
    return SequenceMatcher(None, a.lower(), b.lower()).ratio()


@F.pandas_udf(T.DoubleType())
def name_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """difflib ratio of lower-cased names; the order of the arguments matters."""
    return pd.Series([ratio(x, y) if x is not None and y is not None else None for x, y in zip(a, b)], dtype="float64")


def cosine(a, b) -> Column:
    """dot / (norm * norm) in double; 0.0 for a missing side or a zero norm."""
    wide = lambda c: F.transform(c, lambda x: x.cast("double"))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda acc, x: acc + x)
    dot = total(F.zip_with(wide(a), wide(b), lambda x, y: x * y))
    norm = lambda c: F.sqrt(total(F.transform(wide(c), lambda x: x * x)))
    scale = norm(a) * norm(b)
    return F.coalesce(F.when(scale != 0, dot / scale), F.lit(0.0))


def combined(col1, tab1, col2, tab2) -> Column:
    """The better of column vectors alone and column-plus-table vectors."""
    return F.greatest(cosine(col1, col2), cosine(tab1, tab2))
