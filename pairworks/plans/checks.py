"""Pieces of checking SQL."""

from __future__ import annotations

import json

from ..functions.similarity import ratio
from ..functions.text import BLANK_RUN, BULLETS
from ..operators.relate import ACCEPT_SCORE, CONTAINED, REPEATED, SIMILAR
from .tables import COLUMNS, FOREIGN_KEYS, NAMES

INTEGERS = ("BIGINT", "INTEGER")
NUMBERS = (*INTEGERS, "DOUBLE PRECISION")


def clean(x: str) -> str:
    flat = f"trim(regexp_replace(replace({x}, chr(92), ''), '{BLANK_RUN}', ' ', 'g'))"
    return f"coalesce(CASE WHEN ends_with({flat}, ';') THEN rtrim(left({flat}, length({flat}) - 1)) ELSE {flat} END, '')"


def bare(line: str) -> str:
    return f"trim(ltrim(trim({line}), '{BULLETS}'), '`')"


def hex_draw(h: str, n, slot: int = 0) -> str:
    return f"(('0x' || substr({h}, {slot * 8 + 1}, 8))::BIGINT % {n})"


def values(rows: list[tuple]) -> str:
    def quote(v):
        if v is None:
            return "NULL"
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return f"{v!r}::DOUBLE" if isinstance(v, float) else str(v)
    return "VALUES " + ", ".join("(" + ", ".join(quote(v) for v in r) + ")" for r in rows)


def table_json(name: str, key: str = "null") -> str:
    """A table in the schema JSON, with the given text as its key."""
    columns = json.dumps({c: {"type": ty, "comment": None} for c, ty in COLUMNS[name]}, separators=(",", ":"))
    fks = json.dumps([{"referred_table": p, "constrained_columns": c, "referred_columns": k} for t, c, p, k in FOREIGN_KEYS if t == name],
                     separators=(",", ":"))
    return f'"{name}":{{"columns":{columns},"primary_key":{key},"comment":null,"foreign_keys":{fks}}}'


def _union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


ROWS = "n AS (" + _union([f"SELECT '{t}' AS t, count(*) AS n FROM {t}" for t in NAMES]) + ")"

KEYS = ("keys AS (SELECT t, arg_min(c, pos) AS k, arg_min(ty, pos) AS kty FROM (" + _union(
    [f"SELECT '{t}' AS t, {i} AS pos, '{c}' AS c, '{ty}' AS ty, count(*) = count(DISTINCT {c}) AS u FROM {t}"
     for t in NAMES for i, (c, ty) in enumerate(COLUMNS[t]) if ty in INTEGERS]) + ") WHERE u GROUP BY t)")

COLS = "cols(t, c, ty) AS (" + values([(t, c, ty) for t in NAMES for c, ty in COLUMNS[t]]) + ")"

PROFILE = "prof AS (" + _union(
    [f"SELECT '{t}' AS t, '{c}' AS c, count(*) AS n_rows, count({c}) AS n_nonnull, count(DISTINCT {c}) AS n_distinct FROM {t}"
     for t in NAMES for c, _ in COLUMNS[t]]) + ")"


def best_name(child: str, parent: str, key: str) -> float:
    base = parent.lower().rstrip("s")
    return max(ratio(child, o) for o in (key, f"{parent}_{key}", f"{base}_{key}", parent, base))


def _named() -> list[tuple]:
    """Name similarity has no SQL form, so its values for these columns are literals."""
    return [(t, c, p, k, best_name(c, p, k),
             best_name(c, p, k) >= SIMILAR or p.lower().rstrip("s") in c.lower())
            for t in NAMES for c, _ in COLUMNS[t] for p in NAMES if p != t for k, ty in COLUMNS[p] if ty in INTEGERS]


NAMED = "named(t, c, p, k, name_score, s1) AS (" + values(_named()) + ")"

CANDIDATES = (f"{KEYS}, {COLS}, {NAMED}, cand AS (SELECT cols.t, cols.c, keys.t AS p, keys.k, cols.ty, keys.kty, named.name_score, named.s1 "
              "FROM cols, keys, named WHERE cols.t <> keys.t AND named.t = cols.t AND named.c = cols.c AND named.p = keys.t AND named.k = keys.k)")

VALUE_SETS = "vals AS (" + _union(
    [f"SELECT '{t}' AS t, '{c}' AS c, {c}::DOUBLE AS v FROM {t} WHERE {c} IS NOT NULL GROUP BY 3"
     for t in NAMES for c, ty in COLUMNS[t] if ty in NUMBERS]) + ")"

SCORED = (f"{CANDIDATES}, {PROFILE}, {VALUE_SETS}, "
          "sizes AS (SELECT t, c, count(*) AS n_values FROM vals GROUP BY 1, 2), "
          "met AS (SELECT a.t, a.c, b.t AS p, count(*) AS n_matched FROM vals a JOIN vals b ON a.v = b.v JOIN keys ON keys.t = b.t AND keys.k = b.c "
          "WHERE a.t <> b.t GROUP BY 1, 2, 3), "
          "signals AS (SELECT cand.t, cand.c, cand.p, cand.k, cand.name_score, sizes.n_values IS NOT NULL AS comparable, "
          "coalesce(n_values, 0) AS n_values, coalesce(n_matched, 0) AS n_matched, cand.s1, "
          "cand.ty = cand.kty AS s2, false AS s3, "
          f"coalesce(n_matched, 0) / greatest(coalesce(n_values, 0), 1)::DOUBLE >= {CONTAINED} AS s4, "
          f"prof.n_distinct / greatest(prof.n_rows, 1)::DOUBLE < {REPEATED} AS s5, lower(cand.c) <> 'id' AS s6 "
          "FROM cand JOIN prof ON prof.t = cand.t AND prof.c = cand.c LEFT JOIN sizes ON sizes.t = cand.t AND sizes.c = cand.c "
          "LEFT JOIN met ON met.t = cand.t AND met.c = cand.c AND met.p = cand.p), "
          "scored AS (SELECT *, s1::INT + s2::INT + s3::INT + s4::INT + s5::INT + s6::INT AS score FROM signals), "
          f"accepted AS (SELECT * FROM scored WHERE score >= {ACCEPT_SCORE} AND comparable AND n_matched = n_values)")

BOTH_WAYS = ("both_ways AS (SELECT t, c, p, k, max(score) / 6.0::DOUBLE AS confidence FROM "
             "(SELECT t, c, p, k, score FROM {src} UNION ALL SELECT p, k, t, c, score FROM {src}) GROUP BY 1, 2, 3, 4)")
