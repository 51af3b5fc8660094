"""Text expressions: blanks, lines, SQL cleaning and tolerant JSON."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code points Python treats as blanks, and as line ends.
BLANK_CODES = (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
               0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
BLANKS = "".join(map(chr, BLANK_CODES))
BLANK = r"\x{9}-\x{d}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
BLANK_RUN = f"[ {BLANK}]+"
# a run that is not a single plain blank; single ones need no change and are the most common by far
RAGGED_RUN = f" [ {BLANK}]+|[{BLANK}][ {BLANK}]*"
LINE_END = "\r\n|[\n\x0b\f\r\x1c-\x1e\x85\u2028\u2029]"

# Fixed value: characters that may lead a list item in model output.
BULLETS = "-*0123456789. "


def say(template: str, **cols) -> Column:
    """The template with each ``{name}`` replaced by a column; null if one of them is."""
    parts = re.split(r"\{(\w+)\}", template)
    return F.concat(*[cols[p].cast("string") if i % 2 else F.lit(p) for i, p in enumerate(parts) if p])


def strip(col, chars: str = BLANKS) -> Column:
    return F.btrim(col, F.lit(chars))


def lines(col) -> Column:
    return F.split(col, LINE_END)


def strip_bullet(col) -> Column:
    """One line without its list prefix and surrounding ticks."""
    return F.btrim(F.ltrim(strip(col), F.lit(BULLETS)), F.lit("`"))


def collapse_blanks(col) -> Column:
    return F.trim(F.regexp_replace(col, RAGGED_RUN, " "))


def clean_sql(col, preserve_literals: bool = False) -> Column:
    """SQL on one line: no backslashes, single blanks, at most one closing ``;`` removed; null gives ''.

    ``preserve_literals`` leaves quoted strings as they are.
    """
    if preserve_literals:
        parts = F.regexp_extract_all(col, F.lit("'(?:[^']|'')*'|[^']+|'"), F.lit(0))
        outside = lambda p: F.regexp_replace(F.replace(p, F.lit("\\"), F.lit("")), RAGGED_RUN, " ")
        flat = strip(F.array_join(F.transform(parts, lambda p: F.when(F.length(p).__gt__(1) & p.startswith("'"), p)
                                              .otherwise(outside(p))), ""))
    else:
        flat = collapse_blanks(F.replace(col, F.lit("\\"), F.lit("")))
    return F.coalesce(F.regexp_replace(flat, " ?;$", ""), F.lit(""))


def strip_fence(col) -> Column:
    """Drop surrounding ticks and a leading ``sql`` word."""
    return F.regexp_replace(strip(strip(col), "`"), f"(?i)^sql[ {BLANK}]*", "")


def one_json_value(col) -> Column:
    """The text as a variant if it is exactly one valid JSON value, else null.

    The parser stops after the first value, so the text is wrapped in a list and
    must come back as a list of one.
    """
    return only_member(as_list(col))


def as_list(col) -> Column:
    """The values of a text that holds comma-separated JSON values, else null."""
    return F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), col, F.lit("]"))), "$", "array<variant>")


def only_member(values) -> Column:
    return F.when(F.size(values) == 1, F.get(values, F.lit(0)))


def json_values(texts) -> Column:
    """The texts of an array that are one JSON value each; every text is parsed once."""
    return F.filter(F.transform(F.transform(texts, as_list), only_member), lambda v: v.isNotNull())


def is_object(variant) -> Column:
    return F.try_variant_get(variant, "$", "map<string,variant>").isNotNull()


def as_items(variant) -> Column:
    """Members of a list, of an object's ``pairs`` list, or the value alone."""
    return F.coalesce(F.try_variant_get(variant, "$.pairs", "array<variant>"),
                      F.try_variant_get(variant, "$", "array<variant>"), F.array(variant))


def field(variant, name: str) -> Column:
    return F.try_variant_get(variant, f"$.{name}", "string")


def trie_pattern(words: list[str]) -> str:
    """A pattern that matches the longest of the words that starts at a place; it grows with their letters, not their number."""
    root: dict = {}
    for w in words:
        node = root
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def written(node: dict) -> str:
        ends, nexts, run = "" in node, [(ch, n) for ch, n in sorted(node.items()) if ch], ""
        # letters without a choice need no group
        while not ends and len(nexts) == 1:
            run += re.escape(nexts[0][0])
            node = nexts[0][1]
            ends, nexts = "" in node, [(ch, n) for ch, n in sorted(node.items()) if ch]
        if not nexts:
            return run
        rest = "|".join(re.escape(ch) + written(n) for ch, n in nexts)
        return f"{run}(?:{rest})" + ("?" if ends else "")

    return written(root)


def literal_map(values: dict, kind: str) -> Column:
    """A constant map of a given Spark type as one literal, however many entries it has."""
    return F.from_json(F.lit(json.dumps(values, ensure_ascii=False)), kind)


def words_found(col, words: list[str], word_boundary: bool = False) -> Column:
    """Those of the words that the text holds, in their order, found in one pass over the text.

    At each place the pattern gives the longest word; the shorter ones that begin it are known beforehand.
    """
    at: dict[str, list[dict]] = {}
    for i, w in enumerate(words):
        at.setdefault(w, []).append({"i": i, "w": w})
    is_word = lambda ch: bool(re.match(r"\w", ch, re.ASCII))

    def begins(short: str, long: str) -> bool:
        """Whether `short` is found wherever `long` is: with boundaries, one must lie behind it inside `long`."""
        return not word_boundary or short == long or is_word(short[-1]) != is_word(long[len(short)])

    starts = {w: [e for n in range(1, len(w) + 1) if w[:n] in at and begins(w[:n], w) for e in at[w[:n]]] for w in at}
    edge = r"\b" if word_boundary else ""
    hits = F.regexp_extract_all(col, F.lit(f"{edge}(?=({trie_pattern(sorted(at))}){edge})"), F.lit(1))
    known = literal_map(starts, "map<string,array<struct<i:int,w:string>>>")
    entries = F.flatten(F.transform(F.array_distinct(hits), lambda h: F.element_at(known, h)))
    return F.transform(F.array_sort(F.array_distinct(entries)), lambda e: e["w"])
