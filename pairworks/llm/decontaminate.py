"""Benchmark decontamination with suffix arrays.

Every run of rows of the corpus is a shard with a suffix array over its words; all suffixes of the test items are looked up
in it by binary search.  What a shard finds are verbatim matches and where they lie.

A test set is a stated query set: it is read in blocks of at most `block_bytes`, each sent to the tasks once, and a corpus
row passes all blocks without being shuffled.  Only corpus words that occur in the block can be part of a match, so the
suffixes that start a long enough run of such words are sorted and the others are left out; no match is lost by that.
"""

from __future__ import annotations

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Words, free_name, own, slices, text_or_empty, texts_of, tidied

WINDOW = 13
BLOCK_BYTES = 32 << 20
BITS, PACK = 21, 3
MOST_WORDS = (1 << BITS) - 3
SEPARATORS = bytes(c for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122))
FOUND = "n_words bigint, n_hit bigint, spans array<struct<start:bigint,end:bigint>>, items array<string>, " \
        "matches array<struct<item:string,item_start:bigint,start:bigint,words:bigint>>"


class Tests:
    """The windows of a block of test items, packed for lookup."""

    def __init__(self, rows: list[tuple], window: int):
        self.window = window
        words, bounds = Words(SEPARATORS).of([(t or "").encode() for _, t in rows])
        self.names = [str(i) if i is not None else "" for i, _ in rows]
        self.vocabulary = np.unique(words)
        if len(self.vocabulary) > MOST_WORDS:
            raise ValueError("a test item has too many distinct words")
        ids = np.searchsorted(self.vocabulary, words) + 1
        begins, lengths, items = [], [], []
        for k in range(len(rows)):
            a, n = int(bounds[k]), int(bounds[k + 1] - bounds[k])
            size = min(n, window)
            if size:
                at = np.arange(a, a + n - size + 1)
                begins.append(at)
                lengths.append(np.full(len(at), size))
                items.append(np.full(len(at), k))
        empty = np.zeros(0, dtype=np.int64)
        begins, lengths, items = (np.concatenate(x) if x else empty for x in (begins, lengths, items))
        self.starts = begins - bounds[items]
        low = keys(ids, begins, window, np.minimum(lengths, window), 0)
        # equal windows of several items are looked up once
        order = np.lexsort((*low[::-1], lengths))
        low, lengths = low[:, order], lengths[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (low[:, 1:] != low[:, :-1]).any(axis=0) | (lengths[1:] != lengths[:-1])
        self.low, self.lengths = low[:, new], lengths[new]
        self.high = self.low + padding(self.lengths, window)
        self.items, self.starts = items[order], self.starts[order]
        self.first = np.append(np.flatnonzero(new), len(order))
        self.least = int(self.lengths.min()) if len(self.lengths) else 0


def blocks_of(rows: list[tuple], window: int) -> list[Tests]:
    """The items of a block as lookups, halved until each has few enough distinct words."""
    names = Words(SEPARATORS).of([(t or "").encode() for _, t in rows])[0]
    if len(rows) > 1 and len(np.unique(names)) > MOST_WORDS:
        half = len(rows) // 2
        return blocks_of(rows[:half], window) + blocks_of(rows[half:], window)
    return [Tests(rows, window)]


def keys(ids: np.ndarray, at: np.ndarray, window: int, lengths, beyond: int) -> np.ndarray:
    """The `window` words from each position, a few to a number; words past `lengths` are `beyond`."""
    ids = np.append(ids, np.zeros(window + PACK, dtype=ids.dtype)).astype(np.uint64)
    columns = []
    for c in range(0, window, PACK):
        column = np.zeros(len(at), dtype=np.uint64)
        for j in range(c, c + PACK):
            word = np.where(j < lengths, ids[at + j], np.uint64(beyond)) if j < window else np.zeros(len(at), dtype=np.uint64)
            column = (column << np.uint64(BITS)) | word
        columns.append(column)
    return np.array(columns, dtype=np.uint64).reshape(len(columns), len(at))


def padding(lengths: np.ndarray, window: int) -> np.ndarray:
    """Added to packed windows: the largest word for each place past their length."""
    most, columns = np.uint64((1 << BITS) - 1), []
    for c in range(0, window, PACK):
        column = np.zeros(len(lengths), dtype=np.uint64)
        for j in range(c, c + PACK):
            column = (column << np.uint64(BITS)) | np.where(j < lengths, np.uint64(0), most)
        columns.append(column)
    return np.array(columns, dtype=np.uint64).reshape(len(columns), len(lengths))


def bound(table: np.ndarray, wanted: np.ndarray, after: bool) -> np.ndarray:
    """Binary search of packed windows in a suffix array: the first entry not below, or with `after` above, each."""
    lo, hi = np.zeros(wanted.shape[1], dtype=np.int64), np.full(wanted.shape[1], table.shape[1], dtype=np.int64)
    for _ in range(int(table.shape[1]).bit_length()):
        mid = (lo + hi) >> 1
        at = np.minimum(mid, table.shape[1] - 1)
        less, same = np.zeros(len(mid), dtype=bool), np.ones(len(mid), dtype=bool)
        for k in range(len(table)):
            value = table[k][at]
            less |= same & (value < wanted[k])
            same &= value == wanted[k]
        right = (less | same if after else less) & (lo < hi)
        lo, hi = np.where(right, mid + 1, lo), np.where(right, hi, np.minimum(hi, mid))
    return lo


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All of start, start + 1, ... for each count, one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - counts), counts)


def search(tests: Tests | SimpleNamespace, words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Build the shard's suffix array and look all test windows up: occurrences as (word position, window number)."""
    none = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    if not len(words) or not len(tests.lengths):
        return none
    place = np.minimum(np.searchsorted(tests.vocabulary, words), len(tests.vocabulary) - 1)
    known = tests.vocabulary[place] == words
    total = len(words)
    # words from here to the next unknown word or the end of the document
    stop = np.where(known, total, np.arange(total))
    last = np.minimum(bounds[1:], total) - 1
    full = bounds[1:] > bounds[:-1]
    limit = np.full(total, total)
    limit[last[full]] = last[full] + 1
    limit = np.minimum(np.minimum.accumulate(limit[::-1])[::-1], np.minimum.accumulate(stop[::-1])[::-1])
    run = limit - np.arange(total)
    at = np.flatnonzero(run >= tests.least)
    if not len(at):
        return none
    ids = np.where(known, place + 1, 0)
    table = keys(ids, at, tests.window, run[at], 0)
    order = np.lexsort(table[::-1])
    table, at = table[:, order], at[order]
    lo, hi = bound(table, tests.low, False), bound(table, tests.high, True)
    counts = np.maximum(hi - lo, 0)
    return at[ranges(lo, counts)], np.repeat(np.arange(len(counts)), counts)


def merged(tests: Tests | SimpleNamespace, doc_words: int, at: np.ndarray, which: np.ndarray, earlier: dict | None) -> dict:
    """One document's spans, items and longest matches, with those that earlier blocks found."""
    hit = np.zeros(doc_words + 1, dtype=np.int64)
    np.add.at(hit, at, 1)
    np.add.at(hit, at + tests.lengths[which], -1)
    for s in (earlier or {}).get("spans") or ():
        hit[s["start"]] += 1
        hit[s["end"]] -= 1
    edge = np.diff((np.cumsum(hit[:-1]) > 0).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    counts = tests.first[which + 1] - tests.first[which]
    entry = ranges(tests.first[which], counts)
    item, item_at, doc_at, size = tests.items[entry], tests.starts[entry], np.repeat(at, counts), np.repeat(tests.lengths[which], counts)
    order = np.lexsort((doc_at, doc_at - item_at, item))
    item, item_at, doc_at, size = item[order], item_at[order], doc_at[order], size[order]
    new = np.ones(len(item), dtype=bool)
    new[1:] = (item[1:] != item[:-1]) | (doc_at[1:] != doc_at[:-1] + 1) | (item_at[1:] != item_at[:-1] + 1)
    first, end = np.flatnonzero(new), np.append(np.flatnonzero(new)[1:], len(item)) - 1
    matches = [{"item": tests.names[i], "item_start": int(a), "start": int(b), "words": int(w)} for i, a, b, w in zip(
        item[first], item_at[first], doc_at[first], doc_at[end] + size[end] - doc_at[first], strict=True)] if len(item) else []
    old = earlier or {}
    return {"n_words": doc_words, "n_hit": int((ends - starts).sum()),
            "spans": [{"start": int(a), "end": int(b)} for a, b in zip(starts, ends, strict=True)],
            "items": sorted({*(old.get("items") or ()), *(tests.names[i] for i in np.unique(item))}),
            "matches": [*(old.get("matches") or ()), *matches]}


def find_matches(docs: DataFrame, benchmark: DataFrame, text: str = "text", into: str = "found", window: int = WINDOW,
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """`docs` with one more column, a struct: n_words, n_hit, spans of hit words, items, and the longest matches.

    A word is a run of bytes outside the separators after A-Z are lowered; a window is `window` consecutive words of an item,
    or all words of a shorter one.  Spans and matches count words from 0, ends are exclusive.  Null or empty texts have no
    words; items without words match nothing; a null item_id is named by the empty string; repeated rows each get their
    result; an empty benchmark hits nothing.  All columns of `docs` stay; if `into` is taken, underscores are added to it.
    """
    spark, into = docs.sparkSession, free_name(docs, into)
    # repeated rows are one item
    items = own(benchmark, "item_id", "text").distinct()
    volume = items.agg(F.sum(F.octet_length(text_or_empty(F.col("text"))))).first()[0] or 0
    blocks = max(1, -(-volume // block_bytes))
    schema = T.StructType([*docs.schema.fields, T.StructField(into, T.StructType.fromDDL(FOUND))])
    out, again = docs, False
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b) if blocks > 1 else items
        for tests in blocks_of([tuple(r) for r in part.collect()], window):
            out = out.mapInArrow(tidied(_matcher(spark.sparkContext.broadcast(vars(tests)), text, into, again)), schema)
            again = True
    return out


def _matcher(sent, text: str, into: str, again: bool):
    kind = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()),
                      ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), ("items", pa.list_(pa.string())),
                      ("matches", pa.list_(pa.struct([("item", pa.string()), ("item_start", pa.int64()), ("start", pa.int64()),
                                                      ("words", pa.int64())])))])

    def run(batches):
        tests, words = SimpleNamespace(**sent.value), Words(SEPARATORS)
        for batch in batches:
            for shard in slices(batch, text):
                found, bounds = words.of(texts_of(shard, text))
                at, which = search(tests, found, bounds)
                doc = np.searchsorted(bounds, at, side="right") - 1
                order = np.argsort(doc, kind="stable")
                at, which, doc = at[order], which[order], doc[order]
                cuts = np.searchsorted(doc, np.arange(shard.num_rows + 1))
                earlier = shard.column(into).to_pylist() if again else [None] * shard.num_rows
                rows = []
                for k in range(shard.num_rows):
                    a, z, n = cuts[k], cuts[k + 1], int(bounds[k + 1] - bounds[k])
                    if z > a:
                        rows.append(merged(tests, n, at[a:z] - bounds[k], which[a:z], earlier[k]))
                    else:
                        rows.append(earlier[k] or {"n_words": n, "n_hit": 0, "spans": [], "items": [], "matches": []})
                kept = shard.drop_columns([into]) if again else shard
                yield pa.RecordBatch.from_arrays([*kept.columns, pa.array(rows, kind)], names=[*kept.schema.names, into])
    return run


def contaminated(found):
    """The contract's rule: some hit, and at least a twentieth of the words."""
    return (found.n_hit > 0) & (20 * found.n_hit >= found.n_words)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """`docs` without the affected rows, same columns."""
    name = free_name(docs, "found")
    return find_matches(docs, benchmark, into=name, **options).where(~contaminated(F.col(name))).select(*(F.col(f"`{c}`") for c in docs.columns))


def report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated, one row per document."""
    f = F.col("found")
    return find_matches(own(docs, "doc_id", "text"), benchmark).select(
        "doc_id", f.n_words.alias("n_words"), f.n_hit.alias("n_hit"), F.size(f["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(f["items"], ","), 256).alias("items_sha256"), contaminated(f).alias("contaminated"))
