"""Word pairs, triples and quadruples that occur together more often than their parts would.

Phrases are counted by marginalising the longest ones.  At each word a window of four is made of the word and the three that
lead it within its piece, padded where the piece ends; only these windows are counted.  A phrase of one to three words is a
prefix of as many windows as it has occurrences, so Spark's ROLLUP over the four columns gives the counts of all lengths.

Before that a window is padded where no frequent phrase can go on:

* at a word that itself occurs too seldom.  The frequent words are known to the tasks as a bitmap of `BITMAP_BITS` bits,
  whatever their number; a word it lets through by chance only costs work.
* at the second, third or fourth word where the prefix up to it occurs too seldom.  Windows are dealt by their first two words,
  so a group knows the whole count of every prefix; pairs that fill more than half a group are dealt by three words.

Words have 64-bit names made of their text and language, and get their text back at the end.  At w different words about
w * w / 2^65 pairs share a name.  Between tasks the most frequent words, at most `NUMBERED` of them, go by their number; a name
is sent only for the others, so the bound (eight bytes a word in each task) changes no result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import LOWER, Tokens, cut, from_gaps, from_planes, gaps, joined, mixed, own, planes, slices, text_or_empty, texts_of, tidied

BREAKS = b".,;:!?\n\v\f\r"
BLANKS = b" \t"
LONGEST = 4
LEAST = 30
COVERED_PERCENT = 80
SCALE = 2_000_000
TOP = 2000
SLICE_BYTES = 2 << 20
GROUP_BYTES = 8 << 20
BITMAP_BITS = 24
NUMBERED = 1 << 19
UNKNOWN = "und"

WORDS = "lang string, code bigint, word string, n bigint"
SENT = "place int, codes binary, windows binary, counts binary"
COUNTED = "c1 bigint, c2 bigint, c3 bigint, c4 bigint, n bigint"


class Pieces:
    """The words of some texts: codes of word and language, and the piece each lies in."""

    def __init__(self, batch: pa.RecordBatch):
        texts = texts_of(batch)
        self.blob = b"\n".join(texts) + b"\n"
        data = np.frombuffer(self.blob, dtype=np.uint8)
        self.starts, self.stops, names = Tokens(BLANKS + BREAKS, lower=True).of(data)
        is_break = np.zeros(256, dtype=bool)
        is_break[list(BREAKS)] = True
        self.piece = np.searchsorted(np.flatnonzero(is_break[data]), self.starts)
        langs = batch.column("lang").to_pylist()
        self.langs = sorted(set(langs))
        number = {x: i for i, x in enumerate(self.langs)}
        doc = np.searchsorted(np.cumsum([len(t) + 1 for t in texts]), self.starts, side="right")
        self.lang = np.array([number[x] for x in langs], dtype=np.int32)[doc]
        salts = np.array([int.from_bytes(hashlib.blake2b(x.encode(), digest_size=8).digest(), "little") for x in self.langs], dtype=np.uint64)
        self.codes = mixed(names + salts[self.lang]) if len(names) else names
        self.codes[self.codes == 0] = 1

    def led(self, codes: np.ndarray, by: int) -> np.ndarray:
        """The code `by` words on in the same piece, else 0."""
        out = np.zeros(len(codes), dtype=np.uint64)
        if len(codes) > by:
            out[:-by] = np.where(self.piece[by:] == self.piece[:-by], codes[by:], np.uint64(0))
        return out


def pair_name(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    return joined([first, second])


def grouped(keys: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Different keys in order and the sums of their counts."""
    if not len(counts):
        return keys, counts
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), dtype=bool)
    new[0] = True
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    at = np.flatnonzero(new)
    return [k[order][at] for k in keys], np.add.reduceat(counts[order], at)


def packed(ranks: list[np.ndarray]) -> list[np.ndarray]:
    """Four numbers below 2^32 as two keys that sort alike."""
    return [ranks[0].astype(np.uint64) << np.uint64(32) | ranks[1].astype(np.uint64), ranks[2].astype(np.uint64) << np.uint64(32) | ranks[3].astype(np.uint64)]


def unpacked(keys: list[np.ndarray]) -> list[np.ndarray]:
    low = np.uint64((1 << 32) - 1)
    return [x.astype(np.int64) for k in keys for x in (k >> np.uint64(32), k & low)]


def zipped(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def unzipped(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def most_frequent(words: DataFrame, most: int) -> np.ndarray:
    """Names of the most frequent words, the most frequent first: all above a count that at most `most` words reach."""
    step = F.floor(F.log2("n") * 4)
    least, total = None, 0
    # at most four rows for each power of two
    for r in sorted(words.groupBy(step.alias("step")).agg(F.count("*").alias("c")).collect(), key=lambda r: -r.step):
        total += r.c
        if total > most:
            break
        least = r.step
    if least is None:
        return np.zeros(0, dtype=np.uint64)
    found = words.where(step >= least).select("code", "n").toArrow()
    codes, n = (found.column(c).to_numpy() for c in ("code", "n"))
    return codes[np.lexsort((codes, -n))].view(np.uint64)


def _word_rows(groups: int):
    """Of each run of texts: its different words with their counts, all words of a language (code 0), and pairs that may be hot."""
    def run(batches):
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                p = Pieces(batch)
                if not len(p.codes):
                    continue
                values, at, counts = np.unique(p.codes, return_index=True, return_counts=True)
                words = [p.blob[a:z].translate(LOWER) for a, z in zip(p.starts[at].tolist(), p.stops[at].tolist(), strict=True)]
                langs = np.array(p.langs, dtype=object)
                all_of = np.bincount(p.lang, minlength=len(p.langs))
                second = p.led(p.codes, 1)
                pairs, times = np.unique(pair_name(p.codes, second), return_counts=True)
                hot = times >= max(16, len(p.codes) // (4 * groups))
                k = int(hot.sum())
                yield pa.RecordBatch.from_arrays([
                    pa.array([*langs[p.lang[at]].tolist(), *p.langs, *[None] * k], pa.string()),
                    pa.array(np.concatenate([values, np.zeros(len(p.langs), np.uint64), pairs[hot]]).view(np.int64)),
                    pa.array(words + [None] * (len(p.langs) + k), pa.binary()).cast(pa.string()),
                    pa.array(np.concatenate([counts, all_of, times[hot]]).astype(np.int64))], names=["lang", "code", "word", "n"])
    return run


def _windows(groups: int, bitmap: np.ndarray, hot: np.ndarray, numbered: np.ndarray):
    """Of each run of texts: its different windows and their counts, dealt to groups.

    A word is the number 0 for none, up to K for one of the K in `numbered`, and beyond K one of the names sent along.
    """
    shift, k = np.uint64(64 - BITMAP_BITS), len(numbered)

    def run(batches):
        order_of = np.argsort(numbered)
        sorted_names = numbered[order_of]
        for whole in batches:
            for batch in slices(whole, "text", SLICE_BYTES):
                p = Pieces(batch)
                bit = p.codes >> shift
                known = (bitmap[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
                codes = np.where(known, p.codes, np.uint64(0))
                values, inverse = np.unique(np.concatenate([np.zeros(1, np.uint64), codes]), return_inverse=True)
                at = np.searchsorted(sorted_names, values)
                named = at < k
                named[named] = sorted_names[at[named]] == values[named]
                number = np.zeros(len(values), dtype=np.uint64)
                number[named] = order_of[at[named]] + 1
                far = ~named & (values > 0)
                number[far] = k + 1 + np.arange(int(far.sum()))
                names = np.concatenate([np.zeros(1, np.uint64), numbered, values[far]])
                ranks = [number[inverse[1:]]]
                for by in range(1, LONGEST):
                    led = p.led(ranks[0], by)
                    ranks.append(np.where(ranks[-1] > 0, led, np.uint64(0)))
                start = ranks[0] > 0
                keys, counts = grouped(packed([r[start] for r in ranks]), np.ones(int(start.sum()), np.int64))
                window = unpacked(keys)
                name = pair_name(names[window[0]], names[window[1]])
                split = np.isin(name, hot)
                name[split] = pair_name(name[split], names[window[2][split]])
                place = ((mixed(name) >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)
                order = np.argsort(place, kind="stable")
                place = place[order]
                # the texts' own arrays are not needed beside what is sent
                del p, bit, known, codes, values, inverse, ranks, start, keys, name, split
                edges = np.flatnonzero(np.diff(place, prepend=-1))
                for a, z in zip(edges.tolist(), np.append(edges, len(place))[1:].tolist(), strict=True):
                    part = np.concatenate([w[order[a:z]] for w in window])
                    mine, again = np.unique(part[part > k], return_inverse=True)
                    part[part > k] = k + 1 + again
                    # windows are in order, so their first words are
                    part[:z - a] = np.diff(part[:z - a], prepend=0)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([int(place[a])], pa.int32()), pa.array([gaps(names[mine])], pa.binary()),
                        pa.array([zipped(planes(part.astype(np.uint32)))], pa.binary()), pa.array([zipped(planes(counts[order[a:z]]))], pa.binary())],
                        names=["place", "codes", "windows", "counts"])
    return run


def _merged(least: int, hot: np.ndarray, numbered: np.ndarray):
    """A group's windows with their counts, each padded behind its last prefix that is frequent enough."""
    numbers = len(numbered)

    def run(table: pa.Table) -> pa.Table:
        dictionaries = [from_gaps(x) for x in table.column("codes").to_pylist()]
        others = np.unique(np.concatenate(dictionaries))
        names = np.concatenate([np.zeros(1, np.uint64), numbered, others])
        columns = [[] for _ in range(LONGEST)]
        for codes, x in zip(dictionaries, table.column("windows").to_pylist(), strict=True):
            ranks = from_planes(unzipped(x), np.uint32).reshape(LONGEST, -1)
            ranks[0] = np.cumsum(ranks[0])
            far = ranks > numbers
            ranks[far] = numbers + 1 + np.searchsorted(others, codes)[ranks[far] - np.uint32(numbers + 1)]
            for c, r in zip(columns, ranks, strict=True):
                c.append(r)
        counts = np.concatenate([from_planes(unzipped(x), np.int64) for x in table.column("counts").to_pylist()])
        del dictionaries
        keys = packed([np.concatenate(c) for c in columns])
        columns.clear()
        keys, counts = grouped(keys, counts)
        window = unpacked(keys)
        seldom = np.zeros(len(counts), dtype=bool)
        for k in range(1, LONGEST):
            new = np.zeros(len(counts), dtype=bool)
            new[0] = True
            for w in window[:k + 1]:
                new[1:] |= w[1:] != w[:-1]
            at = np.flatnonzero(new)
            total = np.repeat(np.add.reduceat(counts, at), np.diff(at, append=len(counts)))
            few = total < least
            if k == 1:
                few &= ~np.isin(pair_name(names[window[0]], names[window[1]]), hot)
            seldom |= few
            window[k] = np.where(seldom, 0, window[k])
        keys, counts = grouped(packed(window), counts)
        out = [pa.array(names[w].view(np.int64)) for w in unpacked(keys)]
        return pa.table([*out, pa.array(counts)], names=["c1", "c2", "c3", "c4", "n"])
    return run


def count_phrases(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """All phrases of one to four words that occur at least `least` times, and the words.

    The first table has `p` (codes of the words) and `f` (occurrences), the second `lang`, `code`, `word`, `n`; in that, code 0
    stands for all words of a language.  Null texts are empty, a null language is `und`, repeated rows count again, an empty
    table gives empty tables.  Columns other than text and lang are not read.
    """
    spark = docs.sparkSession
    rows = own(docs, "text", "lang").select(text_or_empty(F.col("text")).alias("text"), F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"))
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), volume // GROUP_BYTES, 1)
    found = rows.mapInArrow(tidied(_word_rows(groups)), WORDS).groupBy("lang", "code", "word").agg(F.sum("n").alias("n"))
    # all that is kept of a language, of frequent words and of pairs that may be hot
    words = cut(found.where((F.col("n") >= least) | (F.col("code") == 0)), "words")
    named = words.where("lang IS NOT NULL AND code <> 0")
    total = words.where("lang IS NOT NULL AND code = 0").agg(F.sum("n")).first()[0] or 0
    # at most two pairs for a group
    hot = np.sort(np.array([r.code for r in words.where(F.col("lang").isNull() & (F.col("n") * 2 * groups > total)).select("code").collect()], dtype=np.int64).view(np.uint64))
    bit = F.shiftrightunsigned("code", 64 - BITMAP_BITS)
    blocks = named.groupBy(F.shiftright(bit, 6).alias("block")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(shiftrightunsigned(code, {64 - BITMAP_BITS}) & 63 AS int))")).alias("bits"))
    bitmap = np.zeros(1 << (BITMAP_BITS - 6), dtype=np.uint64)
    # at most 2^(BITMAP_BITS - 6) rows
    for r in blocks.collect():
        bitmap[r.block] = np.uint64(r.bits & ((1 << 64) - 1))
    numbered = most_frequent(named, NUMBERED)
    sent = rows.mapInArrow(tidied(_windows(groups, bitmap, hot, numbered)), SENT)
    windows = sent.groupBy("place").applyInArrow(_merged(least, hot, numbered), COUNTED)
    columns = ["c1", "c2", "c3", "c4"]
    sums = windows.rollup(*columns).agg(F.sum("n").alias("f"), F.grouping_id().alias("level"))
    size = F.expr("CASE level WHEN 0 THEN 4 WHEN 1 THEN 3 WHEN 3 THEN 2 WHEN 7 THEN 1 ELSE 0 END")
    phrase = F.slice(F.array(*columns), F.lit(1), size)
    phrases = sums.where(F.col("f") >= least).where(size > 0).select(phrase.alias("p"), "f").where(F.element_at("p", -1) != 0)
    return cut(phrases, "phrases"), words.where("lang IS NOT NULL")


def scored(phrases: DataFrame) -> DataFrame:
    """Each phrase of two words or more with its worst cut: p, a, l, r, score; ties go to the shorter first part."""
    cuts = (phrases.where(F.size("p") > 1).select("p", F.col("f").alias("a"), F.explode(F.sequence(F.lit(1), F.size("p") - 1)).alias("k"))
            .select("p", "a", "k", F.slice("p", F.lit(1), F.col("k")).alias("first"), F.slice("p", F.col("k") + 1, F.size("p") - F.col("k")).alias("rest")))
    both = (cuts.join(phrases.select(F.col("p").alias("first"), F.col("f").alias("l")), "first")
            .join(phrases.select(F.col("p").alias("rest"), F.col("f").alias("r")), "rest"))
    exact = F.expr(f"cast((cast(a AS decimal(20,0)) * {SCALE}) div (cast(l AS decimal(20,0)) + cast(r AS decimal(20,0))) AS bigint)")
    worst = both.groupBy("p").agg(F.min(F.struct(exact.alias("score"), "k", "a", "l", "r")).alias("w"))
    return worst.select("p", "w.a", "w.l", "w.r", "w.score")


def uncovered(candidates: DataFrame, percent: int = COVERED_PERCENT) -> DataFrame:
    """Candidates without a longer one around them that has at least `percent` of their occurrences."""
    inner = F.expr("flatten(transform(sequence(2, size(p) - 1), m -> transform(sequence(1, size(p) - m + 1), i -> slice(p, i, m))))")
    around = (candidates.where(F.size("p") > 2).select(F.explode(F.array_distinct(inner)).alias("p"), F.col("a").alias("longer"))
              .groupBy("p").agg(F.max("longer").alias("longer")))
    wide = lambda c, n: F.col(c).cast("decimal(20,0)") * n
    return candidates.join(around, "p", "left").where(F.col("longer").isNull() | (wide("longer", 100) < wide("a", percent))).drop("longer")


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the `top` phrases of each language; `count_phrases` says what nulls and repeats give.

    `top` is what the report is about; ties beyond it are told apart by the phrase.
    """
    phrases, words = count_phrases(docs, least)
    named = words.where("code <> 0")
    left = uncovered(scored(phrases))
    left = left.join(named.select("lang", F.col("code").alias("c1")), F.col("p")[0] == F.col("c1")).drop("c1")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    # with all that tie at the end; their texts decide
    near = left.withColumn("near", F.rank().over(best)).where(F.col("near") <= top).drop("near")
    spelled = (near.select("p", F.posexplode("p").alias("at", "code")).join(named.select("code", "word"), "code")
               .groupBy("p").agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("w"))
               .select("p", F.array_join(F.col("w.word"), " ").alias("phrase")))
    ranked = near.join(spelled, "p").withColumn("rank", F.row_number().over(
        Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")).cast("long")).where(F.col("rank") <= top)
    return ranked.join(words.where("code = 0").select("lang", "n"), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
