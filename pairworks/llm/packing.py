"""Packing of tokens into training sequences with a controlled mixture of sources.

Each source is a queue of tokens.  Deficit round-robin gives a source its quantum in every window and carries what a window
could not give (less than a token here, as documents are cut freely) to the next.  What a source has given after `w` windows
is then a closed form, ``floor(w Q C[s] / W) - floor(w Q C[s-1] / W)`` with cumulated weights `C`, so a task places any
document from its position in its queue alone: deficits carry over windows and partitions without anyone passing them on.
When a queue holds less than its quantum it is emptied and the others share its part; that begins a new phase.
The closed form needs a quantum of a token at least: sources below that share a queue and follow one another in it.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_right
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window as W

from .common import Names, cut, own, tidied

SEQUENCE = 1024
WINDOW = 64 * SEQUENCE
END = 0
RUN = 1 << 20
MOST_SOURCES = 10_000
FOLDED = 1024
TOKENS = "part bigint, place bigint, doc_id bigint, source string, n bigint, before bigint, ids binary"
PIECE = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"

# The letters, digits and blanks among the characters for which the splitting pattern is spelled out here.
LETTERS, DIGITS, BLANKS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾", "\t\n\r "
PLAIN = f"'(?:s|t|re|ve|m|ll|d)| ?[{LETTERS}]+| ?[{DIGITS}]+| ?[^{BLANKS}{LETTERS}{DIGITS}]+|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
OTHER = "[^\t\n\r -~¡-ɏ‐-‧]|<\\|"


def byte_letters() -> dict[int, str]:
    """The letter that byte-level vocabularies write for each byte: itself where printable, else the next one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)}


# kinds of bytes
LETTER, DIGIT, MARK, BLANK = range(4)
APOSTROPHE = ord("'")


def kinds_of_bytes() -> tuple[np.ndarray, np.ndarray]:
    """The kind of each byte that is a character or begins one, and that of the characters with 0xC2 before the byte."""
    plain, latin = re.compile(f"[{LETTERS}]"), re.compile(f"[{DIGITS}]")
    kind = lambda ch: LETTER if plain.match(ch) else DIGIT if latin.match(ch) else BLANK if ch in BLANKS else MARK
    one = np.array([kind(chr(b)) if b < 128 else LETTER if 0xC3 <= b <= 0xC9 else MARK for b in range(256)], dtype=np.int8)
    return one, np.array([kind(chr(b)) if 128 <= b < 192 else MARK for b in range(256)], dtype=np.int8)


class Splitter:
    """Where the pieces of the splitting pattern begin in an array of UTF-8 bytes, found for all texts of it at once."""

    def __init__(self):
        self.one, self.after_c2 = kinds_of_bytes()

    def starts(self, data: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """First bytes of the pieces of the texts that begin at `firsts` (sorted, the first is 0); no text is empty."""
        n = len(data)
        kind = self.one[data]
        two = np.flatnonzero(data[:-1] == 0xC2)
        kind[two] = self.after_c2[data[two + 1]]
        sign = np.flatnonzero(data[:-1] == 0xC3)
        kind[sign[np.isin(data[sign + 1], (0x97, 0xB7))]] = MARK
        inner = (data & 0xC0) == 0x80
        # a character of two or three bytes is of the kind of its first one
        for _ in range(2):
            follow = np.flatnonzero(inner)
            kind[follow] = kind[follow - 1]
        text = np.zeros(n, dtype=bool)
        text[firsts] = True
        begin = np.empty(n, dtype=bool)
        begin[0] = True
        begin[1:] = kind[1:] != kind[:-1]
        begin |= text
        # the last blank before something else is a piece of its own, or begins that piece if it is a space
        last = np.flatnonzero((kind[:-1] == BLANK) & (kind[1:] != BLANK) & ~text[1:])
        begin[last] = True
        begin[last[data[last] == 32] + 1] = False
        # an apostrophe at the beginning of a piece takes the ending of a contraction along
        at = np.flatnonzero((data == APOSTROPHE) & begin)
        ends = np.append(firsts, n)[np.searchsorted(firsts, at, side="right")]
        get = lambda k: np.where(at + k < ends, data[np.minimum(at + k, n - 1)], 0)
        b1, b2 = get(1), get(2)
        short = np.isin(b1, list(b"stmd"))
        long = ((b1 == ord("r")) & (b2 == ord("e"))) | ((b1 == ord("v")) & (b2 == ord("e"))) | ((b1 == ord("l")) & (b2 == ord("l")))
        for some, size in ((at[short], 2), (at[long & ~short], 3)):
            begin[some + 1] = False
            behind = some + size
            begin[behind[behind < n]] = True
        return np.flatnonzero(begin)


class Encoder:
    """Token ids of texts; the same as the tokenizer's, with the ids of pieces remembered.

    Byte-level pair merging never crosses the pieces of the splitting pattern, so a text's ids are those of its pieces.  Pieces are
    told apart by 64-bit fingerprints; each different one goes to the tokenizer's merges once, at most `remember` are kept.
    Texts with characters outside the plain range, or that may hold a special token, go to the tokenizer as they are.
    """

    def __init__(self, path: str, remember: int = 1_000_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "I" if self.tokenizer.get_vocab_size() > 1 << 16 else "H"
        self.width = array(self.kind).itemsize
        self.dtype = np.dtype(np.uint32 if self.kind == "I" else np.uint16)
        self.remember, self.other, self.letters, self.split = remember, re.compile(OTHER), byte_letters(), Splitter()
        self.names = Names()
        self._forget()

    def _forget(self) -> None:
        # by fingerprint: where the ids of a piece lie, and how many they are
        self.known, self.place, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, self.dtype)

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, in runs of about RUN characters."""
        out: list[bytes] = [b""] * len(texts)
        run, held = [], 0
        for i, text in enumerate(texts):
            if not text:
                continue
            if self.other.search(text):
                out[i] = array(self.kind, self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
                continue
            run.append(i)
            held += len(text)
            if held >= RUN:
                self._plain(texts, run, out)
                run, held = [], 0
        if run:
            self._plain(texts, run, out)
        return out

    def _plain(self, texts: list[str], run: list[int], out: list[bytes]) -> None:
        parts = [texts[i].encode() for i in run]
        blob = b"".join(parts)
        data = np.frombuffer(blob, dtype=np.uint8)
        firsts = np.cumsum([0] + [len(p) for p in parts[:-1]])
        starts = self.split.starts(data, firsts)
        stops = np.append(starts[1:], len(data))
        names, at, inverse = np.unique(self.names.of(data, starts, stops), return_index=True, return_inverse=True)
        self._learn(names, blob, starts[at], stops[at])
        where = np.searchsorted(self.known, names)
        count, place = self.count[where][inverse], self.place[where][inverse]
        ends = np.cumsum(count)
        taken = np.arange(int(ends[-1])) + np.repeat(place - (ends - count), count)
        ids = self.ids[taken].tobytes()
        edges = np.append(ends - count, ends[-1])[np.searchsorted(starts, np.append(firsts, len(data)))] * self.width
        for i, a, z in zip(run, edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            out[i] = ids[a:z]

    def _learn(self, names: np.ndarray, blob: bytes, starts: np.ndarray, stops: np.ndarray) -> None:
        if len(self.known) > self.remember:
            self._forget()
        at = np.searchsorted(self.known, names)
        new = np.flatnonzero(at == len(self.known)) if not len(self.known) else np.flatnonzero(self.known[np.minimum(at, len(self.known) - 1)] != names)
        if not len(new):
            return
        merges, letters = self.tokenizer.model.tokenize, self.letters
        found = [[t.id for t in merges(blob[a:z].decode("latin-1").translate(letters))] for a, z in zip(starts[new].tolist(), stops[new].tolist(), strict=True)]
        count = np.array([len(x) for x in found], dtype=np.int64)
        place = np.cumsum(count) - count + len(self.ids)
        self.ids = np.concatenate([self.ids, np.fromiter(chain.from_iterable(found), dtype=self.dtype, count=int(count.sum()))])
        known = np.concatenate([self.known, names[new]])
        order = np.argsort(known)
        self.known, self.place, self.count = known[order], np.concatenate([self.place, place])[order], np.concatenate([self.count, count])[order]


def tokenize(docs: DataFrame, path: str, text: str = "text", source: str = "source") -> DataFrame:
    """Each document's ids with the end id, and how many tokens of its source its partition has before it."""
    def run(batches):
        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, part, place, sums = Encoder(path), TaskContext.get().partitionId(), 0, {}
        end, width = array(encoder.kind, [END]).tobytes(), encoder.width
        for batch in batches:
            texts = ["" if t is None else t for t in batch.column("text").to_pylist()]
            names = ["" if s is None else s for s in batch.column("source").to_pylist()]
            ids = [x + end for x in encoder.encode_all(texts)]
            sizes, before = [len(x) // width for x in ids], []
            for name, n in zip(names, sizes, strict=True):
                before.append(sums.get(name, 0))
                sums[name] = before[-1] + n
            rows = len(texts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([part] * rows, pa.int64()), pa.array(range(place, place + rows), pa.int64()), batch.column("doc_id").cast(pa.int64()),
                 pa.array(names, pa.string()), pa.array(sizes, pa.int64()), pa.array(before, pa.int64()), pa.array(ids, pa.binary())],
                names=["part", "place", "doc_id", "source", "n", "before", "ids"])
            place += rows
    rows = docs.select("doc_id", docs[text].alias("text"), docs[source].cast("string").alias("source"))
    return rows.mapInArrow(tidied(run), TOKENS)


def queues(totals: dict[str, int], weights: dict[str, int], window: int) -> dict[str, tuple[str, int]]:
    """Each unit's queue, named after the first unit in it, and the tokens in the queue before the unit's.

    A unit with a quantum of a token or more has its own queue.  The others are taken by weight and name until they have one
    together; what is left at the end joins the last of these queues, or else the lightest of the units with their own.
    """
    whole, out, groups, held = sum(weights[n] for n, v in totals.items() if v), {}, [[]], 0
    for name in sorted((n for n, v in totals.items() if v), key=lambda n: (weights[n], n)):
        if held * window >= whole:
            groups.append([])
            held = 0
        groups[-1].append(name)
        held += weights[name]
    if held * window < whole and len(groups) > 1:
        groups[-2] += groups.pop()
    for group in groups:
        at = 0
        for name in group:
            out[name] = (group[0], at)
            at += totals[name]
    return out


@dataclass
class Phase:
    """`windows` windows from `start` on, then the rest of the queues that run dry."""
    start: int
    windows: int
    weights: dict[str, int]
    begin: dict[str, int]
    rest: dict[str, int] = field(default_factory=dict)

    def __post_init__(self):
        self.below, self.total = {}, 0
        for name in sorted(self.weights):
            self.below[name] = self.total
            self.total += self.weights[name]

    def plain(self) -> dict:
        return {"start": self.start, "windows": self.windows, "weights": self.weights, "begin": self.begin, "rest": self.rest}

    def given(self, name: str, w: int, window: int) -> int:
        """Tokens of the source in the first `w` windows."""
        below = self.below[name]
        return w * window * (below + self.weights[name]) // self.total - w * window * below // self.total

    def ahead(self, name: str, w: int, window: int) -> int:
        """Where the source's part begins in window `w`."""
        below = self.below[name]
        return (w + 1) * window * below // self.total - w * window * below // self.total


def schedule(totals: dict[str, int], weights: dict[str, int], window: int) -> list[Phase]:
    """The phases that use up all queues."""
    left, begin, start, out = dict(totals), dict.fromkeys(totals, 0), 0, []
    left = {n: v for n, v in left.items() if v}
    while left:
        phase = Phase(start, 0, {n: weights[n] for n in left}, {n: begin[n] for n in left})
        phase.windows = min(left[n] * phase.total // (phase.weights[n] * window) for n in left)
        start += phase.windows * window
        for n in list(left):
            given = phase.given(n, phase.windows, window)
            left[n] -= given
            begin[n] += given
        for n in sorted(left):
            if left[n] * phase.total < window * phase.weights[n]:
                phase.rest[n] = start
                start += left[n]
                begin[n] += left.pop(n)
        out.append(phase)
    return out


def placed(phases: list[Phase], name: str, at: int, n: int, window: int) -> list[tuple[int, int, int]]:
    """(place in the document, place in the stream, length) of the runs that `n` tokens from `at` on in a queue make."""
    out, done = [], 0
    own_phases = [p for p in phases if name in p.weights]
    k = max(bisect_right([p.begin[name] for p in own_phases], at) - 1, 0)
    while done < n:
        phase = own_phases[k]
        here = at + done - phase.begin[name]
        whole = phase.given(name, phase.windows, window)
        if here < whole:
            w = here * phase.total // (phase.weights[name] * window)
            while phase.given(name, w, window) > here:
                w -= 1
            while phase.given(name, w + 1, window) <= here:
                w += 1
            first = phase.given(name, w, window)
            length = min(n - done, phase.given(name, w + 1, window) - here)
            out.append((done, phase.start + w * window + phase.ahead(name, w, window) + here - first, length))
        elif name in phase.rest:
            length = n - done
            out.append((done, phase.rest[name] + here - whole, length))
        else:
            k += 1
            continue
        done += length
    return out


def pack(docs: DataFrame, path: str, text: str = "text", source: str = "source", weights: dict[str, int] | None = None,
         sequence: int = SEQUENCE, window: int = WINDOW, fold: bool = False, checksums: bool = False) -> DataFrame:
    """Pieces of documents in sequences of `sequence` tokens: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    `path` is a tokenizer file.  `weights` are target proportions, by default each source's share of all tokens, so that
    every window has the mixture of the corpus.  Sources not named in `weights` weigh 1.  Null texts are empty and give only
    the end id, a null source is the source with the empty name, repeated rows are packed each.  An empty table gives no
    pieces.  Totals of at most MOST_SOURCES sources go to the driver; more are an error, as the mixture of each cannot be kept.
    With `fold` they are not: sources named in `weights` and those with a 1024th (FOLDED) of all tokens or more stay as they
    are, the others are dealt by xxhash64 to FOLDED units that are mixed like a source each, with the sum of the weights;
    the sources of a unit follow one another by name.
    The order in a source is that of the rows in the input's partitions.  `checksums` adds `ids_crc32` as `with_checksums` does,
    in the pass that makes the pieces.
    """
    spark = docs.sparkSession
    tokens = cut(tokenize(docs, path, text, source), "tokens")
    sums = tokens.groupBy("source", "part").agg(F.sum("n").alias("n"))
    sums = cut(sums, "sums")
    sources = sums.groupBy("source").agg(F.sum("n").alias("size"))
    unit = F.concat(F.lit("="), "source")
    if sources.count() > MOST_SOURCES:
        if not fold:
            raise ValueError(f"more than {MOST_SOURCES} sources: group them first")
        least = -(-sources.agg(F.sum("size")).first()[0] // FOLDED)
        stays = F.col("size") >= least
        if weights:
            stays |= F.col("source").isin(list(weights))
        unit = F.when(stays, unit).otherwise(F.concat(F.lit("#"), F.pmod(F.xxhash64("source"), F.lit(FOLDED)).cast("string")))
    # a unit is a source, or the sources that are folded together
    units = cut(sources.select("source", "size", unit.alias("unit")), "units")
    rows = units.groupBy("unit").agg(F.sum("size"), F.count("*")).collect()
    totals = {r[0]: r[1] for r in rows}
    target = {r[0]: (weights.get(r[0][1:], 1) if r[0][0] == "=" else r[2]) if weights else r[1] for r in rows}
    queue = queues(totals, target, window)
    in_queue, weigh = dict.fromkeys((q for q, _ in queue.values()), 0), dict.fromkeys((q for q, _ in queue.values()), 0)
    for name, (q, _) in queue.items():
        in_queue[q] += totals[name]
        weigh[q] += target[name]
    plan = spark.sparkContext.broadcast(([p.plain() for p in schedule(in_queue, weigh, window)], queue))
    before_it = W.partitionBy("unit").orderBy("source", "part")
    offsets = cut(sums.join(units.select("source", "unit"), "source").select("source", "part", "unit", (F.sum("n").over(before_it) - F.col("n")).alias("earlier")), "offsets")

    def run(batches):
        phases, queue = [Phase(**p) for p in plan.value[0]], plan.value[1]
        by = {n: [p for p in phases if n in p.weights] for n in {q for q, _ in queue.values()}}
        for batch in batches:
            rows = []
            columns = (batch.column(c).to_pylist() for c in ("doc_id", "unit", "n", "before", "earlier", "ids"))
            for doc, unit, n, before, earlier, ids in zip(*columns, strict=True):
                width = len(ids) // n
                name, at = queue[unit]
                for begin, place, length in placed(by[name], name, at + before + earlier, n, window):
                    while length:
                        step = min(length, sequence - place % sequence)
                        own_ids = ids[begin * width:(begin + step) * width]
                        rows.append((doc, begin, step, own_ids, n, place // sequence, place % sequence, *((checksum(own_ids, step),) if checksums else ())))
                        begin, place, length = begin + step, place + step, length - step
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64())[:len(names)]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(names), kinds, strict=True)], names=names)

    names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset", *["ids_crc32"] * checksums]
    return tokens.join(offsets, ["source", "part"]).mapInArrow(tidied(run), PIECE + ", ids_crc32 bigint" * checksums)


def checksum(ids: bytes, n: int) -> int:
    """CRC-32 of `n` ids as four-byte numbers."""
    return zlib.crc32(np.frombuffer(ids, dtype="<u2" if len(ids) == 2 * n else "<u4").astype("<u4").tobytes())


def with_checksums(pieces: DataFrame, keep: bool = False) -> DataFrame:
    """Pieces with `ids_crc32`, the checksum of their ids as four-byte numbers, in place of the ids or, with `keep`, beside them."""
    fields = [f for f in pieces.schema.fields if keep or f.name != "ids"]

    def run(batches):
        for batch in batches:
            wide = [checksum(ids, n) for ids, n in zip(batch.column("ids").to_pylist(), batch.column("length").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(f.name) for f in fields), pa.array(wide, pa.int64())], names=[*(f.name for f in fields), "ids_crc32"])
    return pieces.mapInArrow(tidied(run), T.StructType([*fields, T.StructField("ids_crc32", T.LongType())]))


def report(docs: DataFrame, path: str, fold: bool = False) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece."""
    return with_checksums(pack(own(docs, "doc_id", "text", "source"), path, fold=fold))
