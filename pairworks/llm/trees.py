"""Removal of passages an earlier document has, by suffix trees over words that are built in prefix-partitioned groups.

A window is `WINDOW` words of one document in a row.  A word goes when a window that covers it also starts in a document with
a smaller id.  The suffixes are those of all positions where a window starts; the tree over them is never held in one place:

* *partition*: each chunk of text counts its prefixes of one, two and four words.  A prefix with more suffixes than half a
  group holds is heavy and is told apart by the next longer one, up to eight words.  So every suffix has a prefix of variable
  length; the prefixes are dealt to groups of `GROUP_BYTES` of text, which have a task's memory.
* *first range*: of each suffix a group gets its first eight words, and answers which of these some other document may share.
  All others are leaves above the depth that counts, and are not asked about again.
* *second range*: for the rest the group gets the remaining words and the least document of the chunk.  Suffixes in order are
  the leaves of the group's subtree; where neighbours are equal down to `WINDOW` words they hang below one deep internal node, a
  repeat.  The least document below a node decides for all its leaves.

A range of words is compared by name: the first eight words by as many bits as tell all suffixes apart and some more, the whole
window by 64 further bits, so that two windows meet by chance once in 2^90 or more.  Chunks send a window once however often
they have it; a passage that all documents share is one number for each chunk.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Tokens, bucketed, cut, from_gaps, from_planes, gaps, mixed, own, planes, text_or_empty, texts_of, tidied

WINDOW = 13
RANGE = 8
DEPTHS = (1, 2, 4)
SPACES = b" \t\n\v\f\r"
CHUNK_BYTES = 8 << 20
GROUP_BYTES = 32 << 20
SPARE_BITS = 12
LAST = np.iinfo(np.int64).max
K = [np.uint64(k) for k in (0xD6E8FEB86659FD93, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]

CHUNKS = "chunk bigint, ids array<bigint>, sizes array<bigint>, blob binary, suffixes bigint, heavy binary"
FIRST = "place int, chunk bigint, names binary, several binary"
SECOND = "place int, chunk bigint, names binary, rest binary, docs binary"
ANSWER = "place int, chunk bigint, flags binary"
RESULT = "doc_id bigint, n_words bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"


def twice(h: np.ndarray, step: int) -> np.ndarray:
    """Names of twice as many words, from names of `step` words."""
    return mixed(h[:-step] * K[0] + h[step:] * K[1]) if len(h) > step else h[:0]


class Suffixes:
    """The suffixes of a chunk that start a window: their documents and the names of their first words."""

    def __init__(self, blob: bytes, sizes: np.ndarray, ids: list):
        data = np.frombuffer(blob, dtype=np.uint8)
        self.ends = np.cumsum(sizes + 1)
        self.starts, self.stops, h = Tokens(SPACES).of(data)
        self.bounds = np.searchsorted(self.starts, np.concatenate([[0], self.ends]))
        self.doc = np.repeat(np.arange(len(sizes), dtype=np.int32), np.diff(self.bounds))
        n = max(len(h) - WINDOW + 1, 0)
        self.at = np.flatnonzero(self.doc[:n] == self.doc[WINDOW - 1:])
        self.by_depth, step = {1: h}, 1
        while step < RANGE:
            self.by_depth[2 * step] = twice(self.by_depth[step], step)
            step *= 2
        four = self.by_depth[4]
        five = mixed(four[:-1] * K[2] + h[4:len(four) + 3]) if len(four) > 1 else four[:0]
        eight = self.by_depth[RANGE]
        m = min(len(five) - RANGE, len(eight))
        self.whole = mixed(eight[:m] * K[3] + five[RANGE:RANGE + m] * K[0]) if m > 0 else five[:0]
        # a document without an id comes after all others
        self.id = np.array([LAST if i is None else i for i in ids], dtype=np.int64)

    def prefix(self, depth: int) -> np.ndarray:
        return self.by_depth[depth][self.at]


def heavy_here(s: Suffixes, groups: int) -> bytes:
    """The chunk's prefixes with at least a share of a group, as depth and name and how many suffixes they have."""
    least = max(16, len(s.at) // (4 * groups))
    out = []
    for d in DEPTHS:
        values, counts = np.unique(s.prefix(d), return_counts=True)
        big = counts >= least
        out.append(np.stack([np.full(int(big.sum()), d, np.uint64), values[big], counts[big].astype(np.uint64)], axis=1))
    return np.concatenate(out).tobytes()


def _heavy_rows(batches):
    for batch in batches:
        for x in batch.column("heavy").to_pylist():
            a = np.frombuffer(x, dtype=np.uint64).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([pa.array(a[:, 0].astype(np.int32)), pa.array(a[:, 1].view(np.int64)), pa.array(a[:, 2].astype(np.int64))],
                                             names=["depth", "name", "n"])


def places(s: Suffixes, heavy: dict[int, np.ndarray], groups: int) -> np.ndarray:
    """The group of each suffix: that of its shortest prefix that is not heavy."""
    key = s.prefix(1).copy()
    longer = {1: 2, 2: 4, 4: RANGE}
    open_ = np.arange(len(key))
    for d in DEPTHS:
        open_ = open_[np.isin(key[open_], heavy[d])]
        if not len(open_):
            break
        key[open_] = s.by_depth[longer[d]][s.at[open_]]
    return ((mixed(key * K[2]) >> np.uint64(32)) * np.uint64(groups) >> np.uint64(32)).astype(np.int64)


def entries(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the suffixes by key, and where in that order something new begins."""
    order = np.argsort(key)
    ranked = key[order]
    return order, np.flatnonzero(np.append(True, ranked[1:] != ranked[:-1])) if len(key) else order


def told_apart(active: np.ndarray, key: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in the order of their keys, now also by window where those of one key differ in it, and where something new begins.

    Most that share the first range share the window, and need no second sort.
    """
    if not len(active):
        return active, active
    fresh = np.append(True, key[1:] != key[:-1])
    run, firsts = np.cumsum(fresh) - 1, np.flatnonzero(fresh)
    unlike = np.zeros(len(firsts), dtype=bool)
    unlike[run[whole != whole[firsts][run]]] = True
    slots = np.flatnonzero(unlike[run])
    moved = slots[np.lexsort((whole[slots], run[slots]))]
    active[slots], whole[slots] = active[moved], whole[moved]
    fresh[1:] |= whole[1:] != whole[:-1]
    return active, np.flatnonzero(fresh)


def by_place(place: np.ndarray):
    """(group, first, end) of the runs of a sorted array of groups."""
    edges = np.flatnonzero(np.diff(place, prepend=-1))
    return zip(place[edges].tolist(), edges.tolist(), np.append(edges, len(place))[1:].tolist(), strict=True)


def batch_of(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [{"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary()}[x.split()[1]] for x in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * len(kinds), kinds, strict=True)], names=names)


def bits_of(flags: np.ndarray) -> bytes:
    return np.packbits(flags).tobytes()


def flags_of(answers: list[dict], place: np.ndarray) -> np.ndarray:
    """The answers of all groups in the order in which the entries, sorted by group, were sent."""
    flags = np.zeros(len(place), dtype=bool)
    said = {a["place"]: a["flags"] for a in answers}
    for g, a, z in by_place(place):
        if g in said:
            flags[a:z] = np.unpackbits(np.frombuffer(said[g], dtype=np.uint8), count=z - a)
    return flags


def shared(table: pa.Table) -> pa.Table:
    """First range: which names of a group come from more than one chunk, or from several documents of a chunk."""
    arrays = [from_gaps(x) for x in table.column("names").to_pylist()]
    several = [np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=len(a)) for x, a in zip(table.column("several").to_pylist(), arrays, strict=True)]
    names = np.concatenate(arrays)
    order = np.argsort(names)
    ranked = names[order]
    same = ranked[1:] == ranked[:-1]
    mark = np.concatenate(several).astype(bool)
    mark[order[1:][same]] = True
    mark[order[:-1][same]] = True
    # a name with several documents in one chunk is marked there alone unless others have it, which the neighbours show
    return answered(table, mark, [len(a) for a in arrays])


def earlier(table: pa.Table) -> pa.Table:
    """Second range: the leaves of a group's subtree in order; which of them hang below a deep node with an earlier document."""
    arrays = [from_gaps(x) for x in table.column("names").to_pylist()]
    names = np.concatenate(arrays)
    rest = np.concatenate([from_planes(x, np.uint64) for x in table.column("rest").to_pylist()])
    docs = np.concatenate([from_planes(x, np.int64) for x in table.column("docs").to_pylist()])
    order = np.argsort(names)
    order, firsts = told_apart(order, names[order], rest[order])
    least = np.minimum.reduceat(docs[order], firsts)
    mark = np.zeros(len(names), dtype=bool)
    mark[order] = np.repeat(least, np.diff(firsts, append=len(order))) < docs[order]
    return answered(table, mark, [len(a) for a in arrays])


def answered(table: pa.Table, mark: np.ndarray, sizes: list[int]) -> pa.Table:
    ends = np.cumsum(sizes)
    flags = [bits_of(mark[e - n:e]) for e, n in zip(ends, sizes, strict=True)]
    return pa.table([table.column("place"), table.column("chunk"), pa.array(flags, pa.binary())], names=["place", "chunk", "flags"])


def gathered(sent: DataFrame, answer) -> DataFrame:
    """The answers of all groups for each chunk; written, for they are read more than once."""
    answers = cut(sent.groupBy("place").applyInArrow(answer, ANSWER), "answers")
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("place", "flags")).alias("answers"))


def find_repeats(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_words, the spans of removed words (numbers of words, end exclusive), and the kept
    words with one space between them.

    Null texts have no words; a text of fewer than `WINDOW` words keeps all.  Rows that share a `doc_id` are one document's: they
    take nothing from each other.  A document without an id comes after all that have one, and takes nothing from others without.
    An empty table gives an empty result.  Other columns of `docs` are not read.
    """
    spark = docs.sparkSession
    volume = docs.agg(F.sum(F.octet_length(text_or_empty(docs["text"])))).first()[0] or 0
    groups = max(int(spark.conf.get("spark.sql.shuffle.partitions")), volume // GROUP_BYTES, 1)

    def pack(batches):
        from pyspark import TaskContext

        base, count, ids, texts, held = TaskContext.get().partitionId() << 33, 0, [], [], 0

        def chunk():
            blob = b"".join(t + b"\n" for t in texts)
            sizes = np.array([len(t) for t in texts], dtype=np.int64)
            s = Suffixes(blob, sizes, ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([base + count], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes.tolist()], pa.list_(pa.int64())),
                 pa.array([blob], pa.binary()), pa.array([len(s.at)], pa.int64()), pa.array([heavy_here(s, groups)], pa.binary())],
                names=["chunk", "ids", "sizes", "blob", "suffixes", "heavy"])

        for batch in batches:
            for i, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
                if texts and held + len(text) > CHUNK_BYTES:
                    yield chunk()
                    count, ids, texts, held = count + 1, [], [], 0
                ids.append(i)
                texts.append(text)
                held += len(text) + 1
        if texts:
            yield chunk()

    rows = own(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    chunks = bucketed(rows.mapInArrow(tidied(pack), CHUNKS), "chunk", min(100_000, groups), "trees")
    total = chunks.agg(F.sum("suffixes")).first()[0] or 0
    # a suffix's key is its group, then as many bits of its first range
    bits = max(8, min(64 - groups.bit_length(), math.ceil(math.log2(total + 1)) + SPARE_BITS - int(math.log2(groups))))
    drop, shift = np.uint64(64 - bits), np.uint64(bits)
    # at most two prefixes of each length for a group
    found = (chunks.select("heavy").mapInArrow(_heavy_rows, "depth int, name bigint, n bigint").groupBy("depth", "name")
             .agg(F.sum("n").alias("n")).where(F.col("n") * 2 * groups > total).collect())
    heavy = {d: np.sort(np.array([r.name for r in found if r.depth == d], dtype=np.int64).view(np.uint64)) for d in DEPTHS}

    def opened(batch):
        for k in range(batch.num_rows):
            row = {n: batch.column(n)[k].as_py() for n in batch.schema.names}
            s = Suffixes(row["blob"], np.array(row["sizes"], dtype=np.int64), row["ids"])
            key = places(s, heavy, groups).view(np.uint64) << shift | s.prefix(RANGE) >> drop
            yield row, s, key, *entries(key)

    def parts(key):
        return (key >> shift).astype(np.int64), key & (np.uint64(1) << shift) - np.uint64(1)

    def first(batches):
        for batch in batches:
            for row, s, key, order, new in opened(batch):
                d = s.id[s.doc[s.at]][order]
                several = np.minimum.reduceat(d, new) < np.maximum.reduceat(d, new) if len(new) else np.zeros(0, dtype=bool)
                p, n = parts(key[order[new]])
                yield batch_of([(g, row["chunk"], gaps(n[a:z]), bits_of(several[a:z])) for g, a, z in by_place(p)], FIRST)

    def left(row, s, key, order, new):
        """The suffixes that share their first range, ordered, with the least document of each different one."""
        flags = flags_of(row["answers"] or [], parts(key[order[new]])[0])
        active = order[np.repeat(flags, np.diff(new, append=len(order)))]
        active, new = told_apart(active, key[active], s.whole[s.at[active]])
        d = s.id[s.doc[s.at[active]]]
        least = np.minimum.reduceat(d, new) if len(new) else d[:0]
        return active, new, least, *parts(key[active[new]]), d

    def second(batches):
        for batch in batches:
            for row, s, key, order, new in opened(batch):
                active, new, least, p, n, _ = left(row, s, key, order, new)
                w = s.whole[s.at[active[new]]]
                yield batch_of([(g, row["chunk"], gaps(n[a:z]), planes(w[a:z]), planes(least[a:z])) for g, a, z in by_place(p)], SECOND)

    def finish(batches):
        for batch in batches:
            for row, s, key, order, new in opened(batch):
                active, new, least, p, _, d = left(row, s, key, order, new)
                count = np.diff(new, append=len(active))
                gone = np.repeat(flags_of(row["more"] or [], p), count) | (d > np.repeat(least, count))
                at = s.at[active[gone]]
                edge = np.zeros(len(s.starts) + 1, dtype=np.int32)
                edge[at] += 1
                edge[at + WINDOW] -= 1
                yield from results(row, s, np.cumsum(edge[:-1]) > 0)

    answers = gathered(chunks.drop("heavy").mapInArrow(tidied(first), FIRST), shared)
    asked = chunks.drop("heavy").join(answers.hint("shuffle_hash"), "chunk", "left")
    more = gathered(asked.mapInArrow(tidied(second), SECOND), earlier).withColumnRenamed("answers", "more")
    return asked.join(more.hint("shuffle_hash"), "chunk", "left").mapInArrow(tidied(finish), RESULT)


def results(row: dict, s: Suffixes, gone: np.ndarray, most: int = 256):
    """The documents of a chunk with what is left of them, some at a time."""
    kinds, out = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary()), []
    spans, (kept, ends) = spans_of(gone, s.bounds), kept_words(row["blob"], s.starts, s.stops, gone, s.bounds)
    first = np.searchsorted(spans[:, 0], s.bounds)

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds, strict=True)], names=["doc_id", "n_words", "spans", "kept"])

    for i, (a, z) in enumerate(zip(s.bounds[:-1].tolist(), s.bounds[1:].tolist(), strict=True)):
        own_spans = [{"start": x, "end": y} for x, y in (spans[first[i]:first[i + 1]] - a).tolist()]
        out.append((row["ids"][i], z - a, own_spans, kept[ends[i]:max(ends[i], ends[i + 1] - 1)]))
        if len(out) == most:
            yield batch()
            out.clear()
    if out:
        yield batch()


def spans_of(gone: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """First and end of all runs of words that go; where a document ends, its run does."""
    padded = np.zeros(len(gone) + 2, dtype=bool)
    padded[1:-1] = gone
    inner = np.unique(bounds)
    meet = inner[padded[inner] & padded[inner + 1]]
    return np.sort(np.concatenate([np.flatnonzero(padded[1:] != padded[:-1]), meet, meet])).reshape(-1, 2)


def kept_words(blob: bytes, starts: np.ndarray, stops: np.ndarray, gone: np.ndarray, bounds: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words that stay, a space after each, and where each document's begin there.  The byte after a word is never a word's."""
    data = np.frombuffer(blob, dtype=np.uint8).copy()
    data[stops] = 32
    step = np.zeros(len(data) + 1, dtype=np.int8)
    step[starts[~gone]] += 1
    step[stops[~gone] + 1] -= 1
    ends = np.concatenate([[0], np.cumsum(np.where(gone, 0, stops + 1 - starts))])[bounds]
    return data[np.cumsum(step[:-1], dtype=np.int8).view(bool)].tobytes(), ends


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_removed and the digest of the kept words; `find_repeats` says what nulls and repeated rows give."""
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda acc, s: acc + s["end"] - s["start"])
    return find_repeats(docs).select("doc_id", "n_words", removed.alias("n_removed"), F.sha2("kept", 256).alias("kept_sha256"))
