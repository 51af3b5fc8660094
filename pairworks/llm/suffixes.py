"""Removal of long verbatim repeats by difference-cover suffix sorting.

Texts are taken as bytes.  A string of `LENGTH` bytes that starts at two places of the corpus makes all bytes it covers
repeated.  The steps are those of difference-cover sorting, stopped where prefixes are long enough to decide:

* *sample*: positions whose offset is in a difference cover modulo `PERIOD`.  Any two positions have a common distance, less
  than the period, at which both are sampled, so two equal strings hold two equal samples.
* *triples, recursed on names*: eight bytes are a name, three names in a row make the triple of the next level, whose name
  is a 64-bit fingerprint; 24, 72 and 216 bytes.  A fingerprint needs no exchange to be the same everywhere, a rank would.
* *sort*: names are range-partitioned and sorted, equal neighbours are marked.
* *merge*: the remaining positions that lie within the period before a marked sample are named over all `LENGTH` bytes,
  sorted the same way, and adjacent prefixes are compared: equal neighbours are repeated strings.

Between tasks only sorted arrays of names travel, as their differences, each name once for a chunk of text, so a passage that a
third of all documents share costs a number per chunk.  A sample's name has as many bits as tell all samples apart and some more,
in whole bytes: samples that meet by chance only leave more to the merge, whose names have 64.  Answers are bitmaps in the order
in which the names were sent.  The chunks lie in a bucketed table, so their text is never shuffled.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, cut, from_gaps, gaps, own, text_or_empty, texts_of, tidied

LENGTH = 400
# A perfect difference set modulo 183; its differences give every other remainder once.
PERIOD = 183
COVER = np.array([0, 1, 3, 16, 23, 28, 42, 76, 82, 86, 119, 137, 154, 175])
SAMPLE = 216
CHUNK_BYTES = 4 << 20
BLOCK = 1 << 17
SPARE_BITS = 12
K = [np.uint64(k) for k in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]

CHUNKS = "chunk bigint, ids array<bigint>, sizes array<bigint>, blob binary"
SENT = "bucket int, chunk bigint, names binary, twice binary"
ANSWER = "bucket int, chunk bigint, flags binary"
RESULT = "doc_id bigint, n_bytes bigint, spans array<struct<start:bigint,end:bigint>>, kept binary"


def triples(names: np.ndarray, step: int) -> np.ndarray:
    """Names of triples of names that lie `step` apart."""
    n = len(names) - 2 * step
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = names[:n] * K[0]
    h += names[step:n + step] * K[1]
    h += names[2 * step:n + 2 * step] * K[2]
    h ^= h >> np.uint64(32)
    h *= K[3]
    h ^= h >> np.uint64(29)
    return h


def named(data: np.ndarray, level: int):
    """Blocks of names: (first position, names of 72 bytes, names of 216 bytes if `level` is 3)."""
    for at in range(0, max(len(data) - 7, 0), BLOCK):
        part = data[at:at + BLOCK + LENGTH]
        if len(part) < 8:
            return
        h = np.ndarray(len(part) - 7, dtype="<u8", buffer=part, strides=(1,)) * K[4]
        h ^= h >> np.uint64(29)
        h *= K[3]
        h ^= h >> np.uint64(32)
        n72 = triples(triples(h, 8), 24)
        yield at, n72, triples(n72, 72)


def name_at(data: np.ndarray, at: np.ndarray, whole: bool) -> np.ndarray:
    """Names of the samples, or of the `whole` strings, that start at sorted positions."""
    out = np.zeros(len(at), dtype=np.uint64)
    edges = np.searchsorted(at, np.arange(0, len(data) + BLOCK, BLOCK))
    if not len(at):
        return out
    for k, (begin, n72, n216) in enumerate(named(data, 3)):
        a, z = edges[k], edges[k + 1]
        p = at[a:z] - begin
        if not len(p):
            continue
        h = n216[p]
        if whole:
            h = h * K[0] + n72[p + SAMPLE] * K[1] + n72[p + SAMPLE + 72] * K[2] + n72[p + LENGTH - 72] * K[4]
            h = (h ^ (h >> np.uint64(32))) * K[3]
            h = h ^ (h >> np.uint64(29))
        out[a:z] = h
    return out


def samples(sizes: np.ndarray) -> np.ndarray:
    """Positions in the chunk that the difference cover takes, each document counted from its own start."""
    longest = int(sizes.max(initial=0))
    every = (np.arange(0, longest + PERIOD, PERIOD)[:, None] + COVER).ravel()
    starts = np.cumsum(sizes) - sizes
    counts = np.searchsorted(every, sizes - SAMPLE, side="right")
    return np.concatenate([np.zeros(0, dtype=np.int64), *(every[:c] + s for c, s in zip(counts, starts, strict=True) if c)])


def near(sizes: np.ndarray, marked: np.ndarray) -> np.ndarray:
    """Positions that start a whole string and lie less than the period before a marked sample, or on it."""
    n = int(sizes.sum())
    ends = np.cumsum(sizes)
    starts = ends - sizes
    doc = np.searchsorted(ends, marked, side="right")
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, np.maximum(marked - PERIOD + 1, starts[doc]), 1)
    np.add.at(edge, marked + 1, -1)
    at = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    return at[at + LENGTH <= ends[np.searchsorted(ends, at, side="right")]]


def shortened(volume: int) -> np.uint64:
    """The bits of a sample's name that are sent, in a text of so many bytes."""
    taken = volume * len(COVER) // PERIOD
    return np.uint64((1 << 64) - (1 << 64 - min(64, -(-(taken.bit_length() + SPARE_BITS) // 8) * 8)))


def limits(buckets: int) -> np.ndarray:
    """The first name of each bucket."""
    return np.array([-(-b * (1 << 64) // buckets) for b in range(buckets)], dtype=np.uint64)


def send(chunk: int, names: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each bucket: the chunk's names in order, each once, and which of them it holds more than once."""
    values, counts = np.unique(names, return_counts=True)
    edges = np.append(np.searchsorted(values, limits(buckets)), len(values))
    full = np.flatnonzero(np.diff(edges))
    rows = [(int(b), chunk, gaps(values[edges[b]:edges[b + 1]]), np.packbits(counts[edges[b]:edges[b + 1]] > 1).tobytes()) for b in full]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
        names=["bucket", "chunk", "names", "twice"])


def receive(names: np.ndarray, buckets: int, answers: list[dict]) -> np.ndarray:
    """For each of the names that were sent, in their own order: whether it occurs more than once anywhere."""
    values, inverse = np.unique(names, return_inverse=True)
    edges = np.append(np.searchsorted(values, limits(buckets)), len(values))
    flags = np.zeros(len(values), dtype=bool)
    for a in answers:
        lo, hi = edges[a["bucket"]], edges[a["bucket"] + 1]
        flags[lo:hi] = np.unpackbits(np.frombuffer(a["flags"], dtype=np.uint8), count=hi - lo)
    return flags[inverse]


def compare(table: pa.Table) -> pa.Table:
    """Sort a bucket's names and mark equal neighbours."""
    arrays = [from_gaps(x) for x in table.column("names").to_pylist()]
    twice = np.concatenate([np.unpackbits(np.frombuffer(x, dtype=np.uint8), count=len(a)) for x, a in zip(table.column("twice").to_pylist(), arrays, strict=True)])
    names = np.concatenate(arrays)
    order = np.argsort(names)
    ranked = names[order]
    same = ranked[1:] == ranked[:-1]
    mark = twice.astype(bool)
    mark[order[1:][same]] = True
    mark[order[:-1][same]] = True
    ends = np.cumsum([len(a) for a in arrays])
    flags = [np.packbits(mark[e - len(a):e]).tobytes() for e, a in zip(ends, arrays, strict=True)]
    return pa.table([table.column("bucket"), table.column("chunk"), pa.array(flags, pa.binary())], names=["bucket", "chunk", "flags"])


def repeated(sent: DataFrame) -> DataFrame:
    """The answers of all buckets, gathered for each chunk; written, as they are read more than once."""
    answers = cut(sent.groupBy("bucket").applyInArrow(compare, ANSWER), "answers")
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "flags")).alias("answers"))


def _pack(batches):
    """Rows to chunks of about CHUNK_BYTES; a longer text is a chunk of its own."""
    from pyspark import TaskContext

    base, count, ids, texts, held = TaskContext.get().partitionId() << 33, 0, [], [], 0

    def chunk():
        return pa.RecordBatch.from_arrays(
            [pa.array([base + count], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(t) for t in texts]], pa.list_(pa.int64())),
             pa.array([b"".join(texts)], pa.binary())], names=["chunk", "ids", "sizes", "blob"])

    for batch in batches:
        for i, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch), strict=True):
            if texts and held + len(text) > CHUNK_BYTES:
                yield chunk()
                count, ids, texts, held = count + 1, [], [], 0
            ids.append(i)
            texts.append(text)
            held += len(text)
    if texts:
        yield chunk()


def _rows(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            row = {n: batch.column(n)[k].as_py() for n in batch.schema.names}
            yield row, np.frombuffer(row["blob"], dtype=np.uint8), np.array(row["sizes"], dtype=np.int64)


def find_repeats(docs: DataFrame) -> DataFrame:
    """One row for each row of `docs`: doc_id, n_bytes, the spans of repeated bytes, and the kept bytes.

    Null texts are empty.  Strings never cross documents; a text shorter than `LENGTH` bytes has no repeats.  A row that is
    there twice repeats all of its strings, so both lose them.  An empty table gives an empty result.  Other columns of
    `docs` are not read.
    """
    spark = docs.sparkSession
    volume = docs.agg(F.sum(F.octet_length(text_or_empty(docs["text"])))).first()[0] or 0
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), volume >> 25, 1)
    first, second, bits = 2 * width, 2 * width, shortened(volume)
    packed = own(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(tidied(_pack), CHUNKS)
    stored = min(100_000, max(width, 1))
    chunks = bucketed(packed, "chunk", stored, "chunks")

    def sample(batches):
        for row, data, sizes in _rows(batches):
            yield send(row["chunk"], name_at(data, samples(sizes), False) & bits, first)

    def left(row, data, sizes):
        at = samples(sizes)
        return near(sizes, at[receive(name_at(data, at, False) & bits, first, row["answers"] or [])])

    def merge(batches):
        for row, data, sizes in _rows(batches):
            yield send(row["chunk"], name_at(data, left(row, data, sizes), True), second)

    def finish(batches):
        for row, data, sizes in _rows(batches):
            at = left(row, data, sizes)
            at = at[receive(name_at(data, at, True), second, row["more"] or [])]
            edge = np.zeros(len(data) + 1, dtype=np.int32)
            edge[at] += 1
            edge[at + LENGTH] -= 1
            gone = np.cumsum(edge[:-1]) > 0
            out, begin = [], 0
            for i, size in zip(row["ids"], sizes.tolist(), strict=True):
                own_gone = gone[begin:begin + size]
                step = np.diff(own_gone.astype(np.int8), prepend=0, append=0)
                spans = [{"start": int(a), "end": int(z)} for a, z in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True)]
                out.append((i, size, spans, data[begin:begin + size][~own_gone].tobytes() if spans else data[begin:begin + size].tobytes()))
                begin += size
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds, strict=True)], names=["doc_id", "n_bytes", "spans", "kept"])

    answers = repeated(chunks.mapInArrow(tidied(sample), SENT))
    asked = chunks.join(answers.hint("shuffle_hash"), "chunk", "left")
    more = repeated(asked.mapInArrow(tidied(merge), SENT)).withColumnRenamed("answers", "more")
    return asked.join(more.hint("shuffle_hash"), "chunk", "left").mapInArrow(tidied(finish), RESULT)


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the digest of what is kept."""
    return find_repeats(docs).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
