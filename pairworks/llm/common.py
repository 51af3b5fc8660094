"""What the operators of this subpackage share: cut tables, columnar batches, word fingerprints."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

RELEASED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
SEGMENT = 1 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
M1, M2, M3 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0xD6E8FEB86659FD93)


def cut(df: DataFrame, label: str = "llm", compression: str = "zstd") -> DataFrame:
    """Write the rows below the shared folder and read them back: computed once, kept when executors are lost."""
    path = scratch_path(df.sparkSession, label)
    with released(df.sparkSession):
        df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def released(spark: SparkSession):
    """Queries made and run within delete their shuffle files when they end; Spark else keeps them until the driver collects its garbage."""
    before = spark.conf.get(RELEASED, None)
    spark.conf.set(RELEASED, "true")
    try:
        yield
    finally:
        spark.conf.set(RELEASED, before) if before is not None else spark.conf.unset(RELEASED)


def bucketed(df: DataFrame, column: str, buckets: int, label: str) -> DataFrame:
    """`cut` with the rows dealt to buckets of `column`, so that a later join or group on it moves only the other side.

    Spark keeps buckets only for tables of a catalog; the entry is dropped as soon as the rows can be read, the files stay.
    """
    spark, name = df.sparkSession, f"{label}_{uuid.uuid4().hex}"
    try:
        (df.write.bucketBy(buckets, column).option("path", scratch_path(spark, label)).option("compression", "zstd").saveAsTable(name))
        return spark.table(name)
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def free_name(df: DataFrame, name: str) -> str:
    """A column name that `df` does not have yet, compared without case as Spark does."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def settled(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """`df` with further columns, each computed once for a row however it is used.

    Spark may put a column's expression in the place of its name, also within a lambda that runs for each element, or in a
    filter.  It does not look through a generator, here one that makes a row of a row.
    """
    return df.select("*", F.inline(F.array(F.struct(*(c.alias(n) for n, c in columns.items())))))


def own(df: DataFrame, *names: str) -> DataFrame:
    """Only the columns an operator reads, so that others cannot clash with those it makes."""
    return df.select(*(df[n] for n in names))


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def tidied(run):
    """A function over batches that gives its memory back when it ends: Python workers are used again by other stages, and what
    an allocator keeps for later would add up over them."""
    def wrapped(batches):
        try:
            yield from run(batches)
        finally:
            gc.collect()
            give_back()
    return wrapped


def tidied_group(run):
    """`tidied` for a function over the table of a group."""
    def wrapped(table):
        try:
            return run(table)
        finally:
            give_back()
    return wrapped


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def slices(batch: pa.RecordBatch, column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs of at most `most` bytes of `column`; one longer row is a run of its own."""
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > begin and held + size > most:
            yield batch.slice(begin, i - begin)
            begin, held = i, 0
        held += size
    if begin < batch.num_rows:
        yield batch.slice(begin)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a column; null is empty."""
    return [b"" if x is None else x for x in batch.column(column).cast(pa.binary()).to_pylist()]


def mixed(h: np.ndarray) -> np.ndarray:
    """Scatter 64-bit values one to one."""
    h = (h ^ (h >> np.uint64(30))) * M1
    h = (h ^ (h >> np.uint64(27))) * M2
    return h ^ (h >> np.uint64(31))


def joined(parts: list[np.ndarray]) -> np.ndarray:
    """One fingerprint for each tuple of fingerprints."""
    h = parts[0] * M3
    for p in parts[1:]:
        h = mixed(h + p) * M3
    return mixed(h)


class Words:
    """Finds the words of texts and gives each a 64-bit fingerprint, a segment of bytes at a time.

    `separators` are the bytes no word holds; line feed must be among them.  A fingerprint is a polynomial over the word's
    bytes, taken as a difference of running sums, then scattered.
    """

    def __init__(self, separators: bytes):
        self.inside = np.ones(256, dtype=bool)
        self.inside[list(separators)] = False
        self.powers = self.inverses = np.ones(1, dtype=np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            base = np.full(n, BASE, dtype=np.uint64)
            base[0] = 1
            self.powers = np.cumprod(base)
            base[1:] = BASE_INVERSE
            self.inverses = np.cumprod(base)

    def of(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Fingerprints of all words in order, and for each text the number of words before it (one entry more than texts)."""
        found, bounds = [np.zeros(0, dtype=np.uint64)], np.zeros(len(texts) + 1, dtype=np.int64)
        begin, held, count = 0, 0, 0
        for i, text in enumerate(texts):
            held += len(text) + 1
            if held >= SEGMENT or i == len(texts) - 1:
                count = self._run(texts[begin:i + 1], found, bounds[begin + 1:i + 2], count)
                begin, held = i + 1, 0
        return np.concatenate(found), bounds

    def _run(self, texts: list[bytes], found: list[np.ndarray], bounds: np.ndarray, count: int) -> int:
        blob = b"\n".join(texts) + b"\n"
        data = np.frombuffer(blob.translate(LOWER), dtype=np.uint8)
        ends = np.cumsum([len(t) + 1 for t in texts])
        marks, at, first = [], 0, count
        while at < len(data):
            stop = min(at + SEGMENT, len(data))
            while stop < len(data) and self.inside[data[stop - 1]]:
                stop = min(stop + 4096, len(data))
                gap = np.flatnonzero(~self.inside[data[max(at, stop - 4096):stop]])
                if len(gap):
                    stop = max(at, stop - 4096) + int(gap[-1]) + 1
            part = data[at:stop]
            edge = np.diff(self.inside[part].astype(np.int8), prepend=0, append=0)
            starts, stops = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            self._grow(len(part) + 1)
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * self.powers[:len(part)], out=sums[1:])
            h = (sums[stops] - sums[starts]) * self.inverses[starts]
            found.append(mixed(h + (stops - starts).astype(np.uint64) * M3))
            marks.append(starts + at)
            count += len(starts)
            at = stop
        bounds[:] = first + np.searchsorted(np.concatenate(marks), ends)
        return count


def planes(values: np.ndarray) -> bytes:
    """Numbers as bytes, first all lowest bytes and so on: the high bytes of small numbers become runs that compress away."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def from_planes(data: bytes, kind) -> np.ndarray:
    kind = np.dtype(kind)
    n = len(data) // kind.itemsize
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(kind.itemsize, n).T).view(kind).ravel()


def gaps(ranked: np.ndarray) -> bytes:
    """A sorted array of 64-bit numbers as its differences."""
    return planes(np.diff(ranked, prepend=np.uint64(0)))


def from_gaps(data: bytes) -> np.ndarray:
    return np.cumsum(from_planes(data, np.uint64), dtype=np.uint64)


class Tokens:
    """Where the words of a text lie and a 64-bit fingerprint of each, as `Words` makes them, for one array of bytes at a time.

    `separators` are the bytes no word holds.  Work memory follows SEGMENT and the longest word, not the text.
    """

    def __init__(self, separators: bytes, lower: bool = False):
        self.words = Words(separators)
        self.lower = np.frombuffer(LOWER, dtype=np.uint8) if lower else None

    def of(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First bytes, ends and fingerprints of all words in order."""
        w, inside = self.words, self.words.inside
        found, at = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))], 0
        while at < len(data):
            stop = min(at + SEGMENT, len(data))
            while stop < len(data) and inside[data[stop - 1]] and inside[data[stop]]:
                more = np.flatnonzero(~inside[data[stop:stop + SEGMENT]])
                stop = stop + int(more[0]) if len(more) else min(stop + SEGMENT, len(data))
            part = data[at:stop]
            word = np.zeros(len(part) + 2, dtype=bool)
            word[1:-1] = inside[part]
            edges = np.flatnonzero(word[1:] != word[:-1])
            starts, stops = edges[::2], edges[1::2]
            w._grow(len(part) + 1)
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            low = (part if self.lower is None else self.lower[part]).astype(np.uint64)
            low += np.uint64(1)
            low *= w.powers[:len(part)]
            np.cumsum(low, out=sums[1:])
            h = (sums[stops] - sums[starts]) * w.inverses[starts]
            found.append((starts + at, stops + at, mixed(h + (stops - starts).astype(np.uint64) * M3)))
            at = stop
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


class Names:
    """64-bit fingerprints of adjacent stretches of an array of bytes, as `Tokens` makes them of words."""

    def __init__(self):
        self.words = Words(b"")

    def of(self, data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
        w = self.words
        out, at = np.zeros(len(starts), dtype=np.uint64), 0
        while at < len(starts):
            # whole stretches of about SEGMENT bytes
            z = max(at + 1, int(np.searchsorted(stops, starts[at] + SEGMENT, side="right")))
            a, e = int(starts[at]), int(stops[z - 1])
            part = data[a:e]
            w._grow(len(part) + 1)
            sums = np.zeros(len(part) + 1, dtype=np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * w.powers[:len(part)], out=sums[1:])
            s, t = starts[at:z] - a, stops[at:z] - a
            out[at:z] = mixed((sums[t] - sums[s]) * w.inverses[s] + (t - s).astype(np.uint64) * M3)
            at = z
        return out
