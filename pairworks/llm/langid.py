"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts are taken by tasks and summed feature by feature; the matrix of log probabilities (FEATURES x languages, four bytes
each) is broadcast, its size following from the number of languages alone.  A batch is scored by looking the rows of its
n-grams up and adding them for each text, whole texts a piece at a time.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, slices, tidied

FEATURES = 1 << 16
ORDERS = (1, 2, 3)
MOST_ROWS = 8000
LETTER_LIMIT = 0x110000
SLICE = 1 << 19
UNKNOWN = "und"


@dataclass
class Model:
    languages: list[str]
    prior: np.ndarray
    weights: np.ndarray


def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(LETTER_LIMIT)), dtype=bool, count=LETTER_LIMIT)


def features(texts: list[str], is_letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed n-grams of lowered texts, the text each belongs to, and the number of letters of each text.

    Runs of anything but letters count as one blank; a blank is put before and after each text.
    """
    points = [np.frombuffer(f" {t.lower()} ".encode("utf-32-le", "surrogatepass"), dtype=np.uint32) for t in texts]
    of = np.repeat(np.arange(len(points)), [len(p) for p in points])
    data = np.concatenate(points) if points else np.zeros(0, dtype=np.uint32)
    known = is_letter[data]
    kept = known.copy()
    kept[1:] |= known[:-1] | (of[1:] != of[:-1])
    kept[:1] = True
    number = np.bincount(of, weights=known, minlength=len(points)).astype(np.int64)
    data, of = np.where(known, data, 32)[kept].astype(np.uint64), of[kept]
    found, owner = [], []
    for n in ORDERS:
        if len(data) < n:
            continue
        h = np.full(len(data) - n + 1, n, dtype=np.uint64)
        for i in range(n):
            h = (h + data[i:len(data) - n + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        whole = of[n - 1:] == of[:len(of) - n + 1]
        found.append((h[whole] % np.uint64(FEATURES)).astype(np.int64))
        owner.append(of[n - 1:][whole])
    if not found:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), number
    return np.concatenate(found), np.concatenate(owner), number


def strings(batch: pa.RecordBatch, column: str) -> list[str]:
    return ["" if t is None else t for t in batch.column(column).to_pylist()]


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", most_rows: int = MOST_ROWS, smoothing: float = 0.1) -> Model:
    """Learn from the rows whose language is not null, about `most_rows` of each language, taken by a hash of their text.

    The bound keeps learning cheap on any corpus; each taken text is read whole.  Null texts and texts without letters teach
    nothing.  Without any row there is no language, and every text is unknown.
    """
    rows = docs.select(F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where("lang is not null and text is not null")
    sizes = dict(sorted((r[0], r[1]) for r in rows.groupBy("lang").count().collect()))
    if not sizes:
        return Model([], np.zeros(0), np.zeros((FEATURES, 0), dtype=np.float32))
    order = {name: i for i, name in enumerate(sizes)}
    share = F.create_map(*(F.lit(x) for name, n in sizes.items() for x in (name, int(min(1.0, most_rows / n) * (1 << 30)))))
    taken = rows.where(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < share[F.col("lang")])

    def count(batches):
        is_letter, sums = letters(), {}
        for batch in batches:
            for part in slices(batch, "text", SLICE):
                names = np.array([order[x] for x in part.column("lang").to_pylist()])
                grams, owner, _ = features(strings(part, "text"), is_letter)
                for k in np.unique(names):
                    sums[k] = sums.get(k, 0) + np.bincount(grams[names[owner] == k], minlength=FEATURES)
        for k, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([int(k)], pa.int32()), pa.array([v.astype(np.int64).tobytes()], pa.binary())], names=["k", "counts"])

    def add(batches):
        sums = {}
        for batch in batches:
            for k, v in zip(batch.column("k").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                sums[k] = sums.get(k, 0) + np.frombuffer(v, dtype=np.int64)
        for k, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([v.tobytes()], pa.binary())], names=["k", "counts"])

    schema = "k int, counts binary"
    parts = taken.mapInArrow(tidied(count), schema).repartition(len(order), "k").mapInArrow(tidied(add), schema)
    counts = np.zeros((FEATURES, len(order)))
    for row in parts.toLocalIterator():
        counts[:, row.k] += np.frombuffer(row.counts, dtype=np.int64)
    weights = np.log(counts + smoothing) - np.log(counts.sum(axis=0) + smoothing * FEATURES)
    prior = np.log(np.array(list(sizes.values())) / sum(sizes.values()))
    return Model(list(order), prior, weights.astype(np.float32))


def identify(docs: DataFrame, model: Model, text: str = "text", into: str = "language") -> DataFrame:
    """`docs` with one more column, a struct of `lang` and `score`, the posterior probability of that language.

    A null text, one without a letter, and any text under a model without languages is `und` with score 0.  Ties go to the
    first language in alphabetical order.  All columns and rows stay; if `into` is taken, underscores are added to it.
    """
    into = free_name(docs, into)
    sent = docs.sparkSession.sparkContext.broadcast(vars(model))

    def run(batches):
        is_letter, m = letters(), Model(**sent.value)
        kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])
        for batch in batches:
            for part in slices(batch, text, SLICE):
                grams, owner, number = features(strings(part, text), is_letter)
                total = np.tile(m.prior, (part.num_rows, 1))
                for k in range(len(m.languages)):
                    total[:, k] += np.bincount(owner, weights=m.weights[grams, k], minlength=part.num_rows)
                if m.languages:
                    best = total.argmax(axis=1)
                    odds = np.exp(total - total.max(axis=1, keepdims=True))
                    score = odds.max(axis=1) / odds.sum(axis=1)
                rows = [{"lang": m.languages[best[i]], "score": float(score[i])} if m.languages and number[i] else {"lang": UNKNOWN, "score": 0.0}
                        for i in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(rows, kind)], names=[*part.schema.names, into])

    kind = T.StructType.fromDDL("lang string, score double")
    return docs.mapInArrow(tidied(run), T.StructType([*docs.schema.fields, T.StructField(into, kind)]))


def held_out(doc_id: Column) -> Column:
    """A fifth of the documents, by a checksum of the id; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


def learn(docs: DataFrame, **options) -> Model:
    return fit(docs.where(~held_out(F.col("doc_id"))), **options)


def known(docs: DataFrame) -> DataFrame:
    """The rows whose text is in some language, same columns.

    Where there is nothing to learn from, as without labels, no text with a letter is rejected.
    """
    name, model = free_name(docs, "language"), learn(docs)
    if not model.languages:
        return docs.where(F.regexp_like("text", F.lit(r"\p{L}")))
    return identify(docs, model, into=name).where(F.col(name)["lang"] != UNKNOWN).select(*(F.col(f"`{c}`") for c in docs.columns))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    model = learn(docs)
    found = identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))
