"""Batches of prompts sent to a caller's completion function, and conversations of several rounds."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import say
from ..session import by_key, cut_lineage
from .pairs import parse_answer, parse_pairs
from .prompts import review_messages
from .usage import MICROS, cost_micros
from .windows import SPAN, running_sum

# Attempts per request and the first pause in seconds, which doubles.
ATTEMPTS, FIRST_PAUSE = 5, 1.0
MAX_ROUNDS = 6
# What is asked for after a reply that leaves pairs missing.
FOLLOW_SQL = "Generate {n} more question-SQL pairs about the tables."
FOLLOW_DOCS = "Generate {n} more question-answer pairs about the schema."

# replies to a log file, at most
LOGGED_TOGETHER = 50
LOG = "digest string, text string, in_tok bigint, out_tok bigint"
REPLY = "text string, error string, in_tok bigint, out_tok bigint"
# of a text without counts: characters to a token, and tokens to a pair asked for
CHARS_A_TOKEN, TOKENS_A_PAIR = 4, 100


def with_retry(call: Callable, attempts: int = ATTEMPTS, pause: float = FIRST_PAUSE) -> Callable:
    """The call, tried again after growing pauses; the last error is raised."""
    def tried(*args):
        for left in range(attempts - 1, -1, -1):
            try:
                return call(*args)
            except Exception:
                if not left:
                    raise
                time.sleep(pause * 2 ** (attempts - 1 - left))
    return tried


def log_replies(folder: str, rows: list[tuple]) -> None:
    """Add replies (digest, text, in_tok, out_tok) to a log as one file, which appears under its name once it is whole."""
    store, path = pafs.FileSystem.from_uri(folder)
    name = uuid.uuid4().hex
    kinds = [pa.string(), pa.string(), pa.int64(), pa.int64()]
    table = pa.table([pa.array(c, t) for c, t in zip(zip(*rows), kinds, strict=True)], names=["digest", "text", "in_tok", "out_tok"])
    with store.open_output_stream(f"{path}/_{name}") as out:
        pq.write_table(table, out)
    store.move(f"{path}/_{name}", f"{path}/{name}.parquet")


def read_log(spark: SparkSession, folder: str) -> DataFrame:
    """The replies of a log, one for each digest; a prompt that two attempts sent has the same reply in every later run."""
    store, path = pafs.FileSystem.from_uri(folder)
    store.create_dir(path)
    return spark.read.schema(LOG).parquet(folder).groupBy("digest").agg(F.min(F.struct("text", "in_tok", "out_tok")).alias("r")).select("digest", "r.*")


def ask_all(prompts: DataFrame, completer: Callable, key: tuple = ("task_id",), carry: tuple = (), attempts: int = ATTEMPTS,
            pause: float = FIRST_PAUSE, threads: int = 1, log: str | None = None, strict: bool = False) -> DataFrame:
    """The reply to each row's ``messages``: ``key``, ``carry`` and ``text, error, in_tok, out_tok``.

    ``completer`` gets one conversation as a list of ``{"role", "content"}``, runs inside the tasks, at most ``threads`` at a
    time in each, and returns a text or ``(text, in_tok, out_tok)``.  A call that fails to the end leaves ``text`` null and its
    error beside it, or fails the job if ``strict``.  ``log`` names a folder all executors reach: replies are kept there as they
    come in, by digest of key and messages, and a prompt that has one is not sent again, neither when its task is repeated
    nor in another run.  Equal prompts under different keys are different requests.
    """
    spark, key = prompts.sparkSession, list(key)
    kept = [*key, *(c for c in carry if c not in key)]
    digest = F.sha2(F.to_json(F.struct(*key, "messages")), 256)
    keyed = prompts.select(*dict.fromkeys([*kept, "messages"]), (digest if log else F.lit(None).cast("string")).alias("digest"))
    shape = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in keyed.select(*kept).schema.fields)
    ask = with_retry(completer, attempts, pause)

    def one(messages) -> tuple:
        try:
            got = ask([dict(m) for m in messages])
        except Exception as err:
            return None, f"{type(err).__name__}: {err}", None, None, err
        text, in_tok, out_tok = (got, None, None) if got is None or isinstance(got, str) else got
        return text, None, in_tok, out_tok, None

    def replies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with ThreadPoolExecutor(threads) as pool:
            each = pool.map if threads > 1 else map
            for b in batches:
                done = []
                for at in range(0, b.num_rows, LOGGED_TOGETHER):
                    part = b.slice(at, LOGGED_TOGETHER)
                    got = list(each(one, part.column("messages").to_pylist()))
                    good = [(d, t, i, o) for d, (t, _, i, o, err) in zip(part.column("digest").to_pylist(), got, strict=True) if err is None]
                    if log and good:
                        log_replies(log, good)
                    failed = [g[4] for g in got if g[4] is not None]
                    if strict and failed:
                        raise failed[0]
                    done += [g[:4] for g in got]
                if done:
                    # what is carried along stays in its columns
                    said = [pa.array(c, t) for c, t in zip(zip(*done, strict=True), (pa.string(), pa.string(), pa.int64(), pa.int64()), strict=True)]
                    yield pa.RecordBatch.from_arrays([*(b.column(c) for c in kept), *said], names=[*kept, "text", "error", "in_tok", "out_tok"])

    def asked(rows: DataFrame) -> DataFrame:
        return dealt(rows, *key, "messages").mapInArrow(replies, f"{shape}, {REPLY}")

    if log is None:
        return asked(keyed)
    logged = cut_lineage(read_log(spark, log).join(by_key(keyed.select("digest").distinct()), "digest", "left_semi"))
    sent = cut_lineage(asked(keyed.join(by_key(logged.select("digest")), "digest", "left_anti")))
    known = keyed.join(by_key(logged), "digest").withColumn("error", F.lit(None).cast("string"))
    return sent.unionByName(known.select(*sent.columns))


def dealt(rows: DataFrame, *columns: str) -> DataFrame:
    """Rows over all tasks by columns: what a prompt and its call take does not show in bytes, by which Spark would deal them."""
    spark = rows.sparkSession
    return rows.repartition(max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism), *columns)


def complete_batch(prompts: DataFrame, completer: Callable, key: tuple = ("task_id",), attempts: int = ATTEMPTS,
                   pause: float = FIRST_PAUSE, threads: int = 1, log: str | None = None, strict: bool = True) -> DataFrame:
    """``key, text``: the reply to each row's ``messages``; with ``strict`` off also ``error``, null where the call went well."""
    got = ask_all(prompts, completer, key, (), attempts, pause, threads, log, strict)
    return got.select(*key, "text", *([] if strict else ["error"]))


# ---------------------------------------------------------------- conversations

class Rounds(NamedTuple):
    """What a run of conversations gave: pairs, token usage by request, and the tasks that are still short of pairs."""

    pairs: DataFrame
    usage: DataFrame
    unfinished: DataFrame


def reviewer(markdown: str, completer: Callable, **more) -> Callable[[DataFrame], DataFrame]:
    """A ``review`` for ``fix_rounds`` and ``run_phase``: asks about each distinct pair once; a call that fails reviews nothing.

    ``more`` goes to ``ask_all``: reply log, threads, attempts.
    """
    def review(pairs: DataFrame) -> DataFrame:
        asked = review_messages(pairs.select("question", "sql").distinct(), markdown)
        return ask_all(asked, completer, ("question", "sql"), **more).select("question", "sql", F.col("text").alias("response"), F.lit(0).alias("seq"))

    return review


def single_pairs(replies: DataFrame, keep: tuple = ("task_id",)) -> DataFrame:
    """One pair from each reply, a JSON object or plain SQL; the task's ``question`` stands in for a missing one."""
    return (parse_answer(replies).select(*keep, F.lit(0).alias("pos"), "question", "sql", F.lit(None).cast("string").alias("answer"))
            .where(F.col("sql") != ""))


def estimated_micros(messages, asked) -> Column:
    """Likely cost of a request: its characters and the pairs it asks for, as tokens."""
    chars = F.aggregate(messages, F.lit(0).cast("long"), lambda acc, m: acc + F.length(m["content"]))
    return cost_micros(F.ceil(chars / CHARS_A_TOKEN), asked * TOKENS_A_PAIR)


def admitted(requests: DataFrame, left: int, span: int = SPAN) -> DataFrame:
    """The ``task_id`` of the requests, in order, whose estimates together stay within ``left`` millionths."""
    priced = requests.select("task_id", estimated_micros(F.col("messages"), F.col("asked")).alias("micros"))
    return running_sum(priced, [], ["task_id"], "micros", "upto", span).where(F.col("upto") <= left).select("task_id")


def converse(tasks: DataFrame, prompt: Callable[[DataFrame], DataFrame], completer: Callable, k: int | Column = 1,
             batch: int | Column | None = None, check: Callable[[DataFrame], DataFrame] = lambda p: p, rounds: int = MAX_ROUNDS,
             follow: str = FOLLOW_SQL, shortfall: bool = False, read: Callable = parse_pairs, budget: float | None = None,
             log: str | None = None, threads: int = 1, strict: bool = True, span: int = SPAN) -> Rounds:
    """Talk to the model about each task until it has ``k`` pairs or the rounds are used up.

    ``prompt`` turns tasks with ``asked`` (pairs wanted now) into ``task_id, messages``, once; each later round sends what has
    been said so far, the last reply and ``follow`` with the number of pairs now wanted: what is missing, at most ``batch``.
    With ``shortfall`` it is what the last reply lacked of ``batch``, or ``batch`` again after a full one.  ``k`` and ``batch``
    may be columns of the tasks.  ``read`` finds the pairs of replies, ``check`` keeps the acceptable ones.

    With ``budget`` (USD) requests are admitted in the order of ``task_id`` as long as their estimated costs fit into what is
    left; what they really cost is settled after each round, and those left out may come in later.  Only unfinished tasks
    are carried from round to round, each with its own conversation; one number reaches the driver.  ``log``, ``threads`` and
    ``strict`` are those of ``ask_all``; without ``strict`` a failed request is sent again in the next round.
    """
    as_column = lambda x: x if isinstance(x, Column) else F.lit(x)
    wanted = tasks.withColumn("want", as_column(k).cast("long")).where(F.col("want") > 0)
    wanted = wanted.withColumn("per", F.coalesce(as_column(batch).cast("long"), F.col("want")))
    wanted = dealt(wanted.withColumn("asked", F.least("per", "want")).withColumn("turn", F.lit(0)), "task_id")
    extra = [c for c in ("question",) if c in tasks.columns]
    held = ["want", "per", "asked", "have", *extra, "messages"]
    state = (prompt(wanted).select("task_id", "messages").join(by_key(wanted.select("task_id", "want", "per", "asked", *extra)), "task_id")
             .withColumn("have", F.lit(0).cast("long")).select("task_id", *held))
    left = None if budget is None else round(budget * MICROS)
    pairs, usage = [], []
    for turn in range(rounds):
        later = None
        if left is not None:
            state = cut_lineage(state)
            may = cut_lineage(admitted(state, left, span))
            state, later = state.join(by_key(may), "task_id", "left_semi"), state.join(by_key(may), "task_id", "left_anti")
        replies = cut_lineage(ask_all(state, completer, ("task_id",), tuple(held), threads=threads, log=log, strict=strict))
        spoken = replies.where(F.col("text").isNotNull())
        used = spoken.select("task_id", F.lit(turn).alias("turn"),
                             F.coalesce("in_tok", F.ceil(F.aggregate("messages", F.lit(0).cast("long"), lambda acc, m: acc + F.length(m["content"])) / CHARS_A_TOKEN)).alias("in_tok"),
                             F.coalesce("out_tok", F.ceil(F.length("text") / CHARS_A_TOKEN)).alias("out_tok"))
        usage.append(used)
        parsed = read(spoken, keep=("task_id", "have", "want"))
        found = cut_lineage(check(parsed.where(F.col("pos") < F.col("want") - F.col("have")).drop("have", "want")).withColumn("round", F.lit(turn)))
        pairs.append(found)
        state = _next(replies, found, parsed if shortfall else None, follow).select("task_id", *held)
        if left is not None:
            left -= used.agg(F.sum(cost_micros(F.col("in_tok"), F.col("out_tok")))).first()[0] or 0
            state = state.unionByName(later.select("task_id", *held))
        if state.isEmpty() or (left is not None and left <= 0):
            break
    return Rounds(_union(pairs), _union(usage), state.select("task_id", "have", "want"))


def _next(replies: DataFrame, found: DataFrame, parsed: DataFrame | None, follow: str) -> DataFrame:
    """The tasks that want more pairs, their conversations longer by the reply and the next question."""
    gained = found.groupBy("task_id").agg(F.count(F.lit(1)).alias("gained"))
    state = replies.join(by_key(gained), "task_id", "left").withColumn("have", F.col("have") + F.coalesce("gained", F.lit(0))).where(F.col("have") < F.col("want"))
    missing, again = F.col("want") - F.col("have"), F.col("per")
    if parsed is not None:
        given = parsed.groupBy("task_id").agg(F.count(F.lit(1)).alias("given"))
        state = state.join(by_key(given), "task_id", "left")
        short = F.col("per") - F.coalesce("given", F.lit(0))
        again = F.when(short > 0, short).otherwise(F.col("per"))
    ask = F.greatest(F.lit(0), F.least(again, missing))
    said = lambda role, content: F.struct(F.lit(role).alias("role"), content.alias("content"))
    longer = F.concat("messages", F.array(said("assistant", F.col("text")), said("user", say(follow, n=F.col("asked")))))
    # a request without reply is put again as it was
    return (state.withColumn("asked", F.when(F.col("text").isNull(), F.col("asked")).otherwise(ask))
            .withColumn("messages", F.when(F.col("text").isNull(), F.col("messages")).otherwise(longer)))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def run_rounds(tasks: DataFrame, prompt: Callable[[DataFrame], DataFrame], completer: Callable, k: int | Column,
               batch: int | Column | None = None, check: Callable[[DataFrame], DataFrame] = lambda p: p,
               rounds: int = MAX_ROUNDS, **more) -> DataFrame:
    """The pairs of ``converse``; ``round`` and ``pos`` give the order of a task's pairs."""
    return converse(tasks, prompt, completer, k, batch, check, rounds, **more).pairs
