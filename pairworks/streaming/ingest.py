"""Incremental ingestion of model replies into a set of distinct pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.pairs import drop_failures, parse_pairs

REPLIES = "task_id long, text string"
PAIRS = "task_id long, pos int, question string, sql string, batch long"
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _keyed(replies: DataFrame) -> DataFrame:
    pairs = drop_failures(parse_pairs(replies)).drop("answer")
    return pairs.withColumn("key", F.sha2(F.concat_ws("\u0000", "question", "sql"), 256))


def new_pairs(pairs: DataFrame) -> DataFrame:
    """A stream of keyed pairs together with a row (``new``) for each key that has not come before.

    Only the keys go through the state store, which looks each up; the texts pass beside it.
    """
    seen = pairs.select("key").dropDuplicates(["key"]).withColumn("new", F.lit(True))
    return pairs.withColumn("new", F.lit(False)).unionByName(seen, allowMissingColumns=True)


def first_new(batch: DataFrame) -> DataFrame:
    """Of a micro-batch of ``new_pairs`` the first pair, by ``(task_id, pos)``, of each new key."""
    first = F.min(F.when(~F.col("new"), F.struct("task_id", "pos", "question", "sql")))
    return batch.groupBy("key").agg(first.alias("first"), F.bool_or("new").alias("new")).where("new").select("first.*")


def stream_ingest(spark: SparkSession, replies_dir: str, out: str, checkpoint: str, schema: str = REPLIES,
                  trigger: dict | None = None, files_per_batch: int | None = None) -> StreamingQuery:
    """Append the pairs of newly arrived reply files (JSON lines) that ``out`` does not hold yet.

    Digests of all pairs so far are the query's state, in RocksDB beside ``checkpoint``: a batch looks up its own keys and
    reads nothing of what earlier batches wrote.  Each batch writes its own folder in one job, replaced when the batch is
    repeated after a failure; so a retry neither loses nor doubles a pair.  ``checkpoint`` is the memory of ``out``: use a new
    one only with a new ``out``.
    """
    def add(batch: DataFrame, batch_id: int) -> None:
        (first_new(batch).withColumn("batch", F.lit(batch_id)).write.mode("overwrite").partitionBy("batch")
         .option("partitionOverwriteMode", "dynamic").json(f"{out.rstrip('/')}/pairs"))

    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)
    try:
        return (new_pairs(_keyed(reader.json(replies_dir))).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())
    finally:
        spark.conf.set(STORE, before)


def read_pairs(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(PAIRS).json(f"{out.rstrip('/')}/pairs").select("task_id", "pos", "question", "sql")
