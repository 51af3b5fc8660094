"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the runtime settings the operators rely on."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build_session(master: str | None = None, shuffle_partitions: int | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; the cluster's own settings win where not given."""
    builder = SparkSession.builder.appName("pairworks").config("spark.sql.adaptive.enabled", "true")
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in conf.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Without that setting a temporary folder is used in local mode only; on a cluster
    a machine-local folder would lose data with its executor, so that is an error.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _local_folder()


_LOCAL: list[str] = []


def _local_folder() -> str:
    if not _LOCAL:
        _LOCAL.append(tempfile.mkdtemp(prefix="pairworks-"))
    return _LOCAL[0]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/pairworks/{label}-{uuid.uuid4().hex}"


def spread(df: DataFrame) -> DataFrame:
    """Rows over all cores where the input has fewer splits than cores; larger inputs are left as they are."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and read them back.

    They are computed exactly once, which matters where that costs money, and survive the loss of executors.
    """
    spark, path = df.sparkSession, scratch_path(df.sparkSession, "cut")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def by_key(df: DataFrame) -> DataFrame:
    """The side of a join that has a row for each key: both sides are dealt by the key, however small its files are.

    Spark reckons with the size of the files, and tables cut here compress so well that millions of rows would pass for a table
    to be collected on the driver and sent to all executors.
    """
    return df.hint("merge")
