"""JSON lines: the exchange format of datasets."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_jsonl(df: DataFrame, path: str) -> None:
    """Replace ``path``; null fields are written."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def append_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("ignoreNullFields", "false").json(path)


def read_jsonl(spark: SparkSession, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_version(df: DataFrame, root: str, phase: str, run_version: str) -> str:
    """Replace one version of a phase's dataset, also by no rows, and leave the others alone."""
    path = f"{root.rstrip('/')}/{phase}"
    folder = re.sub(r'[\x00-\x1f"#%\'*/:=?\\{\[\]^\x7f]', lambda m: f"%{ord(m.group()):02X}", run_version)
    write_jsonl(df, f"{path}/run_version={folder}")
    return path


def read_version(spark: SparkSession, root: str, phase: str, run_version: str, schema: str) -> DataFrame:
    df = spark.read.schema(f"{schema}, run_version string").json(f"{root.rstrip('/')}/{phase}")
    return df.where(F.col("run_version") == run_version).drop("run_version")
