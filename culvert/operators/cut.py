"""Cutting lineage with a table in the shared checkpoint folder."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """Folder from ``spark.checkpoint.dir``. Where that is unset, local mode has one of
    its own until the process ends; a cluster needs the setting."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return _own_folder()


@functools.cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="culvert-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def new_table(spark: SparkSession, tag: str) -> str:
    """Path of a table to write, used by nothing else."""
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def written(df: DataFrame, tag: str, *by: str) -> DataFrame:
    """``df`` as a stored table: later plans start there, also after a lost
    executor, and filters reach its files, those on ``by`` its folders."""
    path = new_table(df.sparkSession, tag)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
