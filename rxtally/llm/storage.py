"""The shared folder where operators keep tables that several steps read."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``.

    A cluster must name that folder. A local session that does not, as in tests, gets a scratch one.
    """
    context = spark.sparkContext
    base = context.getConf().get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not base:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        base = tempfile.mkdtemp(prefix="llm-")
        context.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm-{uuid4().hex}"


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """``df`` written once to the shared folder and read back; this cuts its lineage."""
    spark = df.sparkSession
    folder = folder or shared_folder(spark)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def mounted_path(folder: str) -> str:
    """The local path of a shared folder that is mounted on every machine, for memory-mapped files.

    A path without a scheme belongs to the default file system, which must then be the machines' own.
    """
    if folder.startswith("file:"):
        return "/" + folder[len("file:") :].lstrip("/")
    if folder.startswith("/"):
        spark = SparkSession.active()
        default = spark.conf.get("spark.hadoop.fs.defaultFS", None) or spark.conf.get("fs.defaultFS", "file:///")
        if default.startswith("file:"):
            return folder
    raise ValueError(f"memory-mapped files need a mounted shared folder (file:), not {folder}")
