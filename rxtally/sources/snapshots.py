"""Saved aggregates: find the newest snapshot that matches a name, read it with a schema."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def list_snapshots(spark: SparkSession, folder: str, pattern: str) -> DataFrame:
    """Files under ``folder`` whose path below it matches the regular expression.

    Only path and time are selected, so no file content is read.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(folder)
        .select("path", "modificationTime")
    )
    below = F.substring_index("path", f"{folder.rstrip('/')}/", -1)
    return files.filter(below.rlike(pattern))


def newest_snapshot(spark: SparkSession, folder: str, pattern: str) -> str:
    """Path of the newest match; the later name wins between equal times.

    A snapshot that Spark wrote is a folder of part files: the folder is what is found, so that all its parts are
    read, and only if the file that marks it as finished lies beside it. A single file is a snapshot of its own.
    """
    parts = r"/part-[^/]*$"
    files = list_snapshots(spark, folder, pattern).withColumn("snapshot", F.regexp_replace("path", parts, ""))
    marks = list_snapshots(spark, folder, r"\.finished/part-[^/]*$").select(
        F.regexp_replace("path", r"\.finished/part-[^/]*$", "").alias("whole")
    )
    marked = files.join(marks.distinct(), F.col("snapshot") == F.col("whole"), "left")
    found = (
        marked.filter((F.col("path") == F.col("snapshot")) | F.col("whole").isNotNull())
        .groupBy("snapshot")
        .agg(F.max("modificationTime").alias("written"))
        .agg(F.max_by("snapshot", F.struct("written", "snapshot")).alias("path"))
    )
    path = found.first()["path"]
    if path is None:
        raise FileNotFoundError(f"no finished file under {folder} matches {pattern}")
    return path


def read_delimited(
    spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ","
) -> DataFrame:
    """Delimited text with a header, read with a declared schema: codes keep leading zeros."""
    return (
        spark.read.schema(schema)
        .option("header", "true")
        .option("sep", delimiter)
        .option("enforceSchema", "false")
        .option("mode", "FAILFAST")
        .csv(path)
    )
