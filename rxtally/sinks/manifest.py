"""Marks of what is whole: one file beside a finished snapshot, one list of tables in a finished release.

Both are written after everything they speak of, and readers take nothing without them, so that a run that ends half-way
leaves nothing to read.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxtally.sources.snapshots import list_snapshots

FIELDS = "table string, path string, form string, rows bigint, fields string"
MARK = "finished"


def write(spark: SparkSession, folder: str, tables: list[tuple[str, str, str, int, str]]) -> None:
    """One file with the given (table, path, form, rows, fields)."""
    spark.createDataFrame(tables, FIELDS).coalesce(1).write.mode("overwrite").json(folder)


def mark(df: DataFrame, path: str, form: str) -> tuple[str, str, str, int, str]:
    """Mark the folder ``path`` as finished, with the number of rows it holds."""
    spark = df.sparkSession
    stored = spark.read.schema(df.schema).format(form)
    rows = (stored.option("header", "true") if form == "csv" else stored).load(path).count()
    made = (path.rsplit("/", 1)[-1], path, form, rows, df.schema.json())
    write(spark, f"{path}.{MARK}", [made])
    return made


def new_release(folder: str, month: int) -> str:
    """A folder of its own for each run, so that a repeated run meets nothing of an earlier one."""
    return f"{folder.rstrip('/')}/release={month}-{uuid4().hex}"


def finish(spark: SparkSession, release: str, tables: list[tuple[str, str, str, int, str]]) -> None:
    write(spark, f"{release}/manifest", tables)


def newest_release(spark: SparkSession, folder: str) -> str:
    """The folder of the last month's release that has its list; of several runs the one finished last."""
    listed = list_snapshots(spark, folder, r"^release=[0-9]+-[^/]*/manifest/part-[^/]*$")
    release = F.regexp_replace("path", r"/manifest/part-[^/]*$", "")
    month = F.regexp_extract("path", r"release=([0-9]+)-[^/]*/manifest/part-[^/]*$", 1).cast("int")
    found = listed.agg(F.max_by(release, F.struct(month, "modificationTime", "path")).alias("path")).first()["path"]
    if found is None:
        raise FileNotFoundError(f"no finished release under {folder}")
    return found


def tables(spark: SparkSession, release: str) -> DataFrame:
    """table, path, form, rows, fields of a finished release."""
    return spark.read.schema(FIELDS).json(f"{release}/manifest")
