"""Freshness gate and append of new months to stored history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxtally.functions import dates
from rxtally.operators import patient_sets, windows


def stored_maximum(history: DataFrame) -> int | None:
    return history.agg(F.max("YEAR_MONTH").alias("month")).first()["month"]


def next_month(history: DataFrame) -> DataFrame:
    """First month not yet stored; one row."""
    return history.agg(
        dates.shift_year_month(F.max("YEAR_MONTH"), 1).alias("NEXT_MONTH")
    )


def is_newer(calendar: DataFrame, history: DataFrame, quarter: str = "FINANCIAL_QUARTER_EXT") -> bool:
    """Whether the last complete quarter ends after the stored history does.

    ``calendar`` should end with the last month that is loaded (``sources.tables.latest_loaded``).
    """
    latest = windows.latest_complete_quarter(calendar, quarter).first()
    stored = stored_maximum(history)
    if latest is None:
        return False
    return stored is None or latest["YEAR_MONTH"] > stored


def new_months(rows: DataFrame, history: DataFrame) -> DataFrame:
    """Rows of months after the stored maximum; all rows when nothing is stored."""
    stored = history.agg(F.coalesce(F.max("YEAR_MONTH"), F.lit(0))).scalar()
    return rows.filter(F.col("YEAR_MONTH") > stored)


def refreshed(history: DataFrame, extracted: DataFrame) -> DataFrame:
    """Stored history followed by the new months of an extract."""
    return history.unionByName(new_months(extracted, history))


def append_months(new: DataFrame, path: str) -> None:
    """Write whole months; each month's folder is replaced, so a repeated run is harmless."""
    (
        new.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("YEAR_MONTH")
        .parquet(path)
    )


def sets_through(spark: SparkSession, path: str) -> int | None:
    """The last month whose patient sets are stored whole.

    It is read from the mark that is written after them: a month that was begun is not taken for one that is there.
    """
    try:
        return spark.read.schema("YEAR_MONTH int").json(f"{path}.finished").agg(F.max("YEAR_MONTH")).first()[0]
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def stored_sets(spark: SparkSession, path: str) -> DataFrame:
    """The stored patient sets, up to the last whole month."""
    sets = spark.read.schema(patient_sets.SCHEMA).parquet(path)
    return sets.filter(F.col("YEAR_MONTH") <= sets_through(spark, path))


def extend_sets(
    spark: SparkSession, path: str, items_between: Callable[[int, int], DataFrame], first: int, last: int
) -> DataFrame:
    """Store the patient sets of the months up to ``last`` that are not there yet, and give all of them.

    ``items_between`` gives the joined items of a range of months. Only new months are asked for. A run that ends
    half-way leaves the mark as it was, and the next one writes the same months again.
    """
    stored = sets_through(spark, path)
    start = first if stored is None else stored + (89 if stored % 100 == 12 else 1)
    if start <= last:
        new = patient_sets.patient_sets(items_between(start, last))
        append_months(new.repartition("YEAR_MONTH", "BNF_SECTION", "BUCKET"), path)
        spark.createDataFrame([(last,)], "YEAR_MONTH int").coalesce(1).write.mode("overwrite").json(f"{path}.finished")
    return stored_sets(spark, path)
