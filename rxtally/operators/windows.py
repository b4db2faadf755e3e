"""Period counts, month positions and latest-period lookups."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rxtally.operators.predicates import at_maximum


def with_period_counts(calendar: DataFrame, quarter: str = "FINANCIAL_QUARTER_EXT") -> DataFrame:
    """Number of distinct months in the fiscal quarter and year of every row.

    A calendar has at most a few months per key, which bounds both sets.
    """
    def months(key: str):
        return F.size(F.collect_set("YEAR_MONTH").over(W.partitionBy(key)))

    return calendar.withColumns({"Q_COUNT": months(quarter), "FY_COUNT": months("FINANCIAL_YEAR")})


def latest_complete_quarter(
    calendar: DataFrame, quarter: str = "FINANCIAL_QUARTER_EXT"
) -> DataFrame:
    """Last month that closes a three-month fiscal quarter, with its label; one row."""
    per_quarter = calendar.groupBy(quarter).agg(
        F.count_distinct("YEAR_MONTH").alias("Q_COUNT"), F.max("YEAR_MONTH").alias("YEAR_MONTH")
    )
    complete = per_quarter.filter(F.col("Q_COUNT") == 3)
    return at_maximum(complete.select("YEAR_MONTH", quarter))


def with_month_index(df: DataFrame) -> DataFrame:
    """Position of each month inside its section, counted from 1."""
    order = W.partitionBy("SECTION_NAME", "SECTION_CODE").orderBy("YEAR_MONTH")
    return df.withColumn("MONTH_INDEX", F.row_number().over(order))


def top_values(df: DataFrame, key: str, count: int) -> DataFrame:
    """The ``count`` largest distinct values."""
    return df.select(key).distinct().orderBy(F.desc(key)).limit(count)


def latest_quarter(monthly: DataFrame) -> DataFrame:
    """Last month and the quarter it lies in; one row."""
    return monthly.agg(
        F.max("YEAR_MONTH").alias("YEAR_MONTH"),
        F.max_by("FINANCIAL_QUARTER", "YEAR_MONTH").alias("FINANCIAL_QUARTER"),
    )
