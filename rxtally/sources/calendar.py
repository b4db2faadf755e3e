"""Month and day calendars grown from the first and last month of the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxtally.functions import dates


def month_span(months: DataFrame, key: str = "YEAR_MONTH") -> DataFrame:
    """One row with the first and last day covered by a frame of month keys."""
    return months.agg(
        dates.month_start(F.min(key)).alias("FIRST_DAY"),
        F.last_day(dates.month_start(F.max(key))).alias("LAST_DAY"),
    )


def fixed_span(spark: SparkSession, first_month: int, last_month: int) -> DataFrame:
    """The same one row for two given months."""
    return spark.range(1).select(
        dates.month_start(F.lit(first_month)).alias("FIRST_DAY"),
        F.last_day(dates.month_start(F.lit(last_month))).alias("LAST_DAY"),
    )


def _each(span: DataFrame, step: str, name: str) -> DataFrame:
    return span.select(
        F.explode(F.sequence("FIRST_DAY", "LAST_DAY", F.expr(f"interval 1 {step}"))).alias(name)
    )


def time_dim(span: DataFrame, start: Column | int | None = None) -> DataFrame:
    """One row per month with its fiscal year and quarter labels.

    ``QUARTER_KEY`` is the first month of the fiscal quarter: a short key to
    group by while the labels wait until the rows are few. ``start`` drops
    earlier months, for an extract of new months only.
    """
    day = F.col("MONTH_START")
    out = _each(span, "month", "MONTH_START").select(
        dates.year_month(day).alias("YEAR_MONTH"),
        dates.year_month(F.add_months(day, -((F.month(day) + 2) % 3))).alias("QUARTER_KEY"),
        dates.fiscal_year_label(day).alias("FINANCIAL_YEAR"),
        dates.fiscal_quarter_label(day).alias("FINANCIAL_QUARTER"),
    )
    return out if start is None else out.filter(F.col("YEAR_MONTH") >= start)


def keyed_time_dim(dim: DataFrame) -> DataFrame:
    """Any month dimension with the short quarter key added if it has none.

    The key follows from the month alone, so that tables which begin in different months of a quarter agree on it.
    """
    if "QUARTER_KEY" in dim.columns:
        return dim
    month = F.col("YEAR_MONTH") % 100
    return dim.withColumn("QUARTER_KEY", (F.col("YEAR_MONTH") - (month + 2) % 3).cast("int"))


def dispensing_days(span: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Days per month on which items are dispensed: no Sundays, no listed holidays.

    ``holidays`` has one column, ``HOLIDAY date``.
    """
    days = _each(span, "day", "DAY").filter(F.dayofweek("DAY") != 1)
    if holidays is not None:
        days = days.join(holidays, days["DAY"] == holidays["HOLIDAY"], "left_anti")
    return days.groupBy(dates.year_month(F.col("DAY")).alias("YEAR_MONTH")).agg(
        F.count(F.lit(1)).cast("int").alias("DISPENSING_DAYS")
    )
