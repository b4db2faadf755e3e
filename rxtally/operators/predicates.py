"""Row filters that the publication steps share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtally.functions.scalars import UNKNOWN

PRE_PERIOD = "pre_covid"
LATER_PERIOD = "covid"


def month_range(first: int | None = None, last: int | None = None, key: str = "YEAR_MONTH") -> Column:
    """Months from ``first`` to ``last``, both included; either end may be open."""
    condition = F.lit(True)
    if first is not None:
        condition = condition & (F.col(key) >= first)
    if last is not None:
        condition = condition & (F.col(key) <= last)
    return condition


def not_in(key: str, values: Iterable[str]) -> Column:
    return ~F.col(key).isin(*values)


def at_maximum(df: DataFrame, key: str = "YEAR_MONTH") -> DataFrame:
    """Rows that hold the largest key: one-row aggregate, no single-task sort."""
    return df.filter(F.col(key) == df.agg(F.max(key)).scalar())


def known_person(bands: Iterable[str]) -> Column:
    """Rows of identified people of known gender and band.

    Unidentified rows with a gender are dropped, and so is any row whose gender
    or band is not known.
    """
    flag, gender = F.col("IDENTIFIED_FLAG"), F.col("PDS_GENDER")
    unknown = gender == "U"
    for band in bands:
        unknown = unknown | (F.col(band) == UNKNOWN)
    return ~((flag == "N") & gender.isin("F", "M")) & ~unknown


def with_period(df: DataFrame, train_end: int) -> DataFrame:
    """Label each row as before or after the end of the training months."""
    return df.withColumn(
        "time_period",
        F.when(F.col("YEAR_MONTH") <= train_end, PRE_PERIOD).otherwise(LATER_PERIOD),
    )


def training_rows(df: DataFrame, train_end: int) -> DataFrame:
    return with_period(df, train_end).filter(F.col("time_period") == PRE_PERIOD)


def testing_rows(df: DataFrame, train_end: int) -> DataFrame:
    return with_period(df, train_end).filter(F.col("time_period") != PRE_PERIOD)


def group_split(df: DataFrame, group: str, fraction: float, seed: int = 0) -> Column:
    """True for the rows of the training groups; whole groups go to one side.

    A hash of the group key decides, so the split is the same on every run.
    """
    bucket = F.pmod(F.xxhash64(F.lit(seed), F.col(group)), F.lit(1_000_000))
    return bucket < int(fraction * 1_000_000)
