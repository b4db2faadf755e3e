"""Month keys, month arithmetic and April-start fiscal labels as column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(year_month: Column) -> Column:
    """``202212`` -> 2022-12-01."""
    return F.make_date(
        F.floor(year_month / 100).cast("int"), (year_month % 100).cast("int"), F.lit(1)
    )


def year_month(day: Column) -> Column:
    """Any date or timestamp -> its ``YYYYMM`` key."""
    return F.year(day) * 100 + F.month(day)


def month_number(day: Column) -> Column:
    return F.month(day)


def month_index(day: Column, origin: date) -> Column:
    """Whole months passed since ``origin``."""
    return F.floor(F.months_between(day, F.lit(origin))).cast("int")


def shift_months(day: Column, months: int) -> Column:
    """Month arithmetic; a day past the end of the target month moves to its last day."""
    return F.add_months(day, months)


def shift_year_month(key: Column, months: int) -> Column:
    return year_month(shift_months(month_start(key), months))


def trailing_months(latest: Column, count: int, skip: int = 0) -> Column:
    """Array of ``count`` month keys going back from ``latest``, after leaving out ``skip``."""
    start = month_start(latest)
    days = F.sequence(
        F.add_months(start, -skip),
        F.add_months(start, -(skip + count - 1)),
        F.expr("interval -1 month"),
    )
    return F.transform(days, year_month)


def fiscal_quarter(day: Column, fiscal_start: int = 4) -> Column:
    return F.quarter(F.add_months(day, 1 - fiscal_start))


def fiscal_year(day: Column, fiscal_start: int = 4) -> Column:
    """Fiscal year named by the calendar year it ends in."""
    return F.year(F.add_months(day, 1 - fiscal_start)) + 1


def fiscal_year_label(day: Column, fiscal_start: int = 4) -> Column:
    """``2022/2023``."""
    ends = fiscal_year(day, fiscal_start)
    return F.concat_ws("/", (ends - 1).cast("string"), ends.cast("string"))


def fiscal_quarter_label(day: Column, fiscal_start: int = 4) -> Column:
    """``2022/2023 Q3``; fixed width, so text order is time order."""
    return F.concat(
        fiscal_year_label(day, fiscal_start),
        F.lit(" Q"),
        fiscal_quarter(day, fiscal_start).cast("string"),
    )


def month_name(day: Column) -> Column:
    """``December 2022``."""
    return F.date_format(day, "MMMM yyyy")


def range_label(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" to "), last)
