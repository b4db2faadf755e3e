"""The indicator table: 25 lines per section, all sections in one pass per input."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtally import schemas
from rxtally.functions import dates, scalars
from rxtally.operators import windows
from rxtally.operators.aggregates import mean_where, sum_where
from rxtally.plans.publish import identification_rates


@dataclass(frozen=True)
class Periods:
    """Quarters and month runs compared, as column expressions of the latest month."""

    quarter: Column
    last_quarter: Column
    last_year: Column
    five_years: Column
    year: Column
    year_before: Column
    year_first: Column
    year_last: Column
    before_first: Column
    before_last: Column


def periods(latest_month: int, quarter: str) -> Periods:
    """Every compared period follows from the latest month and its quarter."""
    latest = F.lit(latest_month)
    start = dates.month_start(latest)

    def back(months: int) -> Column:
        return dates.fiscal_quarter_label(dates.shift_months(start, -months))

    def name(months: int) -> Column:
        return dates.month_name(dates.shift_months(start, -months))

    return Periods(
        quarter=F.lit(quarter),
        last_quarter=back(3),
        last_year=back(12),
        five_years=back(60),
        year=dates.trailing_months(latest, 12),
        year_before=dates.trailing_months(latest, 12, skip=12),
        year_first=name(11),
        year_last=name(0),
        before_first=name(23),
        before_last=name(12),
    )


def latest_periods(monthly: DataFrame) -> Periods:
    row = windows.latest_quarter(monthly).first()
    return periods(row["YEAR_MONTH"], row["FINANCIAL_QUARTER"])


def quarter_measures(quarterly: DataFrame, p: Periods) -> DataFrame:
    """Items and patients of the four compared quarters, one row per section."""
    compared = {"now": p.quarter, "quarter": p.last_quarter, "year": p.last_year, "five": p.five_years}
    return quarterly.groupBy("SECTION_CODE", "SECTION_NAME").agg(
        *[
            sum_where(F.col("FINANCIAL_QUARTER") == label, column).cast("double").alias(f"{short}_{when}")
            for short, column in (("items", "ITEM_COUNT"), ("patients", "PATIENT_COUNT"))
            for when, label in compared.items()
        ]
    )


def rate_measures(rates: DataFrame, p: Periods) -> DataFrame:
    """Identification rate now and five years ago, one row per section."""
    return rates.groupBy("SECTION_CODE").agg(
        *[
            F.max(F.when(F.col("FINANCIAL_QUARTER") == label, F.col("RATE"))).alias(f"rate_{when}")
            for when, label in (("now", p.quarter), ("five", p.five_years))
        ]
    )


def year_measures(monthly: DataFrame, p: Periods) -> DataFrame:
    """Mean monthly patients and items of the last two runs of twelve months."""
    identified = F.col("IDENTIFIED_FLAG") == "Y"
    runs = {"now": p.year, "before": p.year_before}
    inside = {when: F.array_contains(months, F.col("YEAR_MONTH")) for when, months in runs.items()}
    return monthly.groupBy("SECTION_CODE").agg(
        *[
            mean_where(rows & identified, "PATIENT_COUNT").alias(f"mean_patients_{when}")
            for when, rows in inside.items()
        ],
        *[
            sum_where(rows, "ITEM_COUNT").cast("double").alias(f"year_items_{when}")
            for when, rows in inside.items()
        ],
    )


def _lines(p: Periods) -> list[tuple[Column, str, Column, bool]]:
    """Period, measure, value and whether the value is shown as a percentage."""
    to = dates.range_label

    def change(now: str, before: str) -> Column:
        return scalars.percent_change(F.col(now), F.col(before))

    out = []
    for short, label, five_label in (
        ("items", "Items", "% change volume"),
        ("patients", "Patients", "% change patients"),
    ):
        now, last, year, five = (f"{short}_{when}" for when in ("now", "quarter", "year", "five"))
        percent = f"% change {label.lower()}"
        since_five = to(p.five_years, p.quarter)
        out += [
            (p.quarter, label, F.col(now), False),
            (p.last_year, label, F.col(year), False),
            (to(p.last_year, p.quarter), percent, change(now, year), True),
            (p.last_quarter, label, F.col(last), False),
            (to(p.last_quarter, p.quarter), percent, change(now, last), True),
            (p.five_years, label, F.col(five), False),
            (since_five, f"{label} change", scalars.absolute_change(F.col(now), F.col(five)), False),
            (since_five, five_label, change(now, five), True),
        ]
    points = scalars.absolute_change(F.col("rate_now"), F.col("rate_five"))
    out += [
        (p.five_years, "% identified patients", F.col("rate_five"), True),
        (p.quarter, "% identified patients", F.col("rate_now"), True),
        (to(p.five_years, p.quarter), "Percentage points change", points, False),
    ]
    year, before = to(p.year_first, p.year_last), to(p.before_first, p.before_last)
    both = to(p.before_first, p.year_last)
    for short, label, percent in (
        ("mean_patients", "Mean patients", "% change patients"),
        ("year_items", "Items", "% change items"),
    ):
        now, earlier = f"{short}_now", f"{short}_before"
        out += [
            (year, label, F.col(now), False),
            (before, label, F.col(earlier), False),
            (both, percent, change(now, earlier), True),
        ]
    return out


def indicator_table(quarterly: DataFrame, monthly: DataFrame) -> DataFrame:
    """Twenty-five numbered lines per section.

    Each input is read once with conditional aggregates; the wide row per section
    is then turned into lines.
    """
    p = latest_periods(monthly)
    wide = (
        quarter_measures(quarterly, p)
        .join(rate_measures(identification_rates(quarterly), p), "SECTION_CODE", "left")
        .join(year_measures(monthly, p), "SECTION_CODE", "left")
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(number).alias("LINE"),
                period.alias("Period"),
                F.lit(measure).alias("Measure"),
                value.cast("double").alias("Value"),
                F.lit("%" if percentage else "").alias("_unit"),
            )
            for number, (period, measure, value, percentage) in enumerate(_lines(p), start=1)
        ]
    )
    lines = wide.select(
        "SECTION_CODE",
        scalars.text_name(F.col("SECTION_NAME")).alias("Section_Name"),
        scalars.item_name(F.col("SECTION_NAME")).alias("Section_Formatted"),
        F.inline(rows),
    )
    shown = F.concat(scalars.display_text(F.col("Value")), F.col("_unit"))
    return lines.withColumn("Rounded", shown).select(*schemas.INDICATORS.fieldNames())
