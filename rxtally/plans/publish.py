"""Publication tables and figure data from the saved aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtally.config import ReleaseConfig
from rxtally.functions import dates, scalars
from rxtally.operators import aggregates, joins, predicates, reshape, windows

# Published column headings, in published order.
MONTHLY_HEADINGS = {
    "FINANCIAL_YEAR": "Financial Year",
    "FINANCIAL_QUARTER": "Financial Quarter",
    "YEAR_MONTH": "Year Month",
    "SECTION_NAME": "BNF Section Name",
    "SECTION_CODE": "BNF Section Code",
    "IDENTIFIED_FLAG": "Identified Patient",
    "PATIENT_COUNT": "Total Patients",
    "ITEM_COUNT": "Total Items",
    "ITEM_PAY_DR_NIC": "Total Net Ingredient Cost (GBP)",
}
QUARTERLY_HEADINGS = {
    name: heading for name, heading in MONTHLY_HEADINGS.items() if name != "YEAR_MONTH"
}

# What each published field means.
DATA_DICTIONARY = {
    "BNF Section Code": "Code of the British National Formulary section.",
    "BNF Section Name": "Name of the British National Formulary section.",
    "Financial Year": "Financial year of the data, April to March.",
    "Year Month": "Year and month of the data, as YYYYMM.",
    "Financial Quarter": "Financial quarter of the data.",
    "Identified Patient": "Y if the item is tied to a verified patient, otherwise N.",
    "Total Items": "Number of prescription items dispensed.",
    "Total Net Ingredient Cost (GBP)": "Cost of the items at basic price, in pounds.",
    "Total Patients": "Number of identified patients; always 0 where Identified Patient is N.",
}

ITEMS, PATIENTS = "Prescribed items", "Identified patients"
_SECTION = ["SECTION_NAME", "SECTION_CODE"]
_MEASURES = ["ITEM_COUNT", "ITEM_PAY_DR_NIC", "PATIENT_COUNT"]
_RATE_KEYS = ["FINANCIAL_YEAR", "FINANCIAL_QUARTER", *_SECTION]


def _both_flags(quarterly: DataFrame) -> DataFrame:
    return reshape.flags_to_columns(quarterly, _RATE_KEYS, _MEASURES)


def identification_rates(quarterly: DataFrame) -> DataFrame:
    """Share of items of identified patients, per quarter and section, in long form."""
    rate = scalars.identification_rate(F.col("ITEM_COUNT_Y"), F.col("ITEM_COUNT_N"))
    return _both_flags(quarterly).select(
        "FINANCIAL_QUARTER", *_SECTION, rate.alias("RATE")
    )


def _rates_by_quarter(rates: DataFrame) -> DataFrame:
    named = rates.withColumnsRenamed(
        {"SECTION_NAME": "BNF Section Name", "SECTION_CODE": "BNF Section Code"}
    )
    return reshape.quarters_to_columns(
        named, ["BNF Section Name", "BNF Section Code"], "RATE"
    ).orderBy("BNF Section Code")


def identification_table(quarterly: DataFrame) -> DataFrame:
    """Numeric rates of every quarter, one column per quarter."""
    return _rates_by_quarter(identification_rates(quarterly))


def identification_text(quarterly: DataFrame, quarters: int = 4) -> DataFrame:
    """Rates of the latest quarters as text with one decimal."""
    period = windows.top_values(quarterly, "FINANCIAL_QUARTER", quarters)
    recent = _both_flags(joins.keep_listed(quarterly, period, "FINANCIAL_QUARTER"))
    text = scalars.identification_rate_text(F.col("ITEM_COUNT_Y"), F.col("ITEM_COUNT_N"))
    return _rates_by_quarter(recent.select("FINANCIAL_QUARTER", *_SECTION, text.alias("RATE")))


def monthly_series(monthly: DataFrame, days: DataFrame) -> DataFrame:
    """Section totals per month with index, start date, month number and dispensing days."""
    summed = aggregates.totals(monthly, ["YEAR_MONTH", *_SECTION], _MEASURES)
    indexed = windows.with_month_index(summed).withColumn(
        "MONTH_START", dates.month_start(F.col("YEAR_MONTH"))
    )
    dated = indexed.withColumn("MONTH_NUM", dates.month_number(F.col("MONTH_START")))
    return joins.join_calendar(dated, days)


def _figure(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    named = df.select(
        *keys,
        F.col("PATIENT_COUNT").cast("double").alias(PATIENTS),
        F.col("ITEM_COUNT").cast("double").alias(ITEMS),
    )
    long = reshape.measures_to_rows(named, keys, [PATIENTS, ITEMS])
    return long.withColumn("value", scalars.three_figures(F.col("value")))


def quarterly_figures(quarterly: DataFrame, config: ReleaseConfig) -> DataFrame:
    """Items and patients per quarter and section, three significant figures, long form."""
    keys = ["FINANCIAL_QUARTER", *_SECTION]
    kept = quarterly.filter(predicates.not_in("FINANCIAL_YEAR", config.chart_skip_years))
    summed = aggregates.totals(kept, keys, ["ITEM_COUNT", "PATIENT_COUNT"])
    return _figure(summed, keys).orderBy(F.desc("measure"), "SECTION_CODE", "FINANCIAL_QUARTER")


def monthly_figures(series: DataFrame, config: ReleaseConfig) -> DataFrame:
    """Items and patients per month and section, three significant figures, long form."""
    kept = series.filter(predicates.month_range(first=config.chart_start))
    return _figure(kept, ["YEAR_MONTH", "MONTH_START", *_SECTION])


def _published(df: DataFrame, headings: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(name).alias(heading) for name, heading in headings.items()])


def order_in_period() -> list[Column]:
    """By section, identified before unidentified."""
    return [F.asc("SECTION_CODE"), F.desc("IDENTIFIED_FLAG")]


def published_order(df: DataFrame, period: Sequence[str]) -> DataFrame:
    """Sorted by period and inside it; for the sink."""
    return df.orderBy(*period, *order_in_period())


def published_monthly(monthly: DataFrame) -> DataFrame:
    return _published(published_order(monthly, ["YEAR_MONTH"]), MONTHLY_HEADINGS)


def published_quarterly(quarterly: DataFrame) -> DataFrame:
    period = ["FINANCIAL_YEAR", "FINANCIAL_QUARTER"]
    return _published(published_order(quarterly, period), QUARTERLY_HEADINGS)


def data_dictionary(spark) -> DataFrame:
    return spark.createDataFrame(list(DATA_DICTIONARY.items()), "Field string, Description string")


def disclosure_control(df: DataFrame, threshold: int = 5) -> DataFrame:
    """Blank the measures of a row whose patient count lies between 1 and ``threshold`` - 1."""
    small = F.col("PATIENT_COUNT").between(1, threshold - 1)
    return df.withColumns({name: F.when(small, None).otherwise(F.col(name)) for name in _MEASURES})


def age_at_september(birth: str, financial_year: str):
    """Age on 30 September of a fiscal year labelled ``2022/2023``."""
    start = F.substring(financial_year, 1, 4).cast("int")
    day = F.make_date(start, F.lit(9), F.lit(30))
    return F.floor(F.months_between(day, F.col(birth)) / 12).cast("int")


def deprivation_decile(
    df: DataFrame, postcode_areas: DataFrame, area_deciles: DataFrame, postcode: str = "POSTCODE"
) -> DataFrame:
    """Decile of the prescriber's postcode; "unknown" when it cannot be matched.

    ``postcode_areas`` maps POSTCODE to AREA, ``area_deciles`` AREA to DECILE.
    """
    placed = df.join(postcode_areas, df[postcode] == postcode_areas["POSTCODE"], "left")
    if postcode == "POSTCODE":
        placed = placed.drop(postcode_areas["POSTCODE"])
    ranked = placed.join(area_deciles, "AREA", "left").drop("AREA")
    return ranked.withColumn(
        "DECILE", F.coalesce(F.col("DECILE").cast("string"), F.lit("unknown"))
    )
