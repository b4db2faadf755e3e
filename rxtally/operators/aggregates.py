"""Patient-grain totals, distinct patients and section totals."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtally.functions import scalars
from rxtally.sources.calendar import keyed_time_dim

SECTION = ["SECTION_DESCR", "BNF_SECTION"]
PATIENT = "IDENTIFIED_PATIENT_ID"
FLAG = "IDENTIFIED_FLAG"
PERSON = ["PDS_GENDER", "DALL_5YR_BAND"]

# Periods are grouped by their short integer keys; labels follow at the end.
QUARTER_KEYS = ["QUARTER_KEY", *SECTION, FLAG]
MONTH_KEYS = ["YEAR_MONTH", *SECTION, FLAG]
MODEL_KEYS = [*MONTH_KEYS, *PERSON]

_NAMES = {"SECTION_DESCR": "SECTION_NAME", "BNF_SECTION": "SECTION_CODE"}


def recode_person(items: DataFrame) -> DataFrame:
    """Gender code to letter, missing band to "Unknown"."""
    return items.withColumns(
        {
            "PDS_GENDER": scalars.gender_letter(F.col("PDS_GENDER")),
            "DALL_5YR_BAND": scalars.known_band(F.col("DALL_5YR_BAND")),
        }
    )


def per_patient(items: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Items and pence per patient within ``keys``; no patient id is one patient.

    The map side adds up first, so a patient (or the missing id) that holds a
    large part of all rows reaches the shuffle as a few rows per task.
    """
    return items.groupBy(*keys, PATIENT).agg(
        F.sum("ITEM_COUNT").alias("ITEM_COUNT"), F.sum("ITEM_PAY_DR_NIC").alias("ITEM_PAY_DR_NIC")
    )


def count_patients(patients: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Section totals from patient totals: items, pounds and number of patients."""
    return (
        patients.groupBy(*keys)
        .agg(
            F.sum("ITEM_COUNT").alias("ITEM_COUNT"),
            scalars.pounds(F.sum("ITEM_PAY_DR_NIC")).alias("ITEM_PAY_DR_NIC"),
            F.sum(scalars.patient_indicator(F.col(FLAG))).alias("PATIENT_COUNT"),
        )
        .withColumnsRenamed(_NAMES)
    )


def label_months(totals_by_month: DataFrame, time_dim: DataFrame) -> DataFrame:
    """Fiscal labels on monthly totals.

    Every month came through the time dimension, so a left join loses nothing;
    unlike an inner one it pushes no filter down into the shared base.
    """
    labels = time_dim.select("YEAR_MONTH", "FINANCIAL_YEAR", "FINANCIAL_QUARTER")
    return totals_by_month.join(labels, "YEAR_MONTH", "left")


def label_quarters(totals_by_quarter: DataFrame, time_dim: DataFrame) -> DataFrame:
    labels = keyed_time_dim(time_dim).select("QUARTER_KEY", "FINANCIAL_YEAR", "FINANCIAL_QUARTER")
    return totals_by_quarter.join(labels.distinct(), "QUARTER_KEY", "left").drop("QUARTER_KEY")


def quarterly_totals(items: DataFrame, time_dim: DataFrame) -> DataFrame:
    out = count_patients(per_patient(items, QUARTER_KEYS), QUARTER_KEYS)
    return label_quarters(out, time_dim)


def monthly_totals(items: DataFrame, time_dim: DataFrame) -> DataFrame:
    out = count_patients(per_patient(items, MONTH_KEYS), MONTH_KEYS)
    return label_months(out, time_dim)


def model_totals(items: DataFrame, time_dim: DataFrame) -> DataFrame:
    """Month, gender and 5-year band; a patient with two genders or bands counts in each."""
    out = count_patients(per_patient(recode_person(items), MODEL_KEYS), MODEL_KEYS)
    return label_months(out, time_dim)


def patient_base(items: DataFrame) -> DataFrame:
    """Patient totals at the finest published grain."""
    return per_patient(recode_person(items), ["QUARTER_KEY", *MODEL_KEYS])


def grains_from_base(base: DataFrame, time_dim: DataFrame) -> dict[str, DataFrame]:
    """The three published grains regrouped from one patient base.

    The base has one row per patient and key, so nothing in it is hot any more.
    It is placed once by quarter, section and patient; the monthly and quarterly
    regroupings both find a patient's rows together and need no other shuffle of
    patient rows. The quarterly one goes through the monthly one, which leaves
    the two with the same input and lets Spark reuse it.
    """
    placed = base.repartition("QUARTER_KEY", "BNF_SECTION", PATIENT)
    by_month = per_patient(placed, ["QUARTER_KEY", *MONTH_KEYS])
    by_quarter = per_patient(by_month, QUARTER_KEYS)
    return {
        "quarterly": label_quarters(count_patients(by_quarter, QUARTER_KEYS), time_dim),
        "monthly": label_months(count_patients(by_month, MONTH_KEYS), time_dim),
        "model": label_months(count_patients(base, MODEL_KEYS), time_dim),
    }


def distinct_patients(items: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Exact distinct identified patients; the missing id adds one where it occurs."""
    identified = F.col(FLAG) == "Y"
    missing = F.coalesce(
        F.max(F.when(identified & F.col(PATIENT).isNull(), 1).otherwise(0)), F.lit(0)
    )
    return items.groupBy(*keys).agg(
        (F.count_distinct(F.when(identified, F.col(PATIENT))) + missing).alias("PATIENT_COUNT")
    )


def strict_sum(column: str) -> Column:
    """Sum that is NULL when any value is NULL."""
    return F.when(F.count(column) == F.count(F.lit(1)), F.sum(column))


def totals(df: DataFrame, keys: Iterable[str], measures: Iterable[str]) -> DataFrame:
    """Published totals rolled up; a missing value makes its total missing."""
    return df.groupBy(*keys).agg(*[strict_sum(name).alias(name) for name in measures])


def sum_where(condition: Column, column: str) -> Column:
    """Total of the rows that meet a condition, 0 when there are none; a missing value makes it missing."""
    whole = F.count_if(condition & F.col(column).isNull()) == 0
    return F.when(whole, F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0)))


def mean_where(condition: Column, column: str) -> Column:
    """Mean of the rows that meet a condition, NULL when there are none or a value is missing."""
    whole = F.count_if(condition & F.col(column).isNull()) == 0
    return F.when(whole, F.avg(F.when(condition, F.col(column))))


def actual_totals(model_input: DataFrame) -> DataFrame:
    return model_input.groupBy("YEAR_MONTH", "SECTION_CODE").agg(
        F.sum("ITEM_COUNT").alias("total_items")
    )


def actual_against_expected(predictions: DataFrame, first_month: int, last_month: int) -> DataFrame:
    """Per section: actual and expected items of a period, difference and percentage."""
    actual, expected = F.col("total_actual_items"), F.col("total_expected_items")
    return (
        predictions.filter(F.col("YEAR_MONTH").between(first_month, last_month))
        .groupBy("SECTION_CODE")
        .agg(
            strict_sum("total_items").alias("total_actual_items"),
            strict_sum("mean_fit").alias("total_expected_items"),
        )
        .withColumns(
            {
                "difference": actual - expected,
                "percent_diff": scalars.percent_change(actual, expected),
            }
        )
    )
