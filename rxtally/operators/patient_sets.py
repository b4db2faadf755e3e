"""Exact patient counts from stored sets: one bitmap table for all grains, extended by new months only.

Numbers of patients do not add up over months or bands, but sets of patients do. Each month, section, flag, gender and
band has its items, its cost, and its patients as bitmaps of 32,768 ids; a missing id counts as one patient and is kept
as a mark beside them. Unions of bitmaps give the patients of any coarser grain, so a stored month is never read again
from the items.

Patient rows are shuffled once, reduced on the map side, to one row for each patient and cell; after that only bitmaps
move. A bitmap has 4 KB before compression whatever it holds: ids should be record numbers without large gaps, and not
hashes.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtally.functions import scalars
from rxtally.operators import aggregates
from rxtally.operators.aggregates import FLAG, MODEL_KEYS, MONTH_KEYS, PATIENT, QUARTER_KEYS
from rxtally.sources.calendar import keyed_time_dim

SCHEMA = (
    "SECTION_DESCR string, BNF_SECTION string, IDENTIFIED_FLAG string, PDS_GENDER string, DALL_5YR_BAND string, "
    "BUCKET bigint, PATIENTS binary, MISSING int, ITEM_COUNT bigint, ITEM_PAY_DR_NIC bigint, YEAR_MONTH int"
)


def patient_sets(items: DataFrame) -> DataFrame:
    """One row for each month, section, flag, gender, band and bucket of patient ids; the missing id has no bucket."""
    people = aggregates.per_patient(aggregates.recode_person(items), MODEL_KEYS)
    placed = people.withColumns(
        {"BUCKET": F.bitmap_bucket_number(PATIENT), "_POSITION": F.bitmap_bit_position(PATIENT)}
    )
    return placed.groupBy(*MODEL_KEYS, "BUCKET").agg(
        F.bitmap_construct_agg("_POSITION").alias("PATIENTS"),
        F.max(F.col(PATIENT).isNull().cast("int")).alias("MISSING"),
        F.sum("ITEM_COUNT").alias("ITEM_COUNT"),
        F.sum("ITEM_PAY_DR_NIC").alias("ITEM_PAY_DR_NIC"),
    )


def united(sets: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Sets of a coarser grain."""
    return sets.groupBy(*keys, "BUCKET").agg(
        F.bitmap_or_agg("PATIENTS").alias("PATIENTS"),
        F.max("MISSING").alias("MISSING"),
        F.sum("ITEM_COUNT").alias("ITEM_COUNT"),
        F.sum("ITEM_PAY_DR_NIC").alias("ITEM_PAY_DR_NIC"),
    )


def _patients() -> Column:
    """Patients of all buckets, the missing id as one; none of unidentified items."""
    every = F.sum(F.when(F.col("BUCKET").isNotNull(), F.bitmap_count("PATIENTS")).otherwise(0)) + F.max("MISSING")
    return (scalars.patient_indicator(F.col(FLAG)) * every).cast("long")


def counted(sets: DataFrame, keys: list[str]) -> DataFrame:
    """Section totals with exact patient counts; ``sets`` are of this grain."""
    return (
        sets.groupBy(*keys)
        .agg(
            F.sum("ITEM_COUNT").alias("ITEM_COUNT"),
            scalars.pounds(F.sum("ITEM_PAY_DR_NIC")).alias("ITEM_PAY_DR_NIC"),
            _patients().alias("PATIENT_COUNT"),
        )
        .withColumnsRenamed({"SECTION_DESCR": "SECTION_NAME", "BNF_SECTION": "SECTION_CODE"})
    )


def grains_from_sets(sets: DataFrame, time_dim: DataFrame) -> dict[str, DataFrame]:
    """The three published grains; quarters are unions of the months' sets."""
    by_month = united(sets, MONTH_KEYS)
    keyed = by_month.join(keyed_time_dim(time_dim).select("YEAR_MONTH", "QUARTER_KEY"), "YEAR_MONTH", "left")
    by_quarter = united(keyed, QUARTER_KEYS)
    return {
        "quarterly": aggregates.label_quarters(counted(by_quarter, QUARTER_KEYS), time_dim),
        "monthly": aggregates.label_months(counted(by_month, MONTH_KEYS), time_dim),
        "model": aggregates.label_months(counted(sets, MODEL_KEYS), time_dim),
    }


def all_grains(sets: DataFrame, time_dim: DataFrame) -> DataFrame:
    """The grains in one frame, told apart by ``GRAIN``, as ``extract.all_grains`` gives them."""
    labelled = [df.withColumn("GRAIN", F.lit(name)) for name, df in grains_from_sets(sets, time_dim).items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)
