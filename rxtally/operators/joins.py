"""Star join, semi-join filters and calendar joins.

No side is broadcast by hint here: Spark broadcasts a dimension whose measured
size is under its threshold and otherwise shuffles, where adaptive execution
splits the partitions of a hot key. Only a drug dimension by months is always
shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rxtally.sources.calendar import keyed_time_dim

BLOCK = 20  # month keys counted in one row; a year's twelve lie in one block of its hundred keys


def join_time(fact: DataFrame, time_dim: DataFrame) -> DataFrame:
    return fact.join(time_dim, "YEAR_MONTH")


def join_organisation(fact: DataFrame, org_dim: DataFrame) -> DataFrame:
    keys = (fact["PRESC_TYPE_PRNT"] == org_dim["LVL_5_OUPDT"]) & (
        fact["PRESC_ID_PRNT"] == org_dim["LVL_5_OU"]
    )
    return fact.join(org_dim, keys).drop("LVL_5_OUPDT", "LVL_5_OU")


def join_drug(fact: DataFrame, drug_dim: DataFrame) -> DataFrame:
    """Section of the drug in the month of the item.

    Takes the dimension with one row per record and month, or with one row per
    record and run of months (``VALID_FROM``, ``VALID_TO``). The second form is
    the one to use at scale: it is shorter by the number of months.
    """
    if "VALID_FROM" in drug_dim.columns:
        record = fact["CALC_PREC_DRUG_RECORD_ID"] == drug_dim["RECORD_ID"]
        month = fact["YEAR_MONTH"].between(drug_dim["VALID_FROM"], drug_dim["VALID_TO"])
        return fact.join(drug_dim, record & month).drop("RECORD_ID", "VALID_FROM", "VALID_TO")
    years = drug_years(drug_dim)
    record = fact["CALC_PREC_DRUG_RECORD_ID"] == years["RECORD_ID"]
    year = F.floor(fact["YEAR_MONTH"] / BLOCK) == years["_block"]
    # Merged: Spark takes the size of months for that of the files they were written out from, and would broadcast them.
    place = F.pmod(fact["YEAR_MONTH"], F.lit(BLOCK)).cast("int")
    copies = F.coalesce(F.get("_counts", place), F.getbit("_months", place)).cast("int")
    found = fact.join(years.hint("merge"), record & year).withColumn("_copy", F.explode(F.array_repeat(F.lit(0), copies)))
    return found.drop("RECORD_ID", "_block", "_months", "_counts", "_copy")


def drug_years(by_month: DataFrame) -> DataFrame:
    """Drug dimension with one row per record, section and year, its months as the bits of ``_months``.

    The months are put together before they are sent, so that few rows are. ``_block`` is the month key divided by
    ``BLOCK``, and the rest of that division the place of the bit. Where a month has repeated rows, ``_counts`` has
    their number by place; else it is null.
    """
    same = [name for name in by_month.columns if name != "YEAR_MONTH"]
    place = F.pmod("YEAR_MONTH", F.lit(BLOCK))
    counts = [F.count_if(place == k).alias(f"_{k}") for k in range(BLOCK)]
    found = by_month.filter("RECORD_ID is not null and YEAR_MONTH is not null")
    found = found.groupBy(*same, F.floor(F.col("YEAR_MONTH") / BLOCK).alias("_block")).agg(*counts)
    each = [F.col(f"_{k}") for k in range(BLOCK)]
    months = sum((F.shiftleft((n > 0).cast("long"), k) for k, n in enumerate(each)), F.lit(0).cast("long"))
    repeats = F.when(F.greatest(*each) > 1, F.array(*each))
    return found.select(*same, "_block", months.alias("_months"), repeats.alias("_counts"))


def drug_runs(by_month: DataFrame) -> DataFrame:
    """Drug dimension with one row per record and unbroken run of months in a section.

    A record has at most one row per month, which bounds each window. The result
    is what :func:`join_drug` takes to join a large fact with: a dimension too
    large to broadcast by month often fits once its months are put together.
    """
    same = ["RECORD_ID", "BNF_SECTION", "SECTION_DESCR"]
    place = F.floor(F.col("YEAR_MONTH") / 100) * 12 + F.col("YEAR_MONTH") % 100
    order = W.partitionBy(*same).orderBy("YEAR_MONTH")
    return (
        by_month.select(*same, "YEAR_MONTH")
        .withColumn("_run", place - F.row_number().over(order))
        .groupBy(*same, "_run")
        .agg(F.min("YEAR_MONTH").alias("VALID_FROM"), F.max("YEAR_MONTH").alias("VALID_TO"))
        .drop("_run")
    )


def join_age(fact: DataFrame, age_dim: DataFrame) -> DataFrame:
    """Inner, so an item without an age is left out; an age without a band stays."""
    return fact.join(age_dim, fact["CALC_AGE"] == age_dim["AGE"]).drop("AGE")


def star_join(
    fact: DataFrame,
    time_dim: DataFrame,
    org_dim: DataFrame,
    drug_dim: DataFrame,
    age_dim: DataFrame,
) -> DataFrame:
    """Items with their period, organisation, drug section and age band.

    The two dimensions that drop rows, one country and the listed sections, come
    first, so the others are looked up for the rows that stay.
    """
    out = join_organisation(fact, org_dim)
    out = join_drug(out, drug_dim)
    out = join_time(out, keyed_time_dim(time_dim))
    return join_age(out, age_dim)


def keep_listed(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is in a one-column frame."""
    return df.join(listed.select(key).distinct(), key, "left_semi")


def join_calendar(df: DataFrame, calendar: DataFrame, key: str = "YEAR_MONTH") -> DataFrame:
    """Left join to a month calendar; a missing month gives NULL, NULL matches NULL."""
    other = calendar.withColumnRenamed(key, "_CALENDAR_KEY")
    match = df[key].eqNullSafe(other["_CALENDAR_KEY"])
    return df.join(other, match, "left").drop("_CALENDAR_KEY")


def attach_predictions(actual: DataFrame, predicted: DataFrame) -> DataFrame:
    """Actual totals beside predictions of the same section and month."""
    return actual.join(predicted, ["SECTION_CODE", "YEAR_MONTH"], "left").withColumn(
        "YEAR_MONTH_string", F.col("YEAR_MONTH").cast("string")
    )
