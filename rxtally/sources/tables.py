"""Scans of the warehouse tables: projected, filtered, left lazy for pushdown."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxtally import schemas


def scan(
    spark: SparkSession,
    table: str,
    columns: Iterable[str] | None = None,
    schema: str | None = None,
) -> DataFrame:
    """A catalog table by name, or a parquet path when the name contains a slash."""
    if "/" in table:
        df = spark.read.parquet(table)
    else:
        df = spark.table(f"{schema}.{table}" if schema else table)
    return df.select(*columns) if columns else df


def scan_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    lower: int,
    upper: int,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A database table read by many tasks at once, split on a numeric key."""
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=properties or {},
    )


def prescription_fact(
    table: DataFrame, first_month: int | None = None, last_month: int | None = None
) -> DataFrame:
    """The fact columns the extract reads, optionally between two months."""
    out = table.select(*schemas.FACT.fieldNames())
    if first_month is not None:
        out = out.filter(F.col("YEAR_MONTH") >= first_month)
    if last_month is not None:
        out = out.filter(F.col("YEAR_MONTH") <= last_month)
    return out


def organisation_dim(table: DataFrame, country: int = 1) -> DataFrame:
    """Prescribing organisations of one country."""
    return table.filter(F.col("COUNTRY") == country).select(*schemas.ORG_DIM.fieldNames())


def drug_dim(table: DataFrame, section_codes: Iterable[str]) -> DataFrame:
    """Drug records of the listed sections, one row per record and month."""
    section = F.substring("BNF_CODE", 1, 4)
    return table.filter(section.isin(*section_codes)).select(
        "RECORD_ID", "YEAR_MONTH", section.alias("BNF_SECTION"), "SECTION_DESCR"
    )


def age_dim(table: DataFrame) -> DataFrame:
    return table.select(*schemas.AGE_DIM.fieldNames())


def latest_loaded(dim: DataFrame, fact: DataFrame, first_month: int) -> DataFrame:
    """Calendar rows from ``first_month`` up to the last month the fact holds."""
    loaded = fact.agg(F.max("YEAR_MONTH").alias("LOADED")).scalar()
    return dim.filter((F.col("YEAR_MONTH") >= first_month) & (F.col("YEAR_MONTH") <= loaded))


def largest_partition(spark: SparkSession, table: str, key: str = "YEAR_MONTH") -> int | None:
    """The largest key of a stored table partitioned by it, from the catalog: no file is opened."""
    value = F.regexp_extract("partition", rf"(?:^|/){key}=([0-9]+)(?:/|$)", 1)
    return spark.sql(f"SHOW PARTITIONS {table}").agg(F.max(value.cast("int"))).first()[0]


def at_largest_partition(spark: SparkSession, table: str, key: str = "YEAR_MONTH") -> DataFrame:
    """The rows of the last stored month: one partition is read, once."""
    return spark.table(table).filter(F.col(key) == F.lit(largest_partition(spark, table, key)))


def raw_of_periods(spark: SparkSession, table: str, periods: DataFrame) -> DataFrame:
    """Stored items of the months in ``periods``.

    A join by month, so that Spark works out the months first and reads only their partitions.
    """
    months = periods.select(F.col("YEAR_MONTH").alias("_MONTH")).distinct()
    raw = spark.table(table)
    return raw.join(months, raw["YEAR_MONTH"] == months["_MONTH"]).drop("_MONTH")
