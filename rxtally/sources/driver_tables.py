"""The prescribing star schema read off the driver's order tables.

Each function gives one of the tables the library takes as input, so every
operator can be run and checked on the tables at hand.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rxtally.functions import dates
from rxtally.sources import calendar

# Part type -> section code; every other kept type is "0411".
SECTION_OF_TYPE = {"ECONOMY": "0401", "LARGE": "0402", "MEDIUM": "0403", "SMALL": "0404"}
OTHER_SECTION = "0411"
EXCLUDED_TYPE = "PROMO"


# Declared, so that opening a table starts no job to look at file footers.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
    "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def fact(spark: SparkSession, folder: str) -> DataFrame:
    """One row per line item, named as a prescription item."""
    items = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    unidentified = F.col("l_returnflag") == "R"
    patient = F.col("o_custkey")
    return items.join(orders, items["l_orderkey"] == orders["o_orderkey"]).select(
        dates.year_month(F.col("o_orderdate")).alias("YEAR_MONTH"),
        F.lit("S").alias("PRESC_TYPE_PRNT"),
        F.col("l_suppkey").alias("PRESC_ID_PRNT"),
        F.col("l_partkey").alias("CALC_PREC_DRUG_RECORD_ID"),
        F.when(unidentified, -1).otherwise((patient % 100).cast("int")).alias("CALC_AGE"),
        F.when(unidentified, 0)
        .when(patient % 50 == 0, 9)
        .otherwise((1 + patient % 2).cast("int"))
        .alias("PDS_GENDER"),
        F.when(patient % 211 != 0, patient).alias("IDENTIFIED_PATIENT_ID"),
        F.when(unidentified, "N").otherwise("Y").alias("IDENTIFIED_FLAG"),
        F.col("l_quantity").cast("bigint").alias("ITEM_COUNT"),
        F.rint(F.col("l_extendedprice") * 100).cast("bigint").alias("ITEM_PAY_DR_NIC"),
    )


def span(spark: SparkSession, folder: str) -> DataFrame:
    """First and last day covered by the orders; one row."""
    day = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").agg(
        F.trunc(F.min(day), "month").alias("FIRST_DAY"), F.last_day(F.max(day)).alias("LAST_DAY")
    )


def time_dim(spark: SparkSession, folder: str) -> DataFrame:
    return calendar.time_dim(span(spark, folder))


def dispensing_days(spark: SparkSession, folder: str) -> DataFrame:
    return calendar.dispensing_days(span(spark, folder))


def organisations(spark: SparkSession, folder: str) -> DataFrame:
    """Every supplier, with country 1 for the first three regions and 2 for the others."""
    nations = table(spark, folder, "nation").select("n_nationkey", "n_regionkey")
    suppliers = table(spark, folder, "supplier").select("s_suppkey", "s_nationkey")
    return suppliers.join(
        nations, suppliers["s_nationkey"] == nations["n_nationkey"]
    ).select(
        F.lit("S").alias("LVL_5_OUPDT"),
        F.col("s_suppkey").alias("LVL_5_OU"),
        F.when(F.col("n_regionkey") <= 2, 1).otherwise(2).alias("COUNTRY"),
    )


def org_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Suppliers of country 1, as a semi-join so Spark's size estimate is the supplier scan."""
    home = table(spark, folder, "nation").filter("n_regionkey <= 2")
    suppliers = table(spark, folder, "supplier")
    return suppliers.join(
        home, suppliers["s_nationkey"] == home["n_nationkey"], "left_semi"
    ).select(F.lit("S").alias("LVL_5_OUPDT"), F.col("s_suppkey").alias("LVL_5_OU"))


def section_code(part_type: Column) -> Column:
    out = F.when(part_type == EXCLUDED_TYPE, "0501")
    for name, code in SECTION_OF_TYPE.items():
        out = out.when(part_type == name, code)
    return out.otherwise(OTHER_SECTION)


def drug_records(spark: SparkSession, folder: str) -> DataFrame:
    """Drug records with the first and last month their classification holds for.

    The classification does not change here, so each record is one row; the
    record-by-month form is the same table with the months written out.
    """
    return (
        table(spark, folder, "part")
        .filter(F.col("p_type") != EXCLUDED_TYPE)
        .select(
            F.col("p_partkey").alias("RECORD_ID"),
            F.lit(100001).alias("VALID_FROM"),
            F.lit(999912).alias("VALID_TO"),
            section_code(F.col("p_type")).alias("BNF_SECTION"),
            F.col("p_type").alias("SECTION_DESCR"),
        )
    )


def drug_by_month(spark: SparkSession, folder: str) -> DataFrame:
    """The record-by-month form: every part of a listed type in every month of the orders.

    Parts are dealt out first: their few files are far smaller than the months that are written out from them.
    """
    bounds = span(spark, folder)
    months = bounds.select(
        F.transform(
            F.sequence("FIRST_DAY", "LAST_DAY", F.expr("interval 1 month")), dates.year_month
        )
    ).scalar()
    parts = table(spark, folder, "part").select("p_partkey", "p_type")
    return (
        parts.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
        .select(
            F.col("p_partkey").alias("RECORD_ID"),
            F.explode(months).alias("YEAR_MONTH"),
            section_code(F.col("p_type")).alias("BNF_CODE"),
            F.col("p_type").alias("SECTION_DESCR"),
        )
    )


def age_dim(spark: SparkSession, folder: str) -> DataFrame:
    """Ages found in the orders with their 5-year band; the unidentified age has none.

    The band comes out of an aggregate on purpose: a filter on it then stays on
    this side of the age join instead of being rewritten into text formatting on
    every item.
    """
    age = F.col("AGE")
    floor = (F.floor(age / 5) * 5).cast("int")
    known = table(spark, folder, "orders").select((F.col("o_custkey") % 100).cast("int").alias("AGE"))
    unknown = spark.range(1).select(F.lit(-1).alias("AGE"))
    band = (
        F.when(age < 0, F.lit(None).cast("string"))
        .when(age >= 90, "90+")
        .otherwise(F.format_string("%02d-%02d", floor, floor + 4))
    )
    ages = known.union(unknown).distinct()
    return ages.groupBy("AGE").agg(F.max(band).alias("DALL_5YR_BAND"))
