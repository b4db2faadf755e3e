"""One query per operator, each over the whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rxtally import schemas
from rxtally.checks.tables import Tables
from rxtally.config import SECTION_NAMES
from rxtally.functions import dates, scalars
from rxtally.operators import aggregates, disclosure, joins, patient_sets, predicates, regression, reshape, windows
from rxtally.operators.regression import Categorical, Crossed, Formula, Numeric
from rxtally.plans import indicators, model, publish
from rxtally.sinks import tables as sinks
from rxtally.sources import calendar, driver_tables, snapshots, tables
from rxtally.streaming import refresh

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def portable(df: DataFrame) -> DataFrame:
    """Types that read the same from any engine: decimals as doubles, dates as text."""
    def cast(field: T.StructField):
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.DecimalType):
            return column.cast("double").alias(field.name)
        if isinstance(field.dataType, T.DateType):
            return column.cast("string").alias(field.name)
        return column

    return df.select(*[cast(field) for field in df.schema.fields])


def rounded(df: DataFrame, **decimals: int) -> DataFrame:
    return df.withColumns({name: F.round(name, places) for name, places in decimals.items()})


def query(build: Callable[[Tables], DataFrame]):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return portable(build(Tables(spark, folder)))

    QUERIES[build.__name__] = run
    return build


def _count(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


def _totals(df: DataFrame, *keys) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("ITEM_COUNT").alias("items"),
        F.sum("ITEM_PAY_DR_NIC").alias("pence"),
    )


def _named(df: DataFrame) -> DataFrame:
    """Saved aggregate with the standard section names put in by code."""
    pairs = [F.lit(text) for pair in SECTION_NAMES.items() for text in pair]
    return df.withColumn("SECTION_NAME", F.create_map(*pairs)[F.col("SECTION_CODE")])


# --- sources ---------------------------------------------------------------


@query
def s1_scan_projected(t: Tables) -> DataFrame:
    part = tables.scan(t.spark, f"{t.folder}/lineitem.parquet", ["l_returnflag", "l_quantity"])
    return part.groupBy("l_returnflag").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


@query
def s2_newest_snapshot(t: Tables) -> DataFrame:
    path = snapshots.newest_snapshot(t.spark, t.folder, r"^lineitem.*\.parquet$")
    return t.spark.read.parquet(path).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("l_quantity").cast("bigint")).alias("quantity")
    )


@query
def s4_fact_scan(t: Tables) -> DataFrame:
    return _totals(tables.prescription_fact(t.fact, 199504, 200106), "YEAR_MONTH", "IDENTIFIED_FLAG")


@query
def s5_time_dimension(t: Tables) -> DataFrame:
    return t.time.drop("QUARTER_KEY")


@query
def s5_time_dimension_from_month(t: Tables) -> DataFrame:
    return calendar.time_dim(driver_tables.span(t.spark, t.folder), start=200001).drop("QUARTER_KEY")


@query
def s6_organisation_dimension(t: Tables) -> DataFrame:
    return tables.organisation_dim(driver_tables.organisations(t.spark, t.folder), t.config.country)


@query
def s7_drug_dimension(t: Tables) -> DataFrame:
    monthly = driver_tables.drug_by_month(t.spark, t.folder)
    return (
        tables.drug_dim(monthly, t.config.sections)
        .groupBy("YEAR_MONTH", "BNF_SECTION", "SECTION_DESCR")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("RECORD_ID").alias("record_sum"))
    )


@query
def s8_age_dimension(t: Tables) -> DataFrame:
    return tables.age_dim(t.age)


@query
def s9_dispensing_days(t: Tables) -> DataFrame:
    return t.days


# --- sinks that are also plans ----------------------------------------------


@query
def k2_s3_snapshot_round_trip(t: Tables) -> DataFrame:
    """Quarterly totals saved in several parts beside an older snapshot, found as the newest, read back whole."""
    folder = t.new_folder()
    older = t.quarterly.filter(F.col("FINANCIAL_YEAR") < "1999")
    sinks.save_snapshot(older, folder, "quarterly", t.config.train_end)
    sinks.save_snapshot(t.quarterly.repartition(3), folder, "quarterly", t.config.predict_end)
    path = snapshots.newest_snapshot(t.spark, folder, r"quarterly/.*\.csv$")
    return snapshots.read_delimited(t.spark, path, schemas.QUARTERLY)


@query
def k2_s2_unfinished_snapshot(t: Tables) -> DataFrame:
    """The newest whole snapshot, although a newer one was begun: its parts are there, its mark is not."""
    folder = t.new_folder()
    sinks.save_snapshot(t.monthly.repartition(3), folder, "monthly", t.config.predict_start, "parquet")
    begun = sinks.snapshot_path(folder, "monthly", t.config.predict_end)
    t.monthly.filter(F.col("YEAR_MONTH") > t.config.train_end).write.parquet(begun)
    path = snapshots.newest_snapshot(t.spark, folder, r"monthly/.*\.parquet$")
    return t.spark.read.schema(schemas.MONTHLY).parquet(path)


def _table_name(prefix: str) -> str:
    return f"{prefix}_{uuid4().hex}"


@query
def k1_materialised_table(t: Tables) -> DataFrame:
    """Monthly totals stored as a month-stamped catalog table and read back."""
    return sinks.materialise(t.monthly, _table_name("k1"), t.config.predict_end)


@query
def k3_model_files(t: Tables) -> DataFrame:
    """Actual and expected items of every month, stored as delimited text and read back."""
    table = model.expected_totals(model.actual_and_expected(t.banded, t.fitted, t.config), t.config)
    path = f"{t.new_folder()}/expected_totals"
    sinks.save_csv(table, path)
    stored = snapshots.read_delimited(t.spark, path, table.schema)
    return rounded(stored, total_expected_items=4, difference=4, percent_diff=6)


@query
def k4_published_table(t: Tables) -> DataFrame:
    """Monthly table stored with title, notes and descriptions, read back with its headings."""
    name = _table_name("k4")
    published = publish.published_monthly(t.monthly)
    return sinks.publish_table(published, name, "Totals by month", ["A note."], publish.DATA_DICTIONARY)


@query
def k5_data_dictionary(t: Tables) -> DataFrame:
    """The stored data dictionary's fields, for every column of the monthly table, with the rows they describe."""
    stored = sinks.materialise(publish.data_dictionary(t.spark), _table_name("k5"))
    headings = publish.published_monthly(t.monthly)
    counts = [F.count(F.col(f"`{name}`")).alias(name) for name in headings.columns]
    filled = headings.agg(*counts).unpivot([], headings.columns, "Field", "n")
    return filled.join(stored, "Field", "left").select("Field", "n", F.col("Description").isNotNull().alias("described"))


@query
def k6b_registered_views(t: Tables) -> DataFrame:
    """Indicators through the view of each section."""
    quarterly, monthly = t.saved("quarterly", "monthly", complete_quarters=True)
    table = indicators.indicator_table(_named(quarterly), _named(monthly))
    names = sinks.register_indicators(table, list(t.config.sections))
    parts = [
        t.spark.table(name).withColumn("SECTION_CODE", F.lit(code)).select(*table.columns)
        for name, code in zip(names, t.config.sections, strict=True)
    ]
    return rounded(reduce(DataFrame.unionByName, parts), Value=6)


@query
def k6_stored_indicators(t: Tables) -> DataFrame:
    """The indicator table stored in one folder per section and read back."""
    quarterly, monthly = t.saved("quarterly", "monthly", complete_quarters=True)
    path = t.new_folder()
    sinks.save_indicators(indicators.indicator_table(_named(quarterly), _named(monthly)), path)
    return rounded(sinks.read_indicators(t.spark, path), Value=6)


@query
def k7_stored_refresh(t: Tables) -> DataFrame:
    """Monthly history stored by month, then extended by the months it lacks."""
    monthly, path = t.monthly, t.new_folder()
    refresh.append_months(monthly.filter(F.col("YEAR_MONTH") <= 199912), path)
    stored = t.spark.read.schema(schemas.MONTHLY).parquet(path)
    refresh.append_months(refresh.new_months(monthly, stored), path)
    return t.spark.read.schema(schemas.MONTHLY).parquet(path)


@query
def k7_incremental_refresh(t: Tables) -> DataFrame:
    monthly = t.monthly
    history = monthly.filter(F.col("YEAR_MONTH") <= 199912)
    return refresh.refreshed(history, monthly)


@query
def k7_incremental_patient_sets(t: Tables) -> DataFrame:
    """All grains from sets of patients stored by month in two runs; the second reads only the months that are new."""
    path = f"{t.new_folder()}/sets"

    def items_between(first: int, last: int) -> DataFrame:
        fact = tables.prescription_fact(t.fact, first, last)
        return joins.star_join(fact, t.time, t.org, t.drug, t.age)

    first, last = t.fact.agg(F.min("YEAR_MONTH"), F.max("YEAR_MONTH")).first()
    refresh.extend_sets(t.spark, path, items_between, first, t.config.train_end)
    sets = refresh.extend_sets(t.spark, path, items_between, first, last)
    out = patient_sets.all_grains(sets, t.time)
    return out.withColumn("YEAR_MONTH", F.col("YEAR_MONTH").cast("string"))


@query
def k7_next_month(t: Tables) -> DataFrame:
    return refresh.next_month(t.fact)


@query
def k8_freshness_gate(t: Tables) -> DataFrame:
    latest = windows.latest_complete_quarter(t.time, "FINANCIAL_QUARTER").select(
        F.col("YEAR_MONTH").alias("LATEST")
    )
    history = t.fact.filter(F.col("YEAR_MONTH") <= 200103)
    stored = history.agg(F.max("YEAR_MONTH")).scalar()
    return latest.withColumn("STORED", stored).withColumn("IS_NEWER", F.col("LATEST") > F.col("STORED"))


# --- projections, filters, predicates ---------------------------------------


@query
def p1_select_columns(t: Tables) -> DataFrame:
    return t.single_use("quarterly").select("FINANCIAL_QUARTER", "SECTION_CODE", "IDENTIFIED_FLAG", "ITEM_COUNT")


@query
def p1b_column_by_value(t: Tables) -> DataFrame:
    rates = publish.identification_rates(t.single_use("quarterly"))
    return rounded(
        rates.filter(F.col("FINANCIAL_QUARTER") == "2000/2001 Q4").select("SECTION_CODE", "RATE"), RATE=8
    )


@query
def p2_drop_column(t: Tables) -> DataFrame:
    return t.single_use("quarterly").drop("ITEM_PAY_DR_NIC")


@query
def p5_derived_columns(t: Tables) -> DataFrame:
    derived = t.fact.withColumns(
        {
            "GENDER": scalars.gender_letter(F.col("PDS_GENDER")),
            "MONTH_NUM": F.col("YEAR_MONTH") % 100,
        }
    )
    return _totals(derived, "GENDER", "MONTH_NUM")


@query
def p6_month_range(t: Tables) -> DataFrame:
    return _totals(t.fact.filter(predicates.month_range(199704, 200106)), "YEAR_MONTH")


@query
def p7_latest_loaded(t: Tables) -> DataFrame:
    return tables.latest_loaded(t.time, t.fact, 199901).drop("QUARTER_KEY")


@query
def p8_equality_filter(t: Tables) -> DataFrame:
    rows = (F.col("SECTION_CODE") == "0403") & (F.col("FINANCIAL_QUARTER") == "2000/2001 Q4")
    return t.single_use("quarterly").filter(rows)


@query
def p9_in_list(t: Tables) -> DataFrame:
    return t.single_use("monthly").filter(F.col("YEAR_MONTH").isin(200104, 200105, 200106))


@query
def p10_not_in(t: Tables) -> DataFrame:
    return t.single_use("quarterly").filter(predicates.not_in("FINANCIAL_YEAR", t.config.chart_skip_years))


@query
def p11_known_person(t: Tables) -> DataFrame:
    return t.model.filter(predicates.known_person(["DALL_5YR_BAND"]))


@query
def p12_at_maximum(t: Tables) -> DataFrame:
    return _totals(predicates.at_maximum(t.fact), "YEAR_MONTH", "IDENTIFIED_FLAG")


@query
def p12_p14_from_partitions(t: Tables) -> DataFrame:
    """Stored items of the last month, known from the table's partitions, and how many years back the first one lies."""
    name = _table_name("p12")
    sinks.save_raw(t.items, name)
    first = t.spark.sql(f"SHOW PARTITIONS {name}").agg(F.min(F.substring_index("partition", "=", -1).cast("int"))).first()[0]
    last = tables.at_largest_partition(t.spark, name)
    return _totals(last, "YEAR_MONTH", "IDENTIFIED_FLAG").withColumn(
        "YEARS_BACK", (F.floor(F.col("YEAR_MONTH") / 100) - first // 100).cast("int")
    )


@query
def p13_distinct_rows(t: Tables) -> DataFrame:
    return t.items.select("YEAR_MONTH", "BNF_SECTION", "SECTION_DESCR").distinct()


@query
def p14_scalar(t: Tables) -> DataFrame:
    latest = t.fact.agg(F.max("YEAR_MONTH")).scalar()
    return _count(t.fact.withColumn("MONTHS_BACK", F.floor(latest / 100) - F.floor(F.col("YEAR_MONTH") / 100)),
                  "MONTHS_BACK").withColumnRenamed("MONTHS_BACK", "YEARS_BACK")


@query
def p15_period_split(t: Tables) -> DataFrame:
    return _totals(predicates.with_period(t.fact, t.config.train_end), "time_period")


# --- joins ------------------------------------------------------------------


@query
def j1_join_time(t: Tables) -> DataFrame:
    return _totals(joins.join_time(t.fact, t.time), "FINANCIAL_YEAR", "FINANCIAL_QUARTER")


@query
def j2_join_organisation(t: Tables) -> DataFrame:
    return _totals(joins.join_organisation(t.fact, t.org), "PRESC_TYPE_PRNT", "PRESC_ID_PRNT")


@query
def j3_join_drug_by_month(t: Tables) -> DataFrame:
    dim = tables.drug_dim(driver_tables.drug_by_month(t.spark, t.folder), t.config.sections)
    return _totals(joins.join_drug(t.fact, dim), "YEAR_MONTH", "BNF_SECTION", "SECTION_DESCR")


@query
def j3_join_drug_by_validity(t: Tables) -> DataFrame:
    return _totals(joins.join_drug(t.fact, t.drug), "YEAR_MONTH", "BNF_SECTION", "SECTION_DESCR")


@query
def j3_drug_runs(t: Tables) -> DataFrame:
    """The record-by-month dimension put together into runs of months."""
    dim = tables.drug_dim(driver_tables.drug_by_month(t.spark, t.folder), t.config.sections)
    return joins.drug_runs(dim)


@query
def j4_join_age(t: Tables) -> DataFrame:
    return _totals(joins.join_age(t.fact, t.age), "DALL_5YR_BAND")


@query
def j5_semi_join(t: Tables) -> DataFrame:
    period = windows.top_values(t.time, "FINANCIAL_QUARTER", 4)
    return joins.keep_listed(t.quarterly, period, "FINANCIAL_QUARTER")


@query
def j6_join_calendar(t: Tables) -> DataFrame:
    return joins.join_calendar(t.monthly, t.days)


@query
def j8_cross_domains(t: Tables) -> DataFrame:
    summed = aggregates.totals(
        t.monthly, ["YEAR_MONTH", "SECTION_CODE", "IDENTIFIED_FLAG"], ["ITEM_COUNT"]
    )
    return reshape.complete(
        summed, ["YEAR_MONTH"], ["SECTION_CODE", "IDENTIFIED_FLAG"], {"ITEM_COUNT": 0}
    )


# --- aggregations -----------------------------------------------------------


@query
def a1_quarterly_totals(t: Tables) -> DataFrame:
    return aggregates.quarterly_totals(t.items, t.time)


@query
def a2_monthly_totals(t: Tables) -> DataFrame:
    return aggregates.monthly_totals(t.items, t.time)


@query
def a3_model_totals(t: Tables) -> DataFrame:
    return aggregates.model_totals(t.items, t.time)


@query
def a4_distinct_patients(t: Tables) -> DataFrame:
    return aggregates.distinct_patients(t.items, ["FINANCIAL_QUARTER", "BNF_SECTION", "IDENTIFIED_FLAG"])


@query
def a4_grains_from_patient_sets(t: Tables) -> DataFrame:
    """Quarterly, monthly and model totals as unions of one table of patient sets."""
    out = patient_sets.all_grains(patient_sets.patient_sets(t.items), t.time)
    return out.withColumn("YEAR_MONTH", F.col("YEAR_MONTH").cast("string"))


@query
def a5_section_months(t: Tables) -> DataFrame:
    return aggregates.totals(
        t.monthly,
        ["YEAR_MONTH", "SECTION_NAME", "SECTION_CODE"],
        ["ITEM_COUNT", "ITEM_PAY_DR_NIC", "PATIENT_COUNT"],
    )


@query
def a6_band_totals(t: Tables) -> DataFrame:
    wide = t.model.withColumn("BAND_20YR", scalars.twenty_year_band(F.col("DALL_5YR_BAND")))
    keys = ["YEAR_MONTH", "SECTION_CODE", "IDENTIFIED_FLAG", "PDS_GENDER", "BAND_20YR"]
    return aggregates.totals(wide, keys, ["ITEM_COUNT", "ITEM_PAY_DR_NIC"])


@query
def a7_actual_totals(t: Tables) -> DataFrame:
    return aggregates.actual_totals(t.banded)


@query
def a9_filtered_totals(t: Tables) -> DataFrame:
    now = F.col("FINANCIAL_QUARTER") == "2001/2002 Q1"
    never = F.col("FINANCIAL_QUARTER") == "1900/1901 Q1"
    return t.quarterly.groupBy("SECTION_CODE").agg(
        aggregates.sum_where(now, "ITEM_COUNT").alias("items_now"),
        aggregates.sum_where(now, "PATIENT_COUNT").alias("patients_now"),
        aggregates.sum_where(never, "ITEM_COUNT").alias("items_never"),
    )


@query
def a10_filtered_means(t: Tables) -> DataFrame:
    rows = (F.col("IDENTIFIED_FLAG") == "Y") & F.col("YEAR_MONTH").between(200007, 200106)
    never = F.col("YEAR_MONTH") == 190001
    out = t.monthly.groupBy("SECTION_CODE").agg(
        aggregates.mean_where(rows, "PATIENT_COUNT").alias("mean_patients"),
        aggregates.mean_where(never, "PATIENT_COUNT").alias("mean_never"),
    )
    return rounded(out, mean_patients=8)


@query
def a11_global_maximum(t: Tables) -> DataFrame:
    return t.fact.agg(F.max("YEAR_MONTH").alias("max_month"), F.min("YEAR_MONTH").alias("min_month"))


@query
def a12_month_list_ends(t: Tables) -> DataFrame:
    latest = t.fact.agg(F.max("YEAR_MONTH").alias("latest"))
    now, before = (dates.trailing_months(F.col("latest"), 12, skip) for skip in (0, 12))
    return latest.select(
        F.array_min(now).alias("first_now"), F.array_max(now).alias("last_now"),
        F.array_min(before).alias("first_before"), F.array_max(before).alias("last_before"),
    )


@query
def a13_quarter_totals(t: Tables) -> DataFrame:
    keys = ["FINANCIAL_QUARTER", "SECTION_NAME", "SECTION_CODE"]
    return aggregates.totals(t.quarterly, keys, ["ITEM_COUNT", "PATIENT_COUNT"])


# --- windows, sorts, sets ---------------------------------------------------


@query
def w1_period_counts(t: Tables) -> DataFrame:
    return windows.with_period_counts(t.time, "FINANCIAL_QUARTER").drop("QUARTER_KEY")


@query
def w2_latest_complete_quarter(t: Tables) -> DataFrame:
    return windows.latest_complete_quarter(t.time, "FINANCIAL_QUARTER")


@query
def w3_month_index(t: Tables) -> DataFrame:
    summed = aggregates.totals(t.monthly, ["YEAR_MONTH", "SECTION_NAME", "SECTION_CODE"], ["ITEM_COUNT"])
    return windows.with_month_index(summed)


@query
def w4_top_quarters(t: Tables) -> DataFrame:
    return windows.top_values(t.single_use("quarterly"), "FINANCIAL_QUARTER", 4)


@query
def w5_latest_quarter(t: Tables) -> DataFrame:
    return windows.latest_quarter(t.single_use("monthly"))


@query
def o1_published_sort(t: Tables) -> DataFrame:
    """All rows with their place inside the quarter: a quarter has a few rows for each section."""
    period = ["FINANCIAL_YEAR", "FINANCIAL_QUARTER"]
    inside = W.partitionBy(*period).orderBy(*publish.order_in_period())
    placed = t.quarterly.withColumn("place", F.row_number().over(inside))
    return publish.published_order(placed, period)


@query
def u1_union_sections(t: Tables) -> DataFrame:
    parts = [t.monthly.filter(F.col("SECTION_CODE") == code) for code in t.config.sections]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


# --- reshape ----------------------------------------------------------------


@query
def t1_flags_to_columns(t: Tables) -> DataFrame:
    keys = ["FINANCIAL_QUARTER", "SECTION_CODE"]
    return reshape.flags_to_columns(t.quarterly, keys, ["ITEM_COUNT", "ITEM_PAY_DR_NIC", "PATIENT_COUNT"])


@query
def t2_quarters_to_columns(t: Tables) -> DataFrame:
    items = t.quarterly.filter(F.col("IDENTIFIED_FLAG") == "Y")
    return reshape.quarters_to_columns(items, ["SECTION_CODE"], "ITEM_COUNT")


@query
def t3_measures_to_rows(t: Tables) -> DataFrame:
    keys = ["YEAR_MONTH", "SECTION_CODE", "IDENTIFIED_FLAG"]
    return reshape.measures_to_rows(t.monthly, keys, ["ITEM_COUNT", "PATIENT_COUNT"])


@query
def t4_complete_5yr(t: Tables) -> DataFrame:
    labels = ["DALL_5YR_BAND", "IDENTIFIED_FLAG", "PDS_GENDER"]
    keys = ["YEAR_MONTH", "SECTION_NAME", "SECTION_CODE"]
    summed = aggregates.totals(t.model, [*keys, *labels], ["ITEM_COUNT", "ITEM_PAY_DR_NIC"])
    return reshape.complete(summed, keys, labels, {"ITEM_COUNT": 0, "ITEM_PAY_DR_NIC": 0})


@query
def t5_month_flags(t: Tables) -> DataFrame:
    months = aggregates.totals(t.monthly, ["YEAR_MONTH"], ["ITEM_COUNT"])
    return reshape.with_month_flags(months.withColumn("MONTH_NUM", F.col("YEAR_MONTH") % 100))


# --- scalar functions over whole tables ---------------------------------------


def _order_day(t: Tables) -> DataFrame:
    return t.raw("orders").select(F.col("o_orderdate").cast("date").alias("d"))


@query
def d1_month_start(t: Tables) -> DataFrame:
    start = dates.month_start(F.col("YEAR_MONTH"))
    return _totals(t.fact.withColumn("MONTH_START", start), "MONTH_START")


@query
def d2_month_number(t: Tables) -> DataFrame:
    return _count(_order_day(t).withColumn("MONTH_NUM", dates.month_number(F.col("d"))), "MONTH_NUM")


@query
def d3_month_index(t: Tables) -> DataFrame:
    index = dates.month_index(dates.month_start(F.col("YEAR_MONTH")), t.config.index_origin)
    return _totals(t.fact.withColumn("MONTH_INDEX", index), "MONTH_INDEX")


@query
def d4_month_arithmetic(t: Tables) -> DataFrame:
    day = F.col("d")
    shifted = {f"minus_{k}": dates.shift_months(day, -k) for k in (1, 3, 12, 60)}
    shifted["plus_1"] = dates.shift_months(day, 1)
    return _count(_order_day(t).withColumns(shifted), "d", *shifted)


@query
def d5_fiscal_parts(t: Tables) -> DataFrame:
    day = F.col("d")
    parts = {"quarter": dates.fiscal_quarter(day), "year": dates.fiscal_year(day)}
    return _count(_order_day(t).withColumns(parts), *parts)


@query
def d6_fiscal_labels(t: Tables) -> DataFrame:
    labels = {"label": dates.fiscal_quarter_label(F.col("d")), "year_label": dates.fiscal_year_label(F.col("d"))}
    return _count(_order_day(t).withColumns(labels), *labels)


@query
def d7_year_month(t: Tables) -> DataFrame:
    return _count(_order_day(t).withColumn("YEAR_MONTH", dates.year_month(F.col("d"))), "YEAR_MONTH")


@query
def d8_month_name(t: Tables) -> DataFrame:
    return _count(_order_day(t).withColumn("name", dates.month_name(F.col("d"))), "name")


@query
def c1_patient_indicator(t: Tables) -> DataFrame:
    flag = scalars.patient_indicator(F.col("IDENTIFIED_FLAG"))
    return _totals(t.fact.withColumn("indicator", flag), "IDENTIFIED_FLAG", "indicator")


@query
def c2_gender_letter(t: Tables) -> DataFrame:
    return _totals(t.fact.withColumn("gender", scalars.gender_letter(F.col("PDS_GENDER"))), "gender")


@query
def c3_known_band(t: Tables) -> DataFrame:
    band = scalars.known_band(F.col("DALL_5YR_BAND"))
    return _totals(joins.join_age(t.fact, t.age).withColumn("band", band), "band")


@query
def c4_twenty_year_band(t: Tables) -> DataFrame:
    band = scalars.twenty_year_band(scalars.known_band(F.col("DALL_5YR_BAND")))
    return _totals(joins.join_age(t.fact, t.age).withColumn("band", band), "band")


@query
def c5_pounds(t: Tables) -> DataFrame:
    return t.fact.groupBy("YEAR_MONTH").agg(scalars.pounds(F.sum("ITEM_PAY_DR_NIC")).alias("pounds"))


def _flag_columns(t: Tables) -> DataFrame:
    return reshape.flags_to_columns(t.quarterly, ["FINANCIAL_QUARTER", "SECTION_CODE"], ["ITEM_COUNT"])


@query
def c6_rate_text(t: Tables) -> DataFrame:
    rate = scalars.identification_rate_text(F.col("ITEM_COUNT_Y"), F.col("ITEM_COUNT_N"))
    return _flag_columns(t).select("FINANCIAL_QUARTER", "SECTION_CODE", rate.alias("RATE"))


@query
def c7_rate_number(t: Tables) -> DataFrame:
    rate = scalars.identification_rate(F.col("ITEM_COUNT_Y"), F.col("ITEM_COUNT_N"))
    return rounded(_flag_columns(t).select("FINANCIAL_QUARTER", "SECTION_CODE", rate.alias("RATE")), RATE=8)


@query
def c8_c9_changes(t: Tables) -> DataFrame:
    now = F.col("FINANCIAL_QUARTER") == "2001/2002 Q1"
    before = F.col("FINANCIAL_QUARTER") == "2000/2001 Q1"
    out = t.quarterly.groupBy("SECTION_CODE").agg(
        aggregates.sum_where(now, "ITEM_COUNT").alias("now"),
        aggregates.sum_where(before, "ITEM_COUNT").alias("before"),
    )
    return rounded(
        out.withColumns(
            {
                "percent": scalars.percent_change(F.col("now"), F.col("before")),
                "absolute": scalars.absolute_change(F.col("now"), F.col("before")),
                "no_base": scalars.percent_change(F.col("now"), F.lit(0)),
            }
        ),
        percent=8,
    )


@query
def c10_three_figures(t: Tables) -> DataFrame:
    out = t.fact.groupBy("CALC_PREC_DRUG_RECORD_ID").agg(F.sum("ITEM_PAY_DR_NIC").alias("pence"))
    return out.withColumns(
        {
            "pence_3": scalars.three_figures(F.col("pence")),
            "negative_3": scalars.three_figures(-F.col("pence")),
        }
    )


@query
def c11_display_text(t: Tables) -> DataFrame:
    out = t.fact.groupBy("CALC_PREC_DRUG_RECORD_ID").agg(F.sum("ITEM_PAY_DR_NIC").alias("pence"))
    ratio = scalars.percent_of(F.col("pence"), F.lit(100_000_000))
    return out.select(
        "CALC_PREC_DRUG_RECORD_ID",
        scalars.display_text(F.col("pence")).alias("shown"),
        scalars.display_text(ratio, percentage=True).alias("shown_percent"),
    )


@query
def c12_month_text(t: Tables) -> DataFrame:
    return _totals(t.fact.withColumn("YEAR_MONTH_string", F.col("YEAR_MONTH").cast("string")), "YEAR_MONTH_string")


@query
def c13_display_names(t: Tables) -> DataFrame:
    named = _named(t.quarterly.select("SECTION_CODE").distinct())
    return named.select(
        "SECTION_CODE",
        scalars.text_name(F.col("SECTION_NAME")).alias("in_text"),
        scalars.item_name(F.col("SECTION_NAME")).alias("before_item"),
        scalars.item_name(F.lit("anything else")).alias("unlisted"),
    )


@query
def c14_period_range(t: Tables) -> DataFrame:
    latest = t.fact.agg(F.max("YEAR_MONTH").alias("latest"))
    start = dates.month_start(F.col("latest"))
    return latest.select(
        dates.range_label(
            dates.month_name(F.add_months(start, -11)), dates.month_name(start)
        ).alias("year_range"),
        dates.range_label(
            dates.fiscal_quarter_label(F.add_months(start, -60)), dates.fiscal_quarter_label(start)
        ).alias("quarter_range"),
    )


# --- regression -------------------------------------------------------------

_SIMPLE = Formula("ITEM_PAY_DR_NIC", (Numeric("ITEM_COUNT"),))
_CELLS = Formula("ITEM_COUNT", (Crossed("GENDER", "BAND"),))
_CELLS_AND_PRICE = Formula("PRICE", (Numeric("ITEM_COUNT"), Crossed("GENDER", "BAND")))


def _people(t: Tables) -> DataFrame:
    """Identified items with gender letter and 20-year band, at item grain."""
    band = scalars.twenty_year_band(scalars.known_band(F.col("DALL_5YR_BAND")))
    out = t.items.withColumns(
        {
            "GENDER": scalars.gender_letter(F.col("PDS_GENDER")),
            "BAND": band,
            "PRICE": F.col("ITEM_PAY_DR_NIC") / 100.0,
        }
    )
    return out.filter((F.col("GENDER") != "U") & (F.col("BAND") != "Unknown"))


@query
def m1_design_terms(t: Tables) -> DataFrame:
    """Every design term of the published model with its total over the training rows."""
    rows = predicates.training_rows(t.banded, t.config.train_end)
    entries = rows.select("SECTION_CODE", F.explode(regression.design(model.FINAL)).alias("e"))
    return entries.groupBy("SECTION_CODE", F.col("e.term").alias("term")).agg(
        F.sum("e.value").alias("total")
    )


@query
def m2_simple_fit(t: Tables) -> DataFrame:
    """One regressor, fitted on every item of every section."""
    fitted = regression.fit(t.items, _SIMPLE, ["BNF_SECTION"])
    out = fitted.select(
        "BNF_SECTION",
        F.col("coef")[0].alias("intercept"),
        F.col("coef")[1].alias("slope"),
        "r_squared",
        "nobs",
    )
    return rounded(out, intercept=3, slope=4, r_squared=9)


@query
def m2_price_within_cells(t: Tables) -> DataFrame:
    """Slope on item count beside a full gender by band crossing, at item grain."""
    fitted = regression.fit(_people(t), _CELLS_AND_PRICE, ["BNF_SECTION"])
    slope = F.element_at("coef", F.array_position("terms", F.lit("ITEM_COUNT")).cast("int"))
    return rounded(fitted.select("BNF_SECTION", slope.alias("slope"), "deviance", "rank"), slope=6, deviance=0)


@query
def m3_fit_statistics(t: Tables) -> DataFrame:
    out = regression.fit_statistics(t.fitted, model.BY).drop("MODEL")
    return rounded(
        out, r_squared=8, adj_r_squared=8, sigma=6, statistic=6, statistic_p=6, log_lik=6, aic=6, bic=6, deviance=2
    )


@query
def m4_coefficients(t: Tables) -> DataFrame:
    out = regression.coefficient_table(t.fitted, model.BY).drop("MODEL")
    return rounded(out, estimate=6, std_error=6, t_value=6, p_value=6)


@query
def m5_nested_by_aic(t: Tables) -> DataFrame:
    out = model.compare_nested(t.banded, t.config)
    kept = out.select("MODEL", "SECTION_CODE", "aic", "df", "nobs", "aic_rank")
    return rounded(kept, aic=6)


@query
def m5_bands_by_aic(t: Tables) -> DataFrame:
    both = model.both_bands_input(t.model, t.days, t.config)
    out = model.compare_bands(both, t.config)
    kept = out.select("MODEL", "SECTION_CODE", "aic", "df", "nobs", "aic_rank")
    return rounded(kept, aic=4)


@query
def m6_diagnostics(t: Tables) -> DataFrame:
    rows = predicates.training_rows(t.banded, t.config.train_end)
    out = regression.residual_diagnostics(rows, t.fitted, model.FINAL, model.BY).select(
        "SECTION_CODE", "YEAR_MONTH", "PDS_GENDER", "BAND_20YR", "ITEM_COUNT",
        "fitted", "residual", "leverage", "std_residual", "cooks_distance",
    )
    return rounded(out, fitted=6, residual=6, leverage=9, std_residual=7, cooks_distance=8)


@query
def m6_cell_diagnostics(t: Tables) -> DataFrame:
    """Fitted value and leverage at item grain for a saturated gender by band model."""
    people = _people(t)
    fitted = regression.fit(people, _CELLS, ["BNF_SECTION"])
    rows = regression.residual_diagnostics(people, fitted, _CELLS, ["BNF_SECTION"])
    out = rows.groupBy("BNF_SECTION", "GENDER", "BAND").agg(
        F.count(F.lit(1)).alias("n"),
        F.avg("fitted").alias("fitted"),
        F.sum("leverage").alias("leverage"),
        F.sum("residual").alias("residual"),
    )
    return rounded(out, fitted=6, leverage=8, residual=4)


@query
def m7_point_predictions(t: Tables) -> DataFrame:
    months = predicates.month_range(t.config.predict_start, t.config.predict_end)
    out = regression.predict(t.banded.filter(months), t.fitted, model.FINAL, model.BY)
    return rounded(
        out.select("SECTION_CODE", "YEAR_MONTH", "PDS_GENDER", "BAND_20YR", "fitted"), fitted=6
    )


@query
def m8_weighted_sums(t: Tables) -> DataFrame:
    """Weighted prediction of a saturated cell model, the item count being the weight."""
    people = _people(t)
    fitted = regression.fit(people, _CELLS, ["BNF_SECTION"])
    out = regression.predict_sums(
        people, fitted, _CELLS, ["BNF_SECTION"], ["YEAR_MONTH"], F.col("ITEM_COUNT")
    )
    shown = out.select(
        "BNF_SECTION", "YEAR_MONTH", "mean", "var",
        F.col("ci_half")[0].alias("ci95"), F.col("pi_half")[1].alias("pi99"),
    )
    return rounded(shown, mean=4, var=4, ci95=5, pi99=5)


def _round_predictions(df: DataFrame) -> DataFrame:
    return rounded(df, mean_fit=5, var=4, PIlwr=5, PIupr=5, PIlwr99=5, PIupr99=5)


@query
def m9_monthly_expected(t: Tables) -> DataFrame:
    return _round_predictions(model.expected(t.banded, t.fitted, t.config))


@query
def m10_actual_and_expected(t: Tables) -> DataFrame:
    return _round_predictions(model.actual_and_expected(t.banded, t.fitted, t.config))


@query
def m12_input_20yr(t: Tables) -> DataFrame:
    return model.banded_input(t.model, t.days, t.config)


@query
def m12_input_5yr(t: Tables) -> DataFrame:
    return model.banded_input(t.model, t.days, t.config, "DALL_5YR_BAND")


@query
def m12_input_both(t: Tables) -> DataFrame:
    return model.both_bands_input(t.model, t.days, t.config)


@query
def m12_input_section(t: Tables) -> DataFrame:
    return model.section_level_input(t.monthly, t.days)


# --- products ---------------------------------------------------------------

_RAW_COLUMNS = [
    "YEAR_MONTH", "FINANCIAL_YEAR", "FINANCIAL_QUARTER", "PRESC_TYPE_PRNT", "PRESC_ID_PRNT",
    "CALC_PREC_DRUG_RECORD_ID", "BNF_SECTION", "SECTION_DESCR", "CALC_AGE", "DALL_5YR_BAND",
    "PDS_GENDER", "IDENTIFIED_PATIENT_ID", "IDENTIFIED_FLAG", "ITEM_COUNT", "ITEM_PAY_DR_NIC",
]


@query
def q1_raw_items(t: Tables) -> DataFrame:
    """The joined items, written as text where a value may be missing."""
    patient = F.col("IDENTIFIED_PATIENT_ID").cast("string")
    return t.items.select(*_RAW_COLUMNS).withColumn("IDENTIFIED_PATIENT_ID", patient)


@query
def q1_stored_raw_of_a_year(t: Tables) -> DataFrame:
    """Items stored by month, read back for the months of one fiscal year of the time dimension."""
    name = _table_name("q1")
    sinks.save_raw(t.items, name)
    year = t.time.filter(F.col("FINANCIAL_YEAR") == "1999/2000")
    return _totals(tables.raw_of_periods(t.spark, name, year), "YEAR_MONTH", "BNF_SECTION", "SECTION_DESCR")


@query
def q2_all_grains(t: Tables) -> DataFrame:
    """Quarterly, monthly and model totals from one shared patient base."""
    from rxtally.plans.extract import all_grains

    out = all_grains(t.items, t.time)
    return out.withColumn("YEAR_MONTH", F.col("YEAR_MONTH").cast("string"))


@query
def q3_identification_text(t: Tables) -> DataFrame:
    return publish.identification_text(t.quarterly, t.config.rate_quarters)


@query
def q3_identification_table(t: Tables) -> DataFrame:
    out = publish.identification_table(t.quarterly)
    return rounded(out, **{name: 8 for name in out.columns if name[:4].isdigit()})


@query
def q4_monthly_series(t: Tables) -> DataFrame:
    return publish.monthly_series(t.monthly, t.days)


@query
def q5_quarterly_figures(t: Tables) -> DataFrame:
    return publish.quarterly_figures(t.quarterly, t.config)


@query
def q6_monthly_figures(t: Tables) -> DataFrame:
    return publish.monthly_figures(publish.monthly_series(t.monthly, t.days), t.config)


@query
def q7_expected_figures(t: Tables) -> DataFrame:
    table = model.actual_and_expected(t.banded, t.fitted, t.config)
    return _round_predictions(model.expected_figures(table, t.config))


@query
def q8_expected_totals(t: Tables) -> DataFrame:
    table = model.actual_and_expected(t.banded, t.fitted, t.config)
    return rounded(
        model.expected_totals(table, t.config),
        total_expected_items=4, difference=4, percent_diff=6,
    )


@query
def q9_indicators(t: Tables) -> DataFrame:
    quarterly, monthly = t.saved("quarterly", "monthly", complete_quarters=True)
    return rounded(indicators.indicator_table(_named(quarterly), _named(monthly)), Value=6)


@query
def q10_published_monthly(t: Tables) -> DataFrame:
    return publish.published_monthly(t.monthly)


@query
def q10_published_quarterly(t: Tables) -> DataFrame:
    return publish.published_quarterly(t.quarterly)


# --- rules of the method text -------------------------------------------------


@query
def x1_disclosure_control(t: Tables) -> DataFrame:
    out = publish.disclosure_control(t.model)
    measures = ["ITEM_COUNT", "ITEM_PAY_DR_NIC", "PATIENT_COUNT"]
    return out.withColumns({name: F.col(name).cast("double") for name in measures})


@query
def x1_secondary_suppression(t: Tables) -> DataFrame:
    """Controlled quarterly, monthly and person cells: equations with a single unknown, small or changed cells shown."""
    names = ("quarterly", "monthly", "model")
    exact = dict(zip(names, t.saved(*names), strict=True))
    return disclosure.audit(exact, disclosure.controlled_grains(exact))


@query
def x2_age_at_september(t: Tables) -> DataFrame:
    """Orders by the age their date would give on 30 September five fiscal years later."""
    day = F.col("d")
    dated = _order_day(t).withColumn("fy", dates.fiscal_year_label(F.add_months(day, 60)))
    return _count(dated.withColumn("age", publish.age_at_september("d", "fy")), "fy", "age")


@query
def x3_deprivation_decile(t: Tables) -> DataFrame:
    """Items by decile; suppliers stand for postcodes and nations for areas."""
    suppliers = t.raw("supplier").select(
        F.col("s_suppkey").alias("POSTCODE"), F.col("s_nationkey").alias("AREA")
    )
    areas = t.raw("nation").select(
        F.col("n_nationkey").alias("AREA"), (F.col("n_nationkey") % 10 + 1).alias("DECILE")
    )
    placed = publish.deprivation_decile(t.fact, suppliers, areas, "PRESC_ID_PRNT")
    return _totals(placed, "DECILE")
