import time

import pytest
from pyspark.sql import functions as F

from rxtally import schemas
from rxtally.config import DEC_2022, SECTION_NAMES
from rxtally.plans import indicators, publish
from rxtally.sinks import tables as sinks
from rxtally.sources import calendar, snapshots, tables
from rxtally.streaming import refresh

QUARTERLY = "2022/2023"


def monthly_rows(months, items=10):
    return [
        (QUARTERLY, "2022/2023 Q3", m, "n", "0401", flag, items, None, 2 if flag == "Y" else 0)
        for m in months
        for flag in "YN"
    ]


def monthly(spark, months, items=10):
    return spark.createDataFrame(monthly_rows(months, items), schemas.MONTHLY)


def test_newest_snapshot_among_matches(spark, tmp_path):
    for name in ("saved_monthly_1.csv", "saved_monthly_2.csv", "saved_quarterly.csv"):
        (tmp_path / name).write_text("a\n1\n")
        time.sleep(1.1)
    assert snapshots.newest_snapshot(spark, str(tmp_path), "monthly").endswith("monthly_2.csv")
    with pytest.raises(FileNotFoundError):
        snapshots.newest_snapshot(spark, str(tmp_path), "weekly")


def test_delimited_codes_keep_leading_zeros(spark, tmp_path):
    path = tmp_path / "q.csv"
    names = schemas.QUARTERLY.fieldNames()
    path.write_text(",".join(names) + "\n2022/2023,2022/2023 Q3,n,0401,Y,5,12.34,3\n")
    row = snapshots.read_delimited(spark, str(path), schemas.QUARTERLY).first()
    assert row["SECTION_CODE"] == "0401" and str(row["ITEM_PAY_DR_NIC"]) == "12.34"


def test_snapshot_round_trip(spark, tmp_path):
    df = monthly(spark, [202210, 202211])
    for month in (202211, 202212):
        part = df.filter(F.col("YEAR_MONTH") <= month).repartition(3, "YEAR_MONTH")
        sinks.save_snapshot(part, str(tmp_path), "monthly", month)
    newest = snapshots.newest_snapshot(spark, str(tmp_path), r"monthly/.*\.csv$")
    assert newest.endswith("monthly/snapshot=202212")
    again = snapshots.read_delimited(spark, newest, schemas.MONTHLY)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, df.collect()))


def test_a_snapshot_without_its_mark_is_not_found(spark, tmp_path):
    df = monthly(spark, [202210])
    whole = sinks.save_snapshot(df, str(tmp_path), "monthly", 202210, "parquet")
    df.repartition(2).write.parquet(sinks.snapshot_path(str(tmp_path), "monthly", 202211))
    assert snapshots.newest_snapshot(spark, str(tmp_path), r"monthly/.*\.parquet$").endswith(whole)
    with pytest.raises(FileNotFoundError):
        snapshots.newest_snapshot(spark, str(tmp_path), "snapshot=202211")


def test_materialise_replaces_the_month_stamped_table(spark):
    sinks.materialise(spark.range(3).toDF("x"), "tdim", 202212)
    out = sinks.materialise(spark.range(5).toDF("x"), "tdim", 202212)
    assert out.count() == 5 and spark.catalog.tableExists("tdim_202212")


def test_raw_items_are_partitioned_by_month(spark, sf_dir):
    from rxtally.checks.tables import Tables

    items = Tables(spark, sf_dir).items
    stored = sinks.save_raw(items, "raw_items")
    assert stored.count() == items.count()
    plan = stored.filter("YEAR_MONTH = 200001")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(YEAR_MONTH" in plan


def test_published_table_keeps_title_notes_and_headings(spark):
    df = publish.published_monthly(monthly(spark, [202210]))
    out = sinks.publish_table(df, "published_monthly", "It's a title", ["first"], publish.DATA_DICTIONARY)
    assert out.columns == list(publish.MONTHLY_HEADINGS.values())
    shown = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES published_monthly").collect()}
    assert shown["title"] == "It's a title" and shown["note_1"] == "first"
    assert out.schema["Year Month"].metadata["comment"]


def test_data_dictionary_covers_every_heading(spark):
    fields = {r["Field"] for r in publish.data_dictionary(spark).collect()}
    assert fields == set(publish.MONTHLY_HEADINGS.values())


def test_indicator_sink_refuses_to_overwrite(spark, tmp_path):
    df = spark.createDataFrame([("0401", 1, "a", "b", "p", "m", 1.0, "1")], schemas.INDICATORS)
    path = str(tmp_path / "indicators")
    sinks.save_indicators(df, path)
    with pytest.raises(Exception, match="already exists"):
        sinks.save_indicators(df, path)
    assert sinks.register_indicators(df, ["0401"]) == ["table_0401"]
    assert spark.table("table_0401").count() == 1


def test_csv_sink(spark, tmp_path):
    sinks.save_csv(spark.range(2).toDF("x"), str(tmp_path / "model"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "model")).count() == 2


def test_refresh_appends_only_new_months(spark, tmp_path):
    history, extract = monthly(spark, [202210, 202211]), monthly(spark, [202211, 202212], items=99)
    found = refresh.refreshed(history, extract).groupBy("YEAR_MONTH").agg(F.max("ITEM_COUNT").alias("n"))
    assert {r["YEAR_MONTH"]: r["n"] for r in found.collect()} == {202210: 10, 202211: 10, 202212: 99}
    empty = history.filter("false")
    assert refresh.new_months(extract, empty).count() == extract.count()
    path = str(tmp_path / "history")
    refresh.append_months(history, path)
    for _ in range(2):
        refresh.append_months(refresh.new_months(extract, spark.read.parquet(path)), path)
    assert spark.read.parquet(path).count() == 6


def test_freshness_gate(spark):
    from rxtally.sources import calendar

    dim = calendar.time_dim(calendar.fixed_span(spark, 202207, 202302))
    assert refresh.is_newer(dim, monthly(spark, [202209]), "FINANCIAL_QUARTER")
    assert not refresh.is_newer(dim, monthly(spark, [202212]), "FINANCIAL_QUARTER")
    assert refresh.next_month(monthly(spark, [202212])).first()["NEXT_MONTH"] == 202301


def test_dimension_scans(spark):
    drugs = spark.createDataFrame(
        [(1, 202210, "040301AB", "x"), (2, 202210, "0501", "y")],
        "RECORD_ID bigint, YEAR_MONTH int, BNF_CODE string, SECTION_DESCR string",
    )
    found = tables.drug_dim(drugs, DEC_2022.sections).collect()
    assert [(r["RECORD_ID"], r["BNF_SECTION"]) for r in found] == [(1, "0403")]
    orgs = spark.createDataFrame([("S", 1, 1), ("S", 2, 2)], "LVL_5_OUPDT string, LVL_5_OU bigint, COUNTRY int")
    assert [r["LVL_5_OU"] for r in tables.organisation_dim(orgs, 1).collect()] == [1]


def test_scan_pushes_filter_and_columns(spark, sf_dir):
    df = tables.scan(spark, f"{sf_dir}/lineitem.parquet", ["l_quantity", "l_returnflag"])
    plan = df.filter("l_returnflag = 'R'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(l_returnflag,R)" in plan and "l_shipdate" not in plan


def quarter_rows(label, items, patients, name):
    return [
        (label[:9], label, name, "0403", "Y", items, None, patients),
        (label[:9], label, name, "0403", "N", 10, None, 0),
    ]


def test_indicator_lines(spark):
    name = SECTION_NAMES["0403"]
    quarterly = spark.createDataFrame(
        quarter_rows("2022/2023 Q3", 110, 50, name) + quarter_rows("2021/2022 Q3", 90, 40, name),
        schemas.QUARTERLY,
    )
    months = [
        ("2022/2023", "2022/2023 Q3", m, name, "0403", "Y", 5, None, 4)
        for m in (202112, 202201, 202212)
    ]
    table = indicators.indicator_table(quarterly, spark.createDataFrame(months, schemas.MONTHLY))
    lines = {r["LINE"]: r for r in table.collect()}
    assert len(lines) == 25
    assert lines[1]["Value"] == 120 and lines[1]["Period"] == "2022/2023 Q3"
    assert lines[2]["Value"] == 100 and lines[3]["Rounded"] == "20.0%"
    assert lines[4]["Value"] == 0 and lines[5]["Value"] is None and lines[5]["Rounded"] is None
    assert lines[6]["Period"] == "2017/2018 Q3"
    assert lines[20]["Period"] == "January 2022 to December 2022" and lines[20]["Value"] == 4
    assert lines[23]["Value"] == 10 and lines[24]["Value"] == 5
    assert lines[1]["Section_Formatted"] == "antidepressant drug item"


def test_quarter_keys_agree_whatever_month_a_table_begins_in(spark):
    span = calendar.fixed_span(spark, 202205, 202212)
    plain = calendar.time_dim(span).drop("QUARTER_KEY")
    keys = {r["YEAR_MONTH"]: r["QUARTER_KEY"] for r in calendar.keyed_time_dim(plain).collect()}
    full = calendar.time_dim(calendar.fixed_span(spark, 202101, 202312)).collect()
    assert keys == {r["YEAR_MONTH"]: r["QUARTER_KEY"] for r in full if r["YEAR_MONTH"] in keys}
