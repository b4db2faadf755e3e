from dataclasses import replace

from helpers import drugs
from pyspark.sql import functions as F

from rxtally.checks.tables import Tables
from rxtally.operators import disclosure, joins
from rxtally.plans import publish, release
from rxtally.sinks import manifest
from rxtally.sources import calendar, driver_tables, snapshots
from rxtally import schemas


def test_release_from_tables_to_files(spark, sf_dir, tmp_path):
    t = Tables(spark, sf_dir)
    inputs = release.Inputs(t.fact, t.time, t.org, t.drug, t.age, t.days)
    done = release.build(inputs, t.config)
    assert done.month == 200106 and not done.skipped
    assert done.tables["indicators"].count() == 125
    assert done.tables["monthly"].agg(F.max("YEAR_MONTH")).first()[0] == 200106
    assert done.tables["identification_text"].columns[-1] == "2001/2002 Q1"
    assert done.tables["expected_totals"].count() == 5
    release.store(done, str(tmp_path), "stats")
    newest = snapshots.newest_snapshot(spark, str(tmp_path), "monthly/.*csv$")
    stored = snapshots.read_delimited(spark, newest, schemas.MONTHLY)
    monthly = done.tables["monthly"]
    assert stored.exceptAll(monthly).count() == 0 and monthly.exceptAll(stored).count() == 0
    later = release.from_snapshots(spark, str(tmp_path), t.days, t.config)
    assert later.month == 200106
    for name in ("published_quarterly", "expected_totals", "indicators"):
        a, b = (sorted(map(str, x.tables[name].collect())) for x in (later, done))
        assert a == b
    assert spark.table("stats_data_dictionary_200106").count() == len(publish.DATA_DICTIONARY) and spark.table("table_0403").count() == 25
    assert spark.table("stats_identification_200106").count() == 5

    audit = disclosure.audit(done.tables, done.published)
    assert audit.filter("open > 0").isEmpty()
    shown = spark.table("stats_published_monthly_200106").withColumnRenamed("Total Items", "n")
    assert shown.filter("n is null").count() == done.published["monthly"].filter("ITEM_COUNT is null").count()

    # A run that ended before its list is not read; a second one of the month ends well and is.
    first = manifest.newest_release(spark, str(tmp_path))
    done.tables["monthly"].write.parquet(f"{manifest.new_release(str(tmp_path), 200107)}/monthly/snapshot=200107")
    assert manifest.newest_release(spark, str(tmp_path)) == first
    second = release.store(done, str(tmp_path), "stats", "parquet")
    newest = manifest.newest_release(spark, str(tmp_path))
    assert newest.endswith(second) and newest != first
    listed = {r["table"]: r["rows"] for r in manifest.tables(spark, newest).collect()}
    assert listed["indicators"] == 125 and listed["monthly"] == monthly.count() and len(listed) == 17
    later = release.from_snapshots(spark, str(tmp_path), t.days, t.config)
    assert later.tables["monthly"].exceptAll(monthly).count() == 0

    again = release.build(
        release.Inputs(t.fact, t.time, t.org, t.drug, t.age, t.days, history=done.tables["monthly"]),
        t.config,
    )
    assert again.skipped and not again.tables


def test_a_calendar_longer_than_the_items_opens_no_gate(spark, sf_dir):
    t = Tables(spark, sf_dir)
    span = calendar.fixed_span(spark, 199501, 200412)
    inputs = release.Inputs(t.fact, calendar.time_dim(span), t.org, t.drug, t.age, t.days)
    assert release.build(inputs, t.config).month == 200106
    inputs.history = t.monthly.filter("YEAR_MONTH <= 200106")
    assert release.build(inputs, t.config).skipped
    inputs.time = inputs.time.limit(0)
    none = release.build(inputs, t.config)
    assert none.skipped and none.month is None


def test_bounds_of_a_release(spark, sf_dir):
    t = Tables(spark, sf_dir)
    organisations = driver_tables.organisations(spark, sf_dir)
    config = replace(t.config, first_month=199601, sections=("0401", "0403"), country=2)
    done = release.build(release.Inputs(t.fact, t.time, organisations, t.drug, t.age, t.days), config)
    found = done.tables["monthly"].agg(F.min("YEAR_MONTH"), F.sort_array(F.collect_set("SECTION_CODE"))).first()
    assert tuple(found) == (199601, ["0401", "0403"])
    abroad = organisations.filter("COUNTRY = 2").select(F.col("LVL_5_OU").alias("PRESC_ID_PRNT"))
    wanted = t.fact.join(abroad, "PRESC_ID_PRNT").join(t.drug, F.col("CALC_PREC_DRUG_RECORD_ID") == F.col("RECORD_ID"))
    wanted = wanted.filter("YEAR_MONTH BETWEEN 199601 AND 200106 AND BNF_SECTION IN ('0401', '0403')")
    assert done.tables["monthly"].agg(F.sum("ITEM_COUNT")).first() == wanted.agg(F.sum("ITEM_COUNT")).first()


def test_drug_runs_join_like_the_months(spark):
    by_month = spark.createDataFrame(
        drugs()
        + [(12, 202112, "0403", "x"), (12, 202201, "0403", "x"), (12, 202203, "0403", "x"), (12, 202202, "0401", "y")],
        schemas.DRUG_DIM,
    )
    runs = joins.drug_runs(by_month)
    found = {(r["VALID_FROM"], r["VALID_TO"], r["BNF_SECTION"]) for r in runs.filter("RECORD_ID = 12").collect()}
    assert found == {(202112, 202201, "0403"), (202203, 202203, "0403"), (202202, 202202, "0401")}
    fact = spark.range(600).select(
        F.col("id").alias("ITEM_COUNT"),
        (F.col("id") % 4 + 10).alias("CALC_PREC_DRUG_RECORD_ID"),
        F.element_at(F.array(*[F.lit(m) for m in (202112, 202201, 202202, 202203, 202210, 202301)]),
                     (F.col("id") % 6 + 1).cast("int")).alias("YEAR_MONTH"),
    )
    one = joins.join_drug(fact, by_month).select("ITEM_COUNT", "BNF_SECTION", "SECTION_DESCR")
    two = joins.join_drug(fact, runs).select("ITEM_COUNT", "BNF_SECTION", "SECTION_DESCR")
    assert one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0 and one.count() > 0


def test_drug_by_month_keeps_repeats_and_any_key(spark):
    months = (202212, 202301, 202300, 202399, -7, None)
    rows = [(r, m, "0403", d) for r in (1, 2, None) for m in months for d in ("x", None)]
    rows += [(1, 202212, "0403", "x")] * 300 + [(2, 202301, "0401", "y")]
    by_month = spark.createDataFrame(rows, schemas.DRUG_DIM)
    fact = spark.createDataFrame(
        [(r, m, n) for r in (1, 2, 3, None) for m in (*months, 202302, 202319) for n in (1, 1)],
        "CALC_PREC_DRUG_RECORD_ID bigint, YEAR_MONTH int, ITEM_COUNT int",
    )
    names = ["CALC_PREC_DRUG_RECORD_ID", "YEAR_MONTH", "ITEM_COUNT", "BNF_SECTION", "SECTION_DESCR"]
    one = joins.join_drug(fact, by_month)
    assert one.columns == names
    two = fact.join(by_month.withColumnRenamed("RECORD_ID", "CALC_PREC_DRUG_RECORD_ID"), names[:2]).select(names)
    assert one.count() == two.count() > 600 and one.exceptAll(two).count() == 0 and two.exceptAll(one).count() == 0


def test_drug_by_month_is_planned_by_its_size(spark, tmp_path):
    """A few kilobytes of records, their months written out, are not broadcast because the file is small."""
    spark.range(2000).withColumnRenamed("id", "RECORD_ID").write.parquet(f"{tmp_path}/records")
    months = F.array(*[F.lit(100 * y + m) for y in range(1995, 2002) for m in range(1, 13)])
    by_month = spark.read.parquet(f"{tmp_path}/records").select(
        "RECORD_ID", F.explode(months).alias("YEAR_MONTH"), F.lit("0403").alias("BNF_SECTION"), F.lit("x").alias("SECTION_DESCR")
    )
    fact = spark.range(20_000, numPartitions=4).select(
        (F.col("id") % 3000).alias("CALC_PREC_DRUG_RECORD_ID"), (199501 + F.col("id") % 12).cast("int").alias("YEAR_MONTH"), "id"
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        found = joins.join_drug(fact.localCheckpoint(), by_month)
        assert len(found.collect()) == 14_000
        plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
