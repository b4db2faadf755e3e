import pytest
from helpers import dims, facts, item, star
from pyspark.sql import functions as F

from rxtally.operators import aggregates, joins
from rxtally.plans import extract


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_inner_joins_drop_what_has_no_dimension_row(spark):
    items, _ = star(
        spark,
        [
            item(),
            item(org=9),
            item(drug=99),
            item(month=202401),
            item(age=None),
            item(age=-1, flag="N"),
        ],
    )
    assert rows(items, "CALC_AGE", "DALL_5YR_BAND") == [(-1, None), (42, "40-44")]


def test_drug_section_can_change_between_months(spark):
    time, org, _, age = dims(spark)
    by_month = spark.createDataFrame(
        [(10, 202212, "0403", "a"), (10, 202301, "0401", "b")],
        "RECORD_ID bigint, YEAR_MONTH int, BNF_SECTION string, SECTION_DESCR string",
    )
    by_run = spark.createDataFrame(
        [(10, 202201, 202212, "0403", "a"), (10, 202301, 202312, "0401", "b")],
        "RECORD_ID bigint, VALID_FROM int, VALID_TO int, BNF_SECTION string, SECTION_DESCR string",
    )
    fact = facts(spark, [item(month=202212), item(month=202301)])
    for drug in (by_month, by_run):
        items = joins.star_join(fact, time, org, drug, age)
        assert rows(items, "YEAR_MONTH", "BNF_SECTION") == [(202212, "0403"), (202301, "0401")]


def test_missing_patient_counts_once_and_unidentified_counts_zero(spark):
    items, time = star(
        spark,
        [
            item(patient=None),
            item(patient=None, month=202211),
            item(patient=1),
            item(patient=1, month=202212),
            item(patient=None, flag="N", age=-1),
            item(patient=5, flag="N", age=-1),
        ],
    )
    found = rows(
        aggregates.quarterly_totals(items, time), "IDENTIFIED_FLAG", "ITEM_COUNT", "PATIENT_COUNT"
    )
    assert found == [("N", 2, 0), ("Y", 4, 2)]
    keys = ["FINANCIAL_QUARTER", "BNF_SECTION", "IDENTIFIED_FLAG"]
    assert rows(aggregates.distinct_patients(items, keys), "IDENTIFIED_FLAG", "PATIENT_COUNT") == [
        ("N", 0),
        ("Y", 2),
    ]


def test_other_flag_has_no_patient_count(spark):
    items, time = star(spark, [item(flag="X")])
    assert rows(aggregates.monthly_totals(items, time), "ITEM_COUNT", "PATIENT_COUNT") == [(1, None)]


def test_patient_with_two_genders_counts_in_each(spark):
    items, time = star(spark, [item(gender=1), item(gender=2), item(gender=9), item(gender=0)])
    model = aggregates.model_totals(items, time)
    assert rows(model, "PDS_GENDER", "PATIENT_COUNT") == [("F", 1), ("M", 1), ("U", 1)]
    assert rows(aggregates.monthly_totals(items, time), "PATIENT_COUNT") == [(1,)]


def test_pounds_are_exact(spark):
    items, time = star(spark, [item(patient=k, pence=1) for k in range(7)])
    assert str(aggregates.monthly_totals(items, time).first()["ITEM_PAY_DR_NIC"]) == "0.07"


def test_shared_base_equals_direct_totals(spark):
    data = [
        item(month=m, patient=p, gender=g, age=a, flag=f, drug=d, n=m % 7 + 1, pence=p or 3)
        for m in (202210, 202211, 202301)
        for p in (None, 1, 2)
        for g in (0, 1, 2)
        for a in (-1, 7, 95)
        for f in ("Y", "N")
        for d in (10, 11)
    ]
    items, time = star(spark, data)
    base = aggregates.grains_from_base(aggregates.patient_base(items), time)
    direct = {
        "quarterly": aggregates.quarterly_totals(items, time),
        "monthly": aggregates.monthly_totals(items, time),
        "model": aggregates.model_totals(items, time),
    }
    for name, df in direct.items():
        assert rows(base[name], *df.columns) == rows(df, *df.columns)
    saved = extract.saved_grains(items, time)
    for name, df in direct.items():
        columns = extract.GRAINS[name].fieldNames()
        assert rows(saved[name], *columns) == rows(df, *columns)


def test_strict_totals_keep_missing_values_visible(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 2)], "k string, v int")
    assert rows(aggregates.totals(df, ["k"], ["v"]), "k", "v") == [("a", None), ("b", 2)]


def test_filtered_totals_of_no_rows(spark):
    df = spark.createDataFrame([(1, 2)], "k int, v int")
    out = df.agg(
        aggregates.sum_where(F.col("k") == 9, "v").alias("s"),
        aggregates.mean_where(F.col("k") == 9, "v").alias("m"),
    ).first()
    assert out["s"] == 0 and out["m"] is None


def test_calendar_join_matches_missing_months(spark):
    left = spark.createDataFrame([(202201,), (None,), (202299,)], "YEAR_MONTH int")
    days = spark.createDataFrame([(202201, 25), (None, 7)], "YEAR_MONTH int, DISPENSING_DAYS int")
    found = rows(joins.join_calendar(left, days), "YEAR_MONTH", "DISPENSING_DAYS")
    assert found == [(202201, 25), (202299, None), (None, 7)]


@pytest.mark.parametrize("threshold", ["10485760", "-1"])
def test_dimensions_are_broadcast_by_size_only(spark, sf_dir, threshold):
    from rxtally.checks.tables import Tables

    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", threshold)
    try:
        items = Tables(spark, sf_dir).items
        plan = items._jdf.queryExecution().executedPlan().toString()
        assert ("BroadcastHashJoin" in plan) == (threshold != "-1")
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_hot_organisation_is_split_and_whole(spark):
    """One organisation holds most rows: its shuffle partition is split, no row is lost."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "8",
    }
    old = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = spark.range(60_000, numPartitions=8).select(
            F.lit("S").alias("PRESC_TYPE_PRNT"),
            F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 400).alias("PRESC_ID_PRNT"),
            F.col("id").alias("ITEM_COUNT"),
        )
        org = spark.range(400, numPartitions=4).select(
            F.lit("S").alias("LVL_5_OUPDT"), F.col("id").alias("LVL_5_OU")
        )
        joined = joins.join_organisation(fact, org)
        assert joined.count() == 60_000
        joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for key, value in old.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_grains_share_one_scan_and_one_patient_shuffle(spark, sf_dir):
    from rxtally.checks.tables import Tables

    t = Tables(spark, sf_dir)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = extract.all_grains(t.items, t.time)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("l_quantity") > 0
    scans = [line for line in plan.splitlines() if "FileScan" in line and "l_orderkey" in line]
    assert len(scans) == 1
    reads = [line for line in scans[0].split("ReadSchema")]
    assert "l_shipdate" not in reads[0]


def test_hot_missing_patient_reaches_the_shuffle_reduced(spark):
    """Rows without a patient are added up before the exchange."""
    items, _ = star(spark, [item(patient=None)])
    out = aggregates.per_patient(items, aggregates.MONTH_KEYS)
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "partial_sum" in plan
