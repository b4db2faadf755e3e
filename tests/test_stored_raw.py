"""Items stored by month: pruning, the last month without a scan, and a release built from them."""

import re

import pytest

from rxtally.checks.tables import Tables
from rxtally.plans import extract, release
from rxtally.sinks import tables as sinks
from rxtally.sources import tables


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    t = Tables(spark, sf_dir)
    sinks.save_raw(t.items, "stored_raw")
    return t


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def files_read(df):
    """Files of the scan of the stored items, after the query has run."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaves = plan.finalPhysicalPlan().collectLeaves()
    found = []
    for k in range(leaves.size()):
        leaf = leaves.apply(k)
        leaf = leaf.plan() if "QueryStage" in leaf.getClass().getSimpleName() else leaf
        inner = leaf.collectLeaves()
        for j in range(inner.size()):
            node = inner.apply(j)
            if node.getClass().getSimpleName() == "FileSourceScanExec" and "YEAR_MONTH" in node.toString():
                found.append(node.metrics().apply("numFiles").value())
    return found


def test_a_join_by_month_prunes_partitions(spark, stored):
    year = stored.time.filter("FINANCIAL_YEAR = '1999/2000'")
    found = tables.raw_of_periods(spark, "stored_raw", year)
    assert "dynamicpruning" in plan_of(found)
    everything = spark.table("stored_raw")
    assert 0 < max(files_read(found.groupBy().count())) < max(files_read(everything.groupBy("YEAR_MONTH").count()))
    months = {r[0] for r in found.select("YEAR_MONTH").distinct().collect()}
    assert months == {*range(199904, 199913), 200001, 200002, 200003}


def test_the_last_month_is_known_without_a_scan(spark, stored):
    last = stored.items.agg({"YEAR_MONTH": "max"}).first()[0]
    assert tables.largest_partition(spark, "stored_raw") == last
    plan = plan_of(tables.at_largest_partition(spark, "stored_raw"))
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan and re.search(rf"YEAR_MONTH#\d+ = {last}", plan)
    spark.sql("CREATE TABLE IF NOT EXISTS no_months (x INT, YEAR_MONTH INT) USING parquet PARTITIONED BY (YEAR_MONTH)")
    assert tables.largest_partition(spark, "no_months") is None


def test_a_release_from_stored_items(spark, stored):
    t = stored
    done = release.build(release.Inputs(None, t.time, t.org, t.drug, t.age, t.days, raw="stored_raw"), t.config)
    full = release.build(release.Inputs(t.fact, t.time, t.org, t.drug, t.age, t.days), t.config)
    assert done.month == full.month
    for name in extract.GRAINS:
        a, b = (sorted(map(tuple, x.tables[name].select(*extract.GRAINS[name].fieldNames()).collect()), key=repr) for x in (done, full))
        assert a == b
