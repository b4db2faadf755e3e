"""Stored sets of patients against the counts from items, and releases extended by new months."""

import re
from dataclasses import replace

import pytest
from helpers import item, star
from pyspark.sql import functions as F

from rxtally.checks.tables import Tables
from rxtally.operators import patient_sets
from rxtally.plans import extract, release
from rxtally.streaming import refresh


def rows(df, schema):
    return sorted(map(tuple, df.select(*schema.fieldNames()).collect()), key=repr)


def same(found, expected):
    for name, schema in extract.GRAINS.items():
        assert rows(found[name], schema) == rows(expected[name], schema), name


def test_counts_of_awkward_patients(spark):
    """Missing ids, ids of one bucket and of far ones, both genders, several months of a quarter, no flag."""
    facts = [
        item(patient=None), item(patient=None, gender=2), item(month=202211, patient=None), item(patient=1), item(patient=1),
        item(patient=32768), item(patient=32769), item(month=202212, patient=32769), item(patient=2**40, gender=2),
        item(patient=2**40, gender=1), item(flag="N", patient=7), item(flag="N", patient=None), item(flag=None, patient=9),
        item(month=202301, patient=0), item(drug=11, patient=5), item(age=-1, patient=5),
    ]
    items, time = star(spark, facts)
    full = {name: build(items, time) for name, build in extract.BUILDERS.items()}
    same(patient_sets.grains_from_sets(patient_sets.patient_sets(items), time), full)
    none = {name: build(items.limit(0), time) for name, build in extract.BUILDERS.items()}
    same(patient_sets.grains_from_sets(patient_sets.patient_sets(items.limit(0)), time), none)


def test_patient_rows_are_shuffled_once(spark, sf_dir):
    t = Tables(spark, sf_dir)
    plan = patient_sets.all_grains(patient_sets.patient_sets(t.items), t.time)._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line and "IDENTIFIED_PATIENT_ID" in line]
    branches = plan.count("bitmap_construct_agg") // 2
    assert exchanges and len({re.sub(r"#\d+L?|plan_id=\d+|\s+|[+|:*()-]", "", e) for e in exchanges}) == 1 and branches >= 1


def inputs_of(t, fact):
    return release.Inputs(fact, t.time, t.org, t.drug, t.age, t.days)


def test_a_release_from_new_months_equals_the_full_one(spark, sf_dir, tmp_path):
    t, path = Tables(spark, sf_dir), str(tmp_path / "sets")
    stored = str(tmp_path / "fact")
    t.fact.write.partitionBy("YEAR_MONTH").parquet(stored)
    fact = spark.read.parquet(stored)
    asked = []

    def items_between(first, last):
        asked.append((first, last))
        from rxtally.operators import joins
        from rxtally.sources import tables

        return joins.star_join(tables.prescription_fact(fact, first, last), t.time, t.org, t.drug, t.age)

    assert refresh.sets_through(spark, path) is None
    refresh.extend_sets(spark, path, items_between, t.config.first_month, 200103)
    # Months that were begun and not marked are written again.
    refresh.append_months(patient_sets.patient_sets(items_between(200104, 200104)).limit(1), path)
    assert refresh.sets_through(spark, path) == 200103
    assert refresh.stored_sets(spark, path).agg(F.max("YEAR_MONTH")).first()[0] == 200103

    plan = patient_sets.patient_sets(items_between(200104, 200106))._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan)
    assert sum("200104" in s and "200106" in s for s in scans) == 1

    done = release.build(inputs_of(t, fact), t.config, sets=path)
    assert refresh.sets_through(spark, path) == 200106 and done.month == 200106
    full = release.build(inputs_of(t, t.fact), t.config)
    same(done.tables, full.tables)

    def untouched(first, last):
        raise AssertionError("no month is new")

    refresh.extend_sets(spark, path, untouched, t.config.first_month, 200106)
    assert asked[0] == (t.config.first_month, 200103)


@pytest.mark.parametrize(("stored", "start"), [(200112, 200201), (200111, 200112)])
def test_months_after_the_stored_one(spark, sf_dir, tmp_path, stored, start):
    t, path, asked = Tables(spark, sf_dir), str(tmp_path / "sets"), []

    def items_between(first, last):
        asked.append((first, last))
        return t.items.limit(0)

    config = replace(t.config, first_month=stored)
    refresh.extend_sets(spark, path, lambda a, b: t.items.filter("YEAR_MONTH = 200101").withColumn("YEAR_MONTH", F.lit(stored)), stored, config.first_month)
    refresh.extend_sets(spark, path, items_between, stored, 200203)
    assert asked == [(start, 200203)]
