from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rxtally.operators import predicates, reshape, windows
from rxtally.plans import publish
from rxtally.sources import calendar

KEYS = ["YEAR_MONTH", "SECTION_CODE"]
LABELS = ["BAND", "IDENTIFIED_FLAG", "PDS_GENDER"]


def three_completions(pdf: pd.DataFrame) -> pd.DataFrame:
    """One label at a time over the observed combinations of all the others."""
    for label in LABELS:
        others = [c for c in KEYS + LABELS if c != label]
        grid = pdf[others].drop_duplicates().merge(pdf[[label]].drop_duplicates(), how="cross")
        pdf = grid.merge(pdf, on=KEYS + LABELS, how="left")
    return pdf.fillna({"ITEM_COUNT": 0})


@pytest.mark.parametrize("seed", range(3))
def test_complete_equals_three_completions(spark, seed):
    import numpy as np

    rng = np.random.default_rng(seed)
    rows = {
        (int(rng.choice([202201, 202202])), str(rng.choice(["0401", "0403"])), str(rng.choice(list("abc"))),
         str(rng.choice(["Y", "N"])), str(rng.choice(["M", "F", "U"])))
        for _ in range(12)
    }
    pdf = pd.DataFrame(sorted(rows), columns=KEYS + LABELS).assign(ITEM_COUNT=range(1, len(rows) + 1))
    found = reshape.complete(spark.createDataFrame(pdf), KEYS, LABELS, {"ITEM_COUNT": 0}).toPandas()
    order = KEYS + LABELS
    expected = three_completions(pdf)[order + ["ITEM_COUNT"]].sort_values(order)
    found = found[order + ["ITEM_COUNT"]].sort_values(order)
    assert found.astype(str).values.tolist() == expected.astype({"ITEM_COUNT": int}).astype(str).values.tolist()


def test_complete_keeps_missing_labels_and_fills_missing_measures(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, None, None), (2, "a", 1)], "k int, label string, v int"
    )
    found = reshape.complete(df, ["k"], ["label"], {"v": 0}).collect()
    assert {(r["k"], r["label"], r["v"]) for r in found} == {
        (1, "a", 5), (1, None, 0), (2, "a", 1), (2, None, 0),
    }


def test_label_seen_only_in_a_dropped_row_still_fills(spark):
    df = spark.createDataFrame(
        [(1, "0401", "x", "N", "M", 3), (1, "0401", "y", "Y", "F", 4)],
        "YEAR_MONTH int, SECTION_CODE string, BAND string, IDENTIFIED_FLAG string, PDS_GENDER string, ITEM_COUNT int",
    )
    kept = reshape.complete(df, KEYS, LABELS, {"ITEM_COUNT": 0}).filter(predicates.known_person(["BAND"]))
    assert {(r["BAND"], r["PDS_GENDER"], r["ITEM_COUNT"]) for r in kept.collect()} == {
        ("x", "M", 0), ("x", "F", 0), ("y", "M", 0), ("y", "F", 4),
    }


def test_quarter_columns_are_in_time_order(spark):
    df = spark.createDataFrame(
        [("a", "2022/2023 Q2", 2.0), ("a", "2022/2023 Q1", 1.0), ("b", "2021/2022 Q4", 3.0)],
        "s string, FINANCIAL_QUARTER string, v double",
    )
    wide = reshape.quarters_to_columns(df, ["s"], "v")
    assert wide.columns == ["s", "2021/2022 Q4", "2022/2023 Q1", "2022/2023 Q2"]


def test_absent_flag_gives_no_rate(spark):
    quarterly = spark.createDataFrame(
        [("2022/2023", "2022/2023 Q1", "n", "0401", "Y", 5, 1.0, 3)],
        "FINANCIAL_YEAR string, FINANCIAL_QUARTER string, SECTION_NAME string, SECTION_CODE string, "
        "IDENTIFIED_FLAG string, ITEM_COUNT bigint, ITEM_PAY_DR_NIC double, PATIENT_COUNT bigint",
    )
    assert publish.identification_rates(quarterly).first()["RATE"] is None


def test_latest_complete_quarter(spark):
    span = calendar.fixed_span(spark, 202201, 202302)
    dim = calendar.time_dim(span)
    row = windows.latest_complete_quarter(dim, "FINANCIAL_QUARTER").first()
    assert (row["YEAR_MONTH"], row["FINANCIAL_QUARTER"]) == (202212, "2022/2023 Q3")
    counts = windows.with_period_counts(dim, "FINANCIAL_QUARTER").filter("YEAR_MONTH = 202302").first()
    assert (counts["Q_COUNT"], counts["FY_COUNT"]) == (2, 11)


def test_time_dimension_keys(spark):
    dim = calendar.time_dim(calendar.fixed_span(spark, 202203, 202304), start=202204)
    found = {r["YEAR_MONTH"]: r["QUARTER_KEY"] for r in dim.collect()}
    assert min(found) == 202204 and found[202206] == 202204 and found[202301] == 202301
    plain = dim.drop("QUARTER_KEY")
    again = calendar.keyed_time_dim(plain).filter("YEAR_MONTH = 202212").first()
    assert again["QUARTER_KEY"] == 202210


def test_dispensing_days_and_holidays(spark):
    span = calendar.fixed_span(spark, 202212, 202212)
    assert calendar.dispensing_days(span).first()["DISPENSING_DAYS"] == 27
    holidays = spark.createDataFrame([(date(2022, 12, 26),), (date(2022, 12, 27),)], "HOLIDAY date")
    assert calendar.dispensing_days(span, holidays).first()["DISPENSING_DAYS"] == 25


def test_published_order(spark):
    df = spark.createDataFrame(
        [(2, "0401", "N"), (1, "0403", "N"), (1, "0403", "Y"), (1, "0401", "Y")],
        "YEAR_MONTH int, SECTION_CODE string, IDENTIFIED_FLAG string",
    )
    found = [tuple(r) for r in publish.published_order(df, ["YEAR_MONTH"]).collect()]
    assert found == [(1, "0401", "Y"), (1, "0403", "Y"), (1, "0403", "N"), (2, "0401", "N")]


def test_quarterly_figures_are_sorted_by_measure_descending(spark):
    from rxtally.config import DEC_2022

    df = spark.createDataFrame(
        [("2022/2023", "2022/2023 Q1", "n", "0401", "Y", 5, 3), ("2015/2016", "2015/2016 Q1", "n", "0401", "Y", 5, 3)],
        "FINANCIAL_YEAR string, FINANCIAL_QUARTER string, SECTION_NAME string, SECTION_CODE string, "
        "IDENTIFIED_FLAG string, ITEM_COUNT bigint, PATIENT_COUNT bigint",
    )
    found = [r["measure"] for r in publish.quarterly_figures(df, DEC_2022).collect()]
    assert found == ["Prescribed items", "Identified patients"]


def test_group_split_keeps_groups_whole_and_is_stable(spark):
    df = spark.range(1000).withColumn("g", F.col("id") % 50)
    marked = df.withColumn("train", predicates.group_split(df, "g", 0.75, seed=7))
    sides = marked.groupBy("g").agg(F.count_distinct("train").alias("n"))
    assert sides.filter("n > 1").count() == 0
    again = df.withColumn("train", predicates.group_split(df, "g", 0.75, seed=7))
    assert marked.filter("train").count() == again.filter("train").count()
    assert 0 < marked.filter("train").count() < 1000


def test_periods_split_at_the_end_of_training(spark):
    df = spark.createDataFrame([(202002,), (202003,)], "YEAR_MONTH int")
    assert predicates.training_rows(df, 202002).count() == 1
    assert predicates.testing_rows(df, 202002).first()["time_period"] == "covid"
