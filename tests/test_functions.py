from datetime import date

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rxtally.functions import dates, distributions, scalars
from rxtally.plans import publish


def one(spark, expression):
    return spark.range(1).select(expression.alias("v")).first()["v"]


def test_month_arithmetic_clamps(spark):
    assert one(spark, dates.shift_months(F.lit(date(2022, 3, 31)), -1)) == date(2022, 2, 28)
    assert one(spark, dates.shift_year_month(F.lit(202212), 1)) == 202301


@pytest.mark.parametrize(
    "day,label",
    [
        (date(2022, 12, 1), "2022/2023 Q3"),
        (date(2023, 3, 31), "2022/2023 Q4"),
        (date(2023, 4, 1), "2023/2024 Q1"),
    ],
)
def test_fiscal_labels(spark, day, label):
    assert one(spark, dates.fiscal_quarter_label(F.lit(day))) == label


def test_month_index_and_names(spark):
    origin = date(2015, 3, 1)
    assert one(spark, dates.month_index(dates.month_start(F.lit(201504)), origin)) == 1
    assert one(spark, dates.month_index(dates.month_start(F.lit(202212)), origin)) == 93
    assert one(spark, dates.month_name(F.lit(date(2022, 12, 5)))) == "December 2022"


def test_trailing_months(spark):
    months = one(spark, dates.trailing_months(F.lit(202212), 12))
    assert months[0] == 202212 and months[-1] == 202201 and len(months) == 12
    before = one(spark, dates.trailing_months(F.lit(202212), 12, skip=12))
    assert (before[0], before[-1]) == (202112, 202101)


@pytest.mark.parametrize("rate,text", [((1, 399), "0.2%"), ((3930, 70), "98.2%"), ((5, 0), "100.0%")])
def test_rate_text_rounds_halves_to_even(spark, rate, text):
    assert one(spark, scalars.identification_rate_text(F.lit(rate[0]), F.lit(rate[1]))) == text


def test_rate_of_nothing(spark):
    assert one(spark, scalars.identification_rate(F.lit(0), F.lit(0))) is None
    assert one(spark, scalars.identification_rate_text(F.lit(0), F.lit(0))) is None
    assert one(spark, scalars.percent_change(F.lit(3), F.lit(0))) is None


@pytest.mark.parametrize(
    "value,shown,text",
    [
        (0, 0.0, "0"),
        (999.5, 1000.0, "1,000"),
        (21_687_432, 21_700_000.0, "21,700,000"),
        (2.6749, 2.67, "2.67"),
        (-11.25, -11.2, "-11.2"),
        (0.012345, 0.0123, "0.0123"),
        (9.996, 10.0, "10.0"),
        (0.00123456, 0.00123, "0.00123"),
        (-1e-7, -1e-7, "-0.000000100"),
    ],
)
def test_three_figures(spark, value, shown, text):
    assert one(spark, scalars.three_figures(F.lit(value))) == pytest.approx(shown, rel=1e-12)
    assert one(spark, scalars.display_text(F.lit(value))) == text


def test_published_percentages(spark):
    """Figures stated in a published release."""
    assert one(spark, scalars.display_text(scalars.percent_change(F.lit(646), F.lit(382)), True)) == "69.1%"
    assert one(spark, scalars.display_text(scalars.percent_change(F.lit(180.0), F.lit(97.4)), True)) == "84.8%"
    assert one(spark, scalars.percent_change(F.lit(5.26), F.lit(4.72))) == pytest.approx(11.44, abs=0.01)


@pytest.mark.parametrize(
    "band,wide",
    [("00-04", "00-19"), ("35-39", "20-39"), ("55-59", "40-59"), ("79", "80+"), ("90+", "80+"),
     ("Unknown", "Unknown"), (None, "80+")],
)
def test_twenty_year_bands(spark, band, wide):
    assert one(spark, scalars.twenty_year_band(F.lit(band).cast("string"))) == wide


def test_display_names(spark):
    assert one(spark, scalars.text_name(F.lit("Antidepressant drugs"))) == "antidepressant drug items"
    assert one(spark, scalars.text_name(F.lit("Other"))) == "Other"
    assert one(spark, scalars.item_name(F.lit("Other"))) == ""


def test_disclosure_control(spark):
    df = spark.createDataFrame(
        [(10, 1.5, 0), (10, 1.5, 4), (10, 1.5, 5), (10, 1.5, None)],
        "ITEM_COUNT bigint, ITEM_PAY_DR_NIC double, PATIENT_COUNT bigint",
    )
    found = {r["PATIENT_COUNT"] for r in publish.disclosure_control(df).filter("ITEM_COUNT = 10").collect()}
    assert found == {0, 5, None}
    assert publish.disclosure_control(df).filter("ITEM_COUNT is null").count() == 1


def test_age_at_september(spark):
    df = spark.createDataFrame(
        [(date(1980, 9, 30), "2022/2023"), (date(1980, 10, 1), "2022/2023")], "dob date, fy string"
    )
    ages = [r["a"] for r in df.select(publish.age_at_september("dob", "fy").alias("a")).collect()]
    assert ages == [42, 41]


def test_distribution_values():
    assert distributions.t_quantile(0.95, 10) == pytest.approx(2.2281388520, abs=1e-9)
    assert distributions.t_quantile(0.95, 1) == pytest.approx(12.7062047362, abs=1e-9)
    assert distributions.f_upper(3.0, 2, 10) == pytest.approx(0.0953674316, abs=1e-9)


@settings(max_examples=60, deadline=None)
@given(st.floats(0.5, 0.999), st.integers(1, 500))
def test_t_quantile_inverts_the_tail(level, df):
    t = distributions.t_quantile(level, df)
    assert distributions.t_two_sided(t, df) == pytest.approx(1 - level, rel=1e-9)
