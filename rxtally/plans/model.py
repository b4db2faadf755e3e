"""Model inputs, candidate models and expected-against-actual tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxtally.config import ReleaseConfig
from rxtally.functions import dates, scalars
from rxtally.operators import aggregates, joins, predicates, regression, reshape, windows
from rxtally.operators.regression import Categorical, Crossed, Formula, Numeric

BY = ("SECTION_CODE",)
NARROW, WIDE = "DALL_5YR_BAND", "BAND_20YR"
_KEYS = ["YEAR_MONTH", "SECTION_NAME", "SECTION_CODE"]
_FILL = {"ITEM_COUNT": 0, "ITEM_PAY_DR_NIC": 0}

_TREND = (Numeric("MONTH_INDEX"), Numeric("DISPENSING_DAYS"))
_SEASON = Categorical("MONTH_NUM")


def _formula(*terms) -> Formula:
    return Formula("ITEM_COUNT", terms)


# The model that is published: trend, days, season, gender by 20-year band.
FINAL = _formula(*_TREND, _SEASON, Crossed("PDS_GENDER", WIDE))

# The same model with the season as eleven 0/1 columns.
FINAL_FLAGS = _formula(
    *_TREND, *[Numeric(f"m_{k:02d}") for k in range(2, 13)], Crossed("PDS_GENDER", WIDE)
)

# Narrow against wide bands.
BAND_CANDIDATES = {
    "bands_5yr": _formula(*_TREND, _SEASON, Crossed("PDS_GENDER", NARROW)),
    "bands_20yr": FINAL,
}

# From the calendar alone to the full crossing.
NESTED_CANDIDATES = {
    "m0_days": _formula(Numeric("DISPENSING_DAYS")),
    "m1_season": _formula(Numeric("DISPENSING_DAYS"), _SEASON),
    "m2_trend": _formula(*_TREND, _SEASON),
    "m3_band": _formula(*_TREND, _SEASON, Categorical(WIDE)),
    "m4_gender": _formula(*_TREND, _SEASON, Categorical("PDS_GENDER")),
    "m5_both": _formula(*_TREND, _SEASON, Categorical("PDS_GENDER"), Categorical(WIDE)),
    "m6_crossed": FINAL,
}


def with_calendar(df: DataFrame, days: DataFrame, config: ReleaseConfig) -> DataFrame:
    """Month start, number and index, and dispensing days."""
    start = dates.month_start(F.col("YEAR_MONTH"))
    out = df.withColumn("MONTH_START", start).withColumns(
        {
            "MONTH_NUM": dates.month_number(F.col("MONTH_START")),
            "MONTH_INDEX": dates.month_index(F.col("MONTH_START"), config.index_origin),
        }
    )
    return joins.join_calendar(out, days)


def banded_input(
    model: DataFrame, days: DataFrame, config: ReleaseConfig, band: str = WIDE
) -> DataFrame:
    """Section by month by gender by band, every combination present, known persons only.

    Band and gender labels come from the whole input, before any row is dropped.
    """
    source = model
    if band == WIDE:
        source = source.withColumn(WIDE, scalars.twenty_year_band(F.col(NARROW)))
    labels = [band, "IDENTIFIED_FLAG", "PDS_GENDER"]
    summed = aggregates.totals(source, [*_KEYS, *labels], list(_FILL))
    full = reshape.complete(summed, _KEYS, labels, _FILL)
    kept = full.filter(predicates.known_person([band]))
    return reshape.with_month_flags(with_calendar(kept, days, config))


def both_bands_input(model: DataFrame, days: DataFrame, config: ReleaseConfig) -> DataFrame:
    """Both bandings side by side, observed combinations only."""
    source = model.withColumn(WIDE, scalars.twenty_year_band(F.col(NARROW)))
    labels = ["IDENTIFIED_FLAG", "PDS_GENDER", NARROW, WIDE]
    summed = aggregates.totals(source, [*_KEYS, *labels], list(_FILL))
    kept = summed.filter(predicates.known_person([NARROW, WIDE]))
    return with_calendar(kept, days, config)


def section_level_input(monthly: DataFrame, days: DataFrame) -> DataFrame:
    """The older input: one row per section and month, months numbered within the section."""
    summed = aggregates.totals(monthly, _KEYS, list(_FILL))
    indexed = windows.with_month_index(summed).withColumn(
        "MONTH_START", dates.month_start(F.col("YEAR_MONTH"))
    )
    dated = indexed.withColumn("MONTH_NUM", dates.month_number(F.col("MONTH_START")))
    return joins.join_calendar(dated, days)


def fit_release(model_input: DataFrame, config: ReleaseConfig) -> DataFrame:
    """The published model of every section, fitted on the training months."""
    training = predicates.training_rows(model_input, config.train_end)
    return regression.fit(training, FINAL, BY, config.levels)


def compare_bands(both: DataFrame, config: ReleaseConfig) -> DataFrame:
    training = predicates.training_rows(both, config.train_end)
    fitted = regression.fit_many(training, BAND_CANDIDATES, BY, config.levels)
    return regression.rank_by_aic(fitted, BY)


def compare_nested(model_input: DataFrame, config: ReleaseConfig) -> DataFrame:
    training = predicates.training_rows(model_input, config.train_end)
    fitted = regression.fit_many(training, NESTED_CANDIDATES, BY, config.levels)
    return regression.rank_by_aic(fitted, BY)


def expected(model_input: DataFrame, models: DataFrame, config: ReleaseConfig) -> DataFrame:
    months = predicates.month_range(config.predict_start, config.predict_end)
    return regression.monthly_expected(model_input.filter(months), models, FINAL, BY, config.levels)


def actual_and_expected(
    model_input: DataFrame, models: DataFrame, config: ReleaseConfig
) -> DataFrame:
    """Actual items of every month beside the expected ones of the prediction months."""
    return joins.attach_predictions(
        aggregates.actual_totals(model_input), expected(model_input, models, config)
    )


def expected_figures(table: DataFrame, config: ReleaseConfig) -> DataFrame:
    """Rows of the expected-against-actual figures: months after training."""
    return regression.outside_interval(table.filter(F.col("YEAR_MONTH") > config.train_end))


def expected_totals(table: DataFrame, config: ReleaseConfig) -> DataFrame:
    return aggregates.actual_against_expected(table, config.predict_start, config.predict_end)
