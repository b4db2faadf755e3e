"""Recodes, rates, changes and display rounding as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 20-year bands and the 5-year bands each one covers. Anything else
# that is not "Unknown" counts as the open-ended top band.
TWENTY_YEAR_BANDS = {
    "00-19": ("00-04", "05-09", "10-14", "15-19"),
    "20-39": ("20-24", "25-29", "30-34", "35-39"),
    "40-59": ("40-44", "45-49", "50-54", "55-59"),
    "60-79": ("60-64", "65-69", "70-74", "75-79"),
}
TOP_BAND = "80+"
UNKNOWN = "Unknown"

# Section name -> (name used in text, name used before "item").
DISPLAY_NAMES = {
    "Hypnotics and anxiolytics": (
        "hypnotics and anxiolytics",
        "hypnotic and anxiolytic item",
    ),
    "Drugs used in psychoses and related disorders": (
        "antipsychotic items",
        "antipsychotic drug item",
    ),
    "Antidepressant drugs": (
        "antidepressant drug items",
        "antidepressant drug item",
    ),
    "CNS stimulants and drugs used for ADHD": (
        "CNS stimulants and drugs used for ADHD items",
        "CNS stimulants and drugs used for ADHD item",
    ),
    "Drugs for dementia": (
        "drugs for dementia",
        "drug for dementia item",
    ),
}


def patient_indicator(flag: Column) -> Column:
    """1 for an identified group, 0 for an unidentified one, NULL for any other flag."""
    return F.when(flag == "Y", 1).when(flag == "N", 0)


def gender_letter(code: Column) -> Column:
    return F.when(code == 1, "M").when(code == 2, "F").otherwise("U")


def known_band(band: Column) -> Column:
    return F.coalesce(band, F.lit(UNKNOWN))


def twenty_year_band(band: Column) -> Column:
    out = F.when(band == UNKNOWN, UNKNOWN)
    for wide, narrow in TWENTY_YEAR_BANDS.items():
        out = out.when(band.isin(*narrow), wide)
    return out.otherwise(TOP_BAND)


def pounds(pence: Column) -> Column:
    """Exact pence total -> pounds with two decimals."""
    return (pence.cast("decimal(20,0)") / 100).cast("decimal(18,2)")


def percent_of(part: Column, whole: Column) -> Column:
    """Percentage, NULL when there is nothing to divide by."""
    return 100 * F.try_divide(part.cast("double"), whole.cast("double"))


def identification_rate(identified: Column, unidentified: Column, decimals: int = 10) -> Column:
    return F.bround(percent_of(identified, identified + unidentified), decimals)


def identification_rate_text(identified: Column, unidentified: Column) -> Column:
    rate = identification_rate(identified, unidentified, 1)
    return F.when(rate.isNotNull(), F.format_string("%.1f%%", rate))


def percent_change(current: Column, previous: Column) -> Column:
    return percent_of(current - previous, previous)


def absolute_change(current: Column, previous: Column) -> Column:
    return current - previous


def three_figures(value: Column) -> Column:
    """Round to three significant figures, halves to even."""
    size = F.abs(value.cast("double"))
    exponent = F.floor(F.log10(size)).cast("int") - 2
    step = F.pow(F.lit(10.0), F.abs(exponent))
    rounded = F.when(exponent >= 0, F.bround(size / step) * step).otherwise(
        F.bround(size * step) / step
    )
    return F.when(size == 0, F.lit(0.0)).otherwise(F.signum(value.cast("double")) * rounded)


def display_text(value: Column, percentage: bool = False) -> Column:
    """Three significant figures with thousands separators, and ``%`` if asked for."""
    def text_of(shown: Column) -> Column:
        size = F.abs(shown)
        # Below one, as many decimals as it takes to reach the third figure.
        decimals = 2 - F.floor(F.log10(size)).cast("int")
        return (
            F.when(size == 0, F.lit("0"))
            .when(size >= 100, F.format_number(shown, 0))
            .when(size >= 10, F.format_number(shown, 1))
            .when(size >= 1, F.format_number(shown, 2))
            .otherwise(F.call_function("format_number", shown, decimals))
        )

    # A one-element array, so that the rounding is worked out once and not once for each branch.
    text = F.get(F.transform(F.array(three_figures(value)), text_of), F.lit(0))
    return F.concat(text, F.lit("%")) if percentage else text


def _lookup(name: Column, position: int, default: Column) -> Column:
    pairs = [F.lit(part) for key, shown in DISPLAY_NAMES.items() for part in (key, shown[position])]
    return F.coalesce(F.create_map(*pairs)[name], default)


def text_name(section_name: Column) -> Column:
    """Section name as used in running text; unlisted names stay as they are."""
    return _lookup(section_name, 0, section_name)


def item_name(section_name: Column) -> Column:
    """Section name as used before the word "item"; unlisted names give an empty text."""
    return _lookup(section_name, 1, F.lit(""))
