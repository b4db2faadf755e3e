"""One frozen configuration per release, in place of hand-edited dates."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

# Section codes and the names they are published under.
SECTION_NAMES = {
    "0401": "Hypnotics and anxiolytics",
    "0402": "Drugs used in psychoses and related disorders",
    "0403": "Antidepressant drugs",
    "0404": "CNS stimulants and drugs used for ADHD",
    "0411": "Drugs for dementia",
}


@dataclass(frozen=True)
class ReleaseConfig:
    """Everything that changes from one release to the next.

    ``train_end`` splits the fit from the prediction months, ``index_origin`` is
    the month before month number one, ``chart_start`` the first month shown in
    the monthly figures and ``chart_skip_years`` the fiscal years left out of
    the quarterly ones. Cells of fewer than ``small_cell`` patients are not
    published.
    """

    train_end: int
    predict_start: int
    predict_end: int
    index_origin: date
    chart_start: int
    chart_skip_years: tuple[str, ...]
    first_month: int = 201401
    sections: tuple[str, ...] = tuple(SECTION_NAMES)
    country: int = 1
    rate_quarters: int = 4
    levels: tuple[float, ...] = (0.95, 0.99)
    small_cell: int = 5


# The published December 2022 release.
DEC_2022 = ReleaseConfig(
    train_end=202002,
    predict_start=202003,
    predict_end=202212,
    index_origin=date(2015, 3, 1),
    chart_start=201704,
    chart_skip_years=("2015/2016", "2016/2017"),
)

# The same release moved onto the months of the driver tables.
DRIVER_RELEASE = ReleaseConfig(
    train_end=199912,
    predict_start=200001,
    predict_end=200106,
    index_origin=date(1994, 12, 1),
    chart_start=199704,
    chart_skip_years=("1994/1995", "1995/1996"),
    first_month=199501,
)
