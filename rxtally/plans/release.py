"""One release from warehouse tables to stored results."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxtally.config import ReleaseConfig
from rxtally.operators import disclosure, joins, patient_sets, regression, windows
from rxtally.plans import extract, indicators, model, publish
from rxtally.session import cut_lineage
from rxtally.sinks import manifest
from rxtally.sinks import tables as sinks
from rxtally.sources import snapshots
from rxtally.sources import tables as sources
from rxtally.streaming import refresh


@dataclass
class Inputs:
    """The tables a release reads; ``history`` is the stored monthly aggregate, if any.

    ``raw`` names the stored table of joined items (``sinks.save_raw``). With it the fact and the dimensions of
    organisations, drugs and ages are not read, and ``fact`` may be None.
    """

    fact: DataFrame | None
    time: DataFrame
    organisations: DataFrame
    drugs: DataFrame
    ages: DataFrame
    days: DataFrame
    history: DataFrame | None = None
    raw: str | None = None


@dataclass
class Release:
    """Results by name; ``skipped`` when the warehouse holds no complete quarter, or nothing new.

    ``tables`` are exact; ``published`` are the same after disclosure control, and what ``store`` gives out.
    """

    month: int | None
    skipped: bool = False
    tables: dict[str, DataFrame] = field(default_factory=dict)
    published: dict[str, DataFrame] = field(default_factory=dict)


def _of_country(organisations: DataFrame, config: ReleaseConfig) -> DataFrame:
    """Organisations of the release's country; a table without countries is taken as it is."""
    if "COUNTRY" in organisations.columns:
        return sources.organisation_dim(organisations, config.country)
    return organisations


def build(
    inputs: Inputs, config: ReleaseConfig, quarter: str = "FINANCIAL_QUARTER", sets: str | None = None
) -> Release:
    """Compute every table of the release without writing any.

    The items are joined and reduced once; all tables start from the three small
    aggregates that come out of that job. With ``sets``, a folder of stored
    patient sets, only the items of months that it lacks are read, and it is
    extended by them; it belongs to one choice of country, sections and first
    month.
    """
    # A calendar may run past the items: only months that are loaded can complete a quarter.
    if inputs.raw is None:
        loaded = sources.latest_loaded(inputs.time, inputs.fact, config.first_month)
    else:
        last = sources.largest_partition(inputs.time.sparkSession, inputs.raw)
        loaded = inputs.time.filter(F.col("YEAR_MONTH").between(config.first_month, F.lit(last)))
    latest = windows.latest_complete_quarter(loaded, quarter).first()
    if latest is None:
        return Release(None, skipped=True)
    month = latest["YEAR_MONTH"]
    if inputs.history is not None and not refresh.is_newer(loaded, inputs.history, quarter):
        return Release(month, skipped=True)

    time = inputs.time.filter(F.col("YEAR_MONTH").between(config.first_month, month))
    drugs = inputs.drugs.filter(F.col("BNF_SECTION").isin(*config.sections))

    def items_between(first: int, last: int) -> DataFrame:
        if inputs.raw is not None:
            sections = F.col("BNF_SECTION").isin(*config.sections)
            return time.sparkSession.table(inputs.raw).filter(F.col("YEAR_MONTH").between(first, last) & sections)
        fact = sources.prescription_fact(inputs.fact, first, last)
        return joins.star_join(fact, time, _of_country(inputs.organisations, config), drugs, inputs.ages)

    if sets is None:
        grains = extract.saved_grains(items_between(config.first_month, month), time)
    else:
        stored = refresh.extend_sets(time.sparkSession, sets, items_between, config.first_month, month)
        within = stored.filter(F.col("YEAR_MONTH").between(config.first_month, month))
        saved = cut_lineage(patient_sets.all_grains(within, time))
        grains = {name: extract.pick_grain(saved, name) for name in extract.GRAINS}
    return _release(month, grains, inputs.days, config)


def from_snapshots(spark: SparkSession, folder: str, days: DataFrame, config: ReleaseConfig) -> Release:
    """The same tables from the stored aggregates of the newest finished release, without a look at the items."""
    stored = {row["table"]: row for row in manifest.tables(spark, manifest.newest_release(spark, folder)).collect()}
    grains = {}
    for name, schema in extract.GRAINS.items():
        path, form = stored[name]["path"], stored[name]["form"]
        csv = form == "csv"
        grains[name] = snapshots.read_delimited(spark, path, schema) if csv else spark.read.schema(schema).parquet(path)
    month = grains["monthly"].agg(F.max("YEAR_MONTH")).first()[0]
    return _release(month, grains, days, config)


def _release(month: int, grains: dict[str, DataFrame], days: DataFrame, config: ReleaseConfig) -> Release:
    banded = cut_lineage(model.banded_input(grains["model"], days, config))
    models = model.fit_release(banded, config)
    expected = cut_lineage(model.actual_and_expected(banded, models, config))
    fitted = {
        "model_statistics": regression.fit_statistics(models, model.BY),
        "model_coefficients": regression.coefficient_table(models, model.BY),
    }
    control = disclosure.control(grains, config.small_cell)
    shown = {name: cut_lineage(control.table(grains[name], name)) for name in grains}
    shown_expected = control.table(expected, "known", ["total_items"])
    return Release(
        month,
        tables={**_tables(grains, expected, days, config), **fitted},
        published={**_tables(shown, shown_expected, days, config), **fitted},
    )


def _tables(
    grains: dict[str, DataFrame], expected: DataFrame, days: DataFrame, config: ReleaseConfig
) -> dict[str, DataFrame]:
    """Every published table, from the three stored aggregates and the expected items."""
    quarterly, monthly = grains["quarterly"], grains["monthly"]
    series = publish.monthly_series(monthly, days)
    return {
        **grains,
        "identification_text": publish.identification_text(quarterly, config.rate_quarters),
        "identification": publish.identification_table(quarterly),
        "monthly_series": series,
        "quarterly_figures": publish.quarterly_figures(quarterly, config),
        "monthly_figures": publish.monthly_figures(series, config),
        "published_monthly": publish.published_monthly(monthly),
        "published_quarterly": publish.published_quarterly(quarterly),
        "expected": expected,
        "expected_figures": model.expected_figures(expected, config),
        "expected_totals": model.expected_totals(expected, config),
        "indicators": indicators.indicator_table(quarterly, monthly),
    }


# Tables published with a title, and the notes under it.
_TITLES = {
    "identification": "Share of items with a verified patient number (%)",
    "published_monthly": "Totals by month",
    "published_quarterly": "Totals by quarter",
}
_NOTES = [
    "Field definitions are in the data dictionary.",
    "Patient counts must not be added up to any other level.",
]
_FILES = (
    "identification_text", "monthly_series", "quarterly_figures", "monthly_figures", "model_statistics",
    "model_coefficients", "expected", "expected_figures", "expected_totals",
)


def store(release: Release, folder: str, prefix: str, form: str = "csv") -> str | None:
    """Write a release into a folder of its own, its published tables and views; returns the folder.

    The exact aggregates are stored for later runs; everything else that is written has passed disclosure control. The
    list of all tables comes last, and readers take no release without it, so a run that ends half-way is not seen.
    """
    if release.skipped:
        return None
    month, shown = release.month, release.published
    spark, target = shown["indicators"].sparkSession, manifest.new_release(folder, release.month)
    stored = []

    def noted(name: str, path: str, form_: str, table: DataFrame) -> None:
        stored.append((name, path, form_, table.count(), table.schema.json()))

    for name, schema in extract.GRAINS.items():
        path = sinks.save_snapshot(release.tables[name], target, name, month, form)
        back = snapshots.read_delimited(spark, path, schema) if form == "csv" else spark.read.schema(schema).parquet(path)
        noted(name, path, form, back)
    for name in _FILES:
        path = f"{target}/{name}_{month}"
        sinks.save_csv(shown[name], path)
        noted(name, path, "csv", snapshots.read_delimited(spark, path, shown[name].schema))
    path = f"{target}/indicators_{month}"
    sinks.save_indicators(shown["indicators"], path)
    saved = sinks.read_indicators(spark, path)
    noted("indicators", path, "parquet", saved)
    for name, title in _TITLES.items():
        table = sinks.stamped(f"{prefix}_{name}", month)
        noted(name, table, "table", sinks.publish_table(shown[name], table, title, _NOTES, publish.DATA_DICTIONARY))
    dictionary = sinks.materialise(publish.data_dictionary(spark), f"{prefix}_data_dictionary", month)
    noted("data_dictionary", sinks.stamped(f"{prefix}_data_dictionary", month), "table", dictionary)
    codes = [row["SECTION_CODE"] for row in saved.select("SECTION_CODE").distinct().collect()]
    sinks.register_indicators(saved, sorted(codes))
    manifest.finish(spark, target, stored)
    return target
