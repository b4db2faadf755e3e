"""The star schema and saved aggregates of one folder of driver tables."""

from __future__ import annotations

from functools import cached_property
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxtally.config import DRIVER_RELEASE
from rxtally.operators import joins
from rxtally.plans import extract, model
from rxtally.session import cut_lineage, ensure_checkpoint_dir
from rxtally.sources import driver_tables


class Tables:
    """Frames are built when first asked for, once per query."""

    config = DRIVER_RELEASE

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def raw(self, name: str) -> DataFrame:
        return driver_tables.table(self.spark, self.folder, name)

    def new_folder(self) -> str:
        """An unused folder beside the checkpoints, for queries that store and read back."""
        return f"{ensure_checkpoint_dir(self.spark)}/stored-{uuid4().hex}"

    @cached_property
    def fact(self) -> DataFrame:
        return driver_tables.fact(self.spark, self.folder)

    @cached_property
    def time(self) -> DataFrame:
        return driver_tables.time_dim(self.spark, self.folder)

    @cached_property
    def days(self) -> DataFrame:
        return driver_tables.dispensing_days(self.spark, self.folder)

    @cached_property
    def org(self) -> DataFrame:
        return driver_tables.org_dim(self.spark, self.folder)

    @cached_property
    def drug(self) -> DataFrame:
        return driver_tables.drug_records(self.spark, self.folder)

    @cached_property
    def age(self) -> DataFrame:
        """Saved, as dimensions are: Spark then plans with its hundred rows, not with the orders they come from."""
        return cut_lineage(driver_tables.age_dim(self.spark, self.folder))

    @cached_property
    def items(self) -> DataFrame:
        return joins.star_join(self.fact, self.time, self.org, self.drug, self.age)

    @cached_property
    def release_items(self) -> DataFrame:
        """Items up to the last complete fiscal quarter."""
        return self.items.filter(F.col("YEAR_MONTH") <= self.config.predict_end)

    def saved(self, *names: str, complete_quarters: bool = False) -> list[DataFrame]:
        """Saved aggregates by name, from one extract."""
        items = self.release_items if complete_quarters else self.items
        found = extract.saved_grains(items, self.time, names)
        return [found[name] for name in names]

    def single_use(self, name: str) -> DataFrame:
        """A saved aggregate by name for a query that reads it once: not saved, so that filters reach the scans."""
        return extract.BUILDERS[name](self.items, self.time).select(*extract.GRAINS[name].fieldNames())

    @cached_property
    def quarterly(self) -> DataFrame:
        return self.saved("quarterly")[0]

    @cached_property
    def monthly(self) -> DataFrame:
        return self.saved("monthly")[0]

    @cached_property
    def model(self) -> DataFrame:
        return self.saved("model")[0]

    @cached_property
    def banded(self) -> DataFrame:
        """The 20-year model input, saved because fit and prediction both read it."""
        return cut_lineage(model.banded_input(self.model, self.days, self.config))

    @cached_property
    def fitted(self) -> DataFrame:
        """The fitted models: one row per section."""
        return model.fit_release(self.banded, self.config)
