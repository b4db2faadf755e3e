"""From fact and dimensions to the three saved aggregates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxtally import schemas
from rxtally.operators import aggregates
from rxtally.session import cut_lineage

GRAINS = {
    "quarterly": schemas.QUARTERLY,
    "monthly": schemas.MONTHLY,
    "model": schemas.MODEL,
}
BUILDERS = {
    "quarterly": aggregates.quarterly_totals,
    "monthly": aggregates.monthly_totals,
    "model": aggregates.model_totals,
}


def all_grains(items: DataFrame, time_dim: DataFrame) -> DataFrame:
    """Quarterly, monthly and model totals in one frame, told apart by ``GRAIN``.

    One plan: the branches share the scan, the joins and the patient-grain
    shuffle, which Spark reuses inside a query.
    """
    grains = aggregates.grains_from_base(aggregates.patient_base(items), time_dim)
    labelled = [df.withColumn("GRAIN", F.lit(name)) for name, df in grains.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)


def pick_grain(grains: DataFrame, name: str) -> DataFrame:
    return grains.filter(F.col("GRAIN") == name).select(*GRAINS[name].fieldNames())


def saved_grains(
    items: DataFrame, time_dim: DataFrame, names: tuple[str, ...] = tuple(GRAINS)
) -> dict[str, DataFrame]:
    """The published aggregates, computed once and read back from the checkpoint folder.

    They are small (periods by sections by labels); everything downstream starts
    from them and never touches the items again.
    """
    if len(names) == 1:
        build = BUILDERS[names[0]]
        return {names[0]: cut_lineage(build(items, time_dim).select(*GRAINS[names[0]].fieldNames()))}
    saved = cut_lineage(all_grains(items, time_dim).filter(F.col("GRAIN").isin(*names)))
    return {name: pick_grain(saved, name) for name in names}
