"""Disclosure control: small cells are blanked, and further cells so that no blank follows from published totals.

A cell is one row of a saved aggregate. Published sums tie cells together in equations: the cells of a month, section and
flag add up to the monthly cell, the months of a quarter to the quarterly cell, the cells of known people to the actual
total of a section and month. An equation with one unknown gives it away. So in each equation with exactly one blank the
smallest shown cell is blanked too, the total itself where no part is left, and this is repeated until no equation has a
single unknown. Blanks are only ever added, so the rounds end. Totals over both flags need no equation of their own:
they are added up from the controlled cells and are missing when a part is.

The work is on saved aggregates: an aggregate by equation and a join by cell in each round. An equation's cells are
combined before they are shuffled, and no group is brought together in one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtally.operators.predicates import known_person
from rxtally.session import cut_lineage

MEASURES = ["ITEM_COUNT", "ITEM_PAY_DR_NIC", "PATIENT_COUNT"]
SECTION = ["SECTION_NAME", "SECTION_CODE"]
QUARTER = ["FINANCIAL_YEAR", "FINANCIAL_QUARTER", *SECTION, "IDENTIFIED_FLAG"]
MONTH = ["YEAR_MONTH", *SECTION, "IDENTIFIED_FLAG"]
PERSON = [*MONTH, "PDS_GENDER", "DALL_5YR_BAND"]
KNOWN = ["YEAR_MONTH", "SECTION_CODE"]
CELLS = {"quarterly": QUARTER, "monthly": MONTH, "model": PERSON, "known": KNOWN}


def small(threshold: int) -> Column:
    return F.coalesce(F.col("PATIENT_COUNT").between(1, threshold - 1), F.lit(False))


def _key(kind: str, columns: list[str]) -> Column:
    """A name for a cell or an equation: missing labels are left out of it, which keeps names apart."""
    return F.to_json(F.struct(F.lit(kind).alias("kind"), *columns))


def known_totals(model: DataFrame) -> DataFrame:
    """Items of people of known gender and band by section and month: what the expected items stand beside."""
    return model.filter(known_person(["DALL_5YR_BAND"])).groupBy(*KNOWN).agg(F.sum("ITEM_COUNT").alias("ITEM_COUNT"))


def memberships(grains: dict[str, DataFrame], threshold: int = 5) -> DataFrame:
    """equation, cell, items, blank: every cell of every equation; blank marks the cells that are small themselves."""
    quarterly, monthly, model = (grains[name] for name in ("quarterly", "monthly", "model"))

    def part(df: DataFrame, level: str, equation: str, columns: list[str], blank: Column) -> DataFrame:
        return df.select(
            _key(equation, columns).alias("equation"),
            _key(level, CELLS[level]).alias("cell"),
            F.abs("ITEM_COUNT").alias("items"),
            blank.alias("blank"),
        )

    own = small(threshold)
    return (
        part(model, "model", "month", MONTH, own)
        .unionByName(part(monthly, "monthly", "month", MONTH, own))
        .unionByName(part(monthly, "monthly", "quarter", QUARTER, own))
        .unionByName(part(quarterly, "quarterly", "quarter", QUARTER, own))
        .unionByName(part(model.filter(known_person(["DALL_5YR_BAND"])), "model", "known", KNOWN, own))
        .unionByName(part(known_totals(model), "known", "known", KNOWN, F.lit(False)))
    )


def blanked_cells(members: DataFrame) -> DataFrame:
    """cell: all cells to blank. Each round is saved, and the next one starts from it."""
    current = cut_lineage(members)
    shown = F.when(~F.col("blank") & (F.col("items") > 0), F.struct("items", "cell"))
    while True:
        picked = cut_lineage(
            current.groupBy("equation")
            .agg(F.count_if("blank").alias("unknown"), F.min(shown).alias("least"))
            .filter("unknown = 1 and least is not null")
            .select(F.col("least.cell").alias("picked"))
            .distinct()
        )
        if picked.isEmpty():
            return current.filter("blank").select("cell").distinct()
        joined = current.join(picked, current["cell"] == picked["picked"], "left")
        blank = (F.col("blank") | F.col("picked").isNotNull()).alias("blank")
        current = cut_lineage(joined.select("equation", "cell", "items", blank))


@dataclass(frozen=True)
class Control:
    """The blanked cells of one release; applies them to tables of a level."""

    blanks: DataFrame

    def table(self, df: DataFrame, level: str, measures: list[str] | None = None) -> DataFrame:
        """The same rows, with the measures of blanked cells missing."""
        names = [name for name in measures or MEASURES if name in df.columns]
        hidden = self.blanks.withColumnRenamed("cell", "_hidden")
        marked = df.withColumn("_cell", _key(level, CELLS[level]))
        joined = marked.join(hidden, marked["_cell"] == hidden["_hidden"], "left")
        blanked = {name: F.when(F.col("_hidden").isNull(), F.col(name)) for name in names}
        return joined.withColumns(blanked).drop("_cell", "_hidden")


def control(grains: dict[str, DataFrame], threshold: int = 5) -> Control:
    return Control(cut_lineage(blanked_cells(memberships(grains, threshold))))


def controlled_grains(grains: dict[str, DataFrame], threshold: int = 5) -> dict[str, DataFrame]:
    """Quarterly, monthly and model totals as they may be published."""
    found = control(grains, threshold)
    return {name: found.table(grains[name], name) for name in ("quarterly", "monthly", "model")}


def audit(exact: dict[str, DataFrame], shown: dict[str, DataFrame], threshold: int = 5) -> DataFrame:
    """By kind of equation: how many there are, and how many have a single unknown; small cells shown, values changed.

    Works on the tables alone, so that it also checks tables that were stored and read back.
    """

    def unknowns(df: DataFrame, columns: list[str]) -> DataFrame:
        return df.select(*columns, F.col("ITEM_COUNT").isNull().cast("int").alias("unknown"))

    def equations(kind: str, columns: list[str], *parts: DataFrame) -> DataFrame:
        rows = parts[0]
        for more in parts[1:]:
            rows = rows.unionByName(more)
        each = rows.groupBy(*columns).agg(F.sum("unknown").alias("unknown"))
        return each.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("unknown") == 1).alias("open")).withColumn(
            "kind", F.lit(kind)
        )

    def cells(name: str) -> DataFrame:
        keys = CELLS[name]
        both = exact[name].select(_key(name, keys).alias("cell"), F.struct(*MEASURES).alias("exact"), small(threshold).alias("small"))
        now = shown[name].select(_key(name, keys).alias("seen"), F.struct(*MEASURES).alias("now"))
        joined = both.join(now, F.col("cell") == F.col("seen"), "full")
        absent = F.coalesce(F.col("now.ITEM_COUNT"), F.col("now.ITEM_PAY_DR_NIC"), F.col("now.PATIENT_COUNT")).isNull()
        open_ = (F.col("small") & ~absent) | (~absent & ~F.col("now").eqNullSafe(F.col("exact")))
        return joined.agg(F.count(F.lit(1)).alias("n"), F.count_if(open_).alias("open")).withColumn(
            "kind", F.lit(f"{name} cells")
        )

    monthly, model = shown["monthly"], shown["model"]
    return (
        equations("month", MONTH, unknowns(model, MONTH), unknowns(monthly, MONTH))
        .unionByName(equations("quarter", QUARTER, unknowns(monthly, QUARTER), unknowns(shown["quarterly"], QUARTER)))
        .unionByName(cells("quarterly"))
        .unionByName(cells("monthly"))
        .unionByName(cells("model"))
    )
