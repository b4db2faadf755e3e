"""Secondary suppression on hand-made margins and on the driver tables."""

import itertools

from pyspark.sql import functions as F

from rxtally import schemas
from rxtally.operators import disclosure

FY, Q3 = "2022/2023", "2022/2023 Q3"


def grains_of(spark, people):
    """The three aggregates of (month, flag, gender, band, items, patients); a person's month is counted once."""
    model = [(FY, Q3, m, "n", "0401", f, g, b, i, i, p) for m, f, g, b, i, p in people]
    frame = spark.createDataFrame(
        [(*r[:9], None, r[10]) for r in model], schemas.MODEL
    ).withColumn("ITEM_PAY_DR_NIC", F.col("ITEM_COUNT").cast("decimal(18,2)"))
    sums = [F.sum(c).alias(c) for c in disclosure.MEASURES]
    pay = F.col("ITEM_PAY_DR_NIC").cast("decimal(18,2)").alias("ITEM_PAY_DR_NIC")

    def by(keys, schema):
        return frame.groupBy(*keys).agg(*sums).select(*[pay if n == "ITEM_PAY_DR_NIC" else n for n in schema.fieldNames()])

    return {
        "model": frame,
        "monthly": by(["FINANCIAL_YEAR", "FINANCIAL_QUARTER", *disclosure.MONTH], schemas.MONTHLY),
        "quarterly": by(disclosure.QUARTER, schemas.QUARTERLY),
    }


def blanks(shown, name, *keys):
    return sorted(tuple(r[k] for k in keys) for r in shown[name].filter("ITEM_COUNT is null").collect())


def holds(exact, shown):
    return [tuple(r) for r in disclosure.audit(exact, shown).filter("open > 0").collect()] == []


def test_smallest_neighbour_is_blanked_with_a_small_cell(spark):
    people = [(m, "Y", g, "20-24", n, n) for m in (202210, 202211, 202212) for g, n in (("F", 30), ("M", 20), ("U", 90))]
    people[1] = (202210, "Y", "M", "20-24", 3, 3)
    exact = grains_of(spark, people)
    assert not holds(exact, exact)
    shown = disclosure.controlled_grains(exact)
    assert holds(exact, shown)
    # U is outside the known people, so hiding it would leave the actual total to tell M from F.
    assert blanks(shown, "model", "YEAR_MONTH", "PDS_GENDER") == [(202210, "F"), (202210, "M")]
    assert not blanks(shown, "monthly", "YEAR_MONTH") and not blanks(shown, "quarterly", "FINANCIAL_QUARTER")


def test_a_lone_cell_takes_its_totals_along(spark):
    people = [(202210, "Y", "F", "20-24", 2, 2), (202211, "Y", "F", "20-24", 50, 50), (202212, "Y", "F", "20-24", 60, 60)]
    exact = grains_of(spark, people)
    shown = disclosure.controlled_grains(exact)
    assert holds(exact, shown)
    assert blanks(shown, "monthly", "YEAR_MONTH") == [(202210,), (202211,)]
    assert blanks(shown, "model", "YEAR_MONTH") == [(202210,), (202211,)]
    assert not blanks(shown, "quarterly", "FINANCIAL_QUARTER")


def test_nothing_small_nothing_blank(spark):
    exact = grains_of(spark, [(202210, "Y", "F", "20-24", 9, 5), (202210, "N", "U", "Unknown", 1, 0)])
    shown = disclosure.controlled_grains(exact)
    assert all(shown[n].exceptAll(exact[n].select(*shown[n].columns)).isEmpty() for n in exact)


def test_empty_and_missing_labels(spark):
    exact = grains_of(spark, [(202210, None, None, None, 2, 2), (202210, None, "F", None, 7, 7)])
    assert holds(exact, disclosure.controlled_grains(exact))
    none = {n: df.limit(0) for n, df in exact.items()}
    assert all(df.count() == 0 for df in disclosure.controlled_grains(none).values())


def test_many_small_tables(spark):
    people = [
        (m, f, g, b, 1 + (7 * k * k + 3 * m) % 23, (1 + (7 * k * k + 3 * m) % 23) if f == "Y" else 0)
        for k, (m, f, g, b) in enumerate(
            itertools.product((202210, 202211, 202212), "YN", "FMU", ("00-04", "05-09", "Unknown"))
        )
        if k % 5
    ]
    exact = grains_of(spark, people)
    shown = disclosure.controlled_grains(exact)
    assert holds(exact, shown)
    assert shown["model"].filter("ITEM_COUNT is not null").count() > 0
