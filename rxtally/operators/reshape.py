"""Pivots, unpivots, filling of absent combinations and month flags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FLAGS = ("Y", "N")


def flags_to_columns(
    df: DataFrame, keys: Sequence[str], measures: Iterable[str], flags: Iterable[str] = FLAGS
) -> DataFrame:
    """One column per measure and flag (``ITEM_COUNT_Y``, ...).

    The flags are known, so conditional sums do it in one pass; an absent flag
    stays NULL.
    """
    flags = tuple(flags)
    return df.groupBy(*keys).agg(
        *[
            F.sum(F.when(F.col("IDENTIFIED_FLAG") == flag, F.col(name))).alias(f"{name}_{flag}")
            for name in measures
            for flag in flags
        ]
    )


def quarters_to_columns(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One column per fiscal quarter, in time order.

    The list of quarters is read first: it has four entries per year of data and
    sets the width of the result.
    """
    listed = df.select("FINANCIAL_QUARTER").distinct().orderBy("FINANCIAL_QUARTER").collect()
    quarters = [row["FINANCIAL_QUARTER"] for row in listed]
    return df.groupBy(*keys).pivot("FINANCIAL_QUARTER", quarters).agg(F.first(value))


def measures_to_rows(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    name: str = "measure",
    value: str = "value",
) -> DataFrame:
    return df.unpivot(list(keys), list(measures), name, value)


def _domain(df: DataFrame, column: str):
    """Every value of a label column as one array, with NULL if it occurs."""
    values = F.array_sort(F.collect_set(column))
    has_null = F.max(F.col(column).isNull())
    return df.agg(
        F.when(has_null, F.concat(values, F.array(F.lit(None).cast("string")))).otherwise(values)
    ).scalar()


def complete(
    df: DataFrame, keys: Sequence[str], domains: Sequence[str], fill: Mapping[str, int]
) -> DataFrame:
    """Every combination of the domain labels for each observed key; new measures are filled.

    ``df`` is an aggregate with one row per key and label combination. The labels
    are few and fixed by classification, so the grid is grown by exploding their
    arrays instead of joining every key with every label.
    """
    grid = df.select(*keys).distinct()
    for name in domains:
        grid = grid.withColumn(name, F.explode(_domain(df, name)))
    columns = [*keys, *domains]
    found = df.select(
        *[F.col(name).alias(f"_{name}") for name in columns], *[F.col(name) for name in fill]
    )
    match = [grid[name].eqNullSafe(found[f"_{name}"]) for name in columns]
    return grid.join(found, match, "left").select(
        *[grid[name] for name in columns],
        *[F.coalesce(F.col(name), F.lit(zero)).alias(name) for name, zero in fill.items()],
    )


def with_month_flags(df: DataFrame, month: str = "MONTH_NUM") -> DataFrame:
    """Twelve 0/1 columns ``m_01`` ... ``m_12``."""
    return df.withColumns(
        {f"m_{k:02d}": (F.col(month) == k).cast("double") for k in range(1, 13)}
    )
