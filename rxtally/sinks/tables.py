"""Writers: stored tables, snapshots, model CSVs, published tables, indicators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rxtally import schemas
from rxtally.sinks import manifest


def stamped(name: str, month: int) -> str:
    return f"{name}_{month}"


def materialise(df: DataFrame, name: str, month: int | None = None) -> DataFrame:
    """Replace the catalog table ``name`` (month-stamped if asked) and read it back."""
    table = stamped(name, month) if month else name
    df.write.mode("overwrite").saveAsTable(table)
    return df.sparkSession.table(table)


def save_raw(df: DataFrame, name: str) -> DataFrame:
    """Store the joined items partitioned by month, so later month filters prune files.

    Rebalancing lets Spark split a large month over many files of the advisory
    size and put small ones together.
    """
    (
        df.hint("rebalance", "YEAR_MONTH")
        .write.mode("overwrite")
        .partitionBy("YEAR_MONTH")
        .saveAsTable(name)
    )
    return df.sparkSession.table(name)


def snapshot_path(folder: str, name: str, month: int) -> str:
    return f"{folder.rstrip('/')}/{name}/snapshot={month}"


def save_snapshot(df: DataFrame, folder: str, name: str, month: int, form: str = "csv") -> str:
    """Write an aggregate under ``name/snapshot=YYYYMM``, then mark it as finished; returns the path."""
    path = snapshot_path(folder, name, month)
    writer = df.write.mode("overwrite")
    if form == "csv":
        writer.option("header", "true").csv(path)
    else:
        writer.parquet(path)
    manifest.mark(df, path, form)
    return path


def save_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", "true").csv(path)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def publish_table(
    df: DataFrame, name: str, title: str, notes: list[str], descriptions: dict[str, str] | None = None
) -> DataFrame:
    """Replace a published table; title and notes become table properties.

    Column names with spaces are kept; descriptions become column comments.
    """
    spark = df.sparkSession
    described = df.select(
        *[
            F.col(f"`{column}`").alias(column, metadata={"comment": descriptions[column]})
            if descriptions and column in descriptions
            else F.col(f"`{column}`")
            for column in df.columns
        ]
    )
    described.write.mode("overwrite").saveAsTable(name)
    properties = {"title": title, **{f"note_{k}": note for k, note in enumerate(notes, start=1)}}
    listed = ", ".join(f"'{key}' = {_quoted(value)}" for key, value in properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")
    return spark.table(name)


def save_indicators(df: DataFrame, path: str) -> None:
    """One folder per section; fails if the table is already there."""
    df.write.mode("errorifexists").partitionBy("SECTION_CODE").parquet(path)


def read_indicators(spark: SparkSession, path: str) -> DataFrame:
    """Stored indicators; the declared schema keeps the leading zero of the section folders."""
    return spark.read.schema(schemas.INDICATORS).parquet(path)


def register_indicators(df: DataFrame, sections: list[str]) -> list[str]:
    """A temporary view ``table_<code>`` per section for later queries."""
    names = []
    for code in sections:
        name = f"table_{code}"
        df.filter(F.col("SECTION_CODE") == code).drop("SECTION_CODE").createOrReplaceTempView(name)
        names.append(name)
    return names
