"""Mixing sources to target weights by capped water-filling (operator 3), in DataFrame operations only.

Every source gets a share of all words in proportion to its weight. Sources above ``max_epochs`` times their own
size are clamped there and the excess goes to the others in proportion to their weights, until none is above. A
source then takes every document the whole number of times in ``target / size``; the rest is a seeded choice of
whole documents: in the order of a hash of the row, documents are taken until the words left over are used up.

The choice needs no sort of a source: hashes fall into ``BUCKETS`` equal ranges, words are added up by source and
range, and only the one range in which a source's words run out is put in order, a ``1 / BUCKETS`` part of the source.

Defined results: a null text has size 0 and takes nothing, a null source is a source of its own, an empty table gives
an empty table, repeated rows are separate rows. Sources of size 0 have target 0. A source without a weight, or with
a weight of zero, gets nothing. Only the columns named here are read, so that others may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rxtally.llm.storage import stored
from rxtally.llm.text import n_words

BUCKETS = 4096


def source_sizes(documents: DataFrame) -> DataFrame:
    """source, source_size: words of each source."""
    return documents.groupBy("source").agg(F.sum("size").alias("source_size"))


def cyclic_weights(sizes: DataFrame, cycle: int = 3) -> DataFrame:
    """Weights 1..cycle, repeating over the sources by code point, null last; one row for each source is ordered."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    return sizes.select("source", (F.pmod(F.row_number().over(by_name) - 1, F.lit(cycle)) + 1).alias("weight"))


def targets(sizes: DataFrame, weights: DataFrame, max_epochs: float = 3.0) -> DataFrame:
    """source, source_size, target: the water level of each source.

    Works on one row for each source. A round finds which free sources would be above their caps and clamps them; it
    reads back one row with the words and the weight left for the free ones.
    """
    level = stored(
        sizes.alias("s")
        .join(weights.alias("w"), F.col("s.source").eqNullSafe(F.col("w.source")), "left")
        .select(
            "s.source",
            "source_size",
            F.greatest(F.coalesce(F.col("weight").cast("double"), F.lit(0.0)), F.lit(0.0)).alias("weight"),
            (F.col("source_size") * F.lit(float(max_epochs))).alias("cap"),
        )
    )
    total = level.agg(F.sum("source_size")).first()[0] or 0
    rate = None  # words for each unit of weight
    while True:
        clamped = F.lit(False) if rate is None else F.col("weight") * F.lit(rate) > F.col("cap")
        left = level.agg(
            F.sum(F.when(clamped, F.col("cap")).otherwise(F.lit(0.0))).alias("used"),
            F.sum(F.when(clamped, F.lit(0.0)).otherwise(F.col("weight"))).alias("weight"),
        ).first()
        used, weight = left["used"] or 0.0, left["weight"] or 0.0
        # Rates only rise from round to round: what is clamped stays clamped.
        higher = (total - used) / weight if weight > 0 else rate or 0.0
        if rate is not None and higher <= rate:
            break
        rate = higher
    return level.select(
        "source", "source_size", F.least(F.col("weight") * F.lit(float(rate or 0.0)), F.col("cap")).alias("target")
    )


def sized(documents: DataFrame, *keep: str, seed: int = 0) -> DataFrame:
    """The kept columns with size and draw, the row's seeded place in the order of its source."""
    draw = F.xxhash64(F.lit(seed), "doc_id", "text")
    return documents.select(*keep, "source", n_words(F.col("text")).alias("size"), draw.alias("draw"))


def repetitions(rows: DataFrame, level: DataFrame) -> DataFrame:
    """``rows`` (key columns, source, size, draw) with source_size, target and reps, how often the mix takes the row.

    ``rows`` should be stored: they are read three times.
    """
    epochs = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    level = stored(
        level.select(
            F.col("source").alias("level_source"),
            "source_size",
            "target",
            F.floor(epochs).alias("whole"),
            (F.col("target") - F.floor(epochs) * F.col("source_size")).alias("rest"),
        )
    )
    bucket = F.shiftrightunsigned(F.col("draw"), 64 - BUCKETS.bit_length() + 1).cast("int")
    joined = rows.withColumn("bucket", bucket).join(level, F.col("source").eqNullSafe(F.col("level_source")))
    running = Window.partitionBy("level_source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    words = (
        joined.groupBy("level_source", "bucket")
        .agg(F.sum("size").alias("words"), F.first("rest").alias("rest"))
        .withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0)))
    )
    # The range in which the rest of a source runs out; earlier ranges are taken whole.
    edge = stored(
        words.filter((F.col("before") <= F.col("rest")) & (F.col("rest") < F.col("before") + F.col("words"))).select(
            F.col("level_source").alias("edge_source"), F.col("bucket").alias("edge"), F.col("before").alias("edge_before")
        )
    )
    placed = joined.join(edge, F.col("level_source").eqNullSafe(F.col("edge_source")), "left")
    keys = [c for c in rows.columns if c not in ("source", "size", "draw")]
    out = [*keys, "source", "size", "source_size", "target"]
    within = Window.partitionBy("level_source").orderBy("draw", *keys).rowsBetween(Window.unboundedPreceding, -1)
    on_edge = placed.filter(F.col("bucket") == F.col("edge")).withColumn(
        "before", F.col("edge_before") + F.coalesce(F.sum("size").over(within), F.lit(0))
    )
    # A document is taken if at least half of it fits into what is left.
    fits = F.col("before") + F.col("size") / 2 <= F.col("rest")
    off_edge = placed.filter(F.col("edge").isNull() | (F.col("bucket") != F.col("edge")))
    early = F.col("edge").isNull() & (F.col("rest") > 0) | (F.col("bucket") < F.col("edge"))
    return on_edge.select(*out, (F.col("whole") + fits.cast("long")).alias("reps")).unionByName(
        off_edge.select(*out, (F.col("whole") + F.coalesce(early, F.lit(False)).cast("long")).alias("reps"))
    )


def mixed(documents: DataFrame, *keep: str, cycle: int = 3, max_epochs: float = 3.0, seed: int = 0) -> DataFrame:
    """The kept columns with source, size, source_size, target and reps for every document."""
    rows = stored(sized(documents, *keep, seed=seed))
    sizes = stored(source_sizes(rows))
    return repetitions(rows, targets(sizes, cyclic_weights(sizes, cycle), max_epochs))
