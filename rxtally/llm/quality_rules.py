"""Quality rules (operator 9): rule counts and a hashed n-gram likelihood ratio, in DataFrame operations only.

The verdict compares two multinomials over hashed word n-grams: one of a trusted target, one of the raw corpus. A
document's score is the mean over its n-grams of the logarithm of the two probabilities' ratio; a document under the
threshold is dropped, and nothing is drawn at random.

Both tables have ``buckets`` rows whatever the input; they are folded into one array of that length, which the scoring
pass reads as a scalar subquery. Counting combines on the map side, so a frequent word costs a row for each task.

Defined results: a null text has no words and fails the base rules; a text without n-grams scores 0. An empty target
or corpus gives every bucket the same smoothed probability. Repeated rows count as often as they stand there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rxtally.llm.storage import stored
from rxtally.llm.text import WORD, let, words

BUCKETS = 65_536
WINDOW = 5
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
# Clean prose stays above this mean for each n-gram, short texts of small corpora included.
THRESHOLD = -0.3


def window_hashes(hashes: Column, width: int) -> Column:
    """A hash for every run of ``width`` words; none if there are fewer. ``hashes`` has a hash for each word."""

    def windows(hs: Column) -> Column:
        run = lambda i: F.xxhash64(*[F.get(hs, i + k) for k in range(width)])
        n = F.size(hs)
        return F.when(n < width, F.array().cast("array<bigint>")).otherwise(
            F.transform(F.sequence(F.lit(0), n - width), run)
        )

    return let(hashes, windows)


def repeated_words(windows: Column) -> Column:
    """Words inside windows of five that occur twice or more in the text, the first occurrence included.

    Windows are compared by 64-bit hashes. Sorting (hash, place) puts equal windows side by side; the places found
    are then sorted and each adds the words not covered by the one before it.
    """

    def places(ordered: Column) -> Column:
        def twin(e: Column, k: Column) -> Column:
            before, after = F.get(ordered, k - 1)["h"], F.get(ordered, k + 1)["h"]
            return F.when(F.coalesce(before == e["h"], F.lit(False)) | F.coalesce(after == e["h"], F.lit(False)), e["i"])

        return F.sort_array(F.filter(F.transform(ordered, twin), lambda i: i.isNotNull()))

    def cover(found: Column) -> Column:
        new = lambda p, k: F.when(k == 0, WINDOW).otherwise(F.least(F.lit(WINDOW), p - F.get(found, k - 1)))
        return F.aggregate(F.transform(found, new), F.lit(0), lambda total, g: total + g)

    def counted(ws: Column) -> Column:
        entries = F.sort_array(F.transform(ws, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        repeated = let(entries, lambda e: let(places(e), cover))
        return F.when(F.size(F.array_distinct(ws)) == F.size(ws), F.lit(0)).otherwise(repeated).cast("long")

    return let(windows, counted)


def hashed(documents: DataFrame, *keep: str) -> DataFrame:
    """The kept columns with text_, words_ and hashes_, a hash for each word."""
    split = documents.select(*keep, F.col("text").alias("text_"), words(F.col("text")).alias("words_"))
    return split.withColumn("hashes_", F.transform("words_", lambda w: F.xxhash64(w)))


def base_counts(rows: DataFrame, *keep: str) -> DataFrame:
    """The kept columns with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed.

    ``rows`` come from ``hashed``.
    """
    text = F.coalesce(F.col("text_"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    copies = lambda ls: F.size(ls) - F.size(F.array_distinct(ls))
    counts = rows.select(
        *keep,
        F.size("words_").cast("long").alias("n_words"),
        F.char_length(F.array_join("words_", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        let(lines, copies).cast("long").alias("n_dup_lines"),
        repeated_words(window_hashes(F.col("hashes_"), WINDOW)).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)
    return counts.withColumn("base_failed", failed)


def bucket_ids(hashes: Column, buckets: int = BUCKETS) -> Column:
    """The buckets of a text's words and word pairs."""
    both = let(hashes, lambda hs: F.concat(hs, window_hashes(hs, 2)))
    return F.transform(both, lambda h: F.pmod(h, F.lit(buckets)).cast("int"))


def log_ratios(corpus: DataFrame, buckets: int = BUCKETS, smoothing: float = 1.0) -> DataFrame:
    """One row: ``ratios``, the log ratio of target to corpus for every bucket.

    ``corpus`` has ids (array of buckets) and trusted (boolean). One pass counts both tables.
    """
    spark = corpus.sparkSession
    counts = (
        corpus.select(F.explode_outer("ids").alias("id"), F.coalesce("trusted", F.lit(False)).alias("trusted"))
        .filter("id is not null")
        .groupBy("id")
        .agg(F.count("*").alias("raw"), F.count_if("trusted").alias("target"))
    )
    every = spark.range(buckets).select(F.col("id").cast("int").alias("id")).join(counts, "id", "left")
    raw, target = F.coalesce("raw", F.lit(0)), F.coalesce("target", F.lit(0))
    folded = every.agg(
        F.sum(raw).alias("raw_total"),
        F.sum(target).alias("target_total"),
        F.sort_array(F.collect_list(F.struct("id", raw.alias("raw"), target.alias("target")))).alias("cells"),
    )
    share = lambda count, total: F.log((count + smoothing) / (F.col(total) + smoothing * buckets))
    return folded.select(
        F.transform("cells", lambda c: share(c["target"], "target_total") - share(c["raw"], "raw_total")).alias("ratios")
    )


def mean_log_ratio(ids: Column, ratios: Column) -> Column:
    """The log likelihood ratio of a text's n-grams, divided by their number."""
    total = lambda xs: F.aggregate(xs, F.lit(0.0), lambda s, i: s + F.get(ratios, i))
    return let(ids, lambda xs: F.when(F.size(xs) > 0, total(xs) / F.size(xs)).otherwise(F.lit(0.0)))


def judged(
    documents: DataFrame, trusted: DataFrame, *keep: str, buckets: int = BUCKETS, threshold: float = THRESHOLD
) -> DataFrame:
    """The kept columns with the rule counts, llr and kept for every document.

    ``trusted`` has one column, doc_id: the documents of the target. Null ids are never in it.
    """
    marks = trusted.select(F.col("doc_id").alias("trusted_id")).filter("trusted_id is not null").distinct()
    # Texts always move to the ids: how many ids there are is not bounded, so they are never broadcast.
    marked = documents.select("doc_id", "text").join(marks.hint("merge"), F.col("doc_id") == F.col("trusted_id"), "left")
    corpus = hashed(marked, "trusted_id").select(
        bucket_ids(F.col("hashes_"), buckets).alias("ids"), F.col("trusted_id").isNotNull().alias("trusted")
    )
    ratios = stored(log_ratios(corpus, buckets).repartition(1))
    ids = hashed(documents, *keep).withColumn("ids_", bucket_ids(F.col("hashes_"), buckets))
    # The subquery stands alone in a column of its own: it may not be written inside a higher-order function.
    scores = ids.withColumn("ratios_", ratios.scalar()).withColumn("llr", mean_log_ratio(F.col("ids_"), F.col("ratios_")))
    counts = base_counts(scores, *keep, "llr")
    verdict = ~F.col("base_failed") & (F.col("llr") >= threshold)
    return counts.select(*keep, *COUNTS, "base_failed", "llr", verdict.alias("kept"))
