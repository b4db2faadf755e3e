"""Pairwise quality ranking (operator 7): a Bradley-Terry model of document features.

A document's strength is a weighted sum of its features. The chance that a good document beats a bad one is the
logistic function of the difference, so that weights are learnt by logistic loss on feature differences of preference
pairs. The quantile of the strengths that matches the share of bad labels becomes the score ``CUT``.

Features come from the text alone: shares of characters, of repeated words and lines, and of word shapes, hashed into
``SHAPES`` buckets. A word's shape keeps its punctuation and writes runs of capitals, small letters and digits as one
sign each, so that features mean the same in every language.

Weights are learnt from at most ``MAX_LABELLED`` labelled rows, those with the smallest hashes, and ``PAIRS`` pairs for
each bad one; the sample's features are gathered, a few hundred numbers a row. Every document is scored, in one scan.

Defined results: null and empty texts have the features of no words and are scored. Labels that are null or neither 0
nor 1 teach nothing; without a pair of a good and a bad label all scores are ``CUT``. A doc_id may have several labels
or rows: each value of its labels teaches once, by the least of its rows' features, so that what is gathered is bounded
by ``MAX_LABELLED``. Ties between good and bad leave weights at 0 and all scores at ``CUT``. Every row is scored. Only
doc_id and text are read, and from labels doc_id and quality.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rxtally.llm.text import crc_remainder

SHAPES = 192
MAX_LABELLED = 12_000
PAIRS = 8
CUT = 0.3
RIDGE = 1.0

words_of = re.compile(r"[^\x20\x09-\x0D]+").findall
runs = re.compile(r"A+|a+|0+|(.)\1+", re.DOTALL)


class _Signs(dict):
    """Translates letters and digits to the sign of their class, any other character to itself."""

    def __missing__(self, code: int) -> int:
        c = chr(code)
        sign = "0" if c.isdigit() else "A" if c.isupper() else "a" if c.isalpha() else c
        self[code] = ord(sign)
        return self[code]


SIGNS = _Signs()


def _shape(signs: str) -> int:
    short = runs.sub(lambda m: m[0][:1] if m[1] is None else m[1] * 2, signs)[:12]
    return zlib.crc32(short.encode("utf-8", "surrogatepass")) % SHAPES


def features(text: str | None) -> np.ndarray:
    """Numbers of the order of one for the whole of a text."""
    text = text or ""
    found = words_of(text)
    n, out = max(len(found), 1), np.zeros(12 + SHAPES)
    signs = Counter(words_of(text.translate(SIGNS)))
    shapes: dict[int, int] = {}
    classes: Counter[str] = Counter()
    for word, times in signs.items():
        bucket = _shape(word)
        shapes[bucket] = shapes.get(bucket, 0) + times
        for sign in word:
            classes[sign if sign in "Aa0" else "."] += times
    chars = max(sum(classes.values()), 1)
    counts = Counter(found)
    lines = [line for line in text.split("\n") if line.strip()]
    out[:12] = [
        1.0 * (not found),
        np.log1p(len(found)) / 5,
        np.log1p(chars / n),
        classes["A"] / chars,
        classes["0"] / chars,
        classes["."] / chars,
        len(counts) / n,
        max(counts.values(), default=0) / n,
        sum(a == b for a, b in zip(found, found[1:])) / n,
        len(set(zip(found, found[1:]))) / n,
        1 - len(set(lines)) / max(len(lines), 1),
        np.log1p(len(text) / max(len(lines), 1)) / 5,
    ]
    for bucket, times in shapes.items():
        out[12 + bucket] = np.sqrt(times / n)
    return out


@dataclass(frozen=True)
class Ranking:
    """Weights of the features and the strength that gets the score ``CUT``."""

    weights: np.ndarray
    cut: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        raised = np.clip(rows @ self.weights - self.cut + np.log(CUT / (1 - CUT)), -500, 500)
        return 1 / (1 + np.exp(-raised))


def preference_pairs(good: int, bad: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the winners and losers: every bad document against ``PAIRS`` good ones, drawn with a seed."""
    draw = np.random.default_rng(seed)
    return draw.integers(good, size=bad * PAIRS), np.repeat(np.arange(bad), PAIRS)


def fit(rows: np.ndarray, quality: np.ndarray, seed: int = 0) -> Ranking:
    """Newton's steps on the logistic loss of the differences, with a ridge."""
    good, bad = rows[quality == 1], rows[quality == 0]
    weights = np.zeros(rows.shape[1] if rows.ndim == 2 else 12 + SHAPES)
    if not len(good) or not len(bad):
        return Ranking(weights, 0.0)
    winners, losers = preference_pairs(len(good), len(bad), seed)
    differences = good[winners] - bad[losers]
    for _ in range(25):
        wins = 1 / (1 + np.exp(-np.clip(differences @ weights, -500, 500)))
        slope = differences.T @ (1 - wins) - RIDGE * weights
        bend = (differences * (wins * (1 - wins))[:, None]).T @ differences + RIDGE * np.eye(len(weights))
        step = np.linalg.solve(bend, slope)
        weights = weights + step
        if np.abs(step).max() < 1e-6:
            break
    return Ranking(weights, float(np.quantile(rows @ weights, len(bad) / len(rows), method="midpoint")))


def learn(documents: DataFrame, labels: DataFrame, limit: int = MAX_LABELLED, seed: int = 0) -> Ranking:
    """The ranking learnt from a bounded sample of the labelled rows."""
    usable = labels.filter("doc_id is not null and quality in (0, 1)").select(
        F.col("doc_id").alias("labelled"), F.col("quality").cast("int").alias("quality")
    )
    sample = usable.orderBy(F.xxhash64(F.lit(seed), "labelled", "quality"), "labelled").limit(limit)
    # At most ``limit`` rows of two numbers.
    marked = documents.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("labelled"))

    def measured(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [features(text).astype(np.float32).tobytes() for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["labelled"].astype(str), "quality": batch["quality"], "row": rows})

    rows = marked.mapInPandas(measured, "doc_id string, quality int, row binary")
    # One row for each label, however often its document stands in the table.
    found = rows.groupBy("doc_id", "quality").agg(F.min("row").alias("row")).toPandas()
    found = found.sort_values(["doc_id", "quality", "row"])  # the order of arrival must not matter
    rows = np.array([np.frombuffer(row, np.float32) for row in found["row"]], np.float64)
    return fit(rows, found["quality"].to_numpy(), seed)


def scored(documents: DataFrame, ranking: Ranking, *keep: str) -> DataFrame:
    """The kept columns with score and predicted for every document."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            parts = [
                ranking.scores(np.array([features(text) for text in texts.iloc[at : at + 512]]))
                for at in range(0, len(texts), 512)
            ]
            yield pd.Series(np.concatenate(parts) if parts else np.empty(0))

    return documents.select(*keep, score("text").alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int")
    )


def held_out_scores(documents: DataFrame, labels: DataFrame, folds: int = 5) -> DataFrame:
    """doc_id, held_out, score, predicted: learnt from labels of rows that are not held out."""
    held_out = crc_remainder(F.col("doc_id"), folds) == 0
    ranking = learn(documents, labels.filter(~held_out))
    return scored(documents, ranking, "doc_id").select("doc_id", held_out.alias("held_out"), "score", "predicted")
