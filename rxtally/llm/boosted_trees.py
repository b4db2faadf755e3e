"""Gradient-boosted trees of depth two over binned features, learnt from counts and written as a column expression."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

ROUNDS = 30
SHRINKAGE = 0.4
RIDGE = 1.0

Cell = tuple[tuple[int, ...], float, float]  # features, positives, negatives


@dataclass(frozen=True)
class Split:
    """Rows whose feature is below ``cut`` go to ``low``; sides are further splits or leaf values."""

    feature: int
    cut: int
    low: Split | float
    high: Split | float

    def value(self, features: tuple[int, ...]) -> float:
        side = self.low if features[self.feature] < self.cut else self.high
        return side.value(features) if isinstance(side, Split) else side

    def column(self, features: list[Column]) -> Column:
        low, high = (s.column(features) if isinstance(s, Split) else F.lit(s) for s in (self.low, self.high))
        return F.when(features[self.feature] < self.cut, low).otherwise(high)


@dataclass(frozen=True)
class Boosted:
    """The log odds are ``start`` plus the trees' values."""

    start: float = 0.0
    trees: tuple[Split, ...] = field(default=())

    def log_odds(self, features: tuple[int, ...]) -> float:
        total = self.start
        for tree in self.trees:  # in the order of ``column``, so that both give the same number
            total += tree.value(features)
        return total

    def column(self, features: list[Column]) -> Column:
        total = F.lit(self.start)
        for tree in self.trees:
            total = total + tree.column(features)
        return total


def _best(rows: list[tuple[tuple[int, ...], float, float]], depth: int) -> Split | float:
    """The tree with the largest gain for rows of (features, slope, bend)."""
    slope, bend = sum(r[1] for r in rows), sum(r[2] for r in rows)
    leaf = SHRINKAGE * slope / (bend + RIDGE)
    best, gain = None, 1e-9
    for feature in range(len(rows[0][0])) if depth else ():
        sums: dict[int, list[float]] = {}
        for features, g, h in rows:
            own = sums.setdefault(features[feature], [0.0, 0.0])
            own[0] += g
            own[1] += h
        g = h = 0.0
        values = sorted(sums)
        for before, cut in zip(values, values[1:]):
            g, h = g + sums[before][0], h + sums[before][1]
            rest = slope - g, bend - h
            more = g * g / (h + RIDGE) + rest[0] ** 2 / (rest[1] + RIDGE) - slope * slope / (bend + RIDGE)
            if more > gain:
                best, gain = (feature, cut), more
    if best is None:
        return leaf
    feature, cut = best
    sides = [[r for r in rows if (r[0][feature] < cut) == low] for low in (True, False)]
    return Split(feature, cut, *(_best(side, depth - 1) for side in sides))


def fit(cells: list[Cell], rounds: int = ROUNDS) -> Boosted:
    """Newton boosting of the logistic loss. Without both classes there are no trees."""
    cells = sorted(cells)
    positives, negatives = sum(c[1] for c in cells), sum(c[2] for c in cells)
    if not positives or not negatives:
        return Boosted()
    start = math.log(positives / negatives)
    odds, trees = [start] * len(cells), []
    for _ in range(rounds):
        rows = []
        for (features, yes, no), at in zip(cells, odds):
            p = 1 / (1 + math.exp(-max(-500.0, min(500.0, at))))
            rows.append((features, yes * (1 - p) - no * p, (yes + no) * p * (1 - p)))
        tree = _best(rows, 2)
        if not isinstance(tree, Split):
            break
        trees.append(tree)
        odds = [at + tree.value(cell[0]) for at, cell in zip(odds, cells)]
    return Boosted(start, tuple(trees))


def threshold(model: Boosted, cells: list[Cell], precision: float, support: int) -> float | None:
    """The least log odds from which on the cells' share of positives, smoothed by one negative, reaches ``precision``.

    None where no log odds does so with ``support`` rows.
    """
    found, yes, no = None, 0.0, 1.0
    by_odds: dict[float, list[float]] = {}
    for features, a, b in cells:
        own = by_odds.setdefault(model.log_odds(features), [0.0, 0.0])
        own[0] += a
        own[1] += b
    for odds in sorted(by_odds, reverse=True):
        yes, no = yes + by_odds[odds][0], no + by_odds[odds][1]
        if yes + no - 1 >= support and yes >= precision * (yes + no):
            found = odds
    return found
