"""Solve one group's normal equations (a p-by-p matrix, never data rows).

Runs in Python workers. The functions travel with the job by value, so the
executors need not have this package installed.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle

from rxtally.functions.distributions import f_upper, t_quantile, t_two_sided

cloudpickle.register_pickle_by_value(sys.modules["rxtally.functions"])

INTERCEPT = "(Intercept)"
ALIAS_TOLERANCE = 1e-13  # of a column's squared length, once earlier columns are taken out of it

# Column names of each effect: one for a main effect, two for an interaction.
Effects = Sequence[tuple[str, ...]]


@dataclass
class Solution:
    coef: np.ndarray  # NaN where the term is a combination of earlier ones
    inverse: np.ndarray  # (X'X)^-1, zero rows and columns for those terms
    rank: int
    rss: float


def independent_columns(gram: np.ndarray) -> np.ndarray:
    """Mark the columns that are not combinations of earlier ones."""
    work = gram.copy()
    keep = np.zeros(len(work), dtype=bool)
    for k in range(len(work)):
        pivot = work[k, k]
        if pivot > ALIAS_TOLERANCE:
            keep[k] = True
            work = work - np.outer(work[:, k], work[k, :]) / pivot
    return keep


def solve(gram: np.ndarray, moment: np.ndarray, square: float) -> Solution:
    """Least squares from X'X, X'y and y'y; columns are scaled to length one first."""
    size = len(gram)
    length = np.sqrt(np.diag(gram))
    usable = length > 0
    scale = np.where(usable, length, 1.0)
    scaled = gram / np.outer(scale, scale)
    keep = independent_columns(scaled) & usable
    coef = np.full(size, np.nan)
    inverse = np.zeros((size, size))
    inner = np.linalg.inv(scaled[np.ix_(keep, keep)])
    inner = (inner + inner.T) / 2
    target = (moment / scale)[keep]
    answer = np.linalg.solve(scaled[np.ix_(keep, keep)], target)
    coef[keep] = answer / scale[keep]
    inverse[np.ix_(keep, keep)] = inner / np.outer(scale[keep], scale[keep])
    rss = max(square - float(answer @ target), 0.0)
    return Solution(coef, inverse, int(keep.sum()), rss)


def log_likelihood(rss: float, n: int) -> float:
    if rss <= 0:
        return math.inf
    return -0.5 * n * (math.log(2 * math.pi * rss / n) + 1)


def _sort_key(level: str | None):
    if level is None:
        return (0, 0.0, "")
    try:
        return (1, float(level), "")
    except ValueError:
        return (2, 0.0, level)


def _clean(value: float) -> float | None:
    return None if value is None or not np.isfinite(value) else float(value)


def _reported_terms(found: pd.DataFrame, effects: Effects, numeric: Sequence[str]) -> list[str]:
    """Terms with a coefficient, in formula order, reference levels left out."""
    levels: dict[str, list[str]] = {}
    for effect in effects:
        if len(effect) == 1 and effect[0] not in numeric:
            seen = found.loc[found["i_effect"] == effect, "i_left"]
            levels[effect[0]] = sorted(seen, key=_sort_key)
    terms = [INTERCEPT]
    for effect in effects:
        if len(effect) == 2:
            left, right = effect
            terms += [
                f"{left}[{a}]:{right}[{b}]" for b in levels[right][1:] for a in levels[left][1:]
            ]
        elif effect[0] in numeric:
            terms.append(effect[0])
        else:
            terms += [f"{effect[0]}[{level}]" for level in levels[effect[0]][1:]]
    return terms


def fit_candidates(
    sums: pd.DataFrame,
    effects: Effects,
    candidates: dict[str, Effects],
    numeric: Sequence[str],
    levels: Sequence[float],
) -> list[dict]:
    """One model row per candidate from the sums over all their effects.

    A candidate takes the pairs of its own effects, from the rows that have a
    value for each of them.
    """
    position = {effect: place for place, effect in enumerate(effects, start=1)}
    rows = []
    for name, wanted in candidates.items():
        places = {0, *(position[effect] for effect in wanted)}
        own = sums[
            sums["missing"].map(places.isdisjoint).astype(bool)
            & (sums["i_pos"].isna() | sums["i_pos"].isin(places))
            & (sums["j_pos"].isna() | sums["j_pos"].isin(places))
        ]
        pairs = ["i_pos", "i_left", "i_right", "i_term", "j_pos", "j_term"]
        own = own.groupby(pairs, dropna=False, as_index=False)["product"].sum()
        own["i_effect"] = own["i_pos"].map(lambda p: effects[int(p) - 1] if p and p > 0 else None)
        centres = {name: float(sums[f"_c{i}"].iloc[0]) for i, name in enumerate(numeric)}
        rows.append({"MODEL": name, **fit_group(own, wanted, centres, levels, float(sums["_cy"].iloc[0]))})
    return rows


def with_residuals(row: dict, rss: float, total: float, levels: Sequence[float]) -> dict:
    """A model row with its residual sum, and all that follows from it, replaced."""
    coef = np.array([np.nan if value is None else value for value in row["coef"]], dtype=float)
    inverse = np.array([list(line) for line in row["cov_unscaled"]], dtype=float)
    fit = Solution(coef, inverse, int(row["rank"]), float(rss))
    return {**row, "cov_unscaled": inverse.tolist(), **statistics(fit, float(total), int(row["nobs"]), levels)}


def uncentred(fit: Solution, terms: list[str], centres: dict[str, float], response: float) -> Solution:
    """The solution for the columns as they are: only the intercept and its covariances change."""
    back = np.eye(len(terms))
    for place, term in enumerate(terms):
        if term in centres:
            back[0, place] = -centres[term]
    coef = back @ np.nan_to_num(fit.coef)
    coef[0] += response
    coef[np.isnan(fit.coef)] = np.nan
    return Solution(coef, back @ fit.inverse @ back.T, fit.rank, fit.rss)


def fit_group(
    sums: pd.DataFrame, effects: Effects, numeric: dict[str, float], levels: Sequence[float], response: float = 0.0
) -> dict:
    """One model row from the sums of one model, which come in long form.

    ``numeric`` and ``response`` give what was taken off the numeric columns and the response before summing.
    """
    diagonal = sums[sums["i_term"].notna() & (sums["i_term"] == sums["j_term"])]
    terms = _reported_terms(diagonal, effects, numeric)
    place = {term: k for k, term in enumerate(terms)}
    size = len(terms)
    gram, moment = np.zeros((size, size)), np.zeros(size)
    square = 0.0
    for i, j, value in zip(sums["i_term"], sums["j_term"], sums["product"], strict=True):
        if not isinstance(i, str):
            square = value
        elif i in place and not isinstance(j, str):
            moment[place[i]] = value
        elif i in place and j in place:
            gram[place[i], place[j]] = gram[place[j], place[i]] = value

    fit = solve(gram, moment, square)
    n = int(round(gram[0, 0]))
    fit = uncentred(fit, terms, numeric, response)
    total = max(square - moment[0] ** 2 / n, 0.0)
    return {
        "terms": terms,
        "known_terms": terms + sorted(set(diagonal["i_term"]) - set(terms)),
        "coef": [_clean(v) for v in fit.coef],
        "cov_unscaled": fit.inverse.tolist(),
        **statistics(fit, total, n, levels),
    }


def statistics(fit: Solution, total: float, n: int, levels: Sequence[float]) -> dict:
    """What follows from a solution, its residual sum, the total sum of squares and the number of rows."""
    free = n - fit.rank
    model_df = fit.rank - 1
    sigma2 = fit.rss / free if free > 0 else np.nan
    with np.errstate(divide="ignore", invalid="ignore"):
        error = np.sqrt(sigma2 * np.diag(fit.inverse))
        error[np.isnan(fit.coef)] = np.nan
        t_value = fit.coef / error
        r_squared = 1 - fit.rss / total if total > 0 else np.nan
        explained = (total - fit.rss) / model_df / sigma2 if model_df and free > 0 else np.nan
    log_lik = log_likelihood(fit.rss, n)
    return {
        "std_error": [_clean(v) for v in error],
        "t_value": [_clean(v) for v in t_value],
        "p_value": [
            t_two_sided(v, free) if np.isfinite(v) and free > 0 else None
            for v in t_value
        ],
        "r_squared": _clean(r_squared),
        "adj_r_squared": _clean(1 - (1 - r_squared) * (n - 1) / free) if free > 0 else None,
        "sigma": _clean(np.sqrt(sigma2)),
        "sigma2": _clean(sigma2),
        "statistic": _clean(explained),
        "statistic_p": f_upper(explained, model_df, free)
        if np.isfinite(explained)
        else None,
        "df": model_df,
        "rank": fit.rank,
        "log_lik": _clean(log_lik),
        "aic": _clean(-2 * log_lik + 2 * (fit.rank + 1)),
        "bic": _clean(-2 * log_lik + np.log(n) * (fit.rank + 1)),
        "deviance": fit.rss,
        "df_resid": free,
        "nobs": n,
        "t_quantiles": [t_quantile(level, free) if free > 0 else None for level in levels],
    }
