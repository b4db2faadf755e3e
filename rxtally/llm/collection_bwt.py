"""Burrows-Wheeler transform and common prefixes of a collection of strings, built column by column.

Round j adds the suffix of length j of every string: the symbol before its suffix of length j - 1 tells where. The
transform and the array of common prefixes are read once from front to back in each round and written anew with the new
rows put in between: two arrays of one byte a row. Nothing else is kept from round to round but one row number for each
string. The arrays are held in memory, as most collections come in small sets (``suffix_dedup.STRINGS``); those of
large ones are files (``external_bwt``).

A new suffix ``cX`` follows the suffix ``cY`` of the nearest row above X that has the symbol c; their common prefix is
one more than the least common prefix of the rows between Y and X. The row below changes likewise.
"""

from __future__ import annotations

import numpy as np


def _least(prefixes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Minima of ``prefixes[first:last]`` for many ranges, none empty."""
    if not len(first):
        return np.zeros(0, prefixes.dtype)
    # Ranges go by falling start: then each begins before the one in front ends, and no gap between two is read.
    order = np.argsort(-first, kind="stable")
    bounds = np.empty(2 * len(first), np.int64)
    bounds[::2], bounds[1::2] = first[order], last[order]
    padded = np.append(prefixes, prefixes.dtype.type(255))
    out = np.empty(len(first), prefixes.dtype)
    out[order] = np.minimum.reduceat(padded, bounds)[::2]
    return out


def build(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The transform (symbol + 1, or 0 where a whole string begins) and common prefixes of the sorted suffixes.

    ``text`` holds bytes below 255, string i at ``starts[i]``, of 1 to 254 bytes. The first rows are the empty suffixes,
    in the order of the strings.
    """
    m = len(starts)
    at = starts + lengths - 1  # the symbol in front of a string's present suffix
    bwt = text[at].astype(np.uint8) + np.uint8(1)
    prefixes = np.zeros(m, np.uint8)
    rows, active, ended = np.arange(m), np.arange(m), 0
    while len(active):
        n = len(bwt)
        by_symbol = np.argsort(bwt, kind="stable")
        place = np.empty(n, np.int64)
        place[by_symbol] = np.arange(n)
        mine, symbols = place[rows], bwt[rows]
        above = by_symbol[np.maximum(mine - 1, 0)]
        below = by_symbol[np.minimum(mine + 1, n - 1)]
        tied = (mine > 0) & (bwt[above] == symbols)
        next_tied = (mine < n - 1) & (bwt[below] == symbols)
        own = np.zeros(len(rows), np.uint8)
        own[tied] = _least(prefixes, above[tied] + 1, rows[tied] + 1) + np.uint8(1)
        after = _least(prefixes, rows[next_tied] + 1, below[next_tied] + 1) + np.uint8(1)
        # Rows that begin a whole string count in ``mine`` but no suffix grows from them; the empty suffixes come first.
        new_rows = mine - ended + m
        at[active] -= 1
        whole = at[active] < starts[active]
        added = np.where(whole, 0, text[np.maximum(at[active], 0)].astype(np.uint8) + np.uint8(1)).astype(np.uint8)
        old = np.ones(n + len(rows), bool)
        old[new_rows] = False
        longer, shared = np.empty(len(old), np.uint8), np.empty(len(old), np.uint8)
        longer[old], shared[old] = bwt, prefixes
        longer[new_rows], shared[new_rows] = added, own
        shared[new_rows[next_tied] + 1] = after
        bwt, prefixes = longer, shared
        ended += int(whole.sum())
        rows, active = new_rows[~whole], active[~whole]
    return bwt, prefixes


def window_classes(
    text: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, ranks: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, least): for every window of ``width`` bytes the least rank of a string that holds it."""
    bwt, prefixes = build(text, starts, lengths)
    by_symbol = np.argsort(bwt, kind="stable")
    step = np.empty(len(bwt), np.int64)
    step[by_symbol] = np.arange(len(bwt))
    # A walk from the empty suffix to the whole string, of all strings at once.
    holder = np.full(len(bwt), np.iinfo(np.int64).max)
    rows, active, length = np.arange(len(starts)), np.arange(len(starts)), 0
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    while len(active):
        rows, length = step[rows], length + 1
        holder[rows] = ranks[active]
        if length >= width:
            found.append((active, lengths[active] - length, rows))
        more = lengths[active] > length
        rows, active = rows[more], active[more]
    if not found:
        return (np.zeros(0, np.int64),) * 3
    string, offset, row = (np.concatenate(x) for x in zip(*found))
    heads = np.flatnonzero(prefixes < width)
    least = np.minimum.reduceat(holder, heads)
    return string, offset, least[np.searchsorted(heads, row, "right") - 1]
