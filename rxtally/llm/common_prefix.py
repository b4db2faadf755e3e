"""Longest common extensions of an array by a difference cover: sampled suffixes, few compared words, range minima."""

from __future__ import annotations

import numpy as np

# A perfect difference set; every difference modulo 31 is that of two of its members.
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)


def _steps() -> np.ndarray:
    """How far two places, given by their remainders, must move together until both are in the cover."""
    inside = np.isin(np.arange(2 * MODULUS) % MODULUS, COVER)
    table = np.zeros((MODULUS, MODULUS), np.int64)
    for a in range(MODULUS):
        for b in range(MODULUS):
            table[a, b] = np.flatnonzero(inside[a : a + MODULUS] & inside[b : b + MODULUS])[0]
    return table


STEPS = _steps()


class Extensions:
    """Answers how many values from two places on are equal, for arrays of queries.

    Only suffixes that begin at a cover place are sorted: by their first ``MODULUS`` values, then by doubling. A rank
    of a place at level k stands for the ``MODULUS * 2**k`` values from there on. Common prefixes of neighbours in the
    order are kept in a sparse table of minima. Values are small non-negative whole numbers; all that lies beyond the
    end differs from every value and from one another.
    """

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.n = n
        # Beyond the end: values of their own, so that no comparison needs a bound.
        top = int(values.max(initial=-1)) + 1
        self.values = np.concatenate([values.astype(np.int64), top + np.arange(2 * MODULUS + 1)])
        blocks = np.arange(n // MODULUS + 1) * MODULUS
        places = (blocks[:, None] + np.array(COVER)).ravel()
        places = places[places < n]
        self.slot = np.full(n + 2 * MODULUS, -1, np.int64)
        self.slot[places] = np.arange(len(places))
        levels = self._levels(places)
        order = np.argsort(levels[-1], kind="stable")
        self.rank = np.empty(len(places), np.int64)
        self.rank[order] = np.arange(len(places))
        self.minima = self._minima(self._neighbours(places[order], levels))

    def _levels(self, places: np.ndarray) -> list[np.ndarray]:
        rank = np.zeros(len(places), np.int64)
        size = 1
        for k in range(MODULUS):  # one value more each time; stops mattering once all ranks differ
            if size < len(places):
                rank, size = self._ranked(rank, self.values[places + k])
        levels, step = [rank], MODULUS
        while size < len(places):
            beyond = places + step >= self.n
            after = np.where(beyond, -1, self.slot[np.minimum(places + step, self.n)])
            # A suffix that ends is alone in its rank: the values beyond the end are its own.
            follow = np.where(beyond, len(places) + np.arange(len(places)), levels[-1][after])
            rank, size = self._ranked(levels[-1], follow)
            levels.append(rank)
            step *= 2
        return levels

    @staticmethod
    def _ranked(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, int]:
        key = first * (int(second.max(initial=0)) + 1) + second
        order = np.argsort(key, kind="stable")
        new = np.empty(len(key), bool)
        new[:1], sorted_key = True, key[order]
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        rank = np.empty(len(key), np.int64)
        rank[order] = np.cumsum(new) - 1
        return rank, int(new.sum())

    def _neighbours(self, ordered: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
        """Common prefixes of suffixes that are neighbours in the order, by descent through the levels."""
        a, b = ordered[:-1].copy(), ordered[1:].copy()
        length = np.zeros(len(a), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            inside = np.flatnonzero((a < self.n) & (b < self.n))
            same = inside[levels[k][self.slot[a[inside]]] == levels[k][self.slot[b[inside]]]]
            for places in (a, b, length):
                places[same] += MODULUS << k
        return length + self._compared(a, b, np.full(len(a), MODULUS))

    def _compared(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Equal values from a and b on, up to each row's limit, which is at most ``MODULUS``."""
        out = np.zeros(len(a), np.int64)
        live = np.flatnonzero((limit > 0) & (a < self.n) & (b < self.n))
        for k in range(MODULUS):
            live = live[self.values[a[live] + k] == self.values[b[live] + k]]
            if not len(live):
                break
            out[live] += 1
            live = live[limit[live] > k + 1]
        return out

    @staticmethod
    def _minima(lengths: np.ndarray) -> list[np.ndarray]:
        table, span = [lengths], 1
        while 2 * span <= len(lengths):
            table.append(np.minimum(table[-1][:-span], table[-1][span:]))
            span *= 2
        return table

    def __call__(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Equal values from a[i] and from b[i] on; a[i] and b[i] differ and lie in the array or at its end."""
        steps = STEPS[a % MODULUS, b % MODULUS]
        out = self._compared(a, b, steps)
        far = np.flatnonzero((out == steps) & (a + steps < self.n) & (b + steps < self.n))
        if len(far):
            x, y = (self.rank[self.slot[side[far] + steps[far]]] for side in (a, b))
            low, high = np.minimum(x, y), np.maximum(x, y)
            level = np.frexp((high - low).astype(np.float64))[1] - 1  # whole logarithm, exact below 2**53
            for k in np.unique(level):
                own = level == k
                row = self.minima[k]
                out[far[own]] += np.minimum(row[low[own]], row[high[own] - (1 << int(k))])
        return out
