"""The construction of ``collection_bwt`` for large collections, in sequential files.

Four files have one entry for each row: the symbol in front of its suffix, the prefix it has in common with the row
above, its string, and its length. A round reads the first two from front to back to find where each string's next suffix
goes and what it shares with its neighbours, and then copies all four with the new rows put in between. In memory are
the strings themselves, one row number for each string, a block of each file, and for each symbol how often it was
read, the least prefix since it was last read, and the string that it was read for.
"""

from __future__ import annotations

import os
import shutil
from uuid import uuid4

import numpy as np

from rxtally.llm.collection_bwt import _least

BLOCK = 1 << 20  # rows read together
COLUMNS = {"symbols": np.uint8, "prefixes": np.uint8, "strings": np.int32, "lengths": np.uint8}
SYMBOLS = 256


class Places:
    """What a pass over symbols and prefixes finds for the active strings, which are in the order of their rows."""

    def __init__(self, rows: np.ndarray):
        self.rows = rows
        self.rank = np.zeros(len(rows), np.int64)  # rows above with the same symbol
        self.own = np.zeros(len(rows), np.uint8)  # prefix shared with the new row above
        self.after = np.zeros(len(rows), np.uint8)  # and with the one below, where that has the same symbol
        self.has_next = np.zeros(len(rows), bool)
        self.seen = np.zeros(SYMBOLS, np.int64)
        self.least = np.full(SYMBOLS, 255, np.uint8)  # of the prefixes behind the last row with the symbol
        self.last = np.full(SYMBOLS, -1, np.int64)  # the active string of that row, if it is one
        self.at = 0

    def read(self, symbols: np.ndarray, prefixes: np.ndarray) -> None:
        first, end = np.searchsorted(self.rows, [self.at, self.at + len(symbols)])
        active = np.full(len(symbols), -1, np.int64)
        active[self.rows[first:end] - self.at] = np.arange(first, end)
        by_symbol = np.argsort(symbols, kind="stable")
        many = np.bincount(symbols, minlength=SYMBOLS)
        begin = np.cumsum(many) - many
        place = np.empty(len(symbols), np.int64)
        place[by_symbol] = np.arange(len(symbols))
        inside = place > begin[symbols]
        before = np.where(inside, by_symbol[np.maximum(place - 1, 0)], -1)
        # The string of the row before with the same symbol; that row may lie in an earlier block.
        owner = np.where(inside, active[before], self.last[symbols])
        asked = np.flatnonzero((active >= 0) | (owner >= 0))
        shared = np.zeros(len(asked), np.uint8)
        near = inside[asked]
        shared[near] = _least(prefixes, before[asked[near]] + 1, asked[near] + 1)
        far, front = asked[~near], np.minimum.accumulate(prefixes)
        shared[~near] = np.minimum(self.least[symbols[far]], front[far])
        known = near | (self.seen[symbols[asked]] > 0)
        mine = active[asked] >= 0
        self.rank[active[asked[mine]]] = (self.seen[symbols] + place - begin[symbols])[asked[mine]]
        self.own[active[asked[mine & known]]] = shared[mine & known] + np.uint8(1)
        follows = owner[asked] >= 0
        self.after[owner[asked[follows]]] = shared[follows] + np.uint8(1)
        self.has_next[owner[asked[follows]]] = True
        present = np.flatnonzero(many)
        ends = by_symbol[(begin + many - 1)[present]]
        back = np.append(np.minimum.accumulate(prefixes[::-1])[::-1], np.uint8(255))
        self.least = np.minimum(self.least, back[0])
        self.least[present], self.last[present] = back[ends + 1], active[ends]
        self.seen += many
        self.at += len(symbols)


def _blocks(folder: str, names: list[str], rows: int, block: int):
    files = [open(f"{folder}/{name}", "rb") for name in names]
    try:
        for at in range(0, rows, block):
            read = [np.fromfile(f, COLUMNS[name.split(".")[0]], min(block, rows - at)) for f, name in zip(files, names)]
            if any(len(x) != min(block, rows - at) for x in read):
                raise OSError(f"a file of {folder} is shorter than its {rows} rows")
            yield read
    finally:
        for f in files:
            f.close()


def _inserted(folder: str, name: str, rows: int, new_rows: np.ndarray, values: np.ndarray, fixed: tuple | None, block: int) -> None:
    """A file written anew with ``values`` at the sorted ``new_rows``; ``fixed`` has rows and values to set afterwards."""
    total = rows + len(new_rows)
    with open(f"{folder}/{name}", "rb") as old, open(f"{folder}/{name}.new", "wb") as out:
        for at in range(0, total, block):
            size = min(block, total - at)
            a, b = np.searchsorted(new_rows, [at, at + size])
            whole, kept = np.empty(size, COLUMNS[name]), np.ones(size, bool)
            kept[new_rows[a:b] - at] = False
            whole[kept] = np.fromfile(old, COLUMNS[name], size - (b - a))
            whole[~kept] = values[a:b]
            if fixed:
                c, d = np.searchsorted(fixed[0], [at, at + size])
                whole[fixed[0][c:d] - at] = fixed[1][c:d]
            whole.tofile(out)
    os.replace(f"{folder}/{name}.new", f"{folder}/{name}")


def build(text: np.ndarray, starts: np.ndarray, lengths: np.ndarray, folder: str, block: int = BLOCK) -> int:
    """Write the four files of the sorted suffixes into ``folder``; the number of rows.

    Strings are as for ``collection_bwt.build``.
    """
    m = total = len(starts)
    at = starts + lengths - 1  # the symbol in front of a string's present suffix
    first = {"symbols": text[at].astype(np.uint8) + np.uint8(1), "strings": np.arange(m)}
    for name, kind in COLUMNS.items():
        np.asarray(first.get(name, np.zeros(m)), kind).tofile(f"{folder}/{name}")
    counts = np.bincount(first["symbols"], minlength=SYMBOLS)
    rows, active, length = np.arange(m), np.arange(m), 0
    while len(active):
        length += 1
        places = Places(rows)
        for symbols, prefixes in _blocks(folder, ["symbols", "prefixes"], total, block):
            places.read(symbols, prefixes)
        # Rows that begin a whole string (symbol 0) have no suffix that grows from them; the empty suffixes come first.
        smaller = np.cumsum(counts) - counts - counts[0]
        order = np.argsort(new := m + smaller[text[at[active]].astype(np.int64) + 1] + places.rank)
        active, new_rows, own = active[order], new[order], places.own[order]
        tied, after = places.has_next[order], places.after[order]
        at[active] -= 1
        whole = at[active] < starts[active]
        added = np.where(whole, 0, text[np.maximum(at[active], 0)].astype(np.uint8) + np.uint8(1)).astype(np.uint8)
        values = {"symbols": added, "prefixes": own, "strings": active, "lengths": np.full(len(active), length)}
        for name in COLUMNS:
            fixed = (new_rows[tied] + 1, after[tied]) if name == "prefixes" else None
            _inserted(folder, name, total, new_rows, values[name], fixed, block)
        total += len(active)
        counts += np.bincount(added, minlength=SYMBOLS)
        rows, active = new_rows[~whole], active[~whole]
    return total


def window_classes(
    text: np.ndarray, starts: np.ndarray, lengths: np.ndarray, width: int, ranks: np.ndarray, folder: str, block: int = BLOCK
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(string, offset, least): for every window of ``width`` bytes the least rank of a string that holds it.

    The files lie in a folder of their own below the shared ``folder`` and are removed at the end.
    """
    own = f"{folder}/set-{uuid4().hex}"
    os.makedirs(own)
    try:
        total, runs, found = build(text, starts, lengths, own, block), 0, []
        for prefixes, strings, long in _blocks(own, ["prefixes", "strings", "lengths"], total, block):
            # Rows that share a window follow each other; a shorter suffix shares none.
            run = runs + np.cumsum(prefixes < width)
            runs = int(run[-1])
            windows = np.flatnonzero(long >= width)
            string = strings[windows].astype(np.int64)
            found.append((string, lengths[string] - long[windows], run[windows]))
    finally:
        shutil.rmtree(own)
    string, offset, run = (np.concatenate(x) for x in zip(*found))
    heads = np.flatnonzero(np.r_[True, run[1:] != run[:-1]]) if len(run) else np.zeros(0, np.int64)
    least = np.minimum.reduceat(ranks[string], heads) if len(run) else np.zeros(0, np.int64)
    return string, offset, np.repeat(least, np.diff(np.r_[heads, len(run)]))
