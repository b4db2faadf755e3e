"""Number arrays packed for a shuffle, and arrays in mapped files of the shared folder."""

from __future__ import annotations

import mmap
import os
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import zstandard

MAPPED = 56_000  # files that a process keeps mapped; Linux allows 65,530 maps


def pack(numbers: np.ndarray) -> bytes:
    """Numbers as planes of their bytes, compressed: leading bytes that are alike take no room."""
    planes = np.ascontiguousarray(numbers.astype(np.int64).view(np.uint8).reshape(-1, 8).T)
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.int64).ravel()


@lru_cache(maxsize=1)
def _compressor() -> zstandard.ZstdCompressor:
    return zstandard.ZstdCompressor(level=1)


@lru_cache(maxsize=1)
def _decompressor() -> zstandard.ZstdDecompressor:
    return zstandard.ZstdDecompressor()


def pack_columns(columns: list[np.ndarray]) -> bytes:
    """Columns of one length together: how many, the bytes that each one's numbers take, and planes of these bytes, compressed."""
    planes, widths = [], []
    for column in columns:
        low, high = (int(column.min()), int(column.max())) if len(column) else (0, 0)
        width = 8 if low < 0 else next(w for w in (1, 2, 4, 8) if high < 1 << (8 * w))
        own = column.astype(np.int64 if width == 8 else f"u{width}")
        planes.append(np.ascontiguousarray(own.view(np.uint8).reshape(-1, width).T).tobytes())
        widths.append(width)
    return bytes([len(widths), *widths]) + _compressor().compress(b"".join(planes))


def unpack_columns(blob: bytes) -> list[np.ndarray]:
    widths, columns, at = blob[1 : 1 + blob[0]], [], 0
    data = np.frombuffer(_decompressor().decompress(memoryview(blob)[1 + blob[0] :]), np.uint8)
    n = len(data) // sum(widths)
    for width in widths:
        own = np.ascontiguousarray(data[at : at + n * width].reshape(width, n).T)
        columns.append(own.view(np.int64 if width == 8 else f"u{width}").ravel().astype(np.int64, copy=False))
        at += n * width
    return columns


def save(path: str, array: np.ndarray) -> None:
    """The whole file or none: tasks may be run twice at the same time."""
    own = f"{path}.{os.getpid()}.{np.random.default_rng().integers(1 << 62)}"
    with open(own, "wb") as out:
        np.save(out, array)
    os.replace(own, path)


@lru_cache(maxsize=MAPPED)
def mapped(path: str) -> np.ndarray:
    """A file's array, mapped without holding the file open; a missing file is an error."""
    with open(path, "rb") as file:
        np.lib.format.read_magic(file)
        shape, _, kind = np.lib.format.read_array_header_1_0(file)
        at = file.tell()
        data = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ, trackfd=False)
    return np.frombuffer(data, kind, int(np.prod(shape)), at).reshape(shape)


def save_together(path: str, *arrays: np.ndarray) -> None:
    """Arrays of whole numbers from 0 in one file: how many, where each begins, its length and its numbers' bytes."""
    sizes = [-(-a.nbytes // 8) * 8 for a in arrays]
    starts = np.cumsum([8 * (1 + 3 * len(arrays)), *sizes])
    out = np.zeros(starts[-1], np.uint8)
    heads = [x for a, start in zip(arrays, starts) for x in (start, a.nbytes, a.itemsize)]
    out[: starts[0]] = np.array([len(arrays), *heads], np.int64).view(np.uint8)
    for a, start in zip(arrays, starts):
        out[start : start + a.nbytes] = np.ascontiguousarray(a).view(np.uint8).ravel()
    save(path, out)


@lru_cache(maxsize=MAPPED)
def mapped_together(path: str) -> tuple[np.ndarray, ...]:
    """What ``save_together`` wrote, each array with one dimension."""
    data = mapped.__wrapped__(path)
    n = int(data[:8].view(np.int64)[0])
    heads = data[8 : 8 * (1 + 3 * n)].view(np.int64).reshape(n, 3).tolist()
    return tuple(data[start : start + size].view(f"u{width}") for start, size, width in heads)


def narrowed(numbers: np.ndarray) -> np.ndarray:
    """Numbers from 0 in the smallest type that holds them."""
    return numbers.astype(np.min_scalar_type(int(numbers.max(initial=0))))


def save_narrow(folder: str, name: str, part: int, numbers: np.ndarray) -> None:
    """Small counts in one byte each; those of 255 and more lie in a list of their own, by place."""
    large = np.flatnonzero(numbers >= 255)
    save_together(f"{folder}/{name}-{part}.npy", np.minimum(numbers, 255).astype(np.uint8), narrowed(large), narrowed(numbers[large]))


def save_rows(folder: str, name: str, part: int, rows: np.ndarray) -> None:
    """Rows of four counts in one byte each: the place of the row among the 255 most frequent small ones of the part.

    Other rows have the byte 255 and lie in a list of their own, by place.
    """
    small = np.flatnonzero(rows.max(axis=1) < 256)
    keys = np.ascontiguousarray(rows[small].astype(np.uint8)).view(np.uint32).ravel()
    kinds, many = np.unique(keys, return_counts=True)
    known = np.sort(kinds[np.argsort(-many, kind="stable")[:255]])
    hit, place = found(known, keys)
    codes = np.full(len(rows), 255, np.uint8)
    codes[small[hit]] = place[hit]
    large = np.flatnonzero(codes == 255)
    save_together(f"{folder}/{name}-{part}.npy", codes, known.view(np.uint8), narrowed(large), narrowed(rows[large]))


@dataclass(frozen=True)
class Parts:
    """Arrays of a folder, one file of each name for every part that has rows.

    ``sizes`` says how many rows each part has. It is known where the files are written, so that a file that is not
    there is told from a part without rows.
    """

    folder: str
    sizes: tuple[int, ...]

    def __len__(self) -> int:
        return len(self.sizes)

    def __call__(self, name: str, part: int) -> np.ndarray:
        return mapped(f"{self.folder}/{name}-{part}.npy") if self.sizes[part] else np.zeros(0, np.int64)

    def _together(self, name: str, part: int) -> tuple[np.ndarray, ...]:
        return mapped_together(f"{self.folder}/{name}-{part}.npy")

    def narrow(self, name: str, part: int, places: np.ndarray) -> np.ndarray:
        """Numbers of what ``save_narrow`` wrote; ``places`` are rows of a part that has some."""
        codes, large, values = self._together(name, part)
        out = codes[places].astype(np.int64)
        marked = np.flatnonzero(out == 255)
        if len(marked):
            out[marked] = values[np.searchsorted(large, places[marked])]
        return out

    def rows(self, name: str, part: int, places: np.ndarray) -> np.ndarray:
        """Rows of what ``save_rows`` wrote; ``places`` are rows of a part that has some."""
        codes, known, large, values = self._together(name, part)
        kinds = np.append(known.reshape(-1, 4), np.zeros((256 - len(known) // 4, 4), np.uint8), axis=0).astype(np.int64)
        own = codes[places]
        out = kinds[own]
        marked = np.flatnonzero(own == 255)
        if len(marked):
            out[marked] = values.reshape(-1, 4)[np.searchsorted(large, places[marked])]
        return out

    @property
    def offsets(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)]).astype(np.int64)


def sizes_of(written, parts: int) -> tuple[int, ...]:
    """Sizes by part from rows (part, size)."""
    sizes = [0] * parts
    for part, size in written:
        sizes[part] = int(size)
    return tuple(sizes)


def found(known: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the sorted ``asked`` are in the sorted ``known``, and where."""
    if not len(known):
        return np.zeros(len(asked), bool), np.zeros(len(asked), np.int64)
    place = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    return known[place] == asked, place
