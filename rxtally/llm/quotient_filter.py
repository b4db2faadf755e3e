"""Counting quotient filters over packed n-grams: lossless, compact, and merged in sorted order.

An n-gram of word numbers is packed into one number of ``words * bits`` bits and put through an invertible
permutation, four rounds of a Feistel network over its two halves. The upper bits of the outcome are the quotient, the
rest is the remainder. As the remainder is kept in full and the permutation can be undone, a filter tells no n-gram for
another and gives all of them back.

A filter stands for one range, a prefix of the quotient. Its entries lie sorted in one run for each quotient that
occurs. Stored are a bit for each quotient (does it occur), a bit for each entry (does it end its run), the remainders
in whole bytes, and counters of one byte, with larger counts in a list behind.
"""

from __future__ import annotations

import struct
from dataclasses import dataclass

import numpy as np

ROUNDS = 4
U = np.uint64


def _mask(bits: int) -> np.uint64:
    return U((1 << bits) - 1)


def _mixed(x: np.ndarray, key: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x + U(key * 0x9E3779B97F4A7C15 & (1 << 64) - 1)) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(29))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(32))


@dataclass(frozen=True)
class Packing:
    """How n-grams of ``words`` numbers below ``2**bits`` become pairs of halves, permuted, and back."""

    words: int
    bits: int

    def __post_init__(self) -> None:
        if self.words * self.bits > 128:
            raise ValueError(f"{self.words} words of {self.bits} bits do not fit 128 bits")

    @property
    def half(self) -> int:
        return (self.words * self.bits + 1) // 2

    @property
    def single(self) -> bool:
        """Whether both halves fit one 64-bit number."""
        return self.half <= 32

    def permuted(self, columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        high, low = np.zeros(len(columns[0]), U), np.zeros(len(columns[0]), U)
        for column in columns:
            high = (high << U(self.bits)) | (low >> U(64 - self.bits))
            low = (low << U(self.bits)) | column.astype(U)
        half, mask = self.half, _mask(self.half)
        left = high if half == 64 else ((high << U(64 - half)) | (low >> U(half))) & mask
        right = low & mask
        for key in range(ROUNDS):
            left, right = right, left ^ (_mixed(right, key) & mask)
        return left, right

    def columns(self, left: np.ndarray, right: np.ndarray) -> list[np.ndarray]:
        half, mask = self.half, _mask(self.half)
        for key in reversed(range(ROUNDS)):
            left, right = right ^ (_mixed(left, key) & mask), left
        high = left if half == 64 else left >> U(64 - half)
        low = right if half == 64 else (left << U(half)) | right
        out = []
        for _ in range(self.words):
            out.insert(0, (low & _mask(self.bits)).astype(np.int64))
            low = (low >> U(self.bits)) | (high << U(64 - self.bits))
            high = high >> U(self.bits)
        return out

    def codes(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """One sortable 64-bit number each: the permuted n-gram where it fits, else a hash of it."""
        return (left << U(self.half)) | right if self.single else _mixed(left ^ _mixed(right, 1), 2)


Entries = tuple[np.ndarray, np.ndarray, np.ndarray]  # left, right, count


def added_up(packing: Packing, left: np.ndarray, right: np.ndarray, counts: np.ndarray | None = None) -> Entries:
    """Distinct entries in order, with the sums of their counts; without counts each stands for one."""
    if counts is None and packing.single:
        codes = np.sort((left << U(packing.half)) | right)
        heads = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
        distinct = codes[heads]
        return distinct >> U(packing.half), distinct & _mask(packing.half), np.diff(np.r_[heads, len(codes)])
    counts = np.ones(len(left), np.int64) if counts is None else counts
    order = (
        np.argsort((left << U(packing.half)) | right, kind="stable") if packing.single else np.lexsort((right, left))
    )
    left, right, counts = left[order], right[order], counts[order]
    if not len(left):
        return left, right, counts
    heads = np.flatnonzero(np.r_[True, (left[1:] != left[:-1]) | (right[1:] != right[:-1])])
    return left[heads], right[heads], np.add.reduceat(counts, heads)


def _planes(values: np.ndarray, bits: int) -> bytes:
    """The lower ``bits`` bits of the values in whole bytes."""
    size = (bits + 7) // 8
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8)[:, :size]).tobytes()


def _values(blob: memoryview, at: int, n: int, bits: int) -> tuple[np.ndarray, int]:
    size = (bits + 7) // 8
    out = np.zeros((n, 8), np.uint8)
    out[:, :size] = np.frombuffer(blob, np.uint8, n * size, at).reshape(n, size)
    return out.view(U).ravel(), at + n * size


HEADER = struct.Struct("<qiq")


def encode(packing: Packing, prefix: int, entries: Entries) -> bytes:
    """The filter of sorted distinct entries whose first ``prefix`` bits are alike."""
    left, right, counts = entries
    n = len(left)
    quotient_bits = min(max(n - 1, 0).bit_length(), packing.half - prefix)
    rest = packing.half - prefix - quotient_bits
    quotient = ((left >> U(rest)) & _mask(quotient_bits)).astype(np.int64)
    occupied = np.zeros(1 << quotient_bits, bool)
    occupied[quotient] = True
    ends = np.r_[quotient[1:] != quotient[:-1], True][:n]
    large = counts[counts >= 255]
    return b"".join(
        [
            HEADER.pack(n, quotient_bits, len(large)),
            np.packbits(occupied).tobytes(),
            np.packbits(ends).tobytes(),
            _planes(left & _mask(rest), rest),
            _planes(right, packing.half),
            np.minimum(counts, 255).astype(np.uint8).tobytes(),
            large.astype("<i8").tobytes(),
        ]
    )


def decode(packing: Packing, prefix: int, value: int, blob: bytes) -> Entries:
    """The entries of a filter, in order; ``value`` is its prefix."""
    view = memoryview(blob)
    n, quotient_bits, n_large = HEADER.unpack_from(view)
    at = HEADER.size
    rest = packing.half - prefix - quotient_bits

    def bits(size: int) -> np.ndarray:
        nonlocal at
        raw = np.frombuffer(view, np.uint8, (size + 7) // 8, at)
        at += (size + 7) // 8
        return np.unpackbits(raw, count=size).astype(bool)

    occupied, ends = np.flatnonzero(bits(1 << quotient_bits)), bits(n)
    run = np.cumsum(np.r_[False, ends[:-1]][:n])
    quotient = occupied[run].astype(U) if n else np.zeros(0, U)
    low, at = _values(view, at, n, rest)
    right, at = _values(view, at, n, packing.half)
    counts = np.frombuffer(view, np.uint8, n, at).astype(np.int64)
    counts[counts == 255] = np.frombuffer(view, "<i8", n_large, at + n)
    top = U(value << (packing.half - prefix))
    return top | (quotient << U(rest)) | low, right, counts


def merged(packing: Packing, filters: list[Entries]) -> Entries:
    """One filter's entries from those of several."""
    left, right, counts = (np.concatenate(c) for c in zip(*filters))
    return added_up(packing, left, right, counts)
