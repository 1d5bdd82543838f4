"""Texts as one array of code points: words and hashed n-grams without loops."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np

MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)
CODES = 0x110000


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a 32-bit hash's entropy to its upper bits."""
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (h ^ (h >> np.uint32(12))) * np.uint32(0x297A2D39)


@cache
def powers(length: int) -> np.ndarray:
    out = np.empty(length, np.uint32)
    value = 1
    for i in range(length):
        out[i] = value
        value = value * 0x01000193 & 0xFFFFFFFF
    return out


@cache
def is_letter() -> np.ndarray:
    return np.array([chr(c).isalpha() for c in range(CODES)])


@cache
def is_space() -> np.ndarray:
    return np.array([chr(c).isspace() for c in range(CODES)])


@cache
def lower() -> np.ndarray:
    return np.array([ord(x) if len(x := chr(c).lower()) == 1 else c for c in range(CODES)], np.uint32)


@cache
def multipliers64() -> np.ndarray:
    return np.random.default_rng(42).integers(0, 2**64, LONGEST, np.uint64, endpoint=False)


LONGEST = 4096


def part_hashes(codes: np.ndarray, begin: np.ndarray) -> np.ndarray:
    """64-bit hash of each part that goes from one of ``begin`` to the next.

    A sum of codes times random numbers by place, which repeat after ``LONGEST``.
    """
    length = np.diff(np.append(begin, len(codes)))
    place = np.arange(begin[0], len(codes)) - np.repeat(begin, length)
    value = codes[begin[0] :].astype(np.uint64)
    value *= multipliers64()[place & LONGEST - 1]
    h = np.add.reduceat(value, begin - begin[0], dtype=np.uint64)
    return h ^ (length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


@dataclass
class Codes:
    """``joined`` is all texts with a space before, between and after them, ``codes``
    its code points; text ``i`` is ``codes[starts[i]:ends[i]]``."""

    joined: str
    codes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray

    @classmethod
    def of(cls, texts: list[str]) -> "Codes":
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths + 1)
        joined = " " + " ".join(texts) + " "
        codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
        return cls(joined, codes, ends - lengths, ends)

    def owner(self, places: np.ndarray) -> np.ndarray:
        """The text that holds each place."""
        return np.searchsorted(self.ends, places, "right")

    def sums(self, values: np.ndarray) -> np.ndarray:
        """Sum of one value per place over each text's places and the space before it."""
        out = np.zeros(len(self.starts), np.float64)
        full = np.flatnonzero(self.ends > self.starts)
        if len(full):
            out[full] = np.add.reduceat(values, self.starts[full] - 1, dtype=np.float64)
        return out


def ngrams(codes: np.ndarray, n: int, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the ``n`` codes from each place on, and whether its inner
    codes are all ``inside`` a word (the first and last may be its edge); false
    where fewer codes are left."""
    size = max(len(codes) - n + 1, 0)
    h, ok = np.full(len(codes), n, np.uint32), np.zeros(len(codes), bool)
    for i in range(n):
        h[:size] += codes[i : i + size] * MULTIPLIERS[i]
    ok[:size] = inside[1 : 1 + size]
    for i in range(2, n - 1):
        ok[:size] &= inside[i : i + size]
    return mixed(h), ok


def words(codes: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Begin, end and hash of each run of codes ``inside``."""
    edge = np.diff(np.concatenate([[False], inside, [False]]).astype(np.int8))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(begin):
        return begin, end, np.zeros(0, np.uint32)
    place = np.arange(begin[0], len(codes)) - np.repeat(begin, np.diff(np.append(begin, len(codes))))
    value = np.where(inside[begin[0] :], codes[begin[0] :], 0) * powers(64)[place & 63]
    h = np.add.reduceat(value.astype(np.uint32), begin - begin[0], dtype=np.uint32)
    return begin, end, mixed(h ^ (end - begin).astype(np.uint32))
