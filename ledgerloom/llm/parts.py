"""Encode the parts of many texts, each distinct part once.

What a part was encoded to is remembered per Python worker in arrays: sorted
keys in a few runs of growing length, which are searched and merged as arrays.
Both the parts and their ids that are remembered are bounded; parts of over
``LONGEST`` characters are encoded each time and never remembered.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

from ledgerloom.llm.codes import LONGEST, part_hashes


@dataclass
class Run:
    keys: np.ndarray
    first: np.ndarray
    size: np.ndarray

    def __add__(self, other: "Run") -> "Run":
        keys = np.concatenate([self.keys, other.keys])
        order = np.argsort(keys, kind="stable")
        return Run(
            keys[order],
            np.concatenate([self.first, other.first])[order],
            np.concatenate([self.size, other.size])[order],
        )


class PartStore:
    """``encode_many`` gives the ids of each of a list of parts.

    What is remembered is dropped before a call once it is over ``limit`` parts or
    ``room`` ids; one call adds its own distinct parts to that at most.
    """

    def __init__(
        self,
        encode_many: Callable[[list[str]], list[list[int]]],
        limit: int = 1_000_000,
        room: int = 8_000_000,
    ):
        self.encode_many, self.limit, self.room = encode_many, limit, room
        self._forget()

    def _forget(self) -> None:
        self.runs: list[Run] = []
        self.ids, self.used = np.zeros(1 << 16, np.int32), 0

    def _keep(self, made: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        size = np.array([len(x) for x in made], np.int32)
        total = int(size.sum())
        if self.used + total > len(self.ids):
            more = np.zeros(max(2 * len(self.ids), self.used + total), np.int32)
            more[: self.used] = self.ids[: self.used]
            self.ids = more
        self.ids[self.used : self.used + total] = [i for x in made for i in x]
        first = self.used + np.cumsum(size, dtype=np.int64) - size
        self.used += total
        return first, size

    def encode(self, codes: np.ndarray, joined: str, begin: np.ndarray):
        """Ids of all parts, one after the other, and where each part's begin.

        A part goes from one of ``begin`` to the next in ``joined``, the string
        of ``codes``.
        """
        ends = np.append(begin[1:], len(codes))
        if sum(len(r.keys) for r in self.runs) > self.limit or self.used > self.room:
            self._forget()
        is_long = ends - begin > LONGEST
        short, long = np.flatnonzero(~is_long), np.flatnonzero(is_long)
        begins, stops = begin[short], ends[short]
        key, place, which = np.unique(
            part_hashes(codes, begin)[short], return_index=True, return_inverse=True
        )
        first, size = np.zeros(len(key), np.int64), np.zeros(len(key), np.int32)
        missing = np.ones(len(key), bool)
        for run in self.runs:
            at = np.minimum(np.searchsorted(run.keys, key), len(run.keys) - 1)
            hit = run.keys[at] == key
            first[hit], size[hit] = run.first[at[hit]], run.size[at[hit]]
            missing &= ~hit
        new = np.flatnonzero(missing)
        if len(new):
            spans = zip(begins[place[new]].tolist(), stops[place[new]].tolist(), strict=True)
            first[new], size[new] = self._keep(self.encode_many([joined[a:b] for a, b in spans]))
            self.runs.append(Run(key[new], first[new], size[new]))
            while len(self.runs) > 1 and len(self.runs[-2].keys) < 2 * len(self.runs[-1].keys):
                self.runs[-2:] = [self.runs[-2] + self.runs[-1]]
        first, sizes = first[which], np.zeros(len(begin), np.int64)
        sizes[short] = size[which]
        apart = [
            np.array(self.encode_many([joined[a:b]])[0], np.int32)
            for a, b in zip(begin[long].tolist(), ends[long].tolist(), strict=True)
        ]
        sizes[long] = [len(x) for x in apart]
        after = np.concatenate([[0], np.cumsum(sizes)])
        taken = sizes[short]
        shift = np.repeat(first - np.cumsum(taken) + taken, taken)
        found = self.ids[np.arange(len(shift)) + shift]
        if not len(long):
            return found, after
        ids, of_long = np.empty(after[-1], np.int32), np.repeat(is_long, sizes)
        ids[of_long], ids[~of_long] = np.concatenate(apart), found
        return ids, after
