"""K-d trees over letter counts, with searches that prune by boxes.

A search is for the points that a query becomes by gaining ``gain`` letters and
losing ``lose`` letters at most.  A node's box says how many letters a query must
gain and lose at least to come into it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# fixed values: the letters, a-z and U+00C0 to U+00FF (A-Z are lowered before)
LETTERS = 26 + 64
CLIP = 255


def letter_counts(words: list[str]) -> np.ndarray:
    """A row of letter counts per word; counts above ``CLIP`` are ``CLIP``, which
    brings points closer to each other only."""
    out = np.zeros((len(words), LETTERS), np.uint8)
    if not words:
        return out
    codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype(np.int64)
    letter = np.where(codes < 128, codes - 97, codes - 0xC0 + 26)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    counts = np.bincount(row * LETTERS + letter, minlength=out.size)
    return np.minimum(counts, CLIP).astype(np.uint8).reshape(out.shape)


def _cut(points: np.ndarray) -> tuple[int, int] | None:
    """The letter and count that split the points most evenly, or None."""
    middle = np.partition(points, len(points) // 2, axis=0)[len(points) // 2].astype(np.int16)
    best = None
    for cut in (middle, middle - 1):
        low = (points <= cut).sum(0)
        less = np.minimum(low, len(points) - low)
        at = int(less.argmax())
        if less[at] and (best is None or less[at] > best[0]):
            best = (int(less[at]), at, int(cut[at]))
    return best and best[1:]


class Tree:
    """Splits of points down to ``most`` in a leaf, where they can be told apart."""

    def __init__(self, points: np.ndarray, most: int):
        self.letter: list[int] = []
        self.cut: list[int] = []
        self.children: list[list[int]] = []  # leaves are ~number
        self.leaves: list[np.ndarray] = []
        self.root = self._built(points, np.arange(len(points)), most)

    def _leaf(self, at: np.ndarray) -> int:
        self.leaves.append(at)
        return ~(len(self.leaves) - 1)

    def _built(self, points: np.ndarray, at: np.ndarray, most: int) -> int:
        found = _cut(points[at]) if len(at) > most else None
        if found is None:
            return self._leaf(at)
        node = len(self.letter)
        self.letter.append(found[0])
        self.cut.append(found[1])
        self.children.append([])
        low = points[at, found[0]] <= found[1]
        self.children[node] = [self._built(points, at[low], most), self._built(points, at[~low], most)]
        return node

    def search(self, queries: np.ndarray, gain: int, lose: int) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves, and which queries may have a point there within reach."""
        zero = np.zeros(len(queries), np.int16)
        yield from self._search(self.root, queries, np.arange(len(queries)), zero, zero, {}, gain, lose)

    def _search(self, node, queries, at, gained, lost, box, gain, lose):
        if not len(at):
            return
        if node < 0:
            yield ~node, at
            return
        letter, cut = self.letter[node], self.cut[node]
        low, high = box.get(letter, (0, CLIP))
        held = queries[at, letter].astype(np.int16)
        # below the cut: what was lost to come below `high` is part of it
        more = lost + np.maximum(held - cut, 0) - np.maximum(held - high, 0)
        near = more <= lose
        yield from self._search(
            self.children[node][0], queries, at[near], gained[near], more[near], box | {letter: (low, cut)}, gain, lose
        )
        more = gained + np.maximum(cut + 1 - held, 0) - np.maximum(low - held, 0)
        near = more <= gain
        yield from self._search(
            self.children[node][1], queries, at[near], more[near], lost[near], box | {letter: (cut + 1, high)}, gain, lose
        )

    def places(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        out = np.zeros(len(points), np.int64)
        for leaf, at in self.search(points, 0, 0):
            out[at] = leaf
        return out


def near_vectors(points: np.ndarray, queries: np.ndarray, gain: int, lose: int, leaf: int = 24) -> np.ndarray:
    """Pairs (query, point) of distinct vectors within reach, or clipped ones."""
    used = points.any(0) | queries.any(0)
    points, queries = np.ascontiguousarray(points[:, used]), np.ascontiguousarray(queries[:, used])
    total, asked = points.sum(1, dtype=np.int32), queries.sum(1, dtype=np.int32)
    clipped = (points == CLIP).any(1)
    tree, found = Tree(points, leaf), []
    for number, at in tree.search(queries, gain, lose):
        inside = tree.leaves[number]
        for start in range(0, len(at), 1024):
            some = at[start : start + 1024]
            # letters that either has: what exceeds one's letters the other one has more
            either = np.maximum(points[inside][None], queries[some][:, None]).sum(2, dtype=np.uint16).astype(np.int32)
            more, less = either - asked[some][:, None], either - total[inside][None]
            near = (more <= gain) & (less <= lose) & ((more + less > 0) | clipped[inside][None])
            q, p = np.nonzero(near)
            found.append(np.stack([some[q], inside[p]], 1))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)
