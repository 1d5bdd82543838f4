"""Exact threshold pairs of unit vectors by dual traversal of cover trees.

Distances are Euclidean on the unit sphere: cosine ``c`` is ``sqrt(2 - 2c)``.
Each level of a tree is a net of half the radius of the one above, inside its
nodes; every node knows its true covering radius and how many rows it stands
for.  A pair of nodes is left out if even their nearest points are too far
apart, counted at once if even their farthest points are near enough, and
opened otherwise.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

TOP_RADIUS = 0.5
LEAF = 4
TILE = 1024
#: Slack of bounds for rounding; exact comparisons have none.
SLACK = 1e-6


@dataclass(eq=False)
class Node:
    """``points`` below it; ``children`` unless it is opened to its points."""

    center: int
    points: np.ndarray
    radius: float
    children: list["Node"] | None = None


def net(vectors: np.ndarray, points: np.ndarray, radius: float) -> list[np.ndarray]:
    """Groups of ``points``, each within ``radius`` of its first; firsts are
    farther apart than that."""
    least = 1 - radius * radius / 2
    centers, groups = np.empty(len(points), np.int64), []
    count = 0
    for start in range(0, len(points), TILE):
        some = points[start : start + TILE]
        rest, own = some, None
        if count:
            near = vectors[some] @ vectors[centers[:count]].T
            best = near.argmax(1)
            held = near[np.arange(len(some)), best] >= least
            for p, g in zip(some[held].tolist(), best[held].tolist(), strict=True):
                groups[g].append(p)
            rest = some[~held]
        own = vectors[rest] @ vectors[rest].T >= least
        free = np.ones(len(rest), bool)
        for i in range(len(rest)):
            if free[i]:
                taken = np.flatnonzero(own[i] & free)
                free[taken] = False
                centers[count] = rest[i]
                count += 1
                groups.append([int(rest[i]), *(int(rest[j]) for j in taken if j != i)])
    return [np.array(g) for g in groups]


def build(vectors: np.ndarray, points: np.ndarray, radius: float = TOP_RADIUS) -> list[Node]:
    """The nodes of the level of ``radius``, with all levels below."""
    nodes = []
    for group in net(vectors, points, radius):
        if len(group) == 1:
            nodes.append(Node(int(group[0]), group, 0.0))
            continue
        cosine = vectors[group] @ vectors[group[0]]
        reach = float(np.sqrt(max(0.0, 2 - 2 * float(cosine.min()))))
        node = Node(int(group[0]), group, reach)
        if len(group) > LEAF and reach > SLACK:
            half = radius / 2
            while half > reach:
                half /= 2
            node.children = build(vectors, group, half)
        nodes.append(node)
    return nodes


class Links:
    """What a traversal finds: links per point, and a forest of linked points."""

    def __init__(self, size: int, weight: np.ndarray):
        self.count, self.weight = np.zeros(size, np.int64), weight
        self.parent = np.arange(size)

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def join(self, i: int, j: int) -> None:
        a, b = self.root(i), self.root(j)
        if a != b:
            self.parent[max(a, b)] = min(a, b)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> None:
        np.add.at(self.count, left, self.weight[right])
        np.add.at(self.count, right, self.weight[left])
        for i, j in zip(left.tolist(), right.tolist(), strict=True):
            self.join(i, j)

    def all_between(self, left: np.ndarray, right: np.ndarray) -> None:
        self.count[left] += self.weight[right].sum()
        self.count[right] += self.weight[left].sum()
        first = int(left[0])
        for j in right.tolist():
            self.join(first, j)
        for i in left[1:].tolist():
            self.join(i, int(right[0]))

    def all_within(self, points: np.ndarray) -> None:
        self.count[points] += self.weight[points].sum() - self.weight[points]
        for j in points[1:].tolist():
            self.join(int(points[0]), j)


def _open(node: Node) -> list[Node]:
    if node.children is not None:
        return node.children
    return [Node(int(p), np.array([p]), 0.0) for p in node.points]


def _settle(vectors, work: list, reach: float, cosine: float, links: Links) -> None:
    """Node pairs whose distance is not known to be too large; a pair of a node
    with itself stands for the pairs within it."""
    while work:
        a, b = work.pop()
        if a is b:
            if len(a.points) == 1:
                continue
            if 2 * a.radius <= reach - SLACK:
                links.all_within(a.points)
                continue
            parts = _open(a)
            work += [(p, p) for p in parts]
            work += [(p, q) for i, p in enumerate(parts) for q in parts[i + 1 :]]
            continue
        if a.radius == b.radius == 0 and len(a.points) == len(b.points) == 1:
            if float(vectors[a.center] @ vectors[b.center]) >= cosine:
                links.pairs(a.points, b.points)
            continue
        apart = float(np.linalg.norm(vectors[a.center] - vectors[b.center]))
        if apart > reach + a.radius + b.radius + SLACK:
            continue
        if apart + a.radius + b.radius <= reach - SLACK:
            links.all_between(a.points, b.points)
            continue
        if len(a.points) * len(b.points) <= 1 << 16:
            # a small pair is compared at once
            near = vectors[a.points] @ vectors[b.points].T >= cosine
            left, right = np.nonzero(near)
            links.pairs(a.points[left], b.points[right])
        elif a.radius >= b.radius:
            work += [(p, b) for p in _open(a)]
        else:
            work += [(a, p) for p in _open(b)]


def _near_tops(vectors, left: list[Node], right: list[Node], reach: float, same: bool):
    """Pairs of nodes within reach of each other's points, tile by tile.

    Nodes are sorted by radius, so that a tile's largest radii bound it well.
    """
    single = vectors.astype(np.float32)
    rows, columns = ([n.center for n in side] for side in (left, right))
    radii = [np.array([n.radius for n in side]) for side in (left, right)]
    for i in range(0, len(left), TILE):
        some = single[rows[i : i + TILE]]
        for j in range(i if same else 0, len(right), TILE):
            bound = reach + radii[0][i : i + TILE].max() + radii[1][j : j + TILE].max()
            near = some @ single[columns[j : j + TILE]].T >= 1 - bound * bound / 2 - 1e-4
            for a, b in np.argwhere(near).tolist():
                if not same or i + a < j + b:
                    yield left[i + a], right[j + b]


def threshold_links(vectors: np.ndarray, split: int, weight: np.ndarray, cosine: float) -> Links:
    """Links of cosine ``cosine`` or more, by the tree of rows before ``split``
    against that of the rows from it on; within the tree if all are before it.

    ``weight`` is how many equal vectors a row stands for.
    """
    links = Links(len(vectors), weight)
    reach = float(np.sqrt(2 - 2 * cosine))
    left = build(vectors, np.arange(split))
    left.sort(key=lambda n: n.radius)
    if split == len(vectors):
        right = left
        _settle(vectors, [(n, n) for n in left if len(n.points) > 1], reach, cosine, links)
    else:
        right = build(vectors, np.arange(split, len(vectors)))
        right.sort(key=lambda n: n.radius)
    near = list(_near_tops(vectors, left, right, reach, left is right))
    # most near nodes are single points: these are compared together
    alone = [len(a.points) == len(b.points) == 1 for a, b in near]
    ends = np.array([(a.center, b.center) for (a, b), x in zip(near, alone, strict=True) if x])
    if len(ends):
        hit = np.einsum("ij,ij->i", vectors[ends[:, 0]], vectors[ends[:, 1]]) >= cosine
        links.pairs(ends[hit, 0], ends[hit, 1])
    _settle(
        vectors, [p for p, x in zip(near, alone, strict=True) if not x], reach, cosine, links
    )
    return links
