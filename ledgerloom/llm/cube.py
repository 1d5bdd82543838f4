"""The cube method in memory: balanced rounding of inclusion probabilities.

Probabilities move along directions that leave the expected number of units and
their expected size as they are (the null space of the constraints), each time
until one of them is 0 or 1.  The direction starts at the largest open unit and
is spread over all others, so that large units are settled while there are
many to make up for them, and the few that stay open are small.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

EPS = 1e-9
LAST = 8


@dataclass
class Tail:
    """Units that are not at hand: one probability, linear in the size, for all."""

    n: float = 0.0
    sum: float = 0.0
    squares: float = 0.0
    most: float = 0.0
    share: float = 0.0  # probability of a unit of size 0
    slope: float = 0.0

    def ends(self) -> np.ndarray:
        return self.share + self.slope * np.array([0.0, self.most])


NONE = Tail()


def _direction(
    sizes: np.ndarray, values: np.ndarray, lead: int, tail: Tail, constraints: int
) -> tuple[np.ndarray, float, float]:
    """A direction in the null space in which the lead moves most: per unit, and for
    a tail unit of size 0 and per size.  Others move by their room to 0 and 1."""
    room = np.minimum(values, 1 - values)
    tail_room = max(float(np.minimum(tail.ends(), 1 - tail.ends()).min()), 0.0) if tail.n else 0.0
    level = slope = 0.0
    if constraints == 2:
        n = room.sum() + tail_room * tail.n
        mean = (room @ sizes + tail_room * tail.sum) / n
        apart = sizes - mean
        spread = room @ (apart * apart)
        spread += tail_room * max(tail.squares - 2 * mean * tail.sum + tail.n * mean * mean, 0.0)
        slope = -apart[lead] / spread if spread > EPS * n * mean * mean else 0.0
        level = -1 / n - slope * mean
    elif constraints == 1:
        spread = room @ (sizes * sizes) + tail_room * tail.squares
        slope = -sizes[lead] / spread if spread else 0.0
    u = room * (level + slope * sizes)
    u[lead] += 1
    return u, tail_room * level, tail_room * slope


def certain(sizes: np.ndarray, share: float, tail: Tail) -> tuple[np.ndarray, Tail]:
    """Probabilities where all units would have ``share``.

    A unit larger than all that is to be taken is left, one larger than all that
    is to be left is taken (if both, what misses the total less): nothing could
    make up for it.  The others get the share that keeps the total size.
    """
    shares = np.full(len(sizes), np.nan)
    whole = sizes.sum() + tail.sum
    wanted = share * whole
    for i, size in enumerate(sizes):
        if size <= min(wanted, whole - wanted):
            break
        shares[i] = float(abs(wanted - size) < abs(wanted - min(whole - size, wanted))) if size > wanted else 1.0
        whole -= size
        wanted = min(max(wanted - shares[i] * size, 0.0), whole)
    rest = wanted / whole if whole > 0 else share
    return np.where(np.isnan(shares), rest, shares), Tail(tail.n, tail.sum, tail.squares, tail.most, rest)


def _reach(values: np.ndarray, u: np.ndarray) -> np.ndarray:
    """How far each value can go along ``u`` until it is 0 or 1."""
    moves = np.abs(u) > EPS * np.abs(u).max(initial=EPS)
    room = np.where(u > 0, 1 - values, values)
    return np.where(moves, np.maximum(room, 0.0) / np.where(moves, np.abs(u), 1.0), np.inf)


def settle(
    sizes: np.ndarray, shares: np.ndarray, rng: np.random.Generator, *, tail: Tail = NONE, land: bool = False
) -> tuple[np.ndarray, Tail]:
    """Probabilities after the moves: 0 or 1, but for two units at most.

    ``sizes`` fall.  A ``tail`` takes part as long as all its probabilities are
    between 0 and 1; it is given back with the new ones.  With ``land`` the last
    units are settled too: the number of units is given up when ``LAST`` are open,
    the size when one is.
    """
    scale = max(float(sizes.max(initial=0.0)), tail.most) or 1.0
    s, p = sizes / scale, shares.astype(np.float64)
    t = Tail(tail.n, tail.sum / scale, tail.squares / scale**2, tail.most / scale, tail.share, tail.slope * scale)
    held = t if t.n else NONE
    for constraints in (2, 1, 0) if land else (2,):
        while True:
            p[p < EPS], p[p > 1 - EPS] = 0.0, 1.0
            open_ = np.flatnonzero((p > 0) & (p < 1))
            if land and constraints == 2 and len(open_) <= LAST:
                break
            for lead in range(len(open_)):
                u, level, slope = _direction(s[open_], p[open_], lead, held, constraints)
                if u[lead] > EPS:
                    break
            else:
                break
            values, along = p[open_], u
            if held.n:
                values = np.concatenate([values, held.ends()])
                along = np.concatenate([u, level + slope * np.array([0.0, held.most])])
            up, down = _reach(values, along), _reach(values, -along)
            far, back = up.min(), down.min()
            if far + back <= 0:  # a bound of the tail holds both ways
                held = NONE
                continue
            rise = rng.random() * (far + back) < back
            step, hit = (far, int(up.argmin())) if rise else (-back, int(down.argmin()))
            p[open_] = np.clip(p[open_] + step * u, 0.0, 1.0)
            if held.n:
                held.share, held.slope = held.share + step * level, held.slope + step * slope
            if hit < len(open_):
                p[open_[hit]] = round(p[open_[hit]])
            else:
                held = NONE
    return p, Tail(tail.n, tail.sum, tail.squares, tail.most, t.share, t.slope / scale)
