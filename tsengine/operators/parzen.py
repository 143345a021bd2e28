"""Draws that learn from finished trials: a tree-structured Parzen estimator.

Finished trials are split by score into a good part and the rest.  For every
parameter each part gives a density: a mixture of normal kernels on the part's
values and one broad kernel for the whole range, cut to the range.  Candidates
are drawn from the good density, and the one with the highest ratio of good to
other density is proposed, parameter by parameter.

Only the (few) scores and parameter values of finished trials are held here; the
trials themselves are Spark jobs (``operators.search``).  Log-scaled parameters
live on their logarithm, integers on half-open cells around them.
"""

from __future__ import annotations

import math
import random
from collections.abc import Sequence
from statistics import NormalDist

START = 10          # independent draws before the densities are used
CANDIDATES = 24     # draws from the good density a parameter
GOOD_SHARE = 0.1    # of the finished trials, rounded up ...
GOOD_MOST = 25      # ... and at most so many

_NORMAL = NormalDist()


def bounds(kind: str, low: float, high: float) -> tuple[float, float]:
    """The range that densities live on."""
    if kind == "log":
        return math.log(low), math.log(high)
    if kind == "int":
        return low - 0.5, high + 0.5
    if kind == "uniform":
        return float(low), float(high)
    raise ValueError(f"kind must be 'log', 'int' or 'uniform': {kind!r}")


def to_scale(kind: str, value) -> float:
    return math.log(value) if kind == "log" else float(value)


def from_scale(kind: str, x: float, low, high):
    """A parameter value, never outside its range."""
    if kind == "log":
        return min(max(math.exp(x), low), high)
    if kind == "int":
        return min(max(int(math.floor(x + 0.5)), low), high)
    return min(max(x, low), high)


def draw_uniform(space: dict, rng: random.Random) -> dict:
    """An independent draw: uniform on every parameter's scale."""
    out = {}
    for name in sorted(space):
        kind, low, high = space[name]
        out[name] = from_scale(kind, rng.uniform(*bounds(kind, low, high)), low, high)
    return out


class Density:
    """Mixture of normal kernels cut to ``[low, high]``: one on every point, as
    wide as the larger gap to its neighbours, and one over the whole range."""

    def __init__(self, points: Sequence[float], low: float, high: float):
        self.low, self.high = low, high
        span = high - low
        middle = (low + high) / 2
        centres = sorted([*points, middle])
        least = span / min(100.0, 1.0 + len(centres))
        self.kernels = []
        whole = False
        for i, c in enumerate(centres):
            if c == middle and not whole:
                whole = True
                self.kernels.append((c, span))
                continue
            left = centres[i - 1] if i else low
            right = centres[i + 1] if i + 1 < len(centres) else high
            self.kernels.append((c, min(max(c - left, right - c, least), span)))

    def _inside(self, centre: float, width: float) -> tuple[float, float]:
        return _NORMAL.cdf((self.low - centre) / width), _NORMAL.cdf((self.high - centre) / width)

    def sample(self, rng: random.Random) -> float:
        centre, width = rng.choice(self.kernels)
        a, b = self._inside(centre, width)
        u = min(max(rng.uniform(a, b), 1e-12), 1 - 1e-12)
        return min(max(centre + width * _NORMAL.inv_cdf(u), self.low), self.high)

    def log_at(self, x: float, cell: float = 0.0) -> float:
        """Log density at ``x``; with ``cell``, log probability of the cell around it."""
        total = 0.0
        for centre, width in self.kernels:
            a, b = self._inside(centre, width)
            if cell:
                mass = _NORMAL.cdf((x + cell - centre) / width) - _NORMAL.cdf((x - cell - centre) / width)
            else:
                mass = math.exp(-((x - centre) / width) ** 2 / 2) / (width * math.sqrt(2 * math.pi))
            total += mass / (b - a)
        return math.log(max(total / len(self.kernels), 1e-300))


def propose(space: dict, finished: Sequence[tuple[dict, float]], rng: random.Random, start: int = START,
            candidates: int = CANDIDATES) -> dict:
    """The next draw, given ``finished`` trials as (parameters, score), larger
    scores being better.  Fewer than ``start`` finished trials: an independent
    draw.  Trials without a score (NaN) count as the worst."""
    if len(finished) < max(start, 2):
        return draw_uniform(space, rng)
    ranked = sorted(finished, key=lambda f: math.inf if math.isnan(f[1]) else -f[1])
    n_good = min(max(1, math.ceil(GOOD_SHARE * len(ranked))), GOOD_MOST)
    good, rest = ranked[:n_good], ranked[n_good:]
    out = {}
    for name in sorted(space):
        kind, low, high = space[name]
        lo, hi = bounds(kind, low, high)
        if hi <= lo:
            out[name] = from_scale(kind, lo, low, high)
            continue
        better, worse = (Density([to_scale(kind, p[name]) for p, _ in part], lo, hi) for part in (good, rest))
        cell = 0.5 if kind == "int" else 0.0
        best, gain = None, -math.inf
        for _ in range(candidates):
            value = from_scale(kind, better.sample(rng), low, high)
            x = to_scale(kind, value)
            ratio = better.log_at(x, cell) - worse.log_at(x, cell)
            if ratio > gain:
                best, gain = value, ratio
        out[name] = best
    return out
