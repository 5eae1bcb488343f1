"""A sampler for a settings search that learns from the trials so far.

The better quarter of the finished trials and the rest each become a density over the search space: a mixture of bells
around the trials' values, one mixture a setting, and a flat part that keeps every value possible. Candidates are drawn from the
density of the good trials, and the one with the largest ratio of the two densities is tried next.

A suggestion depends on the trials with smaller numbers and on its own number only, so a search that stops goes on
as if it had not. Trials are few; the sampler is plain Python on the driver.
"""

from __future__ import annotations

import math
import random
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

START = 10  # trials drawn evenly before anything is learnt
GOOD = 0.25
CANDIDATES = 24


@dataclass(frozen=True)
class Range:
    low: float
    high: float
    logarithmic: bool = False
    whole: bool = False

    def _ends(self) -> tuple[float, float]:
        low, high = (self.low - 0.5, self.high + 0.5) if self.whole else (self.low, self.high)
        return (math.log(low), math.log(high)) if self.logarithmic else (low, high)

    def unit(self, value: float) -> float:
        """The value's place between 0 and 1."""
        low, high = self._ends()
        return ((math.log(value) if self.logarithmic else value) - low) / (high - low) if high > low else 0.5

    def value(self, unit: float) -> float:
        low, high = self._ends()
        at = low + min(1.0, max(0.0, unit)) * (high - low)
        at = math.exp(at) if self.logarithmic else at
        return int(min(self.high, max(self.low, round(at)))) if self.whole else min(self.high, max(self.low, at))


class Mixture:
    """Bells at ``points`` of the unit interval, cut off at its ends, and a flat part of the weight of one bell."""

    def __init__(self, points: Sequence[float]):
        self.points = sorted(points)
        edges = [0.0, *self.points, 1.0]
        # A bell reaches to its farther neighbour: wide where trials are few.
        self.widths = [
            max(edges[i + 1] - edges[i], edges[i + 2] - edges[i + 1], 1.0 / (2 + len(points)) ** 1.5) for i in range(len(self.points))
        ]

    def draw(self, r: random.Random) -> float:
        i = r.randrange(len(self.points) + 1)
        if i == len(self.points):
            return r.random()
        while True:
            x = r.gauss(self.points[i], self.widths[i])
            if 0 <= x <= 1:
                return x

    def log_density(self, x: float) -> float:
        total = 1.0
        for m, w in zip(self.points, self.widths, strict=True):
            inside = 0.5 * (math.erf((1 - m) / (w * math.sqrt(2))) + math.erf(m / (w * math.sqrt(2))))
            total += math.exp(-0.5 * ((x - m) / w) ** 2) / (w * math.sqrt(2 * math.pi) * inside)
        return math.log(total / (len(self.points) + 1))


def suggest(
    space: Mapping[str, Range], done: Sequence[Mapping[str, float]], scores: Sequence[float], trial: int, seed: int,
    start: int = START,
) -> dict[str, float]:
    """Settings of trial number ``trial``, given the settings and scores (larger is better) of earlier trials.

    Scores that are not numbers count as the worst; equal scores stand in the order of the trials.
    """
    r = random.Random(seed * 1_000_003 + trial)
    if len(done) < start:
        return {name: range_.value(r.random()) for name, range_ in space.items()}
    worst = [-math.inf if s is None or math.isnan(s) else s for s in scores]
    order = sorted(range(len(done)), key=lambda i: (-worst[i], i))
    n_good = max(1, math.ceil(GOOD * len(done)))
    units = {name: [range_.unit(d[name]) for d in done] for name, range_ in space.items()}
    good = {name: Mixture([units[name][i] for i in order[:n_good]]) for name in space}
    rest = {name: Mixture([units[name][i] for i in order[n_good:]]) for name in space}
    best, best_ratio = None, -math.inf
    for _ in range(CANDIDATES):
        # Whole numbers are judged at the place of the number that would be tried.
        drawn = {name: range_.value(good[name].draw(r)) for name, range_ in space.items()}
        ratio = sum(good[n].log_density(space[n].unit(v)) - rest[n].log_density(space[n].unit(v)) for n, v in drawn.items())
        if ratio > best_ratio:
            best, best_ratio = drawn, ratio
    return best
