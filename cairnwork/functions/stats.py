"""Intervals and small-sample statistics. Inputs are counts, so they run where the counts are, mostly the driver."""

from __future__ import annotations

import math
import random


def wilson(k: int, n: int, z: float = 1.959963984540054) -> tuple[float, float]:
    if n == 0:
        return 0.0, 1.0
    p = k / n
    mid, half, den = p + z * z / (2 * n), z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n)), 1 + z * z / n
    return (mid - half) / den, (mid + half) / den


def _binomial_tail(k: int, n: int, p: float) -> float:
    """P(X >= k)."""
    if k <= 0:
        return 1.0
    if p in (0.0, 1.0):
        return p
    logs = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k, n + 1)]
    top = max(logs)
    return math.exp(top) * sum(math.exp(x - top) for x in logs)


def clopper_pearson(k: int, n: int, alpha: float = 0.05) -> tuple[float, float]:
    """The exact interval, by bisection on the binomial tails."""

    def solve(f) -> float:
        low, high = 0.0, 1.0
        for _ in range(60):
            mid = (low + high) / 2
            low, high = (mid, high) if f(mid) else (low, mid)
        return (low + high) / 2

    low = 0.0 if k == 0 else solve(lambda p: _binomial_tail(k, n, p) < alpha / 2)
    high = 1.0 if k == n else solve(lambda p: 1 - _binomial_tail(k + 1, n, p) > alpha / 2)
    return low, high


def beta_accuracy(cells: list[tuple[int, int, float]], draws: int = 4000, seed: int = 7) -> tuple[float, float, float]:
    """(mean, 2.5 %, 97.5 %) of the weighted accuracy of cells (right, checked, weight), from Beta posteriors with Jeffreys' prior.

    A cell of which nothing was checked has no posterior and is left out; without any other the answer is (nan, nan, nan).
    """
    known = [c for c in cells if c[1] > 0]
    r, total = random.Random(seed), sum(w for *_, w in known)
    if not total:
        return (math.nan,) * 3
    got = sorted(sum(w * r.betavariate(k + 0.5, n - k + 0.5) for k, n, w in known) / total for _ in range(draws))
    return sum(got) / draws, got[int(0.025 * draws)], got[int(0.975 * draws) - 1]
