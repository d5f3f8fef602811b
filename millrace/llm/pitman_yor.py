"""Seating of hierarchical Pitman-Yor restaurants.

A restaurant with discount d and strength s that has served dish w to c customers at t tables gives it probability
(c - d t + (s + d T) parent(w)) / (s + C); T and C are the sums over its dishes.  Every table is a customer of the
parent restaurant.  Who sits with whom does not matter for these probabilities, so the seating of one dish is its
number of tables, and a Gibbs step draws it from its distribution given everything else,

    p(t) ~ S(c, t) * prod_{i < t} (s + d (T' + i)) * parent(w) ** t,

with S the generalised Stirling numbers and T' the tables of the other dishes.  Up to ``EXACT`` customers this is
drawn exactly; beyond, the ratio of neighbouring S comes from a saddle point, and t is drawn by weighing the values
around the mode, or from the normal curve where these are many.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

EXACT = 64
_WINDOW = 200


@lru_cache(maxsize=8)
def log_stirling(d: float, most: int = EXACT) -> np.ndarray:
    """log S(c, t) with S(c + 1, t) = S(c, t - 1) + (c - d t) S(c, t)."""
    out = np.full((most + 1, most + 1), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(most + 1)
    for c in range(most):
        with np.errstate(divide="ignore", invalid="ignore"):
            stay = np.where((c - d * t > 0) & (t >= 1), out[c] + np.log(np.maximum(c - d * t, 1e-300)), -np.inf)
        out[c + 1, 1:] = np.logaddexp(out[c, :-1], stay[1:])
    return out


def _draw_exact(c: int, d: float, strength: np.ndarray, log_parent: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    steps = np.cumsum(np.log(strength[:, None] + d * np.arange(c)), axis=1)
    logits = log_stirling(d)[c, 1 : c + 1] + steps + log_parent[:, None] * np.arange(1, c + 1)
    return np.argmax(logits + rng.gumbel(size=logits.shape), axis=1) + 1


@lru_cache(maxsize=8)
def _saddle(d: float) -> tuple[np.ndarray, np.ndarray]:
    """log(t / c) and log f at the saddle points of the generating function f(z) = (1 - (1 - z) ** d) / d."""
    u = -np.geomspace(1e-9, 600.0, 8192)[::-1]  # log(1 - z)
    z, f = -np.expm1(u), -np.expm1(d * u) / d
    return np.log(f) - np.log(z) - (d - 1) * u, np.log(f)


def _log_ratio(t: np.ndarray, c: np.ndarray, d: float, strength: np.ndarray, log_parent: np.ndarray) -> np.ndarray:
    """log of p(t + 1) / p(t)."""
    share, log_f = _saddle(d)
    return np.interp(np.log((t + 0.5) / c), share, log_f) - np.log(t) + np.log(strength + d * t) + log_parent


def _draw_large(c: np.ndarray, d: float, strength: np.ndarray, log_parent: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    low, high = np.zeros(len(c)), np.log(c)
    for _ in range(40):
        middle = (low + high) / 2
        more = _log_ratio(np.exp(middle), c, d, strength, log_parent) > 0
        low, high = np.where(more, middle, low), np.where(more, high, middle)
    mode = np.exp(low)
    step = np.maximum(1.0, mode * 0.01)
    slope = (_log_ratio(mode + step, c, d, strength, log_parent) - _log_ratio(mode, c, d, strength, log_parent)) / step
    spread = 1 / np.sqrt(np.maximum(-slope, 1e-12))
    drawn = np.rint(mode + 0.5 + spread * rng.standard_normal(len(c)))
    near = np.flatnonzero(spread * 4 < _WINDOW / 2)
    if len(near):  # few values can come up: weigh each
        first = np.maximum(1.0, np.rint(mode[near]) - _WINDOW // 2)[:, None] + np.arange(_WINDOW)
        args = (c[near, None], d, strength[near, None], log_parent[near, None])
        steps = np.where(first < c[near, None], _log_ratio(np.minimum(first, c[near, None]), *args), -np.inf)
        weights = np.concatenate([np.zeros((len(near), 1)), np.cumsum(steps[:, :-1], axis=1)], axis=1)
        drawn[near] = np.take_along_axis(first, np.argmax(weights + rng.gumbel(size=weights.shape), axis=1)[:, None], axis=1)[:, 0]
    return np.clip(drawn, 1, c).astype(np.int64)


def draw_tables(c: np.ndarray, d: float, strength: np.ndarray, log_parent: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Tables of dishes with ``c`` customers; ``strength`` counts the tables of the other dishes in."""
    out = np.ones(len(c), np.int64)
    order = np.argsort(np.minimum(c, EXACT + 1), kind="stable")
    edges = np.searchsorted(np.minimum(c, EXACT + 1)[order], np.arange(2, EXACT + 3))
    for size, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True), start=2):
        step = max(1, 2_000_000 // size) if size <= EXACT else 10_000
        for k in range(a, b, step):
            at = order[k : min(b, k + step)]
            if size == 2:
                second = (strength[at] + d) * np.exp(log_parent[at]) / (1 - d)
                out[at] = 1 + (rng.random(len(at)) * (1 + second) < second)
            elif size <= EXACT:
                out[at] = _draw_exact(size, d, strength[at], log_parent[at], rng)
            else:
                out[at] = _draw_large(c[at].astype(np.float64), d, strength[at], log_parent[at], rng)
    return out


def discount(once: int, twice: int) -> float:
    """Discount by the numbers of dishes with one and with two customers."""
    return float(min(0.9, max(0.05, once / max(1, once + 2 * twice))))


def left_out_log(c: np.ndarray, total: np.ndarray, tables: np.ndarray, parent: np.ndarray, d: float, strength: float) -> np.ndarray:
    """log probability of the customers of dishes when each is left out in turn, with one table per dish."""
    own = np.where(c > 1, c - 1 - d, 0.0)
    return c * (np.log(own + (strength + d * tables) * parent) - np.log(strength + total - 1 + 1e-9))
