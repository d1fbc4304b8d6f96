"""Seating in Pitman-Yor restaurants, as array operations on many dishes at once.

A restaurant with T tables has the factor (strength + discount) .. of its T tables. With an
auxiliary variable g ~ Gamma(strength / discount + T), that factor falls apart: given g and
the parent's probabilities p, the table counts t of all dishes of the restaurant are
independent, with weights S(c, t) * (discount * g * p)^t for c customers, where S are the
generalised Stirling numbers. So all dishes of a restaurant, in whatever tasks, are drawn at
once and the sweep is still exact Gibbs sampling.

Up to `EXACT` customers are drawn from a table of those numbers. For more, when few of the
customers open tables, from the numbers' closed sum, whose terms then fall fast. Otherwise a
restaurant with a matching strength is seated anew and accepted or not by
Metropolis-Hastings, in which the Stirling numbers cancel: the draw keeps the same
distribution, whatever the count.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

EXACT = 160
PROPOSALS = 8
# Most tables, and terms, that the closed sum is used for.
MOST_TABLES, TERMS = 1024, 64


def scale(strength: float, discount: float, tables: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """discount * g, the auxiliary variable of restaurants with so many tables."""
    return discount * rng.gamma(strength / discount + np.asarray(tables, dtype=np.float64))


@lru_cache(maxsize=4)
def stirling(discount: float, most: int = EXACT) -> np.ndarray:
    """Logarithms of the generalised Stirling numbers, customers by tables."""
    table = np.full((most + 1, most + 1), -np.inf)
    table[0, 0] = 0.0
    for c in range(most):
        stay = np.full(c + 1, -np.inf)
        stay[:c] = table[c, 1:c + 1] + np.log(c - np.arange(1, c + 1) * discount)
        table[c + 1, 1:c + 2] = np.logaddexp(table[c, :c + 1], stay)
    return table


def closed_numbers(customers: np.ndarray, most: int, discount: float) -> np.ndarray:
    """Stirling numbers of each count of customers for 1 to `most` tables, up to a factor per
    row: the alternating sum over k of C(t, k) * Gamma(c - k d) / Gamma(-k d) / (d^t t!),
    which `TERMS` terms give when t is at most three quarters of c^d."""
    k = np.arange(1, min(most, TERMS) + 1)
    # 1 / Gamma(-x) by reflection.
    inverse = -np.sin(np.pi * k * discount) * np.exp(log_gamma(1 + k * discount)) / np.pi
    power = log_gamma(customers[:, None] - k * discount) - log_gamma(customers - discount)[:, None]
    terms = (-1.0) ** (k - 1) * inverse / inverse[0] * np.exp(power)
    t = np.arange(1, most + 1)
    inside = t >= k[:, None]
    choose = np.exp(log_gamma(t + 1.0) - log_gamma(k[:, None] + 1.0) - log_gamma(np.maximum(t - k[:, None], 0) + 1.0))
    total = terms @ np.where(inside, choose, 0.0)
    return np.log(np.maximum(total, 1e-300)) - t * math.log(discount) - log_gamma(t + 1.0)


def picked(log_weight: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """One column of every row, from 1, with these weights."""
    mass = np.cumsum(np.exp(log_weight - log_weight.max(axis=1, keepdims=True)), axis=1)
    pick = rng.random(len(mass)) * mass[:, -1]
    return np.minimum((mass <= pick[:, None]).sum(axis=1), mass.shape[1] - 1) + 1


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Logarithm of the gamma function of positive numbers, by Stirling's series."""
    x = np.asarray(x, dtype=np.float64)
    small = x < 10
    far = np.where(small, x + 10, x)
    out = (far - 0.5) * np.log(far) - far + 0.5 * math.log(2 * math.pi)
    out += 1 / (12 * far) - 1 / (360 * far**3) + 1 / (1260 * far**5)
    near = np.where(small, x, 1.0)
    for i in range(10):
        out -= np.where(small, np.log(near + i), 0.0)
    return out


def matching_strength(customers: np.ndarray, weight: np.ndarray, discount: float) -> np.ndarray:
    """The strength with which a restaurant is expected to have as many tables as the
    conditional with this weight prefers: strength + discount * E[tables] = weight."""
    low, high = np.full(len(customers), -20.0), np.full(len(customers), 60.0)
    wanted = np.log(weight)
    for _ in range(40):
        middle = (low + high) / 2
        s = np.exp(middle) - discount
        got = (log_gamma(s + discount + customers) - log_gamma(s + discount)
               - log_gamma(s + customers) + log_gamma(s + 1))
        above = got > wanted
        high, low = np.where(above, middle, high), np.where(above, low, middle)
    return np.exp((low + high) / 2) - discount


def seated(customers: np.ndarray, strength: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of restaurants with so many customers, opened one table after the other: each
    takes the first customer left and a beta share of the others."""
    tables = np.zeros(len(customers), dtype=np.int64)
    rows, left, s = np.arange(len(customers)), customers.astype(np.int64), strength
    number = 1
    while len(rows):
        tables[rows] += 1
        share = rng.beta(1 - discount, s + discount * number)
        left = left - 1 - rng.binomial(left - 1, share)
        stay = left > 0
        rows, left, s = rows[stay], left[stay], s[stay]
        number += 1
    return tables


def seat(
    customers: np.ndarray,
    weight: np.ndarray,
    discount: float,
    rng: np.random.Generator,
    tables: np.ndarray | None = None,
) -> np.ndarray:
    """Tables of each dish, drawn given its customers and its weight; `tables` are the ones
    that the dishes have so far."""
    customers = np.asarray(customers, dtype=np.int64)
    weight = np.maximum(weight, 1e-300)
    out = np.minimum(customers, 1)
    numbers = stirling(discount)
    order = np.argsort(customers, kind="stable")
    ends = np.searchsorted(customers[order], np.arange(EXACT + 2))
    for c in range(2, EXACT + 1):
        rows = order[ends[c]:ends[c + 1]]
        if not len(rows):
            continue
        for part in np.array_split(rows, -(-len(rows) * c // 1_000_000)):
            log_weight = numbers[c, 1:c + 1] + np.outer(np.log(weight[part]), np.arange(1, c + 1))
            out[part] = picked(log_weight, rng)
    rows = order[ends[EXACT + 1]:]
    # Far from all customers, tables but the first are about a Poisson number.
    mean = weight[rows] / discount
    likely = mean + 6 * np.sqrt(mean) + 8
    few = likely <= np.minimum(MOST_TABLES, customers[rows] ** discount * 0.75)
    most = 16
    while most <= MOST_TABLES:
        own = np.nonzero(few & (likely <= most) & (likely > (most // 4 if most > 16 else 0)))[0]
        for part in np.array_split(own, -(-len(own) * most // 1_000_000)) if len(own) else []:
            t = np.arange(1, most + 1)
            log_weight = closed_numbers(customers[rows[part]], most, discount)
            log_weight += np.outer(np.log(weight[rows[part]]), t)
            out[rows[part]] = picked(np.where(t <= likely[part, None], log_weight, -np.inf), rng)
        most *= 4
    rows = rows[~few]
    if len(rows):
        c, a = customers[rows], weight[rows]
        s = matching_strength(c, a, discount)

        def ratio(t: np.ndarray) -> np.ndarray:
            proposed = (t - 1) * math.log(discount) + log_gamma(s / discount + t) - log_gamma(s / discount + 1)
            return t * np.log(a) - proposed

        # Proposals do not depend on the state, so all are seated side by side.
        every = seated(np.tile(c, PROPOSALS + 1), np.tile(s, PROPOSALS + 1), discount, rng)
        now, *proposals = every.reshape(PROPOSALS + 1, len(c))
        if tables is not None:
            now = np.clip(tables[rows], 1, c)
        for new in proposals:
            accept = np.log(rng.random(len(c))) < ratio(new) - ratio(now)
            now = np.where(accept, new, now)
        out[rows] = now
    return out
