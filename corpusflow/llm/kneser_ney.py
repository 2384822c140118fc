"""Interpolated Kneser-Ney models of words as characters, one per class, over shared lower orders.

A word is the characters between ``^`` and ``$``; the model of a class gives each
character's probability after the ``ORDER - 1`` before it.  The highest orders
use the class's own counts; orders up to ``SHARED`` use the continuation counts
of both classes together, so that an expression which is rare in either class
is judged by common statistics and not by chance.
"""
from __future__ import annotations

import math
from collections import defaultdict

ORDER, SHARED = 6, 3


def grams(word: str, order: int = ORDER) -> list[str]:
    padded = "^" * (order - 1) + word + "$"
    return [padded[k:k + order] for k in range(len(word) + 1)]


def discount(counts: list[int]) -> float:
    """Ney's estimate from the n-grams that were seen once and twice."""
    once, twice = sum(c == 1 for c in counts), sum(c == 2 for c in counts)
    return once / (once + 2 * twice) if once and twice else 0.75


class ClassModels:
    """Probabilities of both classes for every n-gram that was seen, and their back-off weights.

    Each pair is one complex number (toxic + ordinary * i), a third of a tuple's
    size: every worker holds the whole model.
    """

    def __init__(self, counts: dict[str, tuple[int, int]], order: int = ORDER, shared: int = SHARED):
        self.seen: dict[str, complex] = {}
        self.weights: dict[str, complex] = {}
        self.order = order
        levels = [counts]
        for _ in range(order - 1):  # continuation counts: how many characters come before
            lower: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0])
            for gram, row in levels[-1].items():
                own = lower[gram[1:]]
                own[0] += row[0] > 0
                own[1] += row[1] > 0
                own[2] += 1
            levels.append(lower)
        self.floor = 1.0 / (len(levels[-1]) + 1)
        for n, level in zip(range(1, order + 1), reversed(levels)):
            both = [(r[2], r[2]) for r in level.values()] if n <= shared else [(r[0], r[1]) for r in level.values()]
            cuts = [discount([r[c] for r in both]) for c in (0, 1)]
            totals: dict[str, list[int]] = defaultdict(lambda: [0, 0, 0, 0])
            for gram, row in zip(level, both):
                t = totals[gram[:-1]]
                for c in (0, 1):
                    t[c] += row[c]
                    t[2 + c] += row[c] > 0
            for h, t in totals.items():
                self.weights[h] = complex(*(cuts[c] * t[2 + c] / t[c] if t[c] else 1.0 for c in (0, 1)))
            fresh = {}
            for gram, row in zip(level, both):
                t, w, below = totals[gram[:-1]], self.weights[gram[:-1]], self.probability(gram[1:])
                w = w.real, w.imag
                fresh[gram] = complex(*((max(row[c] - cuts[c], 0) / t[c] if t[c] else 0.0) + w[c] * below[c] for c in (0, 1)))
            self.seen.update(fresh)

    def probability(self, gram: str) -> tuple[float, float]:
        if not gram:
            return self.floor, self.floor
        found = self.seen.get(gram)
        if found is not None:
            return found.real, found.imag
        toxic, ordinary = self.probability(gram[1:])
        w = self.weights.get(gram[:-1])
        return (w.real * toxic, w.imag * ordinary) if w is not None else (toxic, ordinary)

    def log_ratio(self, word: str) -> float:
        """log P(word | toxic) - log P(word | ordinary)."""
        a = b = 1.0
        out = 0.0
        for gram in grams(word, self.order):
            p, q = self.probability(gram)
            a *= p
            b *= q
            if a < 1e-200 or b < 1e-200:
                out += math.log(a) - math.log(b)
                a = b = 1.0
        return out + math.log(a) - math.log(b)
