"""Kneser-Ney models of two classes in plain Python."""

import math
from collections import Counter, defaultdict
from typing import NamedTuple


def grams_of(word: str, order: int) -> list[str]:
    marked = f"^{word}$"
    return [marked[max(0, i - order + 1) : i + 1] for i in range(1, len(marked))]


class Ratios(NamedTuple):
    order: int
    grams: dict[str, float]
    contexts: dict[str, float]

    def word(self, token: str) -> float:
        total = 0.0
        for gram in grams_of(token, self.order):
            ratio = self.grams.get(gram)
            total += self.contexts.get(gram[:-1], 0.0) if ratio is None else ratio
        return total


def _shared(grams: set[str], order: int) -> dict[str, float]:
    """Kneser-Ney probabilities of all shorter n-grams from the distinct n-grams of both classes."""
    by_length = defaultdict(set)
    for gram in grams:
        by_length[len(gram)].add(gram)
    continued, above = {}, set()
    for length in range(order - 1, 0, -1):
        continued[length] = Counter(gram[1:] for gram in above | by_length[length + 1])
        above = set(continued[length])
    probability: dict[str, float] = {}
    for length in range(1, order):
        total, kinds = Counter(), Counter()
        for gram, n in continued[length].items():
            total[gram[:-1]] += n
            kinds[gram[:-1]] += 1
        for gram, n in continued[length].items():
            context = gram[:-1]
            lower = probability[gram[1:]] if length > 1 else 1 / len(continued[1])
            rest = 0.75 * kinds[context] / total[context]
            probability[gram] = (n - 0.75) / total[context] + rest * lower
    return probability


def fit_ratios(counts: list[tuple[str, int, int]], order: int) -> Ratios:
    """The two models from ``(gram, ordinary, toxic)``, as the ratio of their probabilities."""
    shared = _shared({gram for gram, _, _ in counts}, order)
    total, kinds = (Counter(), Counter()), (Counter(), Counter())
    for gram, *n in counts:
        for c in range(2):
            if n[c]:
                total[c][gram[:-1]] += n[c]
                kinds[c][gram[:-1]] += 1

    def rest(c: int, context: str) -> float:
        return 0.75 * kinds[c][context] / total[c][context] if total[c][context] else 1.0

    contexts = {
        h: math.log(rest(1, h)) - math.log(rest(0, h)) for h in {gram[:-1] for gram, _, _ in counts}
    }
    grams = {}
    for gram, *n in counts:
        h, lower = gram[:-1], shared[gram[1:]]
        p = [(max(n[c] - 0.75, 0) / total[c][h] if total[c][h] else 0) + rest(c, h) * lower for c in range(2)]
        grams[gram] = math.log(p[1] / p[0])
    return Ratios(order, grams, contexts)
