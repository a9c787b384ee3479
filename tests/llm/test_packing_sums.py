from collections import Counter
from itertools import combinations_with_replacement

import numpy as np

from lambi.llm import packing


def complements(count, gap):
    """All of one, two or three available lengths of sum `gap`, longest parts first."""
    have = [int(x) for x in np.flatnonzero(count)]
    for k in (1, 2, 3):
        fits = [c for c in combinations_with_replacement(have, k) if sum(c) == gap and all(count[x] >= n for x, n in Counter(c).items())]
        yield from sorted((tuple(sorted(c, reverse=True)) for c in fits), reverse=True)


def test_sums_find_the_longest_parts_while_counts_fall():
    rng = np.random.default_rng(4)
    for _ in range(60):
        size = int(rng.integers(6, 40))
        count = np.zeros(size + 1, np.int64)
        for x in rng.integers(1, size + 1, int(rng.integers(1, 12))):
            count[x] += int(rng.integers(1, 4))
        sums = packing._Sums(count)
        while count.any():
            for gap in rng.permutation(np.arange(1, size + 1)).tolist():
                assert sums.find(gap) == next(complements(count, gap), None)
            count[rng.choice(np.flatnonzero(count))] -= 1


def test_exact_fill_leaves_no_combination():
    rng = np.random.default_rng(5)
    for _ in range(60):
        size = int(rng.integers(6, 40))
        count = np.zeros(size + 1, np.int64)
        for x in rng.integers(1, size + 1, int(rng.integers(1, 14))):
            count[x] += int(rng.integers(1, 4))
        before = count.copy()
        used = np.zeros(size + 1, np.int64)
        for parts, times in packing._exact(count, size):
            assert sum(parts) == size and len(parts) <= 4 and times > 0
            for x in parts:
                used[x] += times
        assert (used + count == before).all() and (count >= 0).all()
        for lead in np.flatnonzero(count).tolist():
            count[lead] -= 1
            assert lead < size and next(complements(count, size - lead), None) is None
            count[lead] += 1
