"""Order statistics of the slopes between all pairs of points, without listing the pairs.

A pair of points, the second later than the first, has a slope below ``s`` exactly where the rest ``y - s * t`` falls
from the first to the second. So the slopes below ``s`` are the inversions of the rests in order of time, which are
counted in n log n steps. Counts narrow a bracket around the wanted rank, first among the slopes of random pairs, then
by halving, until few enough pairs are inside to list them: those whose order differs between the bracket's ends.
"""

from __future__ import annotations

import numpy as np

#: Up to this many points all pairs are listed at once.
ALL_PAIRS = 1_000
#: Random pairs whose slopes are tried as ends of a bracket.
DRAWS = 4_096
#: Pairs that may be listed from a bracket: so many, or so many a point.
LISTED = 200_000
LISTED_EACH = 2


def _levels(rank: np.ndarray):
    """Take a permutation apart bit by bit: per bit the values so far, the bit, ones before in the group, its start.

    Values that agree in their higher bits stand together in their first order. A group of a permutation has known
    places, so every value's next place follows from running sums alone.
    """
    a = rank.astype(np.int64)
    place = np.arange(len(a))
    for b in range(max(len(a) - 1, 0).bit_length() - 1, -1, -1):
        bit = (a >> b) & 1
        start = (a >> (b + 1)) << (b + 1)
        ones = np.cumsum(bit) - bit
        ones -= ones[start]
        yield b, a, bit, ones, start
        nxt = np.empty_like(a)
        nxt[np.where(bit == 1, start + (1 << b) + ones, place - ones)] = a
        a = nxt


def inversions(rank: np.ndarray) -> int:
    """How many pairs of a permutation stand in falling order."""
    return sum(int(ones[bit == 0].sum()) for _, _, bit, ones, _ in _levels(rank))


def inverted_pairs(rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of values of a permutation in falling order: the greater, which stands first, and the smaller."""
    great, small = [], []
    for b, a, bit, ones, start in _levels(rank):
        zero = np.flatnonzero((bit == 0) & (ones > 0))
        if not len(zero):
            continue
        run = ones[zero]
        # Where the next level puts a group's ones, they stand in order: a zero meets the first ``run`` of them.
        nxt = np.empty_like(a)
        one = bit == 1
        nxt[start[one] + (1 << b) + ones[one]] = a[one]
        step = np.arange(run.sum()) - np.repeat(np.cumsum(run) - run, run)
        great.append(nxt[np.repeat(start[zero] + (1 << b), run) + step])
        small.append(np.repeat(a[zero], run))
    none = np.empty(0, np.int64)
    return (np.concatenate(great), np.concatenate(small)) if great else (none, none)


class PairSlopes:
    """Slopes of all pairs of points at different times, by rank from 0. Points come in order of time.

    Counting compares rests, so where many pairs agree but for rounding the answer is right to the rounding of
    ``y - s * t`` over the pair's time; lists and all-pairs answers are the slopes themselves.
    """

    def __init__(self, t, y, all_pairs: int = ALL_PAIRS):
        self.t, self.y = np.asarray(t, float), np.asarray(y, float)
        n = len(self.t)
        order = np.lexsort((self.y, self.t))
        self.t, self.y = self.t[order], self.y[order]
        same = np.diff(np.flatnonzero(np.diff(self.t, prepend=-np.inf, append=np.inf)))
        self.count = n * (n - 1) // 2 - int((same * (same - 1) // 2).sum())
        self.lists: list[tuple[int, np.ndarray]] = []
        self.below = {-np.inf: 0, np.inf: self.count}
        if n <= all_pairs:
            i, j = np.triu_indices(n, 1)
            dt = self.t[j] - self.t[i]
            keep = dt > 0
            self.lists.append((0, np.sort((self.y[j] - self.y[i])[keep] / dt[keep])))
        else:
            rng = np.random.default_rng(n)
            i, j = rng.integers(0, n, (2, 4 * DRAWS))
            i, j = i[self.t[i] != self.t[j]][:DRAWS], j[self.t[i] != self.t[j]][:DRAWS]
            self.draws = np.unique(np.append((self.y[j] - self.y[i]) / (self.t[j] - self.t[i]), 0.0))
        self.limit = max(LISTED, LISTED_EACH * n)

    def _order(self, s: float) -> np.ndarray:
        """Points by rest, equal rests by time; at the infinite ends by time, forth and back."""
        if np.isinf(s):
            return np.lexsort((self.y, np.sign(s) * -self.t))
        # Points of one time stand by value already, as their rests do: a stable order inverts none of them.
        return np.argsort(self.y - s * self.t, kind="stable")

    def less(self, s: float) -> int:
        """How many slopes are below ``s``."""
        if s not in self.below:
            rank = np.empty(len(self.t), np.int64)
            rank[self._order(s)] = np.arange(len(self.t))
            self.below[s] = inversions(rank)
        return self.below[s]

    def at(self, k: int) -> float:
        """The slope of rank ``k``."""
        for first, found in self.lists:
            if first <= k < first + len(found):
                return float(found[k - first])
        a, b = 0, len(self.draws)  # draws before a have at most k slopes below them, draws from b on more
        while a < b:
            m = (a + b) // 2
            a, b = (m + 1, b) if self.less(self.draws[m]) <= k else (a, m)
        lo = self.draws[a - 1] if a else -np.inf
        hi = self.draws[a] if a < len(self.draws) else np.inf
        width = 1.0 + np.ptp(self.draws)
        while self.less(hi) - self.less(lo) > self.limit:
            if np.isinf(lo) or np.isinf(hi):
                mid, width = (hi - width if np.isinf(lo) else lo + width), 2 * width
            else:
                mid = lo + (hi - lo) / 2
            if mid in (lo, hi) or np.isinf(mid):
                return float(lo if np.isfinite(lo) else hi)  # ties
            lo, hi = (mid, hi) if self.less(mid) <= k else (lo, mid)
        found = self._list(lo, hi)
        if not len(found):
            return float(lo)
        first = self.less(lo)
        self.lists.append((first, found))
        return float(found[min(k - first, len(found) - 1)])

    def _list(self, lo: float, hi: float) -> np.ndarray:
        """Slopes from ``lo`` to below ``hi`` in order: of the pairs that stand differently by the rests at both."""
        before, after = self._order(lo), self._order(hi)
        rank = np.empty(len(after), np.int64)
        rank[after] = np.arange(len(after))
        great, small = inverted_pairs(rank[before])
        i, j = after[great], after[small]
        dt = self.t[j] - self.t[i]
        return np.sort((self.y[j] - self.y[i])[dt != 0] / dt[dt != 0])
