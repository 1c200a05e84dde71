"""When two sets are linked, and components of links in memory."""

from __future__ import annotations

#: Links from this Jaccard similarity on, in hundredths.
PERCENT = 75


def least_overlap(n: int) -> int:
    """Fewest shingles a set of ``n`` shares with any set it links to."""
    return -(-PERCENT * n // 100)


def needed(n, m):
    """Fewest shared shingles with which sets of ``n`` and ``m`` link."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


class DisjointSets:
    def __init__(self, n: int):
        self.up = list(range(n))

    def top(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.top(i), self.top(j)
        self.up[max(i, j)] = min(i, j)
