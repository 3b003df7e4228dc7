"""Patience alignment of two sequences of hashable items."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Sequence


def longest_increasing(values: Sequence[int]) -> list[int]:
    """Places of a longest increasing subsequence of distinct values, by patience piles."""
    tops: list[int] = []
    at: list[int] = []
    before = [-1] * len(values)
    for i, v in enumerate(values):
        pile = bisect_left(tops, v)
        before[i] = at[pile - 1] if pile else -1
        if pile == len(tops):
            tops.append(v)
            at.append(i)
        else:
            tops[pile], at[pile] = v, i
    found, i = [], at[-1] if at else -1
    while i >= 0:
        found.append(i)
        i = before[i]
    return found[::-1]


def align(a: Sequence, b: Sequence) -> list[tuple[int, int]]:
    """Matched places (i, j), both increasing.

    Items that occur once in either sequence and are equal anchor the alignment along
    their longest increasing run; equal items next to anchors or at the ends join it,
    and the gaps between are aligned in the same way.
    """
    found: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        a0, a1, b0, b1 = todo.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            found.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            found.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = Counter(a[a0:a1]), Counter(b[b0:b1])
        once_b = {x: j for j, x in enumerate(b[b0:b1], b0) if in_b[x] == 1}
        pairs = [(i, once_b[x]) for i, x in enumerate(a[a0:a1], a0) if in_a[x] == 1 and x in once_b]
        anchors = [pairs[i] for i in longest_increasing([j for _, j in pairs])]
        if not anchors:
            continue
        found += anchors
        ends = [(a0 - 1, b0 - 1), *anchors, (a1, b1)]
        todo += [(p[0] + 1, q[0], p[1] + 1, q[1]) for p, q in zip(ends, ends[1:])]
    return sorted(found)
