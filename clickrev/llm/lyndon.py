"""Runs of a sequence, from Lyndon roots.

``lyndon_lengths`` is the first phase of Baier's suffix sorter: suffixes lie in groups of
one common prefix each, in lexicographic order; groups are taken from the greatest down, and
the positions just before a group's members move to new groups whose prefix is longer by as
many copies of the group's prefix as stand behind them. When a group's turn comes its prefix
is the longest Lyndon word that starts at its members. This needs no suffix array.

A run's Lyndon root, under the order in which the sign after the run is the smaller one, is
such a longest Lyndon word. So the roots of both orders, extended to the left and to the
right by longest common extensions, give every run.
"""
import numpy as np

# Odd multiplier of the polynomial hash; extensions found by it are compared sign by sign.
_BASE = np.uint64(0xD6E8FEB86659FD93)


def lyndon_lengths(ranks: list[int]) -> list[int]:
    """Length of the longest Lyndon word that starts at each position, under the ranks' order.

    Linear time. A rank that is smaller than all others and stands alone between two parts
    keeps these apart: no Lyndon word starts before it and ends behind it.
    """
    n = len(ranks)
    members: list[list[int]] = []  # of each group, ascending; some may have moved since
    by_rank: dict[int, int] = {}
    group_of = []
    for place, rank in enumerate(ranks):
        group = by_rank.get(rank)
        if group is None:
            group = by_rank[rank] = len(members)
            members.append([])
        members[group].append(place)
        group_of.append(group)
    prefix = [1] * len(members)
    below, above = [-1] * len(members), [-1] * len(members)
    group = -1
    for rank in sorted(by_rank):
        lower, group = group, by_rank[rank]
        below[group] = lower
        if lower >= 0:
            above[lower] = group
    left = list(range(-1, n - 1))  # nearest position to the left whose group is not final
    lengths = [0] * n
    right = list(range(1, n + 1))
    while group >= 0:
        length = prefix[group]
        copies: dict[int, int] = {}  # by position before members: how many stand behind it
        for place in members[group]:
            if group_of[place] != group:
                continue
            lengths[place] = length
            before, after = left[place], right[place]
            if after < n:
                left[after] = before
            if before >= 0:
                right[before] = after
                copies[before] = copies.get(before, 0) + 1
        split: dict[tuple[int, int], list[int]] = {}
        for before, count in copies.items():
            split.setdefault((count, group_of[before]), []).append(before)
        heads: dict[int, int] = {}
        for count, old in sorted(split):  # more copies go further up
            moved = split[count, old]
            new, lower = len(members), heads.get(old, old)
            upper = above[lower]
            members.append(moved)
            prefix.append(prefix[old] + count * length)
            below.append(lower)
            above.append(upper)
            above[lower] = below[upper] = heads[old] = new
            for before in moved:
                group_of[before] = new
        group = below[group]
    return lengths


class Extensions:
    """Longest common extensions of a sequence of ids, many at a time.

    Hashes of all prefixes find them by binary search. Equal stretches always have equal
    hashes, so an extension is never too short; ``runs`` compares what it keeps.
    """

    def __init__(self, ids: np.ndarray) -> None:
        n = len(ids)
        self._n = n
        self._powers = np.ones(n + 1, np.uint64)
        np.cumprod(np.full(n, _BASE), out=self._powers[1:])
        values = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        values ^= values >> np.uint64(29)
        self._sums = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self._powers[:n], out=self._sums[1:])

    def _equal(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether the stretches from a < b are alike."""
        left = (self._sums[a + length] - self._sums[a]) * self._powers[b - a]
        return left == self._sums[b + length] - self._sums[b]

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common prefix from positions a < b."""
        low, high = np.zeros(len(a), np.int64), self._n - b
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = self._equal(a, b, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the longest common suffix that ends before positions a < b."""
        low, high = np.zeros(len(a), np.int64), a.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = self._equal(a - middle, b - middle, middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low


def runs(ids: np.ndarray, least: int = 2, times: int = 2) -> np.ndarray:
    """``start, length, period`` of every run of at least ``least`` signs and ``times`` periods.

    ``ids`` are numbers from 0 on. A negative id belongs to no run and ends those beside it.
    ``times`` is at least 2. Rows are in the order of start, then period.
    """
    n = len(ids)
    if n == 0:
        return np.empty((0, 3), np.int64)
    apart = ids < 0
    # signs that end runs are all different, so that no extension crosses one
    distinct = np.where(apart, np.cumsum(apart) + int(ids.max(initial=0)), ids)
    extensions = Extensions(distinct)
    found = []
    places = np.arange(n)
    for order in (ids, np.where(apart, -1, int(ids.max(initial=0)) - ids)):
        periods = np.array(lyndon_lengths(np.where(apart, -1, order).tolist()), np.int64)
        roots = np.flatnonzero(~apart & (places + periods < n + 1))
        a, p = places[roots], periods[roots]
        ahead = extensions.forward(a, a + p)
        behind = extensions.backward(a, a + p)
        length = behind + p + ahead
        keep = (length >= least) & (length >= times * p)
        found.append(np.stack([(a - behind)[keep], length[keep], p[keep]], axis=1))
    table = np.unique(np.concatenate(found)[:, [0, 2, 1]], axis=0)[:, [0, 2, 1]]
    exact = [_exact(distinct, *map(int, row)) for row in table]
    if all(exact):
        return table
    kept = {_grown(distinct, *map(int, row)) for row, fine in zip(table, exact, strict=True) if not fine}
    kept = {row for row in kept if row[1] >= max(least, times * row[2])}
    kept |= {tuple(map(int, row)) for row, fine in zip(table, exact, strict=True) if fine}
    return np.array(sorted(kept, key=lambda row: (row[0], row[2])), np.int64).reshape(-1, 3)


def _exact(ids: np.ndarray, start: int, length: int, period: int) -> bool:
    return bool((ids[start : start + length - period] == ids[start + period : start + length]).all())


def _grown(ids: np.ndarray, start: int, length: int, period: int) -> tuple[int, int, int]:
    """The longest true part of a stretch whose hashes agreed by chance."""
    same = ids[start : start + length - period] == ids[start + period : start + length]
    breaks = np.concatenate([[-1], np.flatnonzero(~same), [len(same)]])
    widths = np.diff(breaks) - 1
    k = int(widths.argmax())
    return start + int(breaks[k]) + 1, int(widths[k]) + period, period
