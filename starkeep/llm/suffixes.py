"""Enhanced suffix arrays of many short sequences at once, and their branching tandem repeats.

Sequences lie one behind the other; no suffix runs beyond its own sequence. Everything is done on whole
arrays: ranks by prefix doubling, in which only suffixes that still tie are sorted again; longest
common prefixes by descending the ranks of every doubling; the intervals of the prefix array by
previous and next smaller values over a pyramid of minima. No tree is built.
"""

import numpy as np


class SuffixArray:
    """``order`` (suffixes by rank), ``rank`` (its inverse) and ``lcp``.

    ``symbols`` are integers; those of different sequences must differ. ``starts`` and ``stops`` hold for
    each place the bounds of its sequence. ``lcp[p]`` counts the symbols shared by the suffixes of
    ranks p-1 and p. Memory: four bytes a symbol and doubling, of which there are as many as the longest repeat has binary digits.
    """

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, stops: np.ndarray):
        self.symbols, self.starts, self.stops = symbols, starts, stops
        levels = self._sort()
        self.lcp = self._prefixes(levels)

    def _sort(self) -> list[np.ndarray]:
        """Sets order and rank; returns the ranks by the first 1, 2, 4... symbols."""
        n = len(self.symbols)
        order = np.argsort(self.symbols)
        found = self.symbols[order]
        slots = np.arange(n)
        rank = np.empty(n, np.int32)
        levels = []
        suffixes, head, width = order, _heads(found), 1
        while True:
            rank[suffixes] = np.maximum.accumulate(np.where(head, slots, 0))
            levels.append(rank.copy())
            slots = slots[~(head & np.append(head[1:], True))]
            if not len(slots):
                break
            suffixes = order[slots]
            after = suffixes + width
            inside = after < self.stops[suffixes]
            second = np.where(inside, rank[np.minimum(after, n - 1)] + 1, 0)
            keys = rank[suffixes].astype(np.int64) * (n + 1) + second
            by = np.argsort(keys)
            suffixes = order[slots] = suffixes[by]
            head = _heads(keys[by])
            width *= 2
        self.order, self.rank = order, rank
        return levels

    def _prefixes(self, levels: list[np.ndarray]) -> np.ndarray:
        n, order, stops = len(self.symbols), self.order, self.stops
        lcp = np.zeros(n, np.int64)
        pairs, alike = np.arange(1, n), []
        for ranks in levels:
            pairs = pairs[ranks[order[pairs]] == ranks[order[pairs - 1]]]
            alike.append(pairs)
        for k in reversed(range(len(levels))):
            pairs, ranks = alike[k], levels[k]
            a, b = order[pairs - 1] + lcp[pairs], order[pairs] + lcp[pairs]
            inside = (a < stops[order[pairs]]) & (b < stops[order[pairs]])
            pairs, a, b = pairs[inside], a[inside], b[inside]
            lcp[pairs[ranks[a] == ranks[b]]] += 1 << k
        return lcp

    def intervals(self, places: np.ndarray):
        """The intervals of the prefix array that have their depth at one of ``places`` (``lcp`` above zero there).

        Returns ``(left, right, depth, place, group)``: suffixes of ranks left to right-1 share
        depth symbols; ``place`` lists the ranks at which their children meet, ``group`` the interval of each.
        """
        depth = self.lcp[places]
        left = previous_smaller(self.lcp, places)
        by = np.argsort(left * (int(depth.max(initial=0)) + 1) + depth, kind="stable")
        places, depth, left = places[by], depth[by], left[by]
        head = _heads(left) | _heads(depth)
        last = np.flatnonzero(np.append(head[1:], True)) if len(head) else np.zeros(0, np.int64)
        right = len(self.lcp) - previous_smaller(np.append(0, self.lcp[::-1]), len(self.lcp) - places[last])
        return left[head], right, depth[head], places, np.cumsum(head) - 1

    def tandems(self, copies: int = 2):
        """Starts and depths of branching tandem repeats that ``copies - 2`` equal words stand before.

        A repeat ``ww`` branches if another symbol than ``w``'s first follows. Its two suffixes lie in
        different children of the interval of depth ``|w|``, so one of them in a child that is not
        the largest: suffixes of the smaller children alone are looked at, and for each the rank of the suffix
        ``depth`` further and of that ``depth`` before. Repeats may be listed twice.
        """
        room = (self.stops - self.starts)[self.order]
        places = np.flatnonzero((self.lcp > 0) & (copies * self.lcp <= room))
        left, right, depth, places, group = self.intervals(places)
        enough = right - left >= copies
        keep = enough[group]
        left, right, depth = left[enough], right[enough], depth[enough]
        places, group = places[keep], (np.cumsum(enough) - 1)[group[keep]]

        # an interval whose children meet at k places has k + 1 of them
        row = np.arange(len(places)) + group
        first = np.empty(len(places) + len(left), np.int64)
        last = np.empty_like(first)
        owner = np.empty_like(first)
        heads = np.flatnonzero(_heads(group)) + np.arange(len(left))
        tails = np.append(heads[1:], len(first)) - 1 if len(left) else heads
        first[heads], first[row + 1] = left, places
        last[tails], last[row] = right, places
        owner[row + 1], owner[heads] = group, np.arange(len(left))
        sizes = last - first
        largest = np.maximum.reduceat(sizes, heads)[owner] if len(left) else sizes
        candidates = np.flatnonzero(sizes == largest)
        biggest = candidates[_heads(owner[candidates])]
        smaller = np.ones(len(first), bool)
        smaller[biggest] = False
        first, last, owner, sizes = first[smaller], last[smaller], owner[smaller], sizes[smaller]

        child = np.repeat(np.arange(len(first)), sizes)
        slot = np.arange(len(child)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + first[child]
        here, d = self.order[slot], depth[owner[child]]

        def member(at, of):
            """Whether the suffix stands within its sequence and in the interval, and its rank."""
            base = here[of]
            inside = (at >= self.starts[base]) & (at < self.stops[base])
            ranks = self.rank[np.clip(at, 0, len(self.rank) - 1)]
            rows = owner[child[of]]
            return inside & (ranks >= left[rows]) & (ranks < right[rows]), ranks

        starts, depths = [], []
        every = np.arange(len(child))
        for step in (0, -1):
            other = here + (d if step == 0 else -d)
            fine, ranks = member(other, every)
            fine &= (ranks < first[child]) | (ranks >= last[child])
            of = every[fine]
            at = here[of] + step * d[of]
            for k in range(1, copies - 1):
                fine, _ = member(at - k * d[of], of)
                of, at = of[fine], at[fine]
            starts.append(at)
            depths.append(d[of])
        return np.concatenate(starts), np.concatenate(depths)


def _heads(values: np.ndarray) -> np.ndarray:
    """True where a value differs from the one before."""
    head = np.ones(len(values), bool)
    head[1:] = values[1:] != values[:-1]
    return head


def previous_smaller(values: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each place the nearest place before it with a smaller value; ``values[0]`` must be smaller than all asked for."""
    wanted = values[places]
    minima = [values]
    while len(minima[-1]) > 1:
        row = minima[-1]
        row = np.append(row, row[-1:]) if len(row) % 2 else row
        minima.append(np.minimum(row[::2], row[1::2]))
    out = np.empty(len(places), np.int64)
    climbing, node = np.arange(len(places)), places.copy()
    found = []
    for row in minima:
        hit = (node & 1 == 1) & (row[np.maximum(node - 1, 0)] < wanted[climbing])
        found.append((climbing[hit], node[hit] - 1))
        climbing, node = climbing[~hit], node[~hit] >> 1
        if not len(climbing):
            break
    which, node = found.pop()
    while found:
        row = minima[len(found) - 1]
        node = 2 * node + 1
        node -= ~((node < len(row)) & (row[np.minimum(node, len(row) - 1)] < wanted[which]))
        more, at = found.pop()
        which, node = np.concatenate((which, more)), np.concatenate((node, at))
    out[which] = node
    return out


def periodic_stretches(symbols: np.ndarray, starts: np.ndarray, stops: np.ndarray, copies: int, least: int):
    """``(start, length, period)`` of the maximal stretches with at least ``copies`` periods and ``least`` symbols.

    ``period`` is the smallest one. Of the tandem repeats that end at one place the shortest is turned
    to the left, symbol by symbol as it were, as far as it goes; longer ones within that stretch are
    multiples of its period and belong to it. Ordered by start, then period.
    """
    none = np.zeros(0, np.int64)
    if not len(symbols):
        return none, none, none
    at, period = SuffixArray(symbols, starts, stops).tandems(copies)
    end = at + 2 * period
    by = np.lexsort((period, end))
    end, period = end[by], period[by]
    out = []
    while len(end):
        head = np.flatnonzero(_heads(end))
        group = np.cumsum(_heads(end)) - 1
        reach = np.array(
            [_turned(symbols, starts[e - 1], e - 2 * q, q) for e, q in zip(end[head], period[head], strict=True)]
        )
        out.append((reach, end[head] - reach, period[head]))
        rest = end - 2 * period < reach[group]
        end, period = end[rest], period[rest]
    start, length, period = (np.concatenate(c) for c in zip(*out, strict=True)) if out else (none, none, none)
    fine = length >= np.maximum(least, copies * period)
    start, length, period = start[fine], length[fine], period[fine]
    by = np.lexsort((period, start))
    return start[by], length[by], period[by]


def _turned(symbols: np.ndarray, begin: int, at: int, period: int) -> int:
    """How far to the left a stretch with the period reaches from ``at``, not beyond ``begin``."""
    step = max(64, period)
    while at > begin:
        low = max(begin, at - step)
        differ = np.flatnonzero(symbols[low:at] != symbols[low + period : at + period])
        if len(differ):
            return int(low + differ[-1] + 1)
        at, step = low, 2 * step
    return int(begin)
