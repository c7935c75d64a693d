"""Suffix sort whose comparisons are logarithmic: common prefixes by bisection over hashes."""

from __future__ import annotations

import numpy as np

from footfall.llm.words import powers, prefix_hashes

PREFIX = 16  # bytes by which suffixes are put in first groups


class Suffixes:
    """Suffixes of a byte array at given starts, compared on at most ``depth`` bytes.

    ``groups`` are numbers by rising start; suffixes of different groups are never equal,
    and all those compared must have ``depth`` bytes.
    """

    def __init__(self, data: np.ndarray, depth: int) -> None:
        self.data, self.depth = data, depth
        self.prefix = prefix_hashes(data)
        self.powers = powers(len(data) + 1)[0]

    def common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes p and q, by bisection over prefix hashes."""
        found = np.full(len(p), self.depth)
        hp, hq, wp, wq = self.prefix[p], self.prefix[q], self.powers[p], self.powers[q]
        # Most suffixes compared are equal to the full depth.
        whole = (self.prefix[p + self.depth] - hp) * wq == (self.prefix[q + self.depth] - hq) * wp
        rest = np.flatnonzero(~whole)
        if not len(rest):
            return found
        p, q, hp, hq, wp, wq = (x[rest] for x in (p, q, hp, hq, wp, wq))
        length = np.zeros(len(rest), np.int64)
        step = 1 << (self.depth.bit_length() - 1)
        while step:
            longer = np.minimum(length + step, self.depth)
            same = (self.prefix[p + longer] - hp) * wq == (self.prefix[q + longer] - hq) * wp
            length = np.where(same, longer, length)
            step >>= 1
        found[rest] = length
        return found

    def less(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether suffix p comes before q; equal ones go by place."""
        length = self.common(p, q)
        ends = np.minimum(length, self.depth - 1)
        return np.where(length < self.depth, self.data[p + ends] < self.data[q + ends], p < q)

    def sorted(self, starts: np.ndarray, groups: np.ndarray) -> np.ndarray:
        """Order of the suffixes, by group and then by bytes."""
        words = [self._word(starts + k) for k in range(0, PREFIX, 8)]
        order = np.lexsort((*words[::-1], groups))
        first = np.ones(len(order), bool)
        if len(order):
            keys = np.stack([groups.astype(np.uint64), *words])[:, order]
            first[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
        heads = np.flatnonzero(first)
        return self._merge(starts, order, heads)

    def _word(self, at: np.ndarray) -> np.ndarray:
        """Eight bytes as one number that orders like them."""
        out = np.zeros(len(at), np.uint64)
        for k in range(8):
            out = (out << np.uint64(8)) | self.data[at + k]
        return out

    def _merge(self, starts: np.ndarray, order: np.ndarray, heads: np.ndarray) -> np.ndarray:
        """Mergesort inside each group of ties, all groups and all merges of a level at once."""
        n = len(order)
        sizes = np.diff(np.append(heads, n))
        base = np.repeat(heads, sizes)
        ends = base + np.repeat(sizes, sizes)
        place = np.arange(n)
        width = 1
        while width < (sizes.max() if len(sizes) else 0):
            # Only groups that still have two runs to merge.
            at = place[ends - base > width]
            run = (at - base[at]) // width
            low = base[at] + (run ^ 1) * width
            high = np.minimum(low + width, ends[at])
            low = np.minimum(low, high)
            other = low.copy()
            mine = starts[order[at]]
            while True:
                live = np.flatnonzero(low < high)
                if not len(live):
                    break
                middle = (low[live] + high[live]) // 2
                before = self.less(starts[order[middle]], mine[live])
                low[live[before]] = middle[before] + 1
                high[live[~before]] = middle[~before]
            # Run heads of both, own rank in the run, and how many of the other come first.
            pair = base[at] + (run // 2) * 2 * width
            own = (at - base[at]) % width
            target = pair + own + (low - other)
            order[target] = order[at]  # the same places, filled anew
            width *= 2
        return order


def verified(data: np.ndarray, p: np.ndarray, q: np.ndarray, depth: int) -> np.ndarray:
    """Whether ``depth`` bytes at p and q are equal, byte by byte, for pairs equal by hash.

    Of pairs that lie one byte after another pair, only the last byte is new.
    """
    if not len(p):
        return np.zeros(0, bool)
    order = np.lexsort((p, q - p))
    p, q = p[order], q[order]
    follows = np.zeros(len(p), bool)
    follows[1:] = (p[1:] == p[:-1] + 1) & (q[1:] == q[:-1] + 1)
    good = data[p + depth - 1] == data[q + depth - 1]
    heads = np.flatnonzero(~follows)
    for part in np.array_split(heads, max(1, len(heads) // 4096)):
        steps = np.arange(depth)
        good[part] &= (data[p[part][:, None] + steps] == data[q[part][:, None] + steps]).all(axis=1)
    # A pair stands if its chain stands up to it.
    chain = np.cumsum(~follows)
    bad = np.cumsum(~good)
    before = np.concatenate([[0], bad])[heads][chain - 1]
    out = np.empty(len(p), bool)
    out[order] = bad == before
    return out
