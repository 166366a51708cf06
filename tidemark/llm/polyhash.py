"""Prefix polynomial hashes of bytes, window anchors on them, and suffixes sorted by hash-compared mergesort."""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15  # odd, so that powers have inverses mod 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n - 1) mod 2**64, kept for reuse."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, dtype=np.uint64)
        steps[0] = 1
        have = _POWERS[base] = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """H with H[i] = sum of (data[j] + 1) * base**j over j < i, mod 2**64."""
    out = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(_BASE, len(data)), out=out[1:])
    return out


def window_hashes(prefix: np.ndarray, width: int) -> np.ndarray:
    """Hash of every window of ``width`` bytes."""
    n = len(prefix) - width
    return mixed((prefix[width:] - prefix[:n]) * powers(_INVERSE, n)) if n > 0 else np.empty(0, dtype=np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Common:
    """A set of gram hashes that is quick to ask: a table by the lower bits comes before the search."""

    def __init__(self, hashes: np.ndarray):
        self.hashes, self.table = np.sort(hashes.astype(np.uint64)), np.zeros(1 << 20, dtype=bool)
        self.table[self.hashes & np.uint64((1 << 20) - 1)] = True

    def has(self, grams: np.ndarray) -> np.ndarray:
        out = self.table[grams & np.uint64((1 << 20) - 1)]
        at = np.flatnonzero(out)
        place = np.searchsorted(self.hashes, grams[at])
        out[at] = self.hashes[np.minimum(place, len(self.hashes) - 1)] == grams[at]
        return out


def anchors(grams: np.ndarray, windows: int, common: Common | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that share an anchor, the leftmost smallest of the ``windows`` gram hashes in each; common grams come after all others.

    Returns the anchor's place and the first and last window of each run. Equal windows have their anchor at the same place within.
    """
    n = len(grams) - windows + 1
    if n <= 0:
        return (np.empty(0, dtype=np.int64),) * 3
    if len(grams) >= 1 << 24:
        raise ValueError("cut longer texts into pieces that overlap by a window")
    rank = grams >> np.uint64(1)
    if common is not None and len(common.hashes):
        rank |= common.has(grams).astype(np.uint64) << np.uint64(63)
    least = (rank & ~np.uint64((1 << 24) - 1)) | np.arange(len(grams), dtype=np.uint64)
    reach = 1
    while reach * 2 <= windows:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if windows > reach:
        least = np.minimum(least[:n], least[windows - reach : windows - reach + n])
    place = (least[:n] & np.uint64((1 << 24) - 1)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    return place[first], first, np.append(first[1:], n) - 1


class Suffixes:
    """Places in a byte array, compared by their first ``width`` bytes through prefix hashes."""

    def __init__(self, data: np.ndarray, width: int):
        self.data, self.width = data, width
        self.prefix = prefix_hashes(data)
        self.inverse = powers(_INVERSE, len(self.prefix))

    def _hash(self, start: np.ndarray, length: np.ndarray) -> np.ndarray:
        return (self.prefix[start + length] - self.prefix[start]) * self.inverse[start]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair, up to ``width``: binary search over substring hashes."""
        low, high = np.zeros(len(a), dtype=np.int64), np.full(len(a), self.width, dtype=np.int64)
        for _ in range(int(self.width).bit_length()):
            half = (low + high + 1) >> 1
            same = self._hash(a, half) == self._hash(b, half)
            low, high = np.where(same, half, low), np.where(same, high, half - 1)
        return low

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix a sorts before b (or is equal to it, where asked)."""
        reach = self.common(a, b)
        equal = reach >= self.width
        step = np.minimum(reach, self.width - 1)
        return np.where(equal, or_equal, self.data[a + step] < self.data[b + step])

    def sort(self, start: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Order of the suffixes within each segment (equal, adjacent values of ``segment``): a stable bottom-up mergesort.

        All runs of a level merge at once: an element's new place is its place in its own run plus its rank in the
        other one, which a binary search with :meth:`before` finds.
        """
        n = len(start)
        heads = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1]])) if n else np.empty(0, dtype=np.int64)
        sizes = np.diff(np.append(heads, n))
        first, size = np.repeat(heads, sizes), np.repeat(sizes, sizes)
        order, run = np.arange(n), 1
        while n and run < sizes.max():
            active = np.flatnonzero(size > run)
            local = active - first[active]
            left = (local // run) % 2 == 0
            own = local // run * run  # start of the element's run
            other = np.where(left, own + run, own - run)
            low = np.minimum(other, size[active])
            high = np.minimum(other + run, size[active])
            base, item = low.copy(), start[order[active]]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) >> 1
                there = start[order[first[active[open_]] + mid]]
                # equal ones of the left run stay in front
                passed = self.before(there, item[open_], ~left[open_])
                low[open_], high[open_] = np.where(passed, mid + 1, low[open_]), np.where(passed, high[open_], mid)
            place = np.minimum(own, other) + (local - own) + (low - base)
            moved = order.copy()
            moved[first[active] + place] = order[active]
            order, run = moved, run * 2
        return order

    def verified(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the first ``width`` bytes of each pair are the same, byte by byte."""
        same = np.ones(len(a), dtype=bool)
        for at in range(0, len(a), 1 << 13):
            x, y, reach = a[at : at + (1 << 13)], b[at : at + (1 << 13)], np.arange(self.width)
            same[at : at + (1 << 13)] = (self.data[x[:, None] + reach] == self.data[y[:, None] + reach]).all(axis=1)
        return same
