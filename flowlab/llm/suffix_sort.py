"""Suffix sorting by prefix polynomial hashes.

The hash of any substring follows from two prefix hashes, so the longest common extension of two
suffixes is found by binary search over its length, and a comparison takes a logarithmic number
of steps. A mergesort with that comparison sorts many buckets of suffixes at once: in each pass
every suffix finds its place in the run beside its own by binary search. The bytes of neighbours
in the result are compared at last; a bucket that a hash collision put out of order is sorted
again by its bytes."""

from __future__ import annotations

import numpy as np

#: The base of the polynomial (odd, so it has an inverse modulo 2^64) and its inverse.
BASE = 0xD1342543DE82EF95
#: Bytes hashed at a time, and suffix pairs whose bytes are compared at a time.
BLOCK, PAIRS = 1 << 16, 1 << 13
_POWERS: dict[int, np.ndarray] = {}


def _powers(base: int, n: int) -> np.ndarray:
    """The powers 0 to ``n`` - 1 of ``base``, at least; kept for the next call."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(1 << max(n - 1, 1).bit_length(), np.uint64(base))
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        _POWERS[base] = have
    return have


class PrefixHashes:
    """Hashes of all substrings of ``text`` (bytes as uint8), modulo 2^64."""

    def __init__(self, text: np.ndarray, base: int = BASE):
        self.text, n = text, len(text)
        self.sums = np.zeros(n + 1, np.uint64)
        power = _powers(base, BLOCK)[:BLOCK]
        for i in range(0, n, BLOCK):
            part = text[i:i + BLOCK].astype(np.uint64)
            part += np.uint64(1)
            part *= power[:len(part)]
            if i:
                part *= np.uint64(pow(base, i, 1 << 64))
                part[:1] += self.sums[i:i + 1]
            np.cumsum(part, out=self.sums[i + 1:i + 1 + len(part)])
        self.unpower = _powers(pow(base, -1, 1 << 64), n + 1)

    def of(self, start: np.ndarray, length) -> np.ndarray:
        """Hash of ``length`` bytes from each of ``start``."""
        return (self.sums[start + length] - self.sums[start]) * self.unpower[start]

    def windows(self, length: int) -> np.ndarray:
        """Hash of every substring of ``length`` bytes, in order, mixed so that any order of the
        hashes is as good as random."""
        n = len(self.text) - length + 1
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mixed((self.sums[length:] - self.sums[:-length]) * self.unpower[:n])

    def common(self, i: np.ndarray, j: np.ndarray, limit: int) -> np.ndarray:
        """Longest common extension of the suffixes at ``i`` and ``j``, at most ``limit``."""
        same = np.zeros(len(i), np.int64)
        base_i, base_j, un_i, un_j = self.sums[i], self.sums[j], self.unpower[i], self.unpower[j]
        step = 1 << (limit.bit_length() - 1)
        while step:
            to = same + step
            fits = to <= limit
            to = np.minimum(to, limit)
            equal = (self.sums[i + to] - base_i) * un_i == (self.sums[j + to] - base_j) * un_j
            same = np.where(fits & equal, to, same)
            step >>= 1
        return same

    def less(self, i: np.ndarray, j: np.ndarray, limit: int, or_equal: np.ndarray) -> np.ndarray:
        """Whether the suffix at ``i`` sorts before that at ``j`` (or, where asked, equals it in
        ``limit`` bytes)."""
        same = self.common(i, j, limit)
        whole = same == limit
        at = np.minimum(same, limit - 1)
        return np.where(whole, or_equal, self.text[i + at] < self.text[j + at])


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _ordered(text: np.ndarray, i: np.ndarray, j: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Of pairs of suffixes: whether they are equal in ``length`` bytes, and whether the first is
    not greater, byte by byte."""
    view = np.lib.stride_tricks.sliding_window_view(text, length)
    equal, fine = np.zeros(len(i), bool), np.zeros(len(i), bool)
    for k in range(0, len(i), PAIRS):
        x, y = view[i[k:k + PAIRS]], view[j[k:k + PAIRS]]
        other = x != y
        first, at = other.argmax(axis=1), np.arange(len(x))
        equal[k:k + PAIRS] = e = ~other[at, first]
        fine[k:k + PAIRS] = e | (x[at, first] < y[at, first])
    return equal, fine


def sort_buckets(hashes: PrefixHashes, start: np.ndarray, bucket: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes at ``start``, sorted by their first ``length`` bytes inside each bucket, equal ones
    in the order given; ``bucket`` is ascending. Returns (order, whether each suffix in that order
    equals the one before it in its bucket)."""
    n = len(start)
    order = np.arange(n)
    if not n:
        return order, np.zeros(0, bool)
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
    begin = np.repeat(first, np.diff(np.append(first, n)))       # of each place's bucket
    end = np.repeat(np.append(first[1:], n), np.diff(np.append(first, n)))
    width, largest = 1, int((end - begin).max())
    place = np.arange(n)
    while width < largest:
        at = place[(end - begin) > width]                        # smaller buckets are sorted
        run = (at - begin[at]) // width
        left = run % 2 == 0
        own = begin[at] + run * width
        other = np.where(left, own + width, own - width)
        low = np.minimum(other, end[at])
        high = np.minimum(other + width, end[at])
        suffix, since = start[order[at]], low.copy()
        open_ = np.flatnonzero(low < high)
        while len(open_):                                        # how many of the other run come before
            mid = (low[open_] + high[open_]) // 2
            them, me, on_left = start[order[mid]], suffix[open_], left[open_]
            goes = hashes.less(them, me, length, ~on_left)
            low[open_] = np.where(goes, mid + 1, low[open_])
            high[open_] = np.where(goes, high[open_], mid)
            open_ = open_[low[open_] < high[open_]]
        to = np.minimum(own, np.where(left, own, other)) + (at - own) + (low - since)
        moved = order[at]
        order[to] = moved
        width *= 2
    same_bucket = np.append(False, bucket[1:] == bucket[:-1])
    pair = np.flatnonzero(same_bucket)
    sorted_start = start[order]
    equal, fine = _ordered(hashes.text, sorted_start[pair - 1], sorted_start[pair], length)
    there = np.zeros(n, bool)
    there[order] = True                                          # wrong comparisons may give two suffixes one place
    if not fine.all() or not there.all():                        # a collision: by bytes
        for b in np.unique(np.concatenate((begin[pair[~fine]], begin[~there]))).tolist():
            order[b:end[b]] = sorted(range(b, int(end[b])), key=lambda k: hashes.text[start[k]:start[k] + length].tobytes())
        sorted_start = start[order]
        equal, _ = _ordered(hashes.text, sorted_start[pair - 1], sorted_start[pair], length)
    repeats = np.zeros(n, bool)
    repeats[pair] = equal
    return order, repeats
