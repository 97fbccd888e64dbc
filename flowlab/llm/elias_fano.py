"""Elias-Fano lists: sorted integers in about 2 + log2(universe / n) bits each, searched by
array operations over many queries at once. The arrays may lie in a mapped file."""

from __future__ import annotations

import numpy as np

_U = np.uint64


def _split(values: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """``values`` of so many bits in as many whole bytes as hold them, in two arrays where no integer type has that
    size: their low and their other bytes. One spare place, so that a search may look behind the last."""
    size = next(b for b in (8, 16, 24, 32, 48, 64) if b >= bits)
    first = 16 if size == 24 else 32 if size == 48 else size
    values = np.append(values, _U(0))
    low = (values & _U((1 << first) - 1)).astype(f"<u{first // 8}")
    return low, (values >> _U(first)).astype(f"<u{(size - first) // 8}") if size > first else np.zeros(0, np.uint8)


# place of the one bit number r (from 0) of each byte, and the ones of the bytes of a word before each byte
_IN_BYTE = np.zeros((256, 8), np.uint8)
for _b in range(256):
    _at = [i for i in range(8) if _b >> i & 1]
    _IN_BYTE[_b, :len(_at)] = _at
_IN_BYTE = _IN_BYTE.ravel()
_ONES = _U(0x0101010101010101)


def _select_in_word(word: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """Position of the one bit number ``rank`` (from 0) of each word."""
    pairs = word - ((word >> _U(1)) & _U(0x5555555555555555))
    fours = (pairs & _U(0x3333333333333333)) + ((pairs >> _U(2)) & _U(0x3333333333333333))
    upto = ((fours + (fours >> _U(4))) & _U(0x0F0F0F0F0F0F0F0F)) * _ONES       # ones up to and with each byte
    rank = rank.astype(_U)
    # a byte's high bit stays set where its ones up to there are more than rank
    more = ((upto | _U(0x8080808080808080)) - (rank + _U(1)) * _ONES) & _U(0x8080808080808080)
    shift = (_U(8) - np.bitwise_count(more).astype(_U)) << _U(3)
    before = ((upto << _U(8)) >> shift) & _U(0xFF)
    return (shift + _IN_BYTE[(((word >> shift) & _U(0xFF)) << _U(3)) + (rank - before)]).astype(np.int64)


#: The arrays of a list.
PARTS = ("low", "more", "upper", "ones", "zeros", "meta")


class EliasFano:
    """``arrays``: low and more (the low bits of each value, see :func:`_split`), upper, ones and zeros (bits set,
    and not set, before each word of upper) and meta (n, low bits)."""

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        # plain views: a slice of a mapped array costs more than what is read
        self.low, self.more, self.upper, self.ones, self.zeros = (np.asarray(arrays[k]) for k in PARTS[:-1])
        self.n, self.bits = int(arrays["meta"][0]), int(arrays["meta"][1])

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        """``values``: ascending (repeats allowed), unsigned."""
        values = np.asarray(values, _U)
        n = len(values)
        top = int(values[-1]) if n else 0
        bits = max(0, (top // n).bit_length() - 1) if n else 0
        high = (values >> _U(bits)).astype(np.int64)
        upper = np.zeros((int(high[-1]) if n else 0) // 64 + n // 64 + 3, _U)
        at = high + np.arange(n)
        np.bitwise_or.at(upper, at >> 6, _U(1) << (at & 63).astype(_U))
        ones = np.concatenate(([0], np.cumsum(np.bitwise_count(upper).astype(np.int64))))[:-1]
        low, more = _split(values & _U((1 << bits) - 1), bits)
        return cls({"low": low, "more": more, "upper": upper, "ones": ones,
                    "zeros": np.arange(len(ones), dtype=np.int64) * 64 - ones, "meta": np.array([n, bits], np.int64)})

    def _select(self, k: np.ndarray, ones: bool) -> np.ndarray:
        before = self.ones if ones else self.zeros
        word = np.searchsorted(before, k, side="right") - 1
        bits = self.upper[word]
        return word * 64 + _select_in_word(bits if ones else ~bits, k - before[word])

    def _low(self, index: np.ndarray) -> np.ndarray:
        out = self.low.take(index).astype(_U)
        if len(self.more):
            out |= self.more.take(index).astype(_U) << _U(self.low.itemsize * 8)
        return out

    def _run(self, at: np.ndarray, high: np.ndarray) -> np.ndarray:
        """How many bits are set from place ``at`` of upper on, behind ``high`` zeros."""
        ends = ~self.upper.take(at >> 6) >> (at & 63).astype(_U)
        run = np.bitwise_count(ends ^ (ends - _U(1))).astype(np.int64) - 1          # up to the next zero
        beyond = np.flatnonzero(ends == 0)
        if len(beyond):
            run[beyond] = self._select(high[beyond], False) - at[beyond]
        return run

    def get(self, index: np.ndarray) -> np.ndarray:
        """The values at ``index``."""
        index = np.asarray(index, np.int64)
        if not len(index):
            return np.zeros(0, _U)
        high = (self._select(index, True) - index).astype(_U)
        return (high << _U(self.bits)) | self._low(index)

    def get_next(self, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The values at ``index`` and at the places behind them."""
        index = np.asarray(index, np.int64)
        if not len(index):
            return np.zeros(0, _U), np.zeros(0, _U)
        at = self._select(index, True)
        # the next bit that is set: mostly in the same word
        left = (self.upper.take(at >> 6) >> (at & 63).astype(_U)) & ~_U(1)
        other = at + np.bitwise_count(left ^ (left - _U(1))).astype(np.int64) - 1
        beyond = np.flatnonzero(left == 0)
        if len(beyond):
            other[beyond] = self._select(index[beyond] + 1, True)
        return tuple(((place - i).astype(_U) << _U(self.bits)) | self._low(i) for place, i in ((at, index), (other, index + 1)))

    def find(self, targets: np.ndarray) -> np.ndarray:
        """Index of each target in the list (ascending, without repeats), or -1."""
        targets = np.asarray(targets, _U)
        out = np.full(len(targets), -1, np.int64)
        if not self.n or not len(targets):
            return out
        high = targets >> _U(self.bits)
        inside = np.flatnonzero(high <= _U(len(self.ones) * 64 - self.n - 2))
        high = high[inside].view(np.int64)
        at = np.zeros(len(high), np.int64)
        later = np.flatnonzero(high)
        at[later] = self._select(high[later] - 1, False) + 1
        run = self._run(at, high)
        some = np.flatnonzero(run)                             # their bucket has values
        inside, left = inside[some], (at - high)[some]
        end, t = left + run[some], targets[inside] & _U((1 << self.bits) - 1)
        right, asked = end, np.arange(len(t))
        place = left.copy()
        while len(asked):                                      # successor search inside the bucket
            middle = (left + right) >> 1
            less = (self._low(middle) < t[asked]) & (middle < right)
            left, right = np.where(less, middle + 1, left), np.where(less, right, middle)
            more = left < right
            if 4 * np.count_nonzero(more) < 3 * len(more):
                place[asked] = left
                asked, left, right = asked[more], left[more], right[more]
        hit = (self._low(place) == t) & (place < end)
        out[inside[hit]] = place[hit]
        return out
