"""Token ids of whole texts through a cache of the texts' chunks.

A tokenizer whose tokens never span certain places can encode the chunks between them one by
one, and most chunks of a corpus repeat. Chunks are cut and told apart on Arrow arrays; Python
touches each distinct chunk of a slice once. ``ChunkIds`` keeps the ids of the chunks seen so far
(within a bound of bytes) and puts together the ids of many texts with array operations."""

from __future__ import annotations

import ctypes
import gc
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that one table of a Python worker remembers (chunks, what belongs to them, and the cost
#: of an entry); beyond it, chunks seen least often are forgotten.
CACHE_BYTES = 40 << 20
#: The same for a table beside a fitted model.
SMALL_BYTES = 24 << 20
#: What an entry costs beside its bytes.
ENTRY_BYTES = 150
_REMEMBERED: list[dict] = []


def remembered(by_name: dict) -> dict:
    """A worker's encoders, by name. The worker may next run tasks of another operator, whose
    table takes their place."""
    _REMEMBERED.append(by_name)
    return by_name


def take_over() -> None:
    """Forget what other operators left in this worker, before a new encoder or table is built."""
    for by_name in _REMEMBERED:
        by_name.clear()
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)       # glibc keeps freed memory otherwise
    if trim:
        trim(0)


def in_parts(chunks: list[bytes], encode, size: int = 4096, limit: int = 1 << 20):
    """``encode`` (list of chunks -> list of id lists) over parts of the chunks of about ``limit``
    bytes, for :class:`ChunkIds`."""
    i = 0
    while i < len(chunks):
        end, total = i, 0
        while end < len(chunks) and end - i < size and total < limit:
            total += len(chunks[end])
            end += 1
        part = chunks[i:end]
        ids = encode(part)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        yield part, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum())), sizes
        i = end


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The runs without ASCII white space of many texts in a row, and the ends of the texts in it."""
    lists = pc.ascii_split_whitespace(texts)
    flat, ends = lists.flatten(), np.asarray(lists.offsets)[1:].astype(np.int64) - lists.offsets[0].as_py()
    some = pc.greater(pc.binary_length(flat), 0)
    kept = np.append(0, np.cumsum(some.to_numpy(zero_copy_only=False)))
    return (flat if kept[-1] == len(flat) else flat.filter(some)).cast(pa.binary()), kept[ends]


def flattened(chunked: list[list[bytes]]) -> tuple[pa.Array, np.ndarray]:
    """Chunks of each text -> (all chunks in a row, ends of the texts in it)."""
    return pa.array(list(chain.from_iterable(chunked)), pa.binary()), np.cumsum(np.fromiter(map(len, chunked), np.int64, len(chunked)))


def _room(a, need):
    if need <= len(a):
        return a
    b = np.zeros((max(need, len(a) + (len(a) >> 1)), *a.shape[1:]), a.dtype)
    b[:len(a)] = a
    return b


class _Known:
    """Numbers for chunks, and how often each was seen."""

    ordered = False

    def __init__(self, max_bytes: int):
        self.max_bytes = max_bytes
        self.clear()

    def clear(self):
        self.index: dict[bytes, int] = {}
        self.cost, self.hits = 0, np.zeros(0, np.int64)

    def place(self, chunks: pa.Array, learn, cost) -> np.ndarray:
        """The number of each chunk. ``learn`` gets the new ones, ascending if asked; ``cost`` tells what a
        list of numbers costs beside the chunks."""
        if self.cost > self.max_bytes:
            self.forget(cost)
        coded = chunks.dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        at = np.fromiter(map(self.index.get, distinct, repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(at < 0)
        if len(missing):
            new = [distinct[i] for i in missing.tolist()]
            learn(sorted(new) if self.ordered else new)
            at[missing] = np.fromiter(map(self.index.__getitem__, new), np.int64, len(new))
        coded = coded.indices.to_numpy()
        self.hits = _room(self.hits, len(self.index))
        self.hits[at] += np.bincount(coded, minlength=len(distinct))
        return at[coded]

    def add(self, chunks: list[bytes], extra: int):
        n = len(self.index)
        self.index.update(zip(chunks, range(n, n + len(chunks))))
        self.cost += sum(map(len, chunks)) + ENTRY_BYTES * len(chunks) + extra

    def forget(self, cost):
        """Keep the chunks seen most often, half of the bound at most."""
        n = len(self.index)
        hits = self.hits[:n]
        size = np.fromiter(map(len, self.index), np.int64, n) + ENTRY_BYTES + cost(np.arange(n))
        least = 2
        while (size[hits >= least]).sum() > self.max_bytes // 2:
            least *= 2
        keep = np.flatnonzero(hits >= least)
        where = np.full(n, -1)
        where[keep] = np.arange(len(keep))
        self.index = {c: k for c, i in self.index.items() if (k := int(where[i])) >= 0}
        self.hits, self.cost = hits[keep] // 2, int(size[keep].sum())
        self.renumber(keep)

    def renumber(self, keep: np.ndarray):
        raise NotImplementedError


class ChunkIds(_Known):
    def __init__(self, encode_many, max_bytes: int = CACHE_BYTES, ordered: bool = False):
        """``encode_many``: list of distinct byte chunks (ascending if ``ordered``) -> parts of them,
        each as (chunks, their ids in a row, the number of ids of each)."""
        self.encode_many, self.ordered = encode_many, ordered
        super().__init__(max_bytes)

    def clear(self):
        super().clear()
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.begin, self.size = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)

    def renumber(self, keep):
        begin, size = self.begin[keep], self.size[keep]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        self.flat = self.flat[np.repeat(begin - (ends - size), size) + np.arange(total)]
        self.used, self.begin, self.size = total, ends - size, size

    def _learn(self, new) -> None:
        for part, ids, sizes in self.encode_many(new):
            n, m, total = len(self.index), len(part), len(ids)
            self.flat = _room(self.flat, self.used + total)
            self.flat[self.used:self.used + total] = ids
            self.begin, self.size = _room(self.begin, n + m), _room(self.size, n + m)
            self.begin[n:n + m] = self.used + np.cumsum(sizes) - sizes
            self.size[n:n + m] = sizes
            self.used += total
            self.add(part, 4 * total)

    def of(self, chunks: pa.Array, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chunks in a row and the ends of the texts in it -> the same of their ids."""
        at = self.place(chunks, self._learn, lambda i: 4 * self.size[i])
        size = self.size[at]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        ids = self.flat[np.repeat(self.begin[at] - (ends - size), size) + np.arange(total)]
        return ids, np.concatenate(([0], ends))[last]

    def __call__(self, chunked: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        """Chunks of each text -> (ids of all texts in a row, ends of the texts in it)."""
        return self.of(*flattened(chunked))


class ChunkTable(_Known):
    """A row of numbers for every chunk, computed once while the chunk is remembered."""

    def __init__(self, compute, width: int, max_bytes: int = CACHE_BYTES, dtype=np.float64):
        """``compute``: list of distinct byte chunks -> (n, width) array."""
        self.compute, self.width, self.dtype = compute, width, dtype
        super().__init__(max_bytes)

    def clear(self):
        super().clear()
        self.rows = np.zeros((1 << 12, self.width), self.dtype)

    def renumber(self, keep):
        self.rows = self.rows[keep]

    def _learn(self, new) -> None:
        n = len(self.index)
        self.rows = _room(self.rows, n + len(new))
        self.rows[n:n + len(new)] = self.compute(new)
        self.add(new, self.rows.itemsize * self.width * len(new))

    def of(self, chunks: pa.Array, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Chunks in a row and the ends of the texts in it -> (the rows of all chunks, these ends)."""
        at = self.place(chunks, self._learn, lambda i: self.rows.itemsize * self.width)
        return self.rows[at], last

    def __call__(self, chunked: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
        return self.of(*flattened(chunked))


def sums(rows: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sum of the rows of each text."""
    total = np.concatenate([np.zeros((1, rows.shape[1])), np.cumsum(rows, axis=0)])
    return np.diff(total[np.concatenate(([0], ends))], axis=0)
