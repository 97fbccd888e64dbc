"""XXH64 of the words of many texts, by array operations on the texts' bytes.

Texts stay in the one buffer that Arrow holds them in: words are pairs of places there, and the
rounds of the hash run over all words of one length in a slice at once.
Long words (few, but without bound) are hashed one by one."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

_U = np.uint64
_P1, _P2, _P3, _P4, _P5 = (_U(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
#: From this length on XXH64 takes a word in four lanes.
_LONG = 32


def _rotated(x: np.ndarray, by: int) -> np.ndarray:
    return (x << _U(by)) | (x >> _U(64 - by))


def lowered(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row, A-Z lower-cased, and the place where each text ends."""
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(0, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    upper = (raw - np.uint8(65)) < np.uint8(26)
    return raw | (upper.view(np.uint8) << np.uint8(5)), offsets[1:] - offsets[0]


def word_places(low: np.ndarray, text_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each run without ASCII white space begins and ends, and the ends of the texts in the list of runs."""
    if not len(low):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(text_ends), np.int64)
    space = (low == np.uint8(32)) | ((low - np.uint8(9)) < np.uint8(5))
    cut = np.empty(len(low) + 1, bool)                 # a word that reaches here ends, another begins
    cut[0], cut[1:] = True, space
    cut[text_ends] = True
    begins = np.flatnonzero(~space & cut[:-1])
    cut[:-1], cut[-1] = space, True
    cut[text_ends] = True
    ends = np.flatnonzero(~space & cut[1:]) + 1
    return begins, ends, np.searchsorted(begins, text_ends)


def hashes(low: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """XXH64 (seed 0) of ``low[begin:end]`` for each word."""
    padded = np.zeros(len(low) // 8 * 8 + 24, np.uint8)
    padded[:len(low)] = low
    lanes = padded.view("<u8")

    def eight(at):
        word, shift = at >> 3, (at.astype(_U) & _U(7)) << _U(3)
        return (lanes[word] >> shift) | ((lanes[word + 1] << _U(1)) << (_U(63) - shift))

    size = ends - begins
    out = np.empty(len(size), _U)
    order = np.argsort(np.minimum(size, _LONG).astype(np.uint8), kind="stable")
    cut = np.concatenate(([0], np.cumsum(np.bincount(np.minimum(size, _LONG), minlength=_LONG + 1))))
    for n in range(1, _LONG):                          # words of one length at a time
        own = order[cut[n]:cut[n + 1]]
        if not len(own):
            continue
        at, h = begins[own], np.full(len(own), _P5 + _U(n), _U)
        for _ in range(n // 8):
            h = _rotated(h ^ (_rotated(eight(at) * _P2, 31) * _P1), 27) * _P1 + _P4
            at = at + 8
        rest = eight(at) if n % 8 else h
        if n & 4:
            h = _rotated(h ^ ((rest & _U(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
            rest = rest >> _U(32)
        for _ in range(n & 3):
            h = _rotated(h ^ ((rest & _U(0xFF)) * _P5), 11) * _P1
            rest = rest >> _U(8)
        h ^= h >> _U(33)
        h *= _P2
        h ^= h >> _U(29)
        h *= _P3
        h ^= h >> _U(32)
        out[own] = h
    long = order[cut[_LONG]:]
    if len(long):
        held = memoryview(padded)
        out[long] = np.fromiter((xxhash.xxh64_intdigest(held[a:b]) for a, b in zip(begins[long].tolist(), ends[long].tolist())), _U, len(long))
    return out
