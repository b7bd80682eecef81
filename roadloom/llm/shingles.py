"""Word shingles as sets of 64-bit hashes, computed with whole-array operations."""

from __future__ import annotations

import numpy as np

from roadloom.llm.base import mix64

_U = np.uint64
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_POS = 64
_TABLE = np.random.default_rng(20240229).integers(0, 2**64, size=_POS * 256, dtype=np.uint64)
_STEP = _U(0x9E3779B97F4A7C15)


def word_hashes(docs: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words (runs of bytes that are not ASCII white space), and for each document where its words begin (one more entry than documents). A-Z counts as a-z."""
    lower = [d.lower() for d in docs]
    joined = b"\n".join([b"", *lower, b""])
    buf = np.frombuffer(joined, dtype=np.uint8)
    ends = np.cumsum(np.fromiter((len(d) + 1 for d in lower), dtype=np.int64, count=len(lower)))
    bounds = np.concatenate(([0], ends))
    ink = ~_SPACE[buf]
    starts = np.flatnonzero(ink[1:] & ~ink[:-1]) + 1
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(docs) + 1, dtype=np.int64)
    offset = np.zeros(len(buf), dtype=np.int32)
    offset[starts] = np.diff(np.concatenate(([0], starts)))
    pos = np.arange(len(buf), dtype=np.int32) - np.cumsum(offset, dtype=np.int32)
    values = _TABLE[((pos & (_POS - 1)) << 8) | buf]
    far = pos >> 6
    if far.max() > 0:
        values = values * ((far.astype(np.uint64) << _U(1)) + _U(1))
    values[~ink] = 0
    h = mix64(np.add.reduceat(values, starts))
    return h, np.searchsorted(starts - 1, bounds, side="left")


def shingle_sets(docs: list[bytes], k: int) -> list[np.ndarray]:
    """For each document its sorted distinct shingles of ``k`` words; with 1 to k-1 words the whole sequence is one; without words an empty set."""
    words, at = word_hashes(docs)
    n = len(words)
    if n >= k:
        rolled = words[: n - k + 1].copy()
        for j in range(1, k):
            rolled = rolled * _STEP + words[j : n - k + 1 + j]
        rolled = mix64(rolled)
    out = []
    for i in range(len(docs)):
        a, b = int(at[i]), int(at[i + 1])
        if b - a >= k:
            out.append(np.unique(rolled[a : b - k + 1]))
        elif b > a:
            h = _U(0)
            with np.errstate(over="ignore"):
                for w in words[a:b]:
                    h = h * _STEP + w
                h = h + _U(b - a) * _U(0xD6E8FEB86659FD93)
            out.append(mix64(np.array([h], dtype=np.uint64)))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1
    return int((b[at] == a).sum())
