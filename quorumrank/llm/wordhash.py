"""Vectorised hashes of words and word shingles over Arrow string buffers.

A word is a maximal run of bytes other than space and U+0009..U+000D, with A-Z lower-cased. All hashes are 64 bit
and depend on nothing but the words, so they agree between executors and runs.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SHINGLE_WORDS = 5
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD1342543DE82EF95)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (the public splitmix64 constants)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@functools.cache
def _byte_codes() -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=np.uint64) * _BASE)
    codes[65:91] = codes[97:123]
    return codes


@functools.cache
def _spaces() -> np.ndarray:
    flags = np.zeros(256, dtype=bool)
    flags[[32, *range(9, 14)]] = True
    return flags


_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, for n positions at least."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, (1 << 20) + 4096)
        inverse = np.uint64(pow(int(_BASE), -1, 1 << 64))
        tables = []
        for base in (_BASE, inverse):
            row = np.full(size, base, dtype=np.uint64)
            row[0] = 1
            with np.errstate(over="ignore"):
                tables.append(np.cumprod(row, dtype=np.uint64))
        if size > 1 << 24:
            return tables[0], tables[1]  # for one huge text only; not kept
        _powers[:] = tables
    return _powers[0], _powers[1]


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts, or binary values, and the len + 1 offsets into them; null reads as empty."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8)[at[0] : at[-1]], at - at[0]


@functools.cache
def non_letters() -> np.ndarray:
    """Separators for runs of letters: every ASCII byte but A-Z and a-z."""
    flags = np.zeros(256, dtype=bool)
    flags[:128] = True
    flags[65:91] = flags[97:123] = False
    return flags


def spans(texts: pa.Array, separators: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, start and end of each word, len + 1 offsets of each text's words)."""
    data, at = buffers(texts)
    if not len(data):
        none = np.zeros(0, np.int64)
        return data, none, none, np.zeros(len(texts) + 1, np.int64)
    inside = ~(_spaces() if separators is None else separators)[data]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    heads = at[:-1][at[:-1] < len(data)]
    before[heads] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    tails = at[1:] - 1
    after[tails[tails >= 0]] = False
    return data, starts, np.flatnonzero(inside & ~after) + 1, np.searchsorted(starts, at).astype(np.int64)


def span_hashes(data: np.ndarray, starts: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
    """For each array of ends the hashes of the spans from ``starts``; equal lower-cased bytes hash alike."""
    up, down = _power_tables(len(data) + 1)
    out = []
    with np.errstate(over="ignore"):
        sums = np.cumsum(_byte_codes()[data] * up[: len(data)], dtype=np.uint64)
        low = np.where(starts > 0, sums[starts - 1], np.uint64(0)) if len(starts) else np.zeros(0, np.uint64)
        for end in ends:
            out.append(mix((sums[end - 1] - low) * down[starts] + (end - starts).astype(np.uint64) * _STEP))
    return out


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word in order, len + 1 offsets of each text's words)."""
    data, starts, ends, at = spans(texts)
    return (span_hashes(data, starts, ends)[0] if len(data) else np.zeros(0, np.uint64)), at


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its 5-word shingles; fewer words form one shingle, none an empty set."""
    hashes, at = words(texts)
    n, w = len(hashes), SHINGLE_WORDS
    with np.errstate(over="ignore"):
        joined = np.zeros(max(0, n - w + 1), dtype=np.uint64)
        for k in range(w):
            joined = joined * _STEP + hashes[k : n - w + 1 + k] if n >= w else joined
        joined = mix(joined + np.uint64(w))
        out = []
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if hi - lo >= w:
                out.append(np.unique(joined[lo : hi - w + 1]))
            elif hi > lo:
                one = np.uint64(0)
                for h in hashes[lo:hi]:
                    one = one * _STEP + h
                out.append(mix(np.array([one + np.uint64(hi - lo)], dtype=np.uint64)))
            else:
                out.append(np.zeros(0, np.uint64))
    return out
