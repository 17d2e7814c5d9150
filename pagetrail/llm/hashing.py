"""Vectorised 64-bit hashes of words and of runs of words, in numpy."""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 20  # bytes hashed at a time; cut at white space

_RANDOM = np.random.Generator(np.random.PCG64(20_240_607))
_BYTE = _RANDOM.integers(0, 2**64, 256, np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C13)
_STEPS = _RANDOM.integers(0, 2**63, 64, np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_powers = np.ones(1, np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every input bit over all 64 bits (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        steps = np.full(max(n, 2 * len(_powers)), _BASE)
        steps[0] = 1
        _powers = np.cumprod(steps)
    return _powers


def word_hashes(text: bytes, prefix: int | None = None) -> np.ndarray:
    """One hash for each run of bytes that are not ASCII white space, in order; of its
    first ``prefix`` bytes, where that is given."""
    parts, start = [], 0
    while start < len(text):
        stop = start + CHUNK
        while stop < len(text) and not _SPACE[text[stop]]:
            stop += 1
        parts.append(_chunk(np.frombuffer(text[start:stop], np.uint8), prefix))
        start = stop
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def _chunk(data: np.ndarray, prefix: int | None) -> np.ndarray:
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return np.empty(0, np.uint64)
    at = np.flatnonzero(inside)
    word = np.cumsum(begins[at]) - 1
    place = at - starts[word]
    if prefix is not None:
        near = place < prefix
        at, place = at[near], place[near]
    values = _BYTE[data[at]] * _power(int(place.max()) + 1)[place]
    firsts = np.searchsorted(at, starts)
    lengths = np.diff(np.append(firsts, len(at))).astype(np.uint64)
    return mix(np.add.reduceat(values, firsts) + lengths)


def word_endings(text: bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Where the last byte of each word is, and its last ``size`` bytes as one number;
    spaces before a shorter word."""
    data = np.frombuffer(text, np.uint8)
    inside = ~_SPACE[data]
    last = np.flatnonzero(inside & ~np.append(inside[1:], False))
    ending, within = np.zeros(len(last), np.uint64), np.ones(len(last), bool)
    for back in range(size):
        within &= last >= back
        at = np.maximum(last - back, 0)
        within &= inside[at]
        byte = np.where(within, data[at], 32).astype(np.uint64)
        ending += byte << np.uint64(8 * back)
    return last, ending


def run_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words; of all words as one run, where they are fewer."""
    if not len(words):
        return words
    size = min(size, len(words))
    n = len(words) - size + 1
    total = np.full(n, size, np.uint64)
    for k in range(size):
        total += words[k : k + n] * _STEPS[k]
    return mix(total)


def set_id(members: np.ndarray) -> bytes:
    """128 bits that depend on the set and not on the order of its distinct members."""
    parts = (members.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix(members), initial=0))
    return np.array(parts, np.uint64).tobytes()
