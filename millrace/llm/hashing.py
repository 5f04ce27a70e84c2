"""Vectorised hashes of words, shingles and their sets."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np

_SEED = np.random.default_rng(20240611)
_BYTE = _SEED.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE[32] = 0  # blanks end words and add nothing to them
_BASE = int(_SEED.integers(0, 1 << 62)) * 2 + 1
_PLACE = (_SEED.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint64)
_LOWER = bytes(32 if b in b"\t\n\x0b\x0c\r " else b + 32 if 65 <= b <= 90 else b for b in range(256))
_powers = np.ones(1, dtype=np.uint64)


def powers(n: int) -> np.ndarray:
    """The first ``n`` powers of the base, modulo 2**64."""
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1024)
        grown = np.full(size, _BASE, dtype=np.uint64)
        grown[0] = 1
        _powers = np.cumprod(grown, dtype=np.uint64)
    return _powers[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of UTF-8 texts, A-Z in lower case, and the number of words of each text."""
    joined = b" ".join([*texts, b""]).translate(_LOWER)
    data = np.frombuffer(joined, dtype=np.uint8)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    word = data != 32
    first = word.copy()
    first[1:] &= ~word[:-1]
    starts = np.flatnonzero(first)
    if not len(starts):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    at = np.arange(len(data), dtype=np.int64)
    inside = at - np.maximum.accumulate(np.where(first, at, 0))
    inside[~word] = 0
    value = _BYTE[data] * powers(int(inside.max()) + 1)[inside]
    hashes = mixed(np.add.reduceat(value, starts))
    ends = np.cumsum(lengths)
    counts = np.diff(np.searchsorted(starts, np.concatenate(([0], ends))))
    return hashes, counts


def shingle_sets(texts: Sequence[bytes], words: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``words`` words.

    A text with fewer words has one: the whole sequence. A text without words has none.
    """
    hashes, counts = word_hashes(texts)
    runs = np.zeros(len(hashes), dtype=np.uint64)
    for k in range(words):
        runs[: len(hashes) - k] += hashes[k:] * _PLACE[k]
    runs = mixed(runs)
    out, start = [], 0
    for n in counts.tolist():
        if n >= words:
            out.append(np.unique(runs[start : start + n - words + 1]))
        elif n:
            parts = np.append(hashes[start : start + n] * _PLACE[:n], np.array([n], np.uint64) * _PLACE[63:])
            out.append(mixed(parts.sum(dtype=np.uint64, keepdims=True)))
        else:
            out.append(np.empty(0, np.uint64))
        start += n
    return out


def set_digest(values: np.ndarray) -> bytes:
    """128 bits that tell sets apart."""
    return hashlib.blake2b(values.astype("<u8").tobytes(), digest_size=16).digest()


def combined(parts: np.ndarray, tag: np.ndarray) -> np.ndarray:
    """One 64-bit hash of the values along the last axis and a tag."""
    total = (parts.astype(np.uint64) * _PLACE[: parts.shape[-1]]).sum(axis=-1, dtype=np.uint64)
    return mixed(total + tag * _PLACE[62])
