"""Word shingles as 64-bit hashes, computed with numpy on a text's bytes."""

from __future__ import annotations

import hashlib

import numpy as np

WORDS = 5
_BASE = 0x9E3779B97F4A7C15  # odd, so that powers have inverses modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class _Tables:
    """Powers of the base and of its inverse, grown to the longest text met."""

    up = _powers(_BASE, 1 << 16)
    down = _powers(_INVERSE, 1 << 16)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(cls.up):
            size = 1 << (n - 1).bit_length()
            cls.up, cls.down = _powers(_BASE, size), _powers(_INVERSE, size)
        return cls.up, cls.down


def mixed(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit over the word."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(text: str) -> np.ndarray:
    """Hash of each word: runs without ASCII white space, A-Z lower-cased, in order."""
    b = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
    if not len(b):
        return np.zeros(0, dtype=np.uint64)
    space = (b == 32) | ((b >= 9) & (b <= 13))
    lower = np.where((b >= 65) & (b <= 90), b + np.uint8(32), b)
    edge = np.flatnonzero(np.diff(space, prepend=True, append=True))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, dtype=np.uint64)
    up, down = _Tables.upto(len(b) + 1)
    prefix = np.zeros(len(b) + 1, dtype=np.uint64)
    np.cumsum((lower.astype(np.uint64) + np.uint64(1)) * up[:len(b)], out=prefix[1:])
    return mixed((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct shingle hashes; the whole sequence as one if there are fewer words; none without words.

    Equality of 64-bit hashes stands for equality of shingles.
    """
    h = word_hashes(text) if text else np.zeros(0, dtype=np.uint64)
    if not len(h):
        return h
    n = len(h) - words + 1
    parts = [h[j:j + n] for j in range(words)] if n > 0 else [h[j:j + 1] for j in range(len(h))]
    total = np.full(len(parts[0]), len(parts), dtype=np.uint64)
    for p in parts:
        total = mixed(total * np.uint64(_BASE) + p)
    return np.unique(total)


def set_digest(values: np.ndarray) -> bytes:
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()
