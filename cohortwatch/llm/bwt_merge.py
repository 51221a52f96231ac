"""Repeated windows in a collection of byte strings by merging Burrows-Wheeler transforms.

Strings are read in steps of ``STEP`` bytes, at every starting byte: the symbol at a byte is
the hash of the next STEP bytes, and its successor stands STEP bytes on. A window of
``depth * STEP`` bytes is then a run of ``depth`` symbols, so the number of rounds is
that of symbols, not of bytes.

A window with a symbol that occurs once in the collection is not repeated: only the stretches
of the other windows go on. Each shard's suffixes are sorted once (prefix doubling), which gives its transform: the
symbol in front of each suffix. Two transforms are merged without sorting suffixes
again: a bit vector tells of each row of the merged order which shard it comes from.
Each round carries the rows one symbol back (the LF step) in stable order, which
sorts the interleave by one symbol more. Rows of a shard keep their order, so a round
merges two sorted runs. Where neighbours first differ in round h their common prefix is
h - 1 symbols; rows that have not differed after ``depth`` rounds form the repeated
intervals.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

STEP = 40
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
UNSET = np.int16(-1)


@dataclass
class Shard:
    """Sorted suffixes of a shard's strings and the symbols in front of them.

    Rows of the extended order are the string ends, one per string, then the suffixes.
    """

    suffix: np.ndarray  # position of each sorted suffix
    ends: int  # number of strings
    back: np.ndarray  # extended rows that have a symbol in front, sorted by that symbol
    symbol: np.ndarray  # that symbol, sorted


def sort_suffixes(symbol: np.ndarray, nxt: np.ndarray) -> np.ndarray:
    """Positions in suffix order; ``nxt`` is each position's successor, n at a string's end; ties by position."""
    n = len(symbol)
    rank = np.append(symbol.astype(np.int64) + 1, 0)
    hop = np.append(nxt, n)
    while True:
        key = rank[:n] * (int(rank.max()) + 1) + rank[hop[:n]]
        order = np.argsort(key, kind="stable")
        new = np.cumsum(np.concatenate([[1], key[order][1:] != key[order][:-1]]))
        rank[order] = new
        if new[-1] == n or (hop[:n] == n).all():
            return order
        hop = hop[hop]


def make_shard(symbol: np.ndarray, nxt: np.ndarray, before: np.ndarray, first: int) -> Shard:
    """Shard of the positions ``first`` on; ``before`` is each position's predecessor, -1 at a string's start."""
    order = sort_suffixes(symbol, nxt)
    n = len(symbol)
    last = np.flatnonzero(nxt == n)
    # in front of a string's end stands its last symbol, in front of a suffix its predecessor's
    front = np.concatenate([symbol[last], np.where(before[order] >= 0, symbol[before[order]], -1)])
    rows = np.flatnonzero(front >= 0)
    back = rows[np.argsort(front[rows], kind="stable")]
    return Shard(order + first, len(last), back, front[back].astype(np.int64))


def merge(a: Shard, b: Shard, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of two shards sorted by ``depth`` symbols: bits (0: a, 1: b) and common prefixes.

    The prefix of row j is its common one with row j - 1 in symbols, UNSET from depth on.
    """
    n, m = len(a.suffix), len(b.suffix)
    ends, rows = a.ends + b.ends, n + m
    bits = np.concatenate([np.zeros(n, dtype=bool), np.ones(m, dtype=bool)])
    lcp = np.full(rows, UNSET, dtype=np.int16)
    lcp[:1] = 0
    block = np.zeros(ends + rows, dtype=np.int32)
    width = ends + rows
    symbols = np.concatenate([a.symbol, b.symbol])
    base = symbols * width
    place_a, place_b = np.arange(a.ends), a.ends + np.arange(b.ends)
    for h in range(depth):
        at_a = np.concatenate([place_a, ends + np.flatnonzero(~bits)])[a.back]
        at_b = np.concatenate([place_b, ends + np.flatnonzero(bits)])[b.back]
        old = np.concatenate([at_a, at_b])
        order = np.argsort(base + old, kind="stable")  # two sorted runs
        bits = order >= len(at_a)
        was = block[old[order]]
        now = symbols[order]
        cut = np.concatenate([[True], (now[1:] != now[:-1]) | (was[1:] != was[:-1])])
        fresh = cut & (lcp == UNSET)
        lcp[fresh] = h
        block[ends:] = np.cumsum(cut)
        block[:ends] = 0
        if h and not fresh.any() and cut.all():
            break
    return bits, lcp


def repeated(strings: list[bytes], window: int) -> list[np.ndarray]:
    """Of each string, whether the window that starts at each byte occurs more than once in the collection."""
    depth, rest = divmod(window, STEP)
    assert not rest, "the window is a whole number of steps"
    size = np.array([max(0, len(s) - STEP + 1) for s in strings], dtype=np.int64)
    n = int(size.sum())
    out = [np.zeros(max(0, len(s) - window + 1), dtype=bool) for s in strings]
    if not n:
        return out
    start = np.concatenate([[0], np.cumsum(size)])
    symbol = np.concatenate([_symbols(s) for s in strings if len(s) >= STEP])
    _, symbol, times = np.unique(symbol, return_inverse=True, return_counts=True)
    # only stretches of windows whose symbols all occur twice are sorted and merged
    window_at, place, size = stretches(times[symbol] > 1, start, depth)
    n = len(place)
    if not n:
        return out
    symbol = symbol[place]
    tops, start = start, np.concatenate([[0], np.cumsum(size)])
    # two shards of about equal size, whole strings each
    half = int(np.searchsorted(start, n // 2, side="right"))
    half = min(max(half, 1), len(size) - 1) if len(size) > 1 else 1
    shards = []
    for lo, hi in ((0, half), (half, len(size))):
        a, b = int(start[lo]), int(start[hi])
        local = np.repeat(start[lo:hi] - a, size[lo:hi])
        stop = np.repeat(start[lo + 1:hi + 1] - a, size[lo:hi])
        at = np.arange(b - a)
        nxt = np.where(at + STEP < stop, at + STEP, b - a)
        before = np.where(at - STEP >= local, at - STEP, -1)
        if b > a:
            shards.append(make_shard(symbol[a:b], nxt, before, a))
    if len(shards) == 1:
        shards.append(Shard(np.zeros(0, dtype=np.int64), 0, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)))
    bits, lcp = merge(shards[0], shards[1], depth)
    suffix = np.empty(n, dtype=np.int64)
    suffix[~bits], suffix[bits] = shards[0].suffix, shards[1].suffix
    joined = lcp == UNSET
    many = np.zeros(int(tops[-1]), dtype=bool)
    many[place[suffix[joined | np.append(joined[1:], False)]]] = True
    many &= window_at  # what ends with a stretch is no window of it
    for i, o in enumerate(out):
        o[:] = many[tops[i]:tops[i] + len(o)]
    return out


def stretches(common: np.ndarray, start: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows with ``depth`` ``common`` symbols each, positions of the runs of such windows, and the runs' lengths.

    A window with a symbol that occurs once occurs once. Runs of one string whose windows
    overlap are one, so that no position comes twice. ``start`` is where each string begins.
    """
    n = len(common)
    reach = (depth - 1) * STEP
    left = np.repeat(start[1:] - reach, np.diff(start)) - np.arange(n)  # windows that start here or later in the string
    window = left > 0
    for i in range(depth):
        window[:max(0, n - i * STEP)] &= common[i * STEP:]
    at = np.flatnonzero(window)
    if not len(at):
        return window, at, at
    string = np.searchsorted(start, at, side="right")
    cut = np.flatnonzero((np.diff(at) > reach) | (np.diff(string) > 0)) + 1
    first, last = at[np.append(0, cut)], at[np.append(cut - 1, len(at) - 1)]
    size = last - first + 1 + reach
    return window, np.repeat(first - np.cumsum(size) + size, size) + np.arange(int(size.sum())), size


def _symbols(s: bytes) -> np.ndarray:
    """Hash of the STEP bytes from each byte on, put together from stretches of powers of two."""
    b = np.frombuffer(s, dtype=np.uint8).astype(np.uint64)
    n = len(b) - STEP + 1
    power, width = b + np.uint64(1), 1
    total, done = np.zeros(n, dtype=np.uint64), 0
    while done < STEP:
        if STEP & width:
            total = _mix(total * _FACTOR + power[done:done + n])
            done += width
        if done < STEP:
            power = _mix(power[:-width] * _FACTOR + power[width:])
            width *= 2
    return total


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))
