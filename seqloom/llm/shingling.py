"""Hashes of words and word shingles, and compact windows over them, for all texts of an Arrow batch at once in numpy.

Words are `[^\\x20\\x09-\\x0D]+` with A-Z lower-cased. A word's hash is a polynomial over its bytes, each with a random
64-bit number, modulo 2^64: the difference of two prefix sums, brought back by the inverse of the base's power.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LETTER = np.random.default_rng(90210).integers(0, 1 << 64, 256, np.uint64, endpoint=False)
LETTER[65:91] = LETTER[97:123]
BASE = 0x9E3779B97F4A7C15 | 5
#: Bytes whose prefix sums are held at a time, unless a single word is longer.
PIECE = 1 << 19


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


@functools.lru_cache(2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        return tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)])) for b in (BASE, pow(BASE, -1, 1 << 64)))


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words, and where each text's begin among them (one entry more than texts). Null is empty."""
    texts = texts.fill_null("").cast(pa.large_string())
    at, data = texts.buffers()[1:]
    ends = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.zeros(0, np.uint8)
    ends = ends - ends[0]
    if not len(data):
        return np.zeros(0, np.uint64), np.zeros(len(texts) + 1, np.int64)
    ink = ~SPACE[data]
    first, last = ink.copy(), ink.copy()
    first[1:] &= ~ink[:-1]
    last[:-1] &= ~ink[1:]
    edge = ends[:-1][ends[:-1] < len(data)]
    first[edge] = ink[edge]
    edge = ends[1:][ends[1:] > 0] - 1
    last[edge] = ink[edge]
    begin, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    out = np.empty(len(begin), np.uint64)
    i = 0
    with np.errstate(over="ignore"):
        while i < len(begin):
            j = max(int(np.searchsorted(stop, begin[i] + PIECE, "right")), i + 1)
            lo, hi = int(begin[i]), int(stop[j - 1])
            power, back = _powers(PIECE if hi - lo <= PIECE else hi - lo)
            sums = np.zeros(hi - lo + 1, np.uint64)
            np.cumsum(LETTER[data[lo:hi]] * power[: hi - lo], out=sums[1:])
            b, e = begin[i:j] - lo, stop[i:j] - lo
            out[i:j] = mix((sums[e] - sums[b]) * back[b] + (e - b).astype(np.uint64))
            i = j
    return out, np.searchsorted(begin, ends)


def shingles(h: np.ndarray, at: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all shingles in order, and where each text's begin. Texts of fewer words than a shingle have none."""
    n = np.maximum(np.diff(at) - width + 1, 0)
    if len(h) < width:
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    out = np.full(len(h) - width + 1, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k])
    owner = np.repeat(np.arange(len(n)), np.diff(at))[: len(out)]
    inside = np.arange(len(out)) - at[owner] < n[owner]
    return out[inside], np.concatenate([[0], np.cumsum(n)])


def compact(values: np.ndarray, at: np.ndarray, least: int, apart: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The compact windows (text, left, c, right) of at least ``least`` values (0 counts as 1): nodes of each text's Cartesian tree that
    are wide enough, the leftmost of equal values on top.

    Such a node is the least of half a window to one side at least; the nearest smaller values of one that is are such
    nodes or a text's end, so that bounds are found among these few alone, by pointers that jump over larger values.

    Of equal leasts less than ``apart`` places after each other, the first's window holds the others' and stands for them."""
    owner = np.repeat(np.arange(len(at) - 1), np.diff(at))
    z = np.zeros(len(values) + len(at), np.uint64)  # a zero before each text and after the last
    z[np.arange(len(values)) + owner + 1] = np.maximum(values, np.uint64(1))
    half = (least + 1) // 2 - 1
    ok = z > 0
    if half:
        low, n = z, 1
        while n < half:
            step = min(n, half - n)
            low, n = np.minimum(low[:-step], low[step:]), n + step
        side = np.zeros(len(z), bool)
        side[: len(low) - 1] = z[: len(low) - 1] <= low[1:]
        side[half:] |= z[half:] < low[: len(z) - half]
        ok &= side
    ok[np.concatenate([at[:-1] + np.arange(len(at) - 1), [len(z) - 1]])] = True
    spot = np.flatnonzero(ok)
    v = z[spot]
    bounds = []
    for step in (-1, 1):
        to = np.arange(len(spot)) + step
        todo = np.flatnonzero(v > 0)
        while len(todo):
            j = to[todo]
            over = v[j] > v[todo] if step < 0 else v[j] >= v[todo]
            todo, j = todo[over], j[over]
            to[todo] = to[j]
        bounds.append(spot[np.clip(to, 0, len(spot) - 1)])
    left, right = bounds[0] + 1, bounds[1] - 1
    again = (z[left - 1] == v) & (spot - left + 1 < apart)
    wide = np.flatnonzero((v > 0) & (right - left + 1 >= least) & ~again)
    c = spot[wide]
    text = owner[c - 1 - np.searchsorted(at[1:] + np.arange(1, len(at)), c, "right")] if len(wide) else wide
    begin = at[text] + text + 1
    return text, left[wide] - begin, c - begin, right[wide] - begin
