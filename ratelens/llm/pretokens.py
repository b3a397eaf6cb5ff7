"""Vectorised pre-token boundaries on code points (NumPy, used inside tasks).

Implements the split of the public 50k byte-level vocabularies,

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

by character-class runs instead of a regular-expression scan: a run of one
class is a token, a single space joins the run it precedes, the last
white-space character of a longer run splits off, and an apostrophe that
stands alone before one of the listed endings takes it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

import numpy as np

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3


@lru_cache(maxsize=1)
def class_table() -> np.ndarray:
    """Class of every code point, by the ``regex`` library's properties."""
    import regex
    table = np.zeros(0x110000, dtype=np.uint8)
    for low in range(0, 0x110000, 0x800):
        if 0xD800 <= low < 0xE000:                  # surrogates are no characters
            continue
        every = np.arange(low, low + 0x800, dtype="<u4").tobytes().decode("utf-32-le")
        for cls, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
            for m in regex.finditer(pattern, every):
                table[low + m.start():low + m.end()] = cls
    return table


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Concatenated code points, and the n + 1 text boundaries."""
    raw = "".join(texts).encode("utf-32-le", "surrogatepass")
    ends = np.cumsum(np.fromiter((len(t) for t in texts), dtype=np.int64, count=len(texts)))
    return np.frombuffer(raw, dtype=np.uint32), np.concatenate([np.zeros(1, np.int64), ends])


def token_starts(cp: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Ascending start positions of all pre-tokens of the concatenated texts."""
    n = len(cp)
    if n == 0:
        return np.zeros(0, dtype=np.int64)
    cls = class_table()[cp]
    first = np.zeros(n + 1, dtype=bool)             # first character of a text, or the end
    first[bounds] = True
    run = np.empty(n + 1, dtype=bool)               # a class run begins here
    run[0], run[n] = True, True
    np.not_equal(cls[1:], cls[:-1], out=run[1:n])
    run |= first
    start = run[:n].copy()
    # the last white-space character before a run of another class in the same text
    space = cls == SPACE
    last = np.flatnonzero(space & run[1:] & ~first[1:])
    start[last] = True
    joined = last[cp[last] == 0x20] + 1
    start[joined] = False
    # contractions: a lone apostrophe that begins a token, before a listed ending
    mark = np.flatnonzero((cp == 0x27) & run[:n] & run[1:] & start & ~first[1:])
    if len(mark):
        padded = np.concatenate([cp, np.zeros(2, np.uint32)])
        a, b = padded[mark + 1], padded[mark + 2]
        b = np.where(first[np.minimum(mark + 2, n)], 0, b)
        s, t, m, d, r, e, v, ell = map(ord, "stmdrevl")
        size = np.where(np.isin(a, (s, t, m, d)), 2,
                        np.where(((a == r) | (a == v)) & (b == e) | (a == ell) & (b == ell), 3, 0))
        mark, size = mark[size > 0], size[size > 0]
        start[mark + 1] = False
        after = mark + size
        inside = ~first[after]
        start[after[inside]] = start[after[inside]] | (cls[after[inside]] == LETTER)
    return np.flatnonzero(start)


_MULTIPLIER = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_MULTIPLIER, -1, 1 << 64)


@lru_cache(maxsize=4)
def powers(size: int, base: int) -> np.ndarray:
    p = np.full(size, base, dtype=np.uint64)
    p[0] = 1
    return np.cumprod(p, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (all bits depend on all bits)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def coded_span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of ``codes[start:end]`` for many spans, position
    independent: a polynomial prefix sum over 64-bit symbol codes."""
    return span_hasher(codes)(starts, ends)


def coded_window_hashes(codes: np.ndarray, width: int) -> np.ndarray:
    """``coded_span_hashes`` of all windows of ``width`` codes."""
    n = len(codes)
    size = 1 << max(16, int(n).bit_length())
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(codes * powers(size, _MULTIPLIER)[:n], out=prefix[1:])
    value = prefix[width:] - prefix[:-width]
    value *= powers(size, _INVERSE)[:len(value)]
    value ^= np.uint64(width * 0xD6E8FEB86659FD93 & (1 << 64) - 1)
    return mix(value)


def span_hasher(codes: np.ndarray) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """``coded_span_hashes`` of several lists of spans of the same ``codes``."""
    n = len(codes)
    size = 1 << max(16, int(n).bit_length())
    prefix = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(codes * powers(size, _MULTIPLIER)[:n], out=prefix[1:])

    def hashes(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (prefix[ends] - prefix[starts]) * powers(size, _INVERSE)[starts]
        return mix(value ^ (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    return hashes


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """``coded_span_hashes`` of integer symbols."""
    return coded_span_hashes(mix(symbols.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15)), starts, ends)
