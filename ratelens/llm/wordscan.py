"""Vectorised word and shingle hashing over Arrow text batches (NumPy, used
inside tasks).

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z folded to a-z; the separators are
single bytes in UTF-8, so texts are scanned as bytes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

from . import pretokens

STEP_BYTES = 500_000        # the arrays of a scan hold 8 bytes and more for each of them
SHINGLE = 5


@lru_cache(maxsize=2)
def byte_codes(fold: bool) -> np.ndarray:
    """A 64-bit code per byte; with ``fold`` A-Z share the codes of a-z."""
    index = np.arange(256, dtype=np.uint64)
    if fold:
        index[65:91] += np.uint64(32)
    return pretokens.mix(index + np.uint64(0x51ED270B9F3C1B57))


def text_steps(column: pa.Array, step: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, row boundaries) for runs of rows of about
    ``step``; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    n = len(column)
    if n == 0:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    if column.null_count:           # a null's extent is normally empty; make it so
        import pyarrow.compute as pc
        yield from text_steps(pc.fill_null(column, ""), step)
        return
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + step, side="right")) - 1)
        to = min(to, n)
        yield at, to, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row and the total)."""
    n = len(data)
    word = np.zeros(n + 1, dtype=bool)
    word[:n] = (data != 0x20) & ((data < 9) | (data > 13))
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    before = np.concatenate([[False], word[:-1]])
    starts = np.flatnonzero(word & (~before | edge))
    ends = np.flatnonzero(before & (~word | edge))
    return starts, ends, np.searchsorted(starts, bounds)


def word_hasher(data: np.ndarray, fold: bool = True) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    """Hashes of the words of ``data`` by their starts and ends."""
    return pretokens.span_hasher(byte_codes(fold)[data])


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: bool = True) -> np.ndarray:
    return word_hasher(data, fold)(starts, ends)


_FACTORS = [0xA24BAED4963EE407, 0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9]


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of ``size`` words (over row boundaries too)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    return combined(lambda i: words[i:i + n], size, n)


def combined(word: Callable[[int], np.ndarray], size: int, n: int) -> np.ndarray:
    """Hashes of ``n`` windows whose i-th words are ``word(i)``."""
    total = np.zeros(n, dtype=np.uint64)
    for i in range(size):
        total = extended(total, word(i))
    return finished(total)


def extended(total: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Unfinished hashes of windows, in place one word longer."""
    total *= np.uint64(_FACTORS[0])
    total += word
    total ^= total >> np.uint64(29)
    return total


def finished(total: np.ndarray) -> np.ndarray:
    return pretokens.mix(total * np.uint64(_FACTORS[1]))


def shingle_sets(data: np.ndarray, bounds: np.ndarray, size: int = SHINGLE) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its shingles; a row with fewer
    words has its whole sequence as one, a row without words none."""
    starts, ends, rows = word_spans(data, bounds)
    words = word_hashes(data, starts, ends)
    windows = window_hashes(words, size)
    out = []
    for low, high in zip(rows[:-1].tolist(), rows[1:].tolist()):
        if high - low >= size:
            out.append(np.unique(windows[low:high - size + 1]))
        elif high > low:
            out.append(pretokens.coded_span_hashes(words[low:high], np.array([0]), np.array([high - low])))
        else:
            out.append(np.zeros(0, dtype=np.uint64))
    return out
