"""Suffix arrays by prefix doubling and permuted common prefixes (NumPy, used
inside tasks on runs of bounded size).

Suffixes are ordered by their first characters, as many as fit one integer; then,
while some are equal, by the ranks of their first and second halves, which
doubles the characters that count.  Ranks are places in the final order, so a
suffix that is alone keeps its own and is not sorted again.
"""

from __future__ import annotations

import numpy as np


def _first_of_run(new: np.ndarray) -> np.ndarray:
    """For every entry the place where its run begins."""
    return np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))


def _changes(values: np.ndarray) -> np.ndarray:
    return np.append(True, values[1:] != values[:-1])


def _dealt(key: np.ndarray, at: np.ndarray, bits: int, room: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of ``room`` bits in order, and their positions (of ``bits`` bits)."""
    if room + bits > 63:
        order = np.argsort(key, kind="stable")
        return key[order], at[order]
    key = (key << bits) | at        # one integer each: sorted without an index
    key.sort()
    return key >> bits, key & ((1 << bits) - 1)


def suffix_array(text: np.ndarray, alphabet: int) -> np.ndarray:
    """Positions of all suffixes of ``text`` (integers below ``alphabet``) in order."""
    n = len(text)
    if n < 2:
        return np.arange(n, dtype=np.int64)
    bits = n.bit_length()
    used = np.bincount(text, minlength=alphabet) > 0
    code = np.where(used, np.cumsum(used), 0)           # 0: behind the end, the least
    size = int(code.max()).bit_length()
    width = max(1, (63 - bits) // size)                 # characters in one key
    coded = np.concatenate([code[text], np.zeros(width - 1, dtype=np.int64)])
    key = np.zeros(n, dtype=np.int64)
    for i in range(width):
        key <<= size
        key |= coded[i:i + n]
    rank = np.zeros(n + 1, dtype=np.int64)              # place + 1; 0 behind the end
    key, at = _dealt(key, np.arange(n), bits, width * size)
    new = _changes(key)
    rank[at] = _first_of_run(new) + 1
    equal = np.ones(n, dtype=bool)                      # not yet alone
    while not new.all():
        equal[at[new & np.append(new[1:], True)]] = False
        at = np.flatnonzero(equal)
        key, at = _dealt((rank[at] << bits) | rank.take(at + width, mode="clip"), at, bits, 2 * bits)
        new, group = _changes(key), key >> bits
        # suffixes of equal rank stand together, from the place of that rank on
        rank[at] = group + _first_of_run(new) - _first_of_run(_changes(group))
        width *= 2
    sa = np.empty(n, dtype=np.int64)
    sa[rank[:n] - 1] = np.arange(n)
    return sa


def common_prefixes(text: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """In text order, the length that each suffix shares with the one before it in ``sa``.

    Where the characters before both also agree, the length is that of the position
    before less one; only the others are compared."""
    n = len(text)
    previous = np.empty(n, dtype=np.int64)
    previous[sa[1:]] = sa[:-1]
    previous[sa[0]] = -1
    here = np.arange(n)
    follows = (here > 0) & (previous > 0)
    follows[follows] = text[here[follows] - 1] == text[previous[follows] - 1]
    length = np.zeros(n, dtype=np.int64)
    compare = np.flatnonzero(~follows & (previous >= 0))
    words = n - 7
    if words > 0 and text.dtype == np.uint8:            # eight bytes at a time
        wide = np.lib.stride_tricks.as_strided(text, (words, 8), (1, 1)).copy().view(np.uint64).ravel()
        live = compare
        while len(live):
            a, b = live + length[live], previous[live] + length[live]
            fits = np.maximum(a, b) < words
            live, a, b = live[fits], a[fits], b[fits]
            live = live[wide[a] == wide[b]]
            length[live] += 8
    live = compare
    while len(live):
        a, b = live + length[live], previous[live] + length[live]
        fits = np.maximum(a, b) < n
        live, a, b = live[fits], a[fits], b[fits]
        live = live[text[a] == text[b]]
        length[live] += 1
    total = length + here
    total[follows] = 0
    source = np.maximum.accumulate(np.where(follows, 0, here))
    return total[source] - here
