"""Suffix arrays by induced sorting, and permuted common prefixes.

Suffixes are classified as larger or smaller than their successor; the leftmost smaller ones (LMS) are sorted by the
substrings between them, recursively where substrings repeat, and all others are induced from their order in two
linear scans. Over a small alphabet the scans go bucket by bucket in whole arrays, over a large one symbol by symbol.
"""

from __future__ import annotations

import numpy as np

#: Scans go by whole arrays if a bucket has on average so many suffixes.
DENSE = 64


def classified(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(smaller, lms): which suffixes are smaller than the next one, and where the leftmost smaller ones start."""
    n = len(text)
    differs = np.append(text[:-1] != text[1:], True)
    where = np.minimum.accumulate(np.where(differs, np.arange(n), n)[::-1])[::-1]  # the next place that decides
    after = np.append(text, -1)
    smaller = text[where] < after[where + 1]
    smaller[-1] = True
    lms = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1
    return smaller, lms


def _spread(values: np.ndarray, symbols: np.ndarray, slots: np.ndarray, out: np.ndarray, step: int) -> None:
    """Put ``values``, in order, at the next slots of their symbols' buckets, forwards or backwards."""
    order = np.argsort(symbols, kind="stable")
    ordered = symbols[order]
    counts = np.bincount(ordered, minlength=len(slots))
    first = np.cumsum(counts) - counts
    out[slots[ordered] + step * (np.arange(len(ordered)) - first[ordered])] = values[order]
    slots += step * counts


def _induced_dense(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    counts = np.bincount(text, minlength=size)
    ends = np.cumsum(counts)
    starts = ends - counts
    sa = np.full(len(text), -1, np.int64)
    tails = ends - 1
    _spread(lms[::-1], text[lms[::-1]], tails, sa, -1)

    heads = starts.copy()
    for c in range(size):
        done = starts[c]
        while done < heads[c]:
            found, done = sa[done : heads[c]], heads[c]
            before = found[found > 0] - 1
            before = before[~smaller[before]]
            _spread(before, text[before], heads, sa, 1)
        found = sa[tails[c] + 1 : ends[c]]
        before = found[found > 0] - 1
        before = before[~smaller[before]]
        _spread(before, text[before], heads, sa, 1)

    tails = ends - 1
    for c in range(size - 1, -1, -1):
        done = ends[c] - 1
        while done > tails[c]:
            found, done = sa[tails[c] + 1 : done + 1][::-1], tails[c]
            before = found[found > 0] - 1
            before = before[smaller[before]]
            _spread(before, text[before], tails, sa, -1)
        found = sa[starts[c] : heads[c]][::-1]
        before = found[found > 0] - 1
        before = before[smaller[before]]
        _spread(before, text[before], tails, sa, -1)
    return sa


def _induced_sparse(text: np.ndarray, smaller: np.ndarray, lms: np.ndarray, size: int) -> np.ndarray:
    counts = np.bincount(text, minlength=size)
    ends = np.cumsum(counts)
    symbols, small, sa = text.tolist(), smaller.tolist(), [-1] * len(text)
    tails, heads = (ends - 1).tolist(), (ends - counts).tolist()
    for i in reversed(lms.tolist()):
        c = symbols[i]
        sa[tails[c]] = i
        tails[c] -= 1
    for i in range(len(sa)):  # the list grows in front of the scan
        j = sa[i] - 1
        if j >= 0 and not small[j]:
            c = symbols[j]
            sa[heads[c]] = j
            heads[c] += 1
    tails = (ends - 1).tolist()
    for i in range(len(sa) - 1, -1, -1):
        j = sa[i] - 1
        if j >= 0 and small[j]:
            c = symbols[j]
            sa[tails[c]] = j
            tails[c] -= 1
    return np.array(sa, np.int64)


def _names(text: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """A number for each LMS substring in order, equal ones alike."""
    ends = np.append(lms[1:], len(text) - 1)
    place = np.searchsorted(lms, ordered)
    length = ends[place] - ordered
    same = np.append(False, length[1:] == length[:-1])
    left, active, offset = np.append(-1, ordered[:-1]), np.flatnonzero(same), 0
    while len(active):
        equal = text[left[active] + offset] == text[ordered[active] + offset]
        same[active[~equal]] = False
        offset += 1
        active = active[equal]
        active = active[length[active] >= offset]
    return np.cumsum(~same) - 1


def suffix_array(text: np.ndarray, size: int) -> np.ndarray:
    """The suffixes of ``text`` in order; symbols are below ``size`` and the last one is the only 0."""
    n = len(text)
    if n == 1:
        return np.zeros(1, np.int64)
    induced = _induced_dense if n >= DENSE * size else _induced_sparse
    smaller, lms = classified(text)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    first = induced(text, smaller, lms, size)
    ordered = first[is_lms[first]]
    names = _names(text, lms, ordered)
    if names[-1] + 1 < len(lms):
        reduced = np.empty(len(lms), np.int64)
        reduced[np.searchsorted(lms, ordered)] = names
        ordered = lms[suffix_array(reduced, int(names[-1]) + 1)]
    return induced(text, smaller, ordered, size)


def permuted_prefixes(data: np.ndarray, sa: np.ndarray, limit: int) -> np.ndarray:
    """For each place of ``data`` (bytes), in the order of places, how much its suffix shares with the suffix before it in
    ``sa``, up to ``limit``; what lies beyond the end of the data counts as zeros."""
    n = len(data)
    padded = np.append(data, np.zeros(limit + 16, np.uint8))
    words = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(padded, 8)).view("<u8").ravel()
    before = np.full(n, -1, np.int64)
    before[sa[1:]] = sa[:-1]
    shared = np.zeros(n, np.int64)
    active = np.flatnonzero(before >= 0)
    for offset in range(0, limit, 8):
        differs = words[active + offset] ^ words[before[active] + offset]
        ended = differs != 0
        low = differs[ended]
        shared[active[ended]] = offset + np.bitwise_count((low & (~low + np.uint64(1))) - np.uint64(1)) // 8
        active = active[~ended]
        shared[active] = offset + 8
    return np.minimum(shared, limit)
