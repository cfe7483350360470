"""A suffix array by induced sorting, and permuted common prefixes, on arrays.

The steps of the induction run bucket by bucket: what a bucket's suffixes induce is
appended to the buckets of the preceding characters in one array operation, and
what falls into the same bucket is a further round of it.
"""

from __future__ import annotations

import numpy as np


def smaller_than_next(t: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the one after it (S-type). The last
    character must be the smallest and occur once; its type is S."""
    n = len(t)
    out = np.ones(n, bool)
    change = np.flatnonzero(t[1:] != t[:-1])  # the type of an equal run is that of its last character
    if len(change):
        out[: change[-1] + 1] = np.repeat(t[change] < t[change + 1], np.diff(np.append(-1, change)))
    return out


def _ranked(values: np.ndarray) -> np.ndarray:
    """For each element, how many equal ones stand before it."""
    order = np.argsort(values.astype(np.uint16), kind="stable")  # 16 bits are sorted by digits
    v = values[order]
    new = np.append(True, v[1:] != v[:-1])
    out = np.empty(len(v), np.int64)
    at = np.arange(len(v))
    out[order] = at - np.maximum.accumulate(np.where(new, at, 0))
    return out


def induce(t: np.ndarray, s_type: np.ndarray, lms: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """All suffixes in the order that the given order of the leftmost-smaller
    ones induces. ``bounds``: first place of each character's bucket, and the end."""
    n, chars = len(t), len(bounds) - 1
    sa = np.full(n, -1, np.int64)
    # larger suffixes, from the front
    head = bounds[:-1].copy()
    of = [lms[k] for k in _groups(t[lms], chars)]

    def append(found: np.ndarray) -> None:
        c = t[found]
        sa[head[c] + _ranked(c)] = found
        head[:] += np.bincount(c, minlength=chars)

    for c in range(chars):
        at = bounds[c]
        while at < head[c]:
            block, at = sa[at : head[c]], head[c]
            before = block[block > 0] - 1
            before = before[~s_type[before]]
            if len(before):
                append(before)
        before = of[c][of[c] > 0] - 1  # the smaller ones of the bucket come after its larger ones
        if len(before):
            append(before[~s_type[before]])
    # smaller suffixes, from the back
    tail = bounds[1:].copy()

    def prepend(found: np.ndarray) -> None:
        c = t[found]
        sa[tail[c] - 1 - _ranked(c)] = found
        tail[:] -= np.bincount(c, minlength=chars)

    prepend(np.array([n - 1]))
    for c in range(chars - 1, -1, -1):
        at = bounds[c + 1]
        while at > tail[c]:
            block, at = sa[tail[c] : at][::-1], tail[c]
            before = block[block > 0] - 1
            before = before[s_type[before]]
            if len(before):
                prepend(before)
        block = sa[bounds[c] : head[c]][::-1]
        before = block[block > 0] - 1
        before = before[s_type[before]]
        if len(before):
            prepend(before)
    return sa


def _groups(values: np.ndarray, chars: int) -> list[np.ndarray]:
    order = np.argsort(values.astype(np.uint16), kind="stable")
    return np.split(order, np.cumsum(np.bincount(values, minlength=chars))[:-1])


def _names(t: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Ranks of substrings that come in sorted order, equal ones alike."""
    same = lengths[1:] == lengths[:-1]
    rows, k = np.flatnonzero(same), 0
    while len(rows):
        rows = rows[lengths[rows] > k]
        differ = t[starts[rows] + k] != t[starts[rows + 1] + k]
        same[rows[differ]] = False
        rows, k = rows[~differ], k + 1
    return np.append(0, np.cumsum(~same))


def suffix_array(t: np.ndarray) -> np.ndarray:
    """The suffix array of an array of small integers (0 to some hundreds) whose
    last element is 0 and the only 0."""
    n = len(t)
    if t.max() > 0xFFFF:
        raise ValueError("characters of 16 bits at most")
    if n == 1:
        return np.zeros(1, np.int64)
    t = t.astype(np.int64)
    s_type = smaller_than_next(t)
    lms = np.flatnonzero(s_type[1:] & ~s_type[:-1]) + 1
    bounds = np.append(0, np.cumsum(np.bincount(t)))
    if len(lms) > 1:
        # sort the leftmost-smaller substrings by induction from any order, and name them
        sa = induce(t, s_type, lms, bounds)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        ordered = sa[is_lms[sa]]
        ends = np.append(lms[1:] + 1, n)
        length = np.zeros(n, np.int64)
        length[lms] = ends - lms
        name = np.empty(n, np.int64)
        name[ordered] = _names(t, ordered, length[ordered])
        lms = lms[_sorted_names(name[lms])]
    return induce(t, s_type, lms, bounds)


def _sorted_names(names: np.ndarray) -> np.ndarray:
    """The suffix array of the reduced string. Its alphabet is about as large as
    itself, so it is not induced by bucket: ranks are given to pairs of ranks, again
    and again, and only the suffixes that still share one are sorted further."""
    step, n = 1, len(names)
    order = np.argsort(names)
    rows, key, base = order, names[order], np.zeros(n, np.int64)
    rank, at = np.empty(n, np.int64), np.arange(n)
    while True:
        # a rank is the place of the first suffix that has it
        first = np.append(True, key[1:] != key[:-1])
        group = np.append(True, base[1:] != base[:-1])
        at = at[: len(rows)]
        rank[rows] = base + np.maximum.accumulate(np.where(first, at, 0)) - np.maximum.accumulate(np.where(group, at, 0))
        rows = rows[~(first & np.append(first[1:], True))]
        if not len(rows):
            break
        after = np.zeros(len(rows), np.int64)
        inside = rows + step < n
        after[inside] = rank[rows[inside] + step] + 1
        key = rank[rows] * (n + 1) + after
        order = np.argsort(key)
        rows, key = rows[order], key[order]
        base, step = key // (n + 1), step * 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order


def permuted_prefixes(text: np.ndarray, left: np.ndarray, sa: np.ndarray, most: int) -> np.ndarray:
    """Per position of ``text`` (bytes), the length of the prefix it has in common
    with the suffix before it in ``sa`` (0 for the first), at most ``most`` and at
    most ``left``, the bytes to its segment's end. sa holds positions of text."""
    n = len(text)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    limit = np.zeros(n, np.int64)
    has = phi >= 0
    limit[has] = np.minimum(np.minimum(left[has], left[phi[has]]), most)
    padded = np.append(text, np.zeros(most + 8, np.uint8))
    words = np.ndarray((len(padded) - 7,), "<u8", padded.data, strides=(1,))
    out, rows, k = np.zeros(n, np.int64), np.flatnonzero(limit > 0), 0
    while len(rows):
        differ = words[rows + k] ^ words[phi[rows] + k]
        low = differ & (~differ + np.uint64(1))
        equal = np.where(differ == 0, 8, np.bitwise_count(low - np.uint64(1)) // 8).astype(np.int64)
        out[rows] = np.minimum(k + equal, limit[rows])
        k += 8
        rows = rows[(equal == 8) & (limit[rows] > k)]
    return out
