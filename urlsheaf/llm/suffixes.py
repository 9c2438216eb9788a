"""Suffix arrays by induced sorting, and permuted common prefixes, over the bytes of one shard.

Suffixes are classed as smaller or larger than their successor.  The leftmost-smaller (LMS) ones are sorted by sorting
the substrings between them, naming these and sorting the string of names in turn; all other suffixes are induced from
them in one pass up and one pass down the buckets.  A pass handles a bucket's suffixes together, a further time for
every repetition of one letter, so its work is linear in the text.  A string of more different names than
``LARGE_ALPHABET`` is sorted by doubling ranks instead of by buckets, which would hold next to nothing each.
"""

from __future__ import annotations

import numpy as np

LARGE_ALPHABET = 1024


def smaller_than_next(s: np.ndarray) -> np.ndarray:
    """Which suffixes are smaller than the one that begins a place later; the last one is not."""
    n = s.size
    step = np.zeros(n, np.int8)
    step[:-1] = np.sign(s[1:].astype(np.int64) - s[:-1].astype(np.int64))
    step[-1] = -1
    # equal letters: the next step that isn't level decides
    at = np.where(step != 0, np.arange(n), n)
    at = np.minimum.accumulate(at[::-1])[::-1]
    return step[at] > 0


def _append(sa: np.ndarray, heads: np.ndarray, s: np.ndarray, found: np.ndarray, down: bool) -> None:
    """Put suffixes, in their order, at the free ends of their letters' buckets."""
    letters = s[found]
    order = np.argsort(letters, kind="stable")
    letters = letters[order]
    starts = np.flatnonzero(np.concatenate([[True], letters[1:] != letters[:-1]]))
    counts = np.diff(np.append(starts, letters.size))
    within = np.arange(letters.size) - np.repeat(starts, counts)
    own = letters[starts]
    base = np.repeat(heads[own], counts)
    sa[base - within if down else base + within] = found[order]
    heads[own] += -counts if down else counts


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The suffix array that follows from LMS suffixes in their order."""
    n = s.size
    ends = np.cumsum(sizes)
    starts = ends - sizes
    lms_letters = s[lms]
    lms_from = np.searchsorted(lms_letters, np.arange(sizes.size))
    lms_to = np.searchsorted(lms_letters, np.arange(sizes.size), "right")
    sa = np.full(n, -1, np.int64)

    heads = starts.copy()
    _append(sa, heads, s, np.array([n - 1]), False)
    for letter in np.flatnonzero(sizes).tolist():
        done = starts[letter]
        while done < heads[letter]:  # larger ones of this bucket, and those they add to it
            end = heads[letter]
            before = sa[done:end] - 1
            done = end
            before = before[before >= 0]
            before = before[~small[before]]
            if before.size:
                _append(sa, heads, s, before, False)
        if lms_to[letter] > lms_from[letter]:
            before = lms[lms_from[letter] : lms_to[letter]] - 1
            _append(sa, heads, s, before[before >= 0], False)
    larger_to = heads

    tails = ends - 1
    for letter in np.flatnonzero(sizes)[::-1].tolist():
        done = ends[letter] - 1
        while done > tails[letter]:  # smaller ones
            end = tails[letter]
            before = sa[end + 1 : done + 1][::-1] - 1
            done = end
            before = before[before >= 0]
            before = before[small[before]]
            if before.size:
                _append(sa, tails, s, before, True)
        before = sa[starts[letter] : larger_to[letter]][::-1] - 1
        before = before[before >= 0]
        before = before[small[before]]
        if before.size:
            _append(sa, tails, s, before, True)
    return sa


def _named(s: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> tuple[np.ndarray, int]:
    """Names of the LMS substrings, in text order: equal for equal ones, in the order of ``ordered``."""
    place = np.empty(s.size, np.int64)
    place[lms] = np.arange(lms.size)
    ends = np.append(lms[1:], s.size - 1)  # a substring reaches up to the next LMS letter
    length = ends[place[ordered]] - ordered + 1
    differs = np.ones(ordered.size, bool)
    active = np.flatnonzero(length[1:] == length[:-1]) + 1
    # the last substring ends with the text, not with an LMS letter: it equals no other
    last = lms[-1]
    active = active[(ordered[active] != last) & (ordered[active - 1] != last)]
    differs[active] = False
    offset = 0
    while active.size:
        unequal = s[ordered[active] + offset] != s[ordered[active - 1] + offset]
        differs[active[unequal]] = True
        offset += 1
        active = active[~unequal & (length[active] > offset)]
    names = np.empty(lms.size, np.int64)
    names[place[ordered]] = np.cumsum(differs) - 1
    return names, int(differs.sum())


def _doubled(s: np.ndarray) -> np.ndarray:
    """The suffix array by ranks of prefixes that double in length."""
    n, span = s.size, 1
    rank = s.astype(np.int64) + 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - span] = rank[span:]
        order = np.lexsort((after, rank)) if rank.max() >= 1 << 31 else np.argsort(rank << 32 | after, kind="stable")
        a, b = rank[order], after[order]
        new = np.concatenate([[1], ((a[1:] != a[:-1]) | (b[1:] != b[:-1])).astype(np.int64)])
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(new)
        span *= 2
        if new.all() or span >= n:
            return order


def suffix_array(s: np.ndarray, letters: int = 256) -> np.ndarray:
    """Places of the suffixes of ``s`` (numbers below ``letters``) in ascending order."""
    n = s.size
    if n < 3:
        return np.array(sorted(range(n), key=lambda i: s[i:].tolist()), np.int64)
    if letters > LARGE_ALPHABET:
        return _doubled(s)
    small = smaller_than_next(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sizes = np.bincount(s, minlength=letters)
    if lms.size > 1:
        by_letter = lms[np.argsort(s[lms], kind="stable")]
        found = _induce(s, small, by_letter, sizes)
        is_lms = np.zeros(n, bool)
        is_lms[lms] = True
        names, count = _named(s, lms, found[is_lms[found]])
        order = np.argsort(names) if count == lms.size else suffix_array(names, count)
        lms = lms[order]
    return _induce(s, small, lms, sizes)


def permuted_common_prefixes(s: np.ndarray, sa: np.ndarray) -> np.ndarray:
    """For each place, how many letters its suffix shares with the one before it in ``sa``.

    Where the letters to the left of both are equal, the value is one less than that a place further left.  Only the
    other values are worked out, eight letters at a time.
    """
    n = s.size
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    own = np.arange(n)
    left = (own > 0) & (phi > 0)
    left[left] = s[own[left] - 1] == s[phi[left] - 1]
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = s
    words = np.zeros(n + 1, np.uint64)
    for k in range(8):
        words[:n] |= padded[k : k + n].astype(np.uint64) << np.uint64(8 * (7 - k))
    places = np.flatnonzero(~left & (phi >= 0))
    other = phi[places]
    value = np.zeros(places.size, np.int64)
    active = np.arange(places.size)
    while active.size:
        a, b = places[active] + value[active], other[active] + value[active]
        room = n - np.maximum(a, b)
        differing = words[np.minimum(a, n)] ^ words[np.minimum(b, n)]
        # leading equal letters of the eight: the exponent of what differs tells
        bits = np.zeros(active.size, np.int64)
        some = differing != 0
        high = (differing[some] >> np.uint64(32)).astype(np.int64)
        low = (differing[some] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        top = np.where(high > 0, np.frexp(high.astype(float))[1] + 32, np.frexp(low.astype(float))[1])
        bits[some] = top
        equal = np.minimum(np.where(some, (64 - bits) // 8, 8), room)
        value[active] += equal
        active = active[(equal == 8) & (room > 8)]
    plcp = np.zeros(n, np.int64)
    plcp[places] = value
    source = np.zeros(n, np.int64)
    source[places] = places
    source = np.maximum.accumulate(source)
    found = plcp[source] - (own - source)
    return np.where(phi >= 0, np.maximum(found, 0), 0)
