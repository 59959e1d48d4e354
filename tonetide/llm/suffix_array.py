"""Suffix arrays by induced sorting, with numpy (for use inside tasks).

Suffixes are classified as larger (L) or smaller (S) than their right neighbour; the leftmost S of each run
(LMS) are sorted first, everything else is induced from them in one pass up and one pass down the
buckets of first bytes. Inside a bucket the pass moves in rounds, one for each repeat of its byte, so
all work is on whole arrays. LMS substrings are sorted by inducing once from unsorted LMS positions
and named; while names repeat, the string of names is sorted recursively by names of pairs, which
doubles the length that a name covers each time.
"""

from __future__ import annotations

import numpy as np



def suffix_types(t: np.ndarray) -> np.ndarray:
    """True for S: the suffix is smaller than the next one. The last suffix is L; an end is smallest."""
    n = len(t)
    up = np.zeros(n, bool)
    if n < 2:
        return up
    change = np.flatnonzero(t[1:] != t[:-1])  # each run of equal bytes takes the type of its last byte
    rises = t[change + 1] > t[change]
    ends = np.append(change, n - 1)
    up[:] = np.repeat(np.append(rises, False), np.diff(np.append(-1, ends)))
    return up


class Buckets:
    """Bounds of each byte's suffixes: L-types first, then S-types."""

    def __init__(self, t: np.ndarray, is_s: np.ndarray):
        self.all = np.bincount(t, minlength=256)
        self.s = np.bincount(t[is_s], minlength=256)
        self.end = np.cumsum(self.all)
        self.start = self.end - self.all
        self.used = np.flatnonzero(self.all)


def _deal(sa, chars, items, pointer, downwards):
    """Append ``items`` in order to the buckets of ``chars``."""
    order = np.argsort(chars, kind="stable")
    chars, items = chars[order], items[order]
    cuts = np.flatnonzero(np.diff(chars)) + 1
    for lo, hi in zip(np.append(0, cuts), np.append(cuts, len(chars))):
        if hi > lo:
            c = chars[lo]
            if downwards:
                pointer[c] -= hi - lo
                sa[pointer[c]: pointer[c] + hi - lo] = items[lo:hi][::-1]
            else:
                sa[pointer[c]: pointer[c] + hi - lo] = items[lo:hi]
                pointer[c] += hi - lo


def induce(t: np.ndarray, is_s: np.ndarray, buckets: Buckets, lms: np.ndarray) -> np.ndarray:
    """All suffixes in order, given the LMS suffixes in order (or LMS substrings, from any order)."""
    n = len(t)
    sa = np.empty(n, np.int32)
    by_byte = np.argsort(t[lms], kind="stable")
    lms_of = np.split(lms[by_byte], np.cumsum(np.bincount(t[lms], minlength=256))[:-1])

    head = buckets.start.copy()  # next free place of the L-part of each bucket
    last = t[n - 1]
    sa[head[last]] = n - 1  # the last suffix is the smallest L of its bucket
    head[last] += 1
    for c in buckets.used:
        done, scanned = buckets.start[c], []
        while done < head[c]:
            now = sa[done:head[c]]
            done = head[c]
            before = now[now > 0] - 1
            before = before[~is_s[before]]
            own = t[before] == c
            same = before[own]
            sa[head[c]: head[c] + len(same)] = same
            head[c] += len(same)
            scanned.append(before[~own])
        first = lms_of[c]
        scanned.append(first[first > 0] - 1)
        after = np.concatenate(scanned)
        _deal(sa, t[after], after, head, False)

    tail = buckets.end.copy()  # end of what is still free of the S-part of each bucket
    for c in buckets.used[::-1]:
        done, scanned = buckets.end[c], []
        while done > tail[c]:
            now = sa[tail[c]:done][::-1]
            done = tail[c]
            before = now[now > 0] - 1
            before = before[is_s[before]]
            own = t[before] == c
            same = before[own]
            tail[c] -= len(same)
            sa[tail[c]: tail[c] + len(same)] = same[::-1]
            scanned.append(before[~own])
        larger = sa[buckets.start[c]: buckets.end[c] - buckets.s[c]][::-1]
        before = larger[larger > 0] - 1
        scanned.append(before[is_s[before]])
        after = np.concatenate(scanned)
        _deal(sa, t[after], after, tail, True)
    return sa


def differ(t: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether each string ``t[start:end]`` differs from the one before it: eight bytes at a time, while pairs agree."""
    out = np.diff(ends - starts) != 0
    eight = np.lib.stride_tricks.sliding_window_view(np.concatenate((t, np.zeros(8, t.dtype))).astype(np.uint8), 8)
    candidates = np.flatnonzero(~out)
    for lo in range(0, len(candidates), 1 << 18):
        pair = candidates[lo:lo + (1 << 18)]
        size, k = (ends - starts)[pair], 0
        while len(pair):
            inside = np.arange(8) < (size - k)[:, None]  # bytes beyond the string don't count
            equal = ((eight[starts[pair] + k] == eight[starts[pair + 1] + k]) | ~inside).all(axis=1)
            out[pair[~equal]] = True
            k += 8
            going = equal & (size > k)
            pair, size = pair[going], size[going]
    return out


def sorted_names(names: np.ndarray, reach: int) -> np.ndarray:
    """Order of the suffixes of a string of names; names that cover ``reach`` items may stay equal."""
    def recurse(rank: np.ndarray, covered: int) -> np.ndarray:
        n = len(rank)
        counts = np.bincount(rank)
        if covered >= min(reach, n) or counts.max(initial=0) <= 1:
            return rank
        follow = np.full(n, -1, np.int64)
        follow[: max(n - covered, 0)] = rank[covered:]
        open_ = np.flatnonzero(counts[rank] > 1)  # only names that repeat need a longer look
        key = rank[open_] * (n + 1) + follow[open_] + 1
        order = np.argsort(key, kind="stable")
        fresh = np.concatenate(([True], np.diff(key[order]) != 0))
        # A name stays at the first place of its group, so longer names fall between the old ones.
        start = np.concatenate(([0], np.cumsum(counts)[:-1]))
        base = np.empty(n, np.int64)
        base[:] = start[rank]
        group = rank[open_][order]
        place = np.arange(len(order)) - np.maximum.accumulate(np.where(np.concatenate(([True], np.diff(group) != 0)), np.arange(len(order)), 0))
        place = np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0)) - (np.arange(len(order)) - place)
        base[open_[order]] = start[group] + place
        dense = np.unique(base, return_inverse=True)[1]
        return recurse(dense, covered * 2)

    return np.argsort(recurse(names.astype(np.int64), 1), kind="stable")


def suffix_array(t: np.ndarray, reach: int) -> np.ndarray:
    """Suffixes of the bytes ``t`` in order of at least their first ``reach`` bytes."""
    if len(t) == 0:
        return np.zeros(0, np.int32)
    is_s = suffix_types(t)
    buckets = Buckets(t, is_s)
    lms = (np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1).astype(np.int32)
    if len(lms) > 1:
        rough = induce(t, is_s, buckets, lms)
        flag = np.zeros(len(t), bool)
        flag[lms] = True
        by_substring = rough[flag[rough]]
        end = np.empty(len(t), np.int64)
        end[lms] = np.minimum(np.append(lms[1:], len(t) - 1) + 1, len(t))
        new = np.concatenate(([True], differ(t, by_substring, end[by_substring])))
        last = int(np.flatnonzero(by_substring == lms[-1])[0])
        new[last: last + 2] = True  # it ends with the text and equals no other
        name = np.empty(len(t), np.int64)
        name[by_substring] = np.cumsum(new) - 1
        lms = lms[sorted_names(name[lms], reach)]
    return induce(t, is_s, buckets, lms)


def common_prefixes(t: np.ndarray, order: np.ndarray, limit: int) -> np.ndarray:
    """Permuted common prefixes, up to ``limit``: for each suffix of ``order``, by position, how many first
    bytes it has in common with the one before it in the order. Others have 0.

    The comparison runs over positions, not over the order, so both sides are read nearly in sequence.
    """
    n = len(t)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    plcp = np.zeros(n, np.int32)
    at = np.flatnonzero(before >= 0)
    padded = np.concatenate((t, np.zeros(8, t.dtype))).astype(np.uint64)
    words = np.zeros(n, np.uint64)
    for k in range(8):
        words |= padded[k: n + k] << np.uint64(8 * k)
    other = before[at].astype(np.int64)
    for k in range(0, limit, 8):
        inside = np.maximum(at, other) + k < n
        plcp[at[~inside]] = k
        at, other = at[inside], other[inside]
        differ = words[at + k] ^ words[other + k]
        same = differ == 0
        low = differ[~same]
        low = low & (~low + np.uint64(1))  # lowest differing bit
        plcp[at[~same]] = k + (np.log2(low.astype(np.float64)).astype(np.int32) >> 3)
        at, other = at[same], other[same]
    plcp[at] = limit
    return np.minimum(plcp, n - np.maximum(np.arange(n), before))
