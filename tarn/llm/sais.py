"""Suffix arrays by induced sorting, with numpy: whole bucket waves are induced at once."""

from __future__ import annotations

import numpy as np


def _places(symbols: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stable order by symbol, the rank of each within its symbol, and the number of each symbol."""
    order = np.argsort(symbols, kind="stable")
    count = np.bincount(symbols, minlength=width)
    rank = np.arange(len(symbols)) - np.repeat(np.cumsum(count) - count, count)
    return order, rank, count


def _induce(s: np.ndarray, is_s: np.ndarray, width: int, lms: np.ndarray) -> np.ndarray:
    """All suffixes sorted from the leftmost-smaller ones given in order."""
    n, used = len(s), np.bincount(s, minlength=width)
    ends = np.cumsum(used)
    starts = ends - used
    sa = np.full(n, -1, np.int64)
    order, rank, count = _places(s[lms], width)
    placed = lms[order]
    sa[ends[s[placed]] - count[s[placed]] + rank] = placed
    heads, symbols = starts.copy(), np.nonzero(used)[0].tolist()

    def push(wave, larger):
        before = wave[wave > 0] - 1
        before = before[is_s[before] != larger]
        if not len(before):
            return
        if len(before) == 1:
            c = s[before[0]]
            if larger:
                sa[heads[c]] = before[0]
                heads[c] += 1
            else:
                heads[c] -= 1
                sa[heads[c]] = before[0]
            return
        symbol = s[before]
        order = np.argsort(symbol, kind="stable")
        before, symbol = before[order], symbol[order]
        first = np.concatenate([[0], np.nonzero(symbol[1:] != symbol[:-1])[0] + 1])
        size = np.diff(np.append(first, len(symbol)))
        rank = np.arange(len(symbol)) - np.repeat(first, size)
        if larger:
            sa[heads[symbol] + rank] = before
            heads[symbol[first]] += size
        else:
            sa[heads[symbol] - 1 - rank] = before
            heads[symbol[first]] -= size

    for c in symbols:  # larger suffixes, smallest bucket first
        at = starts[c]
        while at < heads[c]:
            upto = heads[c]
            push(sa[at:upto], True)
            at = upto
        if count[c]:
            push(sa[ends[c] - count[c]:ends[c]], True)
    larger_end = heads.copy()
    heads = ends.copy()
    heads[0] -= 1  # the end of the string keeps its place
    for c in reversed(symbols):  # smaller suffixes, largest bucket first
        at = ends[c]
        while at > heads[c]:
            downto = heads[c]
            push(sa[downto:at][::-1], False)
            at = downto
        if larger_end[c] > starts[c]:
            push(sa[starts[c]:larger_end[c]][::-1], False)
    return sa


def _sort_names(names: np.ndarray, depth: int) -> np.ndarray:
    """Order of the suffixes of a string of names, by its first ``depth`` names at least: ranks of pairs, doubling."""
    n, reach = len(names), 1
    rank = names.astype(np.int64)
    while True:
        following = np.zeros(n, np.int64)
        following[:n - reach] = rank[reach:] + 1
        pair = rank * (n + 2) + following
        order = np.argsort(pair, kind="stable")
        fresh = np.concatenate([[0], np.cumsum(np.diff(pair[order]) != 0)])
        rank = np.empty(n, np.int64)
        rank[order] = fresh
        reach *= 2
        if fresh[-1] == n - 1 or reach >= depth:
            return order


def suffix_array(s: np.ndarray, width: int, depth: int | None = None) -> np.ndarray:
    """Suffix array of symbols below ``width``; the last symbol must be the only 0.

    Leftmost-smaller substrings are named and, where names repeat, the string
    of names is sorted by doubling: with numpy that is faster than descending
    into ever wider alphabets.  With ``depth`` suffixes that share so many
    symbols may come in any order.
    """
    n = len(s)
    if n == 1:
        return np.zeros(1, np.int64)
    step = s[:-1] - s[1:]
    following = np.minimum.accumulate(np.where(step != 0, np.arange(n - 1), n)[::-1])[::-1]
    is_s = np.append(step[following] < 0, True)
    is_lms = np.zeros(n, bool)
    is_lms[1:] = is_s[1:] & ~is_s[:-1]
    lms = np.nonzero(is_lms)[0]
    sa = _induce(s, is_s, width, lms)
    ordered = sa[is_lms[sa]]
    ending = np.empty(n, np.int64)
    ending[lms] = np.append(lms[1:], lms[-1]) - lms
    a, b = ordered[:-1], ordered[1:]
    same = ending[a] == ending[b]
    left, k = np.nonzero(same)[0], 0
    while len(left):
        unequal = s[a[left] + k] != s[b[left] + k]
        same[left[unequal]] = False
        left = left[~unequal & (ending[a[left]] > k)]
        k += 1
    names = np.empty(n, np.int64)
    names[ordered] = np.concatenate([[0], np.cumsum(~same)])
    if not same.any():
        return _induce(s, is_s, width, ordered)
    return _induce(s, is_s, width, lms[_sort_names(names[lms], n if depth is None else depth)])


def text_suffix_array(data: bytes, depth: int | None = None) -> np.ndarray:
    """Suffix array of bytes, without the empty suffix; ordered by ``depth`` bytes if that is given."""
    s = np.zeros(len(data) + 1, np.int64)
    s[:-1] = np.frombuffer(data, np.uint8)
    s[:-1] += 1
    return suffix_array(s, 257, depth)[1:]


def common_prefixes(data: bytes, sa: np.ndarray, most: int) -> np.ndarray:
    """Permuted common prefixes: for each place of the text, the bytes its suffix shares with the one sorted before it.

    Counted up to ``most``.  Where a place and the next one have neighbours that
    follow each other too, the next one shares a byte less, so bytes are compared
    only at the last place of each such chain: eight at a time, a pair leaves as
    soon as it differs.
    """
    n = len(data)
    padded = np.frombuffer(data + bytes(most + 16), np.uint8)
    words = np.ndarray((n + most + 8,), "<u8", padded, strides=(1,))
    place = np.arange(n)
    before = np.full(n, n, np.int64)  # the first suffix in order shares nothing
    before[sa[1:]] = sa[:-1]
    equal_here = (padded[:n] == padded[before]) & (before < n)
    chained = np.zeros(n, bool)
    chained[:-1] = (before[1:] == before[:-1] + 1) & (before[1:] < n)
    ends = np.nonzero(equal_here & ~chained)[0]
    shared = np.zeros(n, np.int64)
    left = ends
    while len(left):
        at, other = left + shared[left], before[left] + shared[left]
        apart = words[at] ^ words[other]
        lowest = apart & (~apart + np.uint64(1))  # its place tells the first differing byte
        equal = np.where(apart == 0, 8, (np.bitwise_count(lowest - np.uint64(1)) // 8).astype(np.int64))
        shared[left] += equal
        left = left[(equal == 8) & (shared[left] < most)]
    shared[ends] = np.minimum(shared[ends], np.minimum(n - ends, n - before[ends]))  # the padding is no part of the text
    # A chain stops where its bytes differ, or where its last place stops.
    stops = np.where(equal_here & chained, n, place)
    following = np.minimum.accumulate(stops[::-1])[::-1]
    return np.minimum(following + shared[following] - place, most)
