"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Induced sorting: suffixes are S (smaller than the next suffix) or L; leftmost S suffixes are sorted by naming the substrings between
them and sorting the string of names recursively; then every L suffix follows from a smaller one and every S suffix from a larger one,
in one scan each. The scans go bucket by bucket, since all suffixes of a bucket can be induced at once, a run of one symbol in
waves. A string of names over a large alphabet is sorted by doubling ranks of what is still tied.
"""

from __future__ import annotations

import numpy as np

#: Alphabets above this are sorted by doubling instead of by buckets.
MANY = 1024


def types(s: np.ndarray) -> np.ndarray:
    """True for S suffixes. s ends with a unique smallest symbol."""
    change = np.flatnonzero(s[:-1] != s[1:])
    kind = s[change] < s[change + 1]
    out = np.ones(len(s), bool)
    out[: change[-1] + 1 if len(change) else 0] = np.repeat(kind, np.diff(np.concatenate([[-1], change])))
    return out


def name_substrings(s: np.ndarray, is_s: np.ndarray, lms: np.ndarray) -> tuple[np.ndarray, int]:
    """Ranks of the substrings from one leftmost S suffix to the next, both ends included; equal substrings share a rank."""
    typed = 2 * s.astype(np.int64) + is_s + 1  # at an equal symbol an L suffix is smaller than an S suffix
    size = np.diff(np.append(lms, len(s) - 1)) + 1
    bits = int(typed.max() + 1).bit_length()
    pack = max(1, 62 // bits)
    rank = np.zeros(len(lms), np.int64)
    tied, at = np.arange(len(lms)), 0
    while len(tied):
        key = np.zeros(len(tied), np.int64)
        for d in range(at, at + pack):
            inside = d < size[tied]
            key = (key << bits) | np.where(inside, typed[np.minimum(lms[tied] + d, len(s) - 1)], 0)
        order = np.argsort(key)
        order = order[np.argsort(rank[tied][order], kind="stable")] if at else order
        r, k = rank[tied][order], key[order]
        new = np.concatenate([[True], (r[1:] != r[:-1]) | (k[1:] != k[:-1])])
        group = np.concatenate([[True], r[1:] != r[:-1]])
        # a rank is the number of smaller substrings, so splitting a tie leaves all other ranks
        head = np.maximum.accumulate(np.where(new, np.arange(len(r)), 0))
        base = np.maximum.accumulate(np.where(group, np.arange(len(r)), 0))
        rank[tied[order]] = r + head - base
        at += pack
        alone = new & np.append(new[1:], True)
        left = tied[order[~alone]]
        tied = left[size[left] > at]
    _, dense = np.unique(rank, return_inverse=True)
    return dense.astype(np.int64), int(dense.max(initial=-1)) + 1


def by_doubling(s: np.ndarray, depth: int) -> np.ndarray:
    """Suffix array of s, right at least for the first `depth` symbols, by doubling the ranks of ties."""
    order = np.argsort(s, kind="stable")
    v = s[order]
    new = np.concatenate([[True], v[1:] != v[:-1]])
    rank = np.empty(len(s), np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(s)), 0))
    alone = new & np.append(new[1:], True)
    tied, step = order[~alone], 1
    while len(tied) and step < depth:
        after = tied + step
        key = np.where(after < len(s), rank[np.minimum(after, len(s) - 1)] + 1, 0)
        both = rank[tied] * (len(s) + 1) + key
        o = np.argsort(both)
        r, b, t = rank[tied][o], both[o], tied[o]
        new = np.concatenate([[True], b[1:] != b[:-1]])
        group = np.concatenate([[True], r[1:] != r[:-1]])
        n = np.arange(len(t))
        rank[t] = r + np.maximum.accumulate(np.where(new, n, 0)) - np.maximum.accumulate(np.where(group, n, 0))
        tied = t[~(new & np.append(new[1:], True))]
        step *= 2
    return np.argsort(rank, kind="stable")


def _deal(pending: list, items: np.ndarray, symbol: np.ndarray) -> None:
    """Append items to the lists of their symbols, keeping their order."""
    if len(items) == 0:
        return
    order = np.argsort(symbol, kind="stable")
    items, symbol = items[order], symbol[order]
    head = np.flatnonzero(np.concatenate([[True], symbol[1:] != symbol[:-1]]))
    stop = np.append(head[1:], len(items))
    for c, a, b in zip(symbol[head].tolist(), head.tolist(), stop.tolist()):
        pending[c].append(items[a:b])


def _joined(parts: list) -> np.ndarray:
    return np.concatenate(parts) if len(parts) > 1 else parts[0] if parts else np.empty(0, np.int32)


def induce(s: np.ndarray, sorted_lms: np.ndarray, alphabet: int) -> np.ndarray:
    """All suffixes in order, from the leftmost S suffixes in order."""
    n = len(s)
    sorted_lms = sorted_lms.astype(np.int32)
    seed: list[list] = [[] for _ in range(alphabet)]
    _deal(seed, sorted_lms, s[sorted_lms])
    pending: list[list] = [[] for _ in range(alphabet)]
    low: list[np.ndarray] = []
    for c in range(alphabet):
        wave, own, moved = _joined(pending[c]), [], []
        pending[c] = []
        while len(wave):
            own.append(wave)
            before = wave[wave > 0] - 1
            symbol = s[before]
            moved.append(before[symbol > c])
            wave = before[symbol == c]
        low.append(_joined(own))
        lms = _joined(seed[c])
        before = lms[lms > 0] - 1
        moved.append(before)  # what stands before a leftmost S suffix is larger
        before = _joined(moved)
        _deal(pending, before, s[before])
    high: list[np.ndarray] = [np.empty(0, np.int32)] * alphabet
    pending = [[] for _ in range(alphabet)]
    pending[int(s[-1])].append(np.array([n - 1], np.int32))
    for c in range(alphabet - 1, -1, -1):
        wave, own, moved = _joined(pending[c]), [], []
        pending[c] = []
        while len(wave):
            own.append(wave)
            before = wave[wave > 0] - 1
            symbol = s[before]
            moved.append(before[symbol < c])
            wave = before[symbol == c]
        down = _joined(own)
        last = low[c][::-1]
        before = last[last > 0] - 1
        moved.append(before[s[before] < c])
        before = _joined(moved)
        _deal(pending, before, s[before])
        high[c] = down[::-1]
    return np.concatenate([x for c in range(alphabet) for x in (low[c], high[c])])


def suffix_array(s: np.ndarray, alphabet: int, depth: int) -> np.ndarray:
    """Suffix array of s, which ends with a unique smallest symbol 0; right at least for the first `depth` symbols."""
    n = len(s)
    if n <= 2 or alphabet > MANY:
        return by_doubling(s, depth)
    is_s = types(s)
    lms = np.flatnonzero(is_s[1:] & ~is_s[:-1]) + 1
    if len(lms) < 2:
        return induce(s, lms, alphabet)
    names, count = name_substrings(s, is_s, lms)
    if count == len(lms):
        order = np.argsort(names, kind="stable")
    else:
        # leftmost S suffixes are at least two symbols apart
        order = suffix_array(names, count, depth // 2 + 2)
    return induce(s, lms[order], alphabet)


def common_prefixes(s: np.ndarray, sa: np.ndarray, starts: np.ndarray, least: int, most: int, equal) -> np.ndarray:
    """Permuted common prefixes: for each text position the common prefix, up to `most`, with the suffix before it in the array;
    prefixes shorter than `least` are not told apart and given as 0.

    Where the symbols before a suffix and before its neighbour agree, the prefix is one less than at the position before; elsewhere it is
    measured by `equal(i, j, length)`. `starts` are measured as well, so that `most` need only be the longest stretch between them.
    """
    n = len(s)
    phi = np.full(n, -1, np.int64)
    phi[sa[1:]] = sa[:-1]
    fresh = phi <= 0
    fresh[1:] |= s[:-1] != s[np.maximum(phi[1:] - 1, 0)]
    fresh[0] = True
    fresh[starts] = True
    i = np.flatnonzero(fresh & (phi >= 0))
    j = phi[i]
    top = np.minimum(n - np.maximum(i, j), most)
    low = np.zeros(len(i), np.int64)
    # one look at `least` symbols; what agrees there is measured by halving
    live = np.flatnonzero(top >= least)
    live = live[equal(i[live], j[live], np.full(len(live), least))]
    low[live] = least
    live = live[low[live] < top[live]]
    while len(live):
        mid = (low[live] + top[live] + 1) >> 1
        same = equal(i[live], j[live], mid)
        low[live[same]] = mid[same]
        top[live[~same]] = mid[~same] - 1
        live = live[low[live] < top[live]]
    plcp = np.zeros(n, np.int64)
    plcp[i] = low
    at = np.arange(n)
    source = np.maximum.accumulate(np.where(fresh, at, 0))
    return np.maximum(plcp[source] - (at - source), 0)
