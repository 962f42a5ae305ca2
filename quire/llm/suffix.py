"""Suffix arrays by induced sorting, and permuted common prefixes, over numpy arrays.

Both are linear passes whose inner loops run in numpy: suffixes are induced a bucket at a
time (all suffixes of one first byte together, once more for each repeat of that byte), and
common prefixes are compared only where they cannot be derived from the position before.
"""

from __future__ import annotations

import numpy as np

BUCKETS = 4096


def _types(s: np.ndarray) -> np.ndarray:
    """True where the suffix is smaller than the one after it; the last one counts as smaller."""
    n = len(s)
    up = np.empty(n, np.int8)
    up[-1] = 1
    up[:-1] = (s[1:] > s[:-1]).astype(np.int8) - (s[1:] < s[:-1])
    if n > 1:
        at = np.where(up != 0, np.arange(n, dtype=np.int32), np.int32(n))
        up = up[np.minimum.accumulate(at[::-1])[::-1]]  # equal neighbours take the type of the next difference
    return up > 0


def _deal(sa: np.ndarray, edge: np.ndarray, j: np.ndarray, ch: np.ndarray, step: int) -> None:
    """Append ``j`` to the buckets of ``ch``, in order, at ``edge`` moving by ``step``."""
    order = np.argsort(ch, kind="stable")
    ch, j = ch[order], j[order]
    first = np.flatnonzero(np.concatenate(([True], ch[1:] != ch[:-1])))
    size = np.diff(np.append(first, len(ch)))
    rank = np.arange(len(ch)) - np.repeat(first, size)
    sa[edge[ch] + step * rank] = j
    edge[ch[first]] += step * size


def _induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, k: int) -> np.ndarray:
    """The suffix array of ``s`` from its leftmost-smaller suffixes in the order ``lms``."""
    n = len(s)
    size = np.bincount(s, minlength=k)
    end = np.cumsum(size)
    start = end - size
    sa = np.full(n, -1, np.int32)
    by = lms[np.argsort(s[lms], kind="stable")]
    cut = np.searchsorted(s[by], np.arange(k + 1))
    head = start.copy()
    used = np.flatnonzero(size)
    for c in used:
        done = start[c]
        while done < head[c]:
            cur = sa[done:head[c]]
            done = head[c]
            j = cur[cur > 0] - 1
            j = j[~small[j]]
            if len(j):
                _deal(sa, head, j, s[j], 1)
        own = by[cut[c]:cut[c + 1]]
        j = own[own > 0] - 1
        if len(j):
            _deal(sa, head, j, s[j], 1)
    tail = end - 1
    last = by[cut[0]:cut[1]]  # the sentinel suffix stands first and is induced by nothing
    if len(last):
        sa[start[0]:start[0] + len(last)] = last
        tail[0] = start[0] - 1
    for c in used[::-1]:
        done = end[c] - 1 if c else start[c] - 1
        while done > tail[c]:
            cur = sa[tail[c] + 1:done + 1][::-1]
            done = tail[c]
            j = cur[cur > 0] - 1
            j = j[small[j]]
            if len(j):
                _deal(sa, tail, j, s[j], -1)
        cur = sa[start[c]:head[c]][::-1]
        j = cur[cur > 0] - 1
        j = j[small[j]]
        if len(j):
            _deal(sa, tail, j, s[j], -1)
    return sa


def _same_parts(s: np.ndarray, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether ``s[a:a+size]`` equals ``s[b:b+size]``, for each pair."""
    out = np.ones(len(a), bool)
    live = np.arange(len(a))
    step = 0
    while len(live):
        live = live[step < size[live]]
        same = s[a[live] + step] == s[b[live] + step]
        out[live[~same]] = False
        live = live[same]
        step += 1
    return out


def _doubled(r: np.ndarray) -> np.ndarray:
    """Suffix order of the names ``r`` by doubling the compared length: for alphabets too wide for buckets."""
    m = len(r)
    rank = np.unique(r, return_inverse=True)[1].astype(np.int64)
    step = 1
    while True:
        after = np.full(m, 0, np.int64)
        after[:m - step] = rank[step:] + 1
        key = rank * (m + 2) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        fresh = np.empty(m, np.int64)
        fresh[order] = np.concatenate(([0], np.cumsum(key[1:] != key[:-1])))
        rank = fresh
        if rank.max() == m - 1 or step >= m:
            return order
        step *= 2


def suffix_array(s: np.ndarray, k: int | None = None) -> np.ndarray:
    """Suffix array of ``s``, whose last value is 0 and occurs there alone."""
    n = len(s)
    if n <= 1:
        return np.arange(n)
    k = int(s.max()) + 1 if k is None else k
    if k > BUCKETS:
        return _doubled(s)
    small = _types(s)
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    sa = _induce(s, small, lms, k)
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    order = sa[is_lms[sa]]
    if len(order) > 1:
        place = np.zeros(n, np.int32)
        place[lms] = np.arange(len(lms))
        span = np.append(np.diff(lms) + 1, 1)  # a part reaches to the next one's first value
        a, b = order[:-1], order[1:]
        la, lb = span[place[a]], span[place[b]]
        same = la == lb
        same[same] = _same_parts(s, a[same], b[same], la[same])
        name = np.concatenate(([0], np.cumsum(~same)))
        if name[-1] < len(lms) - 1:
            reduced = np.empty(len(lms), np.int64)
            reduced[place[order]] = name
            order = lms[suffix_array(reduced, int(name[-1]) + 1)]
    return _induce(s, small, order, k)


def common_prefixes(s: np.ndarray, sa: np.ndarray, most: int, stop: int | None = None) -> np.ndarray:
    """For each position, the length (up to ``most``) it shares with the suffix before it in the array.

    With ``stop``, lengths end before the next value ``stop`` (the end of a part).

    In text order a value falls by at most one from the position before. Where the byte before
    equals the byte before the compared suffix it falls by exactly one; only at other positions
    are bytes compared, eight at a time.
    """
    n = len(s)
    before = np.full(n, -1, np.int32)
    before[sa[1:]] = sa[:-1]
    i = np.arange(n, dtype=np.int32)
    derived = np.zeros(n, bool)
    p = before[1:]
    derived[1:] = (p > 0) & (s[:-1] == s[np.maximum(p, 1) - 1])
    far = np.full(n, n, np.int32)
    if stop is not None:
        derived[1:] &= s[:-1] != stop
        far = np.minimum.accumulate(np.where(s == stop, i, np.int32(n))[::-1])[::-1]
    at = np.flatnonzero(~derived & (before >= 0))
    wide = np.zeros(n + 16, np.uint16)
    wide[:n] = s
    ln = np.zeros(len(at), np.int32)
    live = np.arange(len(at), dtype=np.int32)
    a, b = at.astype(np.int32), before[at]
    limit = np.minimum(n - np.maximum(a, b), far[a] - a)
    packed = wide[:-3].astype(np.uint64)
    for t in (1, 2, 3):
        packed |= wide[t:len(wide) - 3 + t].astype(np.uint64) << np.uint64(16 * t)
    while len(live):
        x = packed[a[live] + ln[live]] ^ packed[b[live] + ln[live]]
        low = np.where(x == 0, 4, 0)
        odd = x != 0
        if odd.any():
            y = x[odd]
            low[odd] = np.select([y & np.uint64(0xFFFF) != 0, y & np.uint64(0xFFFF0000) != 0, y & np.uint64(0xFFFF00000000) != 0], [0, 1, 2], 3)
        ln[live] += low
        live = live[(low == 4) & (ln[live] < limit[live])]
    ln = np.minimum(ln, limit)
    # a derived value is the nearest compared one to its left, less the distance
    del packed, wide, far
    value = np.full(n, -1, np.int32)
    value[at] = ln + a
    return np.clip(np.maximum.accumulate(value) - i, 0, most) if n else value


def repeated_starts(parts: list[bytes], length: int) -> list[np.ndarray]:
    """For each part, the starts of its ``length``-byte strings that also start elsewhere in the parts."""
    total = sum(map(len, parts)) + len(parts) + 1
    s = np.ones(total, np.uint16)  # 1 ends a part, 0 ends all
    at = np.empty(len(parts), np.int64)
    i = 0
    for k, p in enumerate(parts):
        at[k] = i
        s[i:i + len(p)] = np.frombuffer(p, np.uint8).astype(np.uint16) + 2
        i += len(p) + 1
    s[-1] = 0
    sa = suffix_array(s, 258)
    lcp = common_prefixes(s, sa, length, 1)
    rank = np.empty(total, np.int32)
    rank[sa] = np.arange(total, dtype=np.int32)
    after = np.append(sa, np.int32(-1))[rank + 1]
    twice = (lcp >= length) | ((after >= 0) & (lcp[after] >= length))
    out = []
    for k, p in enumerate(parts):
        n = len(p) - length + 1
        out.append(np.flatnonzero(twice[at[k]:at[k] + n]) if n > 0 else np.empty(0, np.int64))
    return out
