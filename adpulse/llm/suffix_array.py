"""Suffix arrays by induced sorting, and permuted common prefixes, in numpy.

Suffixes are classified as larger or smaller than their right neighbour. The
leftmost-smaller (LMS) substrings are sorted by one induction, named, and the
string of names is sorted recursively; from the sorted LMS suffixes a second
induction yields the whole array. An induction visits the buckets of the first
symbol in order and moves whole slices of a bucket to their predecessors'
buckets at once, so its work is linear in the text. Where symbols are many
(``MAX_SYMBOLS``, mostly names) and so slices short, the same induction moves
suffixes one by one.
"""

from __future__ import annotations

import numpy as np

#: Beyond so many symbols an induction moves suffixes one by one.
MAX_SYMBOLS = 2048


def classify(t: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than its right neighbour (the last one is)."""
    n = len(t)
    differs = np.append(t[1:] != t[:-1], True)
    ends = np.flatnonzero(differs)
    end = ends[np.searchsorted(ends, np.arange(n))]  # last place of each run of one symbol
    smaller = np.ones(n, dtype=bool)
    inner = end < n - 1
    smaller[inner] = t[end[inner]] < t[end[inner] + 1]
    return smaller


def _spread(sa: np.ndarray, at: np.ndarray, head: np.ndarray, syms: np.ndarray, step: int) -> None:
    """Writes suffixes, in order, to the next free places of their buckets."""
    order = np.argsort(syms.astype(np.uint16), kind="stable")  # in one linear pass; symbols are at most MAX_SYMBOLS
    s = syms[order]
    first = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    counts = np.diff(np.append(first, len(s)))
    rank = np.arange(len(s)) - np.repeat(first, counts)
    sa[head[s] + step * rank] = at[order]
    head[s[first]] += step * counts


def _induce(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """The suffix order induced from LMS suffixes given in order."""
    n = len(t)
    sizes = np.bincount(t, minlength=symbols)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    sa = np.full(n, -1, dtype=np.int64)
    lms_sym = t[lms]
    by = np.argsort(lms_sym, kind="stable")
    lms_sorted, cut = lms[by], np.searchsorted(lms_sym[by], np.arange(symbols + 1))
    live = np.flatnonzero(sizes)
    head = starts.copy()
    for c in live:
        done = starts[c]
        while done < head[c]:  # larger-type suffixes of this bucket, wave by wave
            wave = sa[done:head[c]] - 1
            done = head[c]
            wave = wave[wave >= 0]
            wave = wave[~smaller[wave]]
            if len(wave):
                _spread(sa, wave, head, t[wave], 1)
        wave = lms_sorted[cut[c]:cut[c + 1]] - 1
        wave = wave[wave >= 0]
        if len(wave):
            _spread(sa, wave, head, t[wave], 1)
    tail = ends - 1
    for c in live[::-1]:
        done = ends[c] - 1
        while done > tail[c]:  # smaller-type suffixes, from the bucket's end
            wave = sa[tail[c] + 1:done + 1][::-1] - 1
            done = tail[c]
            wave = wave[wave >= 0]
            wave = wave[smaller[wave]]
            if len(wave):
                _spread(sa, wave, tail, t[wave], -1)
        wave = sa[starts[c]:head[c]][::-1] - 1
        wave = wave[wave >= 0]
        wave = wave[smaller[wave]]
        if len(wave):
            _spread(sa, wave, tail, t[wave], -1)
    sa[0] = n - 1  # the sentinel, which no suffix induces
    return sa


def _induce_each(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray, symbols: int) -> np.ndarray:
    """As :func:`_induce`, suffix by suffix."""
    n = len(t)
    sizes = np.bincount(t, minlength=symbols)
    ends = np.cumsum(sizes)
    head, tail, last = (ends - sizes).tolist(), ends.tolist(), ends.tolist()
    sym = t.tolist()
    # of each suffix's predecessor: its symbol where it is larger (or smaller) than the suffix, or -1
    before = np.append(-1, t[:-1])
    kind = np.append(False, smaller[:-1])
    larger, less = np.where(kind, -1, before).tolist(), np.where(kind, before, -1).tolist()
    sa = [0] * n  # 0 has no predecessor and induces nothing
    for j in lms[::-1].tolist():
        c = sym[j]
        p = tail[c] - 1
        tail[c] = p
        sa[p] = j
    for j in sa:  # meets what it has written ahead
        c = larger[j]
        if c >= 0:
            p = head[c]
            sa[p] = j - 1
            head[c] = p + 1
    for j in reversed(sa):
        c = less[j]
        if c >= 0:
            p = last[c] - 1
            last[c] = p
            sa[p] = j - 1
    return np.array(sa, dtype=np.int64)


def _names(t: np.ndarray, smaller: np.ndarray, lms: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """Names, rising in order, of LMS substrings; equal substrings share one."""
    length = np.append(np.diff(lms) + 1, 1)  # up to and with the next LMS place
    of = np.zeros(len(t), np.int64)
    of[lms] = length
    size = of[ordered]
    differs = np.append(True, size[1:] != size[:-1])
    same = np.flatnonzero(~differs)
    k = 0
    while len(same):  # compare the k-th symbols of neighbours that agree so far
        a, b = ordered[same], ordered[same - 1]
        eq = (t[a + k] == t[b + k]) & (smaller[a + k] == smaller[b + k])
        differs[same[~eq]] = True
        k += 1
        same = same[eq]
        same = same[size[same] > k]
    names = np.zeros(len(t), np.int64)
    names[ordered] = np.cumsum(differs) - 1
    return names[lms]


def suffix_array(t: np.ndarray) -> np.ndarray:
    """The suffix array of ``t``: small non-negative ints that end in a unique 0."""
    t = np.asarray(t, dtype=np.int64)
    n, symbols = len(t), int(t.max()) + 1 if len(t) else 1
    if n <= 2:
        return np.arange(n)[::-1].copy()
    if symbols > n:  # gaps among the symbols
        t = np.unique(t, return_inverse=True)[1]
        symbols = int(t.max()) + 1
    induce = _induce if symbols <= MAX_SYMBOLS else _induce_each
    smaller = classify(t)
    lms = np.flatnonzero(smaller & np.append(False, ~smaller[:-1]))
    guess = induce(t, smaller, lms, symbols)
    is_lms = np.zeros(n, dtype=bool)
    is_lms[lms] = True
    ordered = guess[is_lms[guess]]
    names = _names(t, smaller, lms, ordered)
    if names.max() + 1 < len(names):
        ordered = lms[suffix_array(names)]
    return induce(t, smaller, ordered, symbols)


def common_prefixes(t: np.ndarray, sa: np.ndarray, most: int, places: np.ndarray | None = None) -> np.ndarray:
    """Permuted common prefixes: at each text place, or only at the given ones (0
    elsewhere), how many symbols (up to ``most``) its suffix shares with the one
    before it in suffix order."""
    n = len(t)
    before = np.full(n, n, dtype=np.int64)
    before[sa[1:]] = sa[:-1]
    # as many symbols as fit are packed into one word and compared together
    bits = max(1, int(t.max(initial=0)).bit_length())
    per = max(1, 62 // bits)
    padded = np.append(t, np.zeros(per, dtype=t.dtype)).astype(np.int64)
    words = np.zeros(n + 1, dtype=np.int64)
    for j in range(per):
        words = (words << bits) | padded[j:j + n + 1]
    out = np.zeros(n, dtype=np.int64)
    live = np.flatnonzero(before < n) if places is None else np.sort(places)
    for k in range(0, most, per):
        live = live[(live + k < n) & (before[live] + k < n)]
        a, b = live + k, before[live] + k
        diff = words[a] ^ words[b]
        unequal = diff != 0
        high = np.frexp(diff[unequal].astype(np.float64))[1]  # bits up to the first difference
        # rounding up to a power of two may hide the last symbol before it: look again
        same = np.maximum(per - 1 - (high - 1) // bits, 0)
        u, v = a[unequal], b[unequal]
        wrong = (same < per - 1) & (padded[u + np.minimum(same, per - 1)] == padded[v + np.minimum(same, per - 1)])
        same[wrong] += 1
        out[live[unequal]] += np.minimum(np.minimum(same, n - u), n - v)
        live = live[~unequal]
        out[live] += np.minimum(np.minimum(per, n - a[~unequal]), n - b[~unequal])
        if not len(live):
            break
    return np.minimum(out, most)
