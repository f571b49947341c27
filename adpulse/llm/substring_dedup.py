"""Exact removal of repeated byte strings, by suffix arrays over shards.

A byte goes when it is covered by a string of ``length`` bytes that also starts
in a document with a smaller id. Strings must meet wherever they occur, so they
are dealt by content: each string belongs to its *minimizer*, the least of the
hashes of its ``GRAM``-byte substrings, and neighbouring strings of a document
with one minimizer form a *stretch*, mostly of under ``2 * length`` bytes.

1. Documents are dealt into blocks. A block sends the distinct minimizers of
   its strings to their shards, which answer which of them occur in more than
   one document.
2. Blocks merge their equal stretches of those minimizers. Every occurrence but
   those of the smallest id goes whole, which the block settles alone; one of
   the smallest id is sent to a shard, so that a hot passage is one entry per
   block however often it occurs. A shard groups equal stretches and sorts what
   differs under one minimizer by a suffix array, built by induced sorting
   (:mod:`adpulse.llm.suffix_array`); permuted common prefixes of ``length`` or
   more show equal strings, and the smallest id among them is compared with the
   id of every entry.
3. Runs of removed strings return to their blocks, which apply them to the other
   occurrences of that id and cut each document.

Minimizers seen in many blocks (``HOT_BLOCKS``) deal their strings one by one,
by the hash of the whole string, so that no shard receives all the contexts of
a very frequent passage; equal strings are merged in the block as well.

Defined results: a null or empty text has no bytes and loses none; a text
shorter than ``length`` loses none; strings don't cross documents; rows of one
id don't remove from each other; a null id counts as larger than any other;
equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adpulse.llm.suffix_array import common_prefixes, suffix_array

LENGTH = 50
GRAM = 20
BLOCK_BYTES = 8 << 20
#: Mean minimizers in one packet from a block to a shard, at least.
PACKET = 256
HOT_BLOCKS = 4096
#: Strings in one stretch at most, in lengths of a string.
MOST = 4
#: Bytes hashed at a time, few enough for a processor's cache, and bytes of one suffix array.
PIECE = 1 << 16
SA_BYTES = 4 << 20
#: Ranges of the minimizer's place in a string, by which stretches without a common string are told.
PARTS = 4
NO_ID = np.iinfo(np.int64).max
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                  0xFF51AFD7ED558CCD], dtype=np.uint64)


def _hash(words: list[np.ndarray], size: int) -> np.ndarray:
    """A 64-bit hash of strings of ``size`` bytes, given as words of 8 at :func:`_word_places`."""
    out = np.full(len(words[0]), size, dtype=np.uint64)
    for i, word in enumerate(words):
        out ^= word * _MULT[i % 4]
        out ^= out >> np.uint64(29)
        out *= _MULT[4]
    out ^= out >> np.uint64(32)
    return out


def _word_places(size: int) -> list[int]:
    return [*range(0, size - 8, 8), size - 8]


def _window_hash(data: np.ndarray, size: int) -> np.ndarray:
    """The hash of every window of ``size`` (8 or more) bytes."""
    n = len(data) - size + 1
    words = data
    for kind in (np.uint16, np.uint32, np.uint64):  # little-endian words of 2, 4 and 8 bytes
        width = words.itemsize
        words = words[:-width].astype(kind) | words[width:].astype(kind) << kind(8 * width)
    return _hash([words[at:at + n] for at in _word_places(size)], size)


def _hash_at(data: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """The same for the windows that start at the places ``at`` alone."""
    each = np.arange(8)
    return _hash([data[(at + j)[:, None] + each].view("<u8").ravel() for j in _word_places(size)], size)


def _minimizers(data: np.ndarray, length: int, gram: int) -> np.ndarray:
    """For each place of a string of ``length`` bytes, the least hash of its grams, mixed again."""
    h = _window_hash(data, gram)
    span, width = length - gram + 1, 1
    while width * 2 <= span:
        h = np.minimum(h[:-width], h[width:])
        width *= 2
    if span > width:
        h = np.minimum(h[:len(h) - (span - width)], h[span - width:])
    return h * _MULT[0]


def stretches(data: np.ndarray, base: np.ndarray, length: int,
              gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(minimizer, text, start in it, strings) of each stretch of the texts that lie end to end
    in ``data``, text ``i`` from ``base[i]`` to ``base[i + 1]``, hashed in pieces."""
    places = len(data) - length + 1
    if places <= 0:
        return np.zeros(0, np.uint64), *(np.zeros(0, np.int64) for _ in range(3))
    # a stretch ends where a text's last string starts; what follows crosses into the next text
    cuts = np.union1d(base, np.maximum(base[1:] - length + 1, base[:-1]))
    ms, starts, before = [], [], None
    for at in range(0, places, PIECE):
        m = _minimizers(data[at:min(len(data), at + PIECE + length - 1)], length, gram)
        new = np.append(before is None or m[0] != before, m[1:] != m[:-1])
        before = m[-1]
        x, y = np.searchsorted(cuts, (at, at + len(m)))
        new[cuts[x:y] - at] = True
        new = np.flatnonzero(new)
        ms.append(m[new])
        starts.append(new + at)
    m, start = np.concatenate(ms), np.concatenate(starts)
    strings = np.diff(np.append(start, places))
    doc = np.searchsorted(base, start, side="right") - 1
    whole = start + length <= base[doc + 1]
    m, doc, start, strings = m[whole], doc[whole], start[whole], strings[whole]
    # text of a short period has one minimizer throughout: cut it up
    parts = -(-strings // (MOST * length))
    step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    most = MOST * length
    strings = np.minimum(np.repeat(strings, parts) - step * most, most)
    doc = np.repeat(doc, parts)
    return np.repeat(m, parts), doc, np.repeat(start, parts) + step * most - base[doc], strings


class _Block:
    """The stretches of a block's documents, and its distinct minimizers in order."""

    def __init__(self, texts: list[bytes], ids: np.ndarray, length: int, gram: int):
        self.base = np.cumsum([0, *map(len, texts)])
        self.data = np.frombuffer(b"".join(texts), np.uint8)
        self.m, self.doc, self.start, self.strings = stretches(self.data, self.base, length, gram)
        order = np.argsort(self.m)
        m, who = self.m[order], ids[self.doc[order]]
        new = np.append(True, m[1:] != m[:-1])[:len(m)]
        first = np.flatnonzero(new)
        self.unique = m[first]
        #: Each stretch's place among the distinct minimizers.
        self.inverse = np.empty(len(m), np.int64)
        self.inverse[order] = np.cumsum(new) - 1
        self.many = (np.minimum.reduceat(who, first) != np.maximum.reduceat(who, first)) if len(first) else np.zeros(0, bool)


def _shard_of(m: np.ndarray, bits: int) -> np.ndarray:
    return (m >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(m), np.int64)


def _clean(pdf: pd.DataFrame) -> tuple[list[bytes], np.ndarray]:
    return [bytes(t) for t in pdf["_sd_text"]], pdf["_sd_id"].to_numpy(np.int64)


def _low40(m: np.ndarray) -> bytes:
    return m.astype("<u8").view("u1").reshape(-1, 8)[:, :5].tobytes()


def _from40(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 5, 8), np.uint8)
    out[:, :5] = np.frombuffer(data, np.uint8).reshape(-1, 5)
    return out.view("<u8").ravel()


def _ask(length: int, gram: int, bits: int):
    """Step 1 in a block: its distinct minimizers, one packet per shard."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        b = _Block(*_clean(pdf), length, gram)
        cuts = np.searchsorted(_shard_of(b.unique, bits), np.arange((1 << bits) + 1))
        # 40 bits do within a shard: a chance equality only makes strings candidates
        rows = [(int(pdf["_sd_block"].iloc[0]), s, _low40(b.unique[x:y]),
                 np.packbits(b.many[x:y]).tobytes())
                for s, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
        return pd.DataFrame(rows, columns=["block", "shard", "ms", "many"])
    return run


def _answer(hot_blocks: int):
    """Step 1 in a shard: per packet, which minimizers are shared, which are hot."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        ms = [_from40(x) for x in pdf["ms"]]
        many = [np.unpackbits(np.frombuffer(x, np.uint8), count=len(m)) for x, m in zip(pdf["many"], ms)]
        everything = np.concatenate(ms)
        unique, inverse, counts = np.unique(everything, return_inverse=True, return_counts=True)
        shared = counts > 1
        shared[inverse[np.concatenate(many).astype(bool)]] = True
        state = (shared.astype(np.uint8) + (counts > hot_blocks))[inverse]
        cuts = np.cumsum([0, *map(len, ms)])
        return pd.DataFrame({"block": pdf["block"], "shard": pdf["shard"],
                             "state": [state[a:b].tobytes() for a, b in zip(cuts, cuts[1:])]})
    return run


def _pack(*arrays: np.ndarray) -> bytes:
    return b"".join(struct.pack("<q", a.nbytes) + a.tobytes() for a in arrays)


def _unpack(data: bytes, *dtypes: str) -> list[np.ndarray]:
    out, at = [], 0
    for d in dtypes:
        size = struct.unpack_from("<q", data, at)[0]
        out.append(np.frombuffer(data, d, size // np.dtype(d).itemsize, at + 8))
        at += 8 + size
    return out


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The concatenation of ``data[s:s + n]``."""
    ends = np.cumsum(size)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)]


def _kinds(m: np.ndarray, begin: np.ndarray, size: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Numbers of equal stretches, rising with the minimizer: told apart by it,
    the size and two hashes of all bytes."""
    padded = np.append(data, np.zeros(8, np.uint8))
    h = size.astype(np.uint64)
    g = m.copy()
    for j in range(0, int(size.max(initial=0)), 8):
        live = np.flatnonzero(size > j)
        at = np.minimum(begin[live] + j, begin[live] + size[live] - 8)
        word = padded[at[:, None] + np.arange(8)].view("<u8").ravel()
        x = (h[live] ^ word) * _MULT[4]
        h[live] = x ^ (x >> np.uint64(31))
        x = (g[live] + word) * _MULT[1]
        g[live] = x ^ (x >> np.uint64(27))
    order = np.lexsort((g, h, m))
    m, h, g = m[order], h[order], g[order]
    kind = np.empty(len(m), np.int64)
    kind[order] = np.cumsum(np.append(False, (m[1:] != m[:-1]) | (h[1:] != h[:-1]) | (g[1:] != g[:-1]))[:len(m)])
    return kind


def _merge(m: np.ndarray, ids: np.ndarray, begin: np.ndarray, size: np.ndarray,
           data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each stretch the first of the smallest id among its equals, and
    whether its own id is larger than that one's."""
    first = np.arange(len(m))
    inverse, counts = np.unique(m, return_inverse=True, return_counts=True)[1:]
    todo = np.flatnonzero(counts[inverse] > 1)  # one of its minimizer has no equal
    kind = _kinds(m[todo], begin[todo], size[todo], data)
    order = todo[np.lexsort((ids[todo], kind))]
    kind = np.sort(kind)
    heads = np.flatnonzero(np.append(True, kind[1:] != kind[:-1])[:len(kind)])
    first[order] = np.repeat(order[heads], np.diff(np.append(heads, len(kind))))
    return first, ids > ids[first]


def _send(length: int, gram: int, bits: int):
    """Step 2 in a block: its distinct shared stretches, one packet per shard, and a
    packet for itself, under a negative shard: what it settles alone and which
    occurrences follow the one that is sent."""
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        cols = ["block", "shard", "data"]
        if not len(docs) or not len(answers):
            return pd.DataFrame(columns=cols)
        texts, ids = _clean(docs)
        number = np.unique(docs["_sd_rid"].to_numpy(np.int64), return_inverse=True)[1]
        b = _Block(texts, ids, length, gram)
        state = np.frombuffer(b"".join(answers.sort_values("shard")["state"]), np.uint8)
        state = state[b.inverse] if len(b.m) else state[:0]
        keep = state > 0
        m, doc, start, strings, hot = b.m[keep], b.doc[keep], b.start[keep], b.strings[keep], state[keep] > 1
        base, data = b.base, b.data
        gone, same = [], []  # places of removed strings; occurrences and those they follow

        def merged(m, doc, start, strings):
            first, larger = _merge(m, ids[doc], base[doc] + start, strings + length - 1, data)
            at = _place(number[doc], start)
            gone.append((at[larger], strings[larger]))
            others = np.flatnonzero(~larger & (at != at[first]))
            same.append((at[first[others]], strings[others], at[others]))
            return first == np.arange(len(m))

        keep = merged(m, doc, start, strings)
        m, doc, start, strings, hot = m[keep], doc[keep], start[keep], strings[keep], hot[keep]
        if hot.any():  # strings of their own, dealt by their whole content
            n = strings[hot]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            hd, hs = np.repeat(doc[hot], n), np.repeat(start[hot], n) + step
            whole = np.array([struct.unpack("<Q", hashlib.blake2b(texts[d][s:s + length], digest_size=8).digest())[0]
                              for d, s in zip(hd, hs)], dtype=np.uint64)
            keep = merged(whole, hd, hs, np.ones(len(hd), np.int64))
            whole, hd, hs = whole[keep], hd[keep], hs[keep]
            m, doc = np.append(m[~hot], whole), np.append(doc[~hot], hd)
            start, strings = np.append(start[~hot], hs), np.append(strings[~hot], np.ones(len(hd), np.int64))
        order = np.argsort(m, kind="stable")
        m, doc, start, strings = m[order], doc[order], start[order], strings[order]
        cuts = np.searchsorted(_shard_of(m, bits), np.arange((1 << bits) + 1))
        block, rows = int(docs["_sd_block"].iloc[0]), []
        strings_same = same[1] if len(same) > 1 else [np.zeros(0, np.int64)] * 3
        at, n = (np.concatenate(x) for x in zip(*gone))
        at, end = _runs(at, at + n)
        if len(at) or any(len(x[0]) for x in same):
            rows.append((block, -1 - block, _pack(*_packable(at, end), *(x.astype("<i8") for x in (*strings_same, *same[0])))))
        for s, (x, y) in enumerate(zip(cuts, cuts[1:])):
            if y > x:
                size = strings[x:y] + length - 1
                rows.append((block, s, _pack(
                    m[x:y].astype("<u8"), ids[doc[x:y]].astype("<i8"), number[doc[x:y]].astype("<u4"),
                    start[x:y].astype("<i4"), size.astype("<u2"),
                    _gather(data, base[doc[x:y]] + start[x:y], size))))
        return pd.DataFrame(rows, columns=cols)
    return run


def _may_share(m: np.ndarray, begin: np.ndarray, size: np.ndarray, data: np.ndarray, length: int,
               gram: int) -> np.ndarray:
    """Which of the given stretches may hold a string that another of their minimizer holds.

    Such a string holds the minimizer's gram, at one place in both, with a number of bytes to
    its left that lies in one of ``PARTS`` ranges; so both have the gram with the bytes that
    all strings of that range have around it. A gram that isn't found (strings of a hot
    minimizer, or a hash met by chance) says nothing, and the stretch may share.
    """
    room = length - gram
    base = np.cumsum(size) - size
    cat, sought = _gather(data, begin, size), np.repeat(m, size)
    at = np.concatenate([
        x + np.flatnonzero((h := _window_hash(cat[x:x + PIECE + gram - 1], gram) * _MULT[0]) == sought[x:x + len(h)])
        for x in range(0, len(cat) - gram + 1, PIECE)])
    owner = np.searchsorted(base, at, side="right") - 1
    inside = at + gram <= base[owner] + size[owner]
    at, owner = at[inside], owner[inside]
    out = np.ones(len(m), dtype=bool)
    out[owner] = False
    parts = min(PARTS, room + 1)
    cuts = np.arange(parts + 1) * (room + 1) // parts
    for least, most in zip(cuts[:-1].tolist(), (cuts[1:] - 1).tolist()):  # bytes to the left of the gram
        wide = least + gram + room - most
        whole = (at - least >= base[owner]) & (at - least + wide <= base[owner] + size[owner])
        who, key = owner[whole], _hash_at(cat, at[whole] - least, wide)
        order = np.argsort(key)
        who, key = who[order], key[order]
        first = np.flatnonzero(np.append(len(key) > 0, key[1:] != key[:-1])[:len(key)])
        if len(first):
            several = np.minimum.reduceat(who, first) != np.maximum.reduceat(who, first)
            out[who[np.repeat(several, np.diff(np.append(first, len(key))))]] = True
    return out


def least_ids(m: np.ndarray, ids: np.ndarray, begin: np.ndarray, size: np.ndarray, data: np.ndarray,
              length: int, gram: int) -> np.ndarray:
    """For every string of the given distinct stretches, in order, the smallest
    id among stretches of its minimizer that hold it.

    Minimizers with one stretch are decided by it, and so are stretches whose bytes
    around the minimizer's gram no other has. All others go through a
    suffix array of their stretches, each closed by a separator, in parts of
    about ``SA_BYTES`` that don't split a minimizer.
    """
    strings = size - length + 1
    ends = np.cumsum(strings)
    out = np.repeat(ids, strings)
    new = np.append(True, m[1:] != m[:-1])
    group = np.cumsum(new) - 1
    several = np.bincount(group)[group] > 1
    todo = np.flatnonzero(several)
    if len(todo):
        todo = todo[_may_share(m[todo], begin[todo], size[todo], data, length, gram)]
    if not len(todo):
        return out
    part = np.cumsum(size[todo] + 1) // SA_BYTES
    opens = np.append(True, group[todo][1:] != group[todo][:-1])
    part = part[np.maximum.accumulate(np.where(opens, np.arange(len(todo)), 0))]
    for which in np.split(todo, np.flatnonzero(part[1:] != part[:-1]) + 1):
        n = size[which]
        at = np.cumsum(n + 1) - (n + 1)  # place of each stretch in the string
        t = np.ones(int((n + 1).sum()) + 1, dtype=np.int64)  # 1 separates
        t[-1] = 0
        inside = np.arange(n.sum()) + np.repeat(np.arange(len(n)), n)
        t[inside] = _gather(data, begin[which], n).astype(np.int64) + 2
        sa = suffix_array(t)
        # places of whole strings, the stretch they lie in, their slot in the result
        k = strings[which]
        step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        place = np.repeat(at, k) + step
        slot = np.repeat(ends[which] - k, k) + step
        owner, slots = np.full(len(t), -1, np.int64), np.full(len(t), -1, np.int64)
        owner[place], slots[place] = np.repeat(ids[which], k), slot
        string = slots[sa] >= 0
        rows = sa[string]
        # one that follows no string shares less: only whole strings have no separator in ``length`` symbols
        prefix = common_prefixes(t, sa, length, sa[1:][string[1:] & string[:-1]])
        heads = np.flatnonzero(np.append(True, prefix[rows[1:]] < length))
        least = np.minimum.reduceat(owner[rows], heads)
        out[slots[rows]] = np.repeat(least, np.diff(np.append(heads, len(rows))))
    return out


def _decide(length: int, gram: int):
    """Step 2 in a shard: runs of removed strings, one packet per block. What a
    block sends itself passes through."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["shard"].iloc[0] < 0:
            return pd.DataFrame({"block": pdf["block"], "ranges": None, "own": pdf["data"]})
        parts = [_unpack(x, "<u8", "<i8", "<u4", "<i4", "<u2", "u1") for x in pdf["data"]]
        blocks = np.repeat(pdf["block"].to_numpy(), [len(p[0]) for p in parts])
        m, ids, number, start, size, data = (np.concatenate([p[i] for p in parts]) for i in range(6))
        del parts
        size = size.astype(np.int64)
        begin = np.cumsum(size) - size
        kind = _kinds(m, begin, size, data)
        order = np.argsort(kind, kind="stable")
        new = np.append(True, kind[order][1:] != kind[order][:-1])
        one = order[new]  # a representative of each distinct stretch
        low = np.minimum.reduceat(ids[order], np.flatnonzero(new))
        least = least_ids(m[one], low, begin[one], size[one], data, length, gram)
        # entries against the least ids of their strings
        strings = size[one] - length + 1
        base = np.cumsum(strings) - strings
        worst = np.minimum.reduceat(least, base)  # the smallest of a stretch
        hit = np.flatnonzero(worst[kind] < ids)
        k = strings[kind[hit]]
        step = np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
        gone = least[np.repeat(base[kind[hit]], k) + step] < np.repeat(ids[hit], k)
        row = np.repeat(hit, k)
        # runs of removed strings within one entry
        opens = gone & np.append(True, (row[1:] != row[:-1]) | ~gone[:-1])
        closes = gone & np.append((row[1:] != row[:-1]) | ~gone[1:], True)
        row, a, b = row[opens], step[opens], step[closes] + 1
        order = np.argsort(blocks[row], kind="stable")
        row, a, b = row[order], a[order], b[order]
        cuts = np.flatnonzero(np.append(True, blocks[row][1:] != blocks[row][:-1])) if len(row) else []
        rows = [(int(blocks[row[x]]), _pack(number[row[x:y]].astype("<u4"), (start[row[x:y]] + a[x:y]).astype("<i4"),
                                            (start[row[x:y]] + b[x:y]).astype("<i4")), None)
                for x, y in zip(cuts, np.append(cuts[1:], len(row)))]
        return pd.DataFrame(rows, columns=["block", "ranges", "own"])
    return run


def _place(number: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Places of a block's documents, in one line."""
    return (number.astype(np.int64) << 32) + at


def _packable(at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = 0xFFFFFFFF
    return (at >> 32).astype("<u4"), (at & low).astype("<i4"), (end & low).astype("<i4")


def _runs(at: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The maximal runs of places in ``[at, end)``, in order."""
    order = np.argsort(at, kind="stable")
    at, end = at[order], np.maximum.accumulate(end[order])
    opens = np.append(True, at[1:] > end[:-1])[:len(at)]
    return at[opens], end[np.append(opens[1:], True)[:len(at)]]


def _follow(at: np.ndarray, end: np.ndarray, of: np.ndarray, n: np.ndarray,
            to: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs with what lies in ``[of, of + n)`` repeated from ``to`` on."""
    first = np.searchsorted(end, of, side="right")
    k = np.maximum(np.searchsorted(at, of + n) - first, 0)
    which = np.arange(k.sum()) + np.repeat(first - (np.cumsum(k) - k), k)
    of, n, to = np.repeat(of, k), np.repeat(n, k), np.repeat(to, k)
    return _runs(np.append(at, np.maximum(at[which], of) - of + to),
                 np.append(end, np.minimum(end[which], of + n) - of + to))


def _union(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs covered by the ranges ``[a, b)``."""
    order = np.argsort(a, kind="stable")
    a, b = a[order], np.maximum.accumulate(b[order])
    opens = np.flatnonzero(np.append(True, a[1:] > b[:-1]))
    return list(zip(a[opens].tolist(), b[np.append(opens[1:], len(a)) - 1].tolist()))


def _whole_chars(text: bytes, runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Runs widened to whole UTF-8 characters."""
    out: list[tuple[int, int]] = []
    for a, b in runs:
        while a > 0 and text[a] & 0xC0 == 0x80:
            a -= 1
        while b < len(text) and text[b] & 0xC0 == 0x80:
            b += 1
        if out and a <= out[-1][1]:
            a, b = out[-1][0], max(b, out.pop()[1])
        out.append((a, b))
    return out


def _removed(ranges: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Runs of removed strings in a block, from the shards and from itself."""
    parts = [_unpack(x, "<u4", "<i4", "<i4") for x in ranges["ranges"] if x is not None]
    same = []
    for x in ranges["own"]:
        if x is not None:
            own = _unpack(x, "<u4", "<i4", "<i4", *["<i8"] * 6)
            parts.append(own[:3])
            same = [own[i:i + 3] for i in range(3, len(own), 3)]
    number, a, b = (np.concatenate([p[i] for p in parts]) if parts else np.zeros(0, np.int64) for i in range(3))
    at, end = _runs(_place(number, a), _place(number, b))
    for s in same:  # strings before the stretches that hold them
        at, end = _follow(at, end, *s)
    return at, end


def _cut(length: int, whole_chars: bool):
    """Step 3 in a block: every document's removed runs. Documents go by the
    rank of their row hash in the block, as they did when stretches were sent."""
    def run(docs: pd.DataFrame, ranges: pd.DataFrame) -> pd.DataFrame:
        if not len(docs):
            return pd.DataFrame(columns=[*docs.columns.drop(["_sd_text", "_sd_block", "_sd_rid", "_sd_id"]),
                                         "n_bytes", "spans", "kept_bytes"])
        rid, a, b = (x.astype(np.int64) for x in _packable(*_removed(ranges)))
        b += length - 1
        rows = []
        numbers = np.unique(docs["_sd_rid"].to_numpy(np.int64), return_inverse=True)[1]
        for r, text in zip(numbers, docs["_sd_text"]):
            x, y = np.searchsorted(rid, r), np.searchsorted(rid, r, side="right")
            runs = _union(a[x:y], b[x:y]) if y > x else []
            runs = _whole_chars(text, runs) if whole_chars else runs
            kept, at = [], 0
            for s, e in runs:
                kept.append(text[at:s])
                at = e
            rows.append((len(text), [v for s in runs for v in s], b"".join([*kept, text[at:]])))
        out = pd.DataFrame(rows, columns=["n_bytes", "spans", "kept_bytes"])
        own = docs.drop(columns=["_sd_text", "_sd_block", "_sd_rid", "_sd_id"]).reset_index(drop=True)
        return pd.concat([own, out], axis=1)
    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                   gram: int = GRAM, block_bytes: int = BLOCK_BYTES, hot_blocks: int = HOT_BLOCKS,
                   whole_chars: bool = False) -> DataFrame:
    """The other columns of ``docs`` with ``n_bytes``, ``spans`` (starts and ends
    of removed runs, flat) and ``kept_bytes``; with ``whole_chars`` a character
    that loses a byte goes whole, so that the rest is UTF-8. Names starting with ``_sd_`` are
    reserved; a column of the same name as a result is replaced by it."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    n_blocks = max(1, -(-total // block_bytes))
    anchors = min(total, block_bytes) * 2 // (length - gram + 2)
    bits = max(0, min(n_blocks - 1, max(1, anchors // PACKET))).bit_length()
    rest = [c for c in docs.columns if c not in (text_col, "n_bytes", "spans", "kept_bytes")]
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    rid = F.xxhash64(F.col(id_col), F.col(text_col))
    blocked = docs.select(
        *rest, text.alias("_sd_text"), rid.alias("_sd_rid"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(int(NO_ID))).alias("_sd_id"),
        F.pmod(rid, F.lit(n_blocks)).cast("int").alias("_sd_block")).repartition(n_blocks, "_sd_block")
    shards = 1 << bits
    asked = blocked.groupBy("_sd_block").applyInPandas(
        _ask(length, gram, bits), "block int, shard int, ms binary, many binary")
    answers = asked.repartition(shards, "shard").groupBy("shard").applyInPandas(
        _answer(hot_blocks), "block int, shard int, state binary")
    sent = blocked.groupBy("_sd_block").cogroup(answers.groupBy("block")).applyInPandas(
        _send(length, gram, bits), "block int, shard int, data binary")
    ranges = sent.repartition(shards, "shard").groupBy("shard").applyInPandas(
        _decide(length, gram), "block int, ranges binary, own binary")
    schema = docs.select(*rest).schema.add("n_bytes", "long").add("spans", T.ArrayType(T.IntegerType())).add("kept_bytes", "binary")
    return blocked.groupBy("_sd_block").cogroup(ranges.groupBy("block")).applyInPandas(_cut(length, whole_chars), schema)
