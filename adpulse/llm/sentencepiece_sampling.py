"""SentencePiece segmentations sampled without replacement, and decoding.

A text, with a word-start mark for every space and one in front, is a lattice:
places between characters are nodes, vocabulary pieces are arcs, and a
character that is no piece has one arc of its byte pieces. An arc weighs the
log probability of its pieces, by Zipf's law over the vocabulary's merge ranks
(the model file orders pieces by rank and holds no probabilities); a path's
probability is its weight over that of all paths.

Gumbel top-k: every path has the perturbed score ``log p + Gumbel noise`` and
the ``k`` largest are a sample without replacement. They are found without
enumerating paths, by A* over subtrees of paths: a subtree's largest perturbed
score is drawn top-down, given its parent's; the queue's best subtree is
followed down to its best path, and at every node on the way the arcs not taken
go into the queue as one subtree, with a score truncated at the path's. The
queue's head after ``k`` paths is the (k+1)-th score, the threshold of the
inclusion score ``1 - exp(-exp(log p - threshold))``.

No piece has a word-start mark after another character, so weights are summed
word by word, over the distinct words of a batch; the search itself runs over
the whole text. Noise is a hash of seed, row key, path number and place: the
same row gives the same sample wherever it lies.

Defined results: a null or empty text has one segmentation, of no pieces; texts
with fewer than ``k`` segmentations yield all they have; equal keys with equal
texts get equal samples; a null key counts as zero; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
K = 3
SEED = 20
#: Characters of text in one batch.
BATCH = 2 << 20
#: First bits of a hash by which pieces are looked up.
NEAR_BITS = 16
#: Words of a lattice built at a time, and word occurrences followed at a time: few enough for a processor's cache.
CHUNK = 4096
FOLLOWED = 1 << 15
#: Log of the other arcs' share of a node below which they count as none.
_SURE = np.log(1e-12)
#: The largest number below one, and the least that log(-log(u)) can be.
_BELOW_ONE = 1.0 - 2.0 ** -53
_EARLIEST = float(np.log(-np.log(_BELOW_ONE)))
#: Steps of a path, and paths, looked at together.
NEAR_STEPS = 512
NEAR_PATHS = 64
#: What the steps of a path first looked at for subtrees that leave it may take off its log probability.
_NEAR = 42.0
_UNIT = re.compile(f"{MARK}+[^{MARK}]*")
_P = np.uint64(0x100000001B3)
_M1, _M2, _M3 = (np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0x9E3779B97F4A7C15))


class Vocabulary:
    """Pieces by length and hash, their log probabilities, and decoding."""

    def __init__(self, name: str = "piece_bpe_32k"):
        import public_tokenizers
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(f"{name}.model"))
        n = sp.get_piece_size()
        self.byte_id, self.bytes = np.zeros(256, np.int64), {}
        plain = []
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:-1], 16)] = i
                self.bytes[i] = bytes([int(piece[3:-1], 16)])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                if MARK in piece.lstrip(MARK):
                    raise ValueError(f"piece {i} crosses a word start")
                plain.append((piece, i))
                self.bytes[i] = piece.replace(MARK, " ").encode()
        order = sorted(plain, key=lambda x: -sp.get_score(x[1]))
        rank = np.arange(len(order))
        logp = -np.log(rank + 2.7)
        logp -= np.logaddexp.reduce(logp)
        self.logp = np.full(n, logp.min() - 2)  # byte pieces
        for (_, i), w in zip(order, logp):
            self.logp[i] = w
        #: By length: the sorted hashes of all pieces' beginnings, and the piece that ends there (-1: none).
        self.by_length: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        #: Where the hashes with the same first bits start, and how many those are at most.
        self.near: dict[int, tuple[np.ndarray, int]] = {}
        whole = {p: i for p, i in plain}
        for size in range(1, max(map(len, whole)) + 1):
            starts = sorted({p[:size] for p in whole if len(p) >= size})
            codes = np.frombuffer("".join(starts).encode("utf-32-le"), "<u4").reshape(-1, size)
            keys = _hash(codes.astype(np.uint64)) * _M3  # so that the first bits differ
            order = np.argsort(keys)
            keys = np.append(keys[order], np.uint64(0xFFFFFFFFFFFFFFFF))
            self.by_length[size] = keys, np.array([*(whole.get(starts[j], -1) for j in order), -1])
            start = np.searchsorted(keys[:-1], np.arange(1 << NEAR_BITS, dtype=np.uint64) << np.uint64(64 - NEAR_BITS))
            self.near[size] = start, int(np.diff(np.append(start, len(keys) - 1)).max())
        self.spelled = pa.array([self.bytes.get(i, b"") for i in range(n)], pa.binary())

    def decode_bytes(self, ids) -> bytes:
        """The text of a segmentation in UTF-8."""
        found = self.spelled.take(pa.array(np.asarray(ids, dtype=np.int64)))
        data = found.buffers()[2]
        return data.to_pybytes()[1:] if data is not None else b""

    def decode(self, ids) -> str:
        """The text of a segmentation."""
        return self.decode_bytes(ids).decode()


def _hash(codes: np.ndarray) -> np.ndarray:
    h = np.zeros(len(codes), np.uint64)
    for j in range(codes.shape[1]):
        h = h * _P + codes[:, j] + np.uint64(1)
    return h


@lru_cache(maxsize=1)
def vocabulary(name: str = "piece_bpe_32k") -> Vocabulary:
    return Vocabulary(name)


def _even(text: str) -> bool:
    """Whether a text is words with one space between."""
    return not (MARK in text or "  " in text or text[-1:] == " " or text[:1] == " ")


def units(text: str) -> list[str]:
    """The words of a text, each without its first mark."""
    if _even(text):
        return text.split(" ")
    return [u[1:] for u in _UNIT.findall(MARK + text.replace(" ", MARK))]


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of the texts as characters, a mark before each; the word of each occurrence; and each text's
    number of them."""
    plain = [None if not t else t if _even(t) else " ".join(units(t)) for t in texts]  # no word holds a space
    split = pc.split_pattern(pa.array([t and t.encode("utf-8", "surrogatepass") for t in plain], pa.binary()), " ")
    coded = split.flatten().dictionary_encode()
    each = pa.ListArray.from_arrays(pa.array([0, len(coded.dictionary)], pa.int32()), coded.dictionary)
    joined = " " + pc.binary_join(each, b" ")[0].as_py().decode("utf-8", "surrogatepass") if len(coded) else ""
    chars = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    return chars, coded.indices.to_numpy(), pc.list_value_length(split).fill_null(0).to_numpy()


class Lattice:
    """The lattices of distinct words, end to end: node ``i`` is before character
    ``i`` of the joined words, and each word has one more node at its end."""

    def __init__(self, words: list[str] | np.ndarray, vocab: Vocabulary, chunk: int = CHUNK):
        """``words``, or their characters with a space before each."""
        if isinstance(words, list):
            words = np.frombuffer("".join(f" {w}" for w in words).encode("utf-32-le", "surrogatepass"), "<u4")
        cuts = np.append(np.flatnonzero(words == ord(" ")), len(words))
        parts = [_chunk(words[cuts[x]:cuts[min(x + chunk, len(cuts) - 1)]], np.diff(cuts[x:x + chunk + 1]), vocab)
                 for x in range(0, max(1, len(cuts) - 1), chunk)]
        # one after another: what points at nodes, arcs or bytes moves on by those before
        nodes, arcs, bare = ([0, *np.cumsum([len(p[name]) for p in parts]).tolist()]
                             for name in ("counts", "dst", "bare_size"))
        kind = np.int32 if max(nodes[-1], arcs[-1]) < 1 << 31 else np.int64

        def joined(name: str, size: int, by: list[int] | None, kind) -> np.ndarray:
            out, lo = np.empty(size, kind), 0
            for i, p in enumerate(parts):
                x = p[name]
                out[lo:lo + len(x)] = x + by[i] if by and by[i] else x
                lo += len(x)
            return out

        #: Of a word: its first node and its end.
        self.start = joined("start", len(cuts) - 1, nodes, np.int64)
        self.end = joined("end", len(cuts) - 1, nodes, np.int64)
        #: Of a node: its first arc.
        self.first = np.zeros(nodes[-1] + 1, kind)
        np.cumsum(joined("counts", nodes[-1], None, np.uint16), out=self.first[1:])
        #: Of an arc, a node's likeliest first, so that few are looked at to draw one: where it leads, its log
        #: probability given its node, and that of it and those before it.
        self.dst = joined("dst", arcs[-1], nodes, kind)
        self.logp = joined("logp", arcs[-1], None, np.float64)
        self.upto = joined("upto", arcs[-1], None, np.float64)
        #: Its piece, or -1 - b for the b-th character that is spelled in bytes.
        self.piece = joined("piece", arcs[-1], None, kind)
        for i in range(1, len(parts)):
            if bare[i] and bare[i + 1] > bare[i]:
                own = self.piece[arcs[i]:arcs[i + 1]]
                own[own < 0] -= bare[i]
        #: Of such a character: its number of pieces, and these end to end.
        self.bare_size = np.concatenate([p["bare_size"] for p in parts])
        self.bare_pieces = np.concatenate([p["bare_pieces"] for p in parts])
        self.bare_at = np.cumsum(self.bare_size) - self.bare_size

    @property
    def rest(self) -> np.ndarray:
        """Log probability of the node's other arcs together."""
        return others(self.logp)

    def src(self, arc: int) -> int:
        """The node an arc leaves."""
        return int(self.first.searchsorted(self.first.dtype.type(arc), "right")) - 1  # another type would copy the nodes

    def pieces(self, arcs: np.ndarray) -> np.ndarray:
        """The piece ids of a path."""
        return self.pieces_and_ends(arcs)[0]

    def pieces_and_ends(self, arcs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece ids of a path, and before each step and at the end how many there are."""
        ids = self.piece.take(arcs)
        bare = (ids < 0).nonzero()[0]
        if not len(bare):
            return ids, np.arange(len(ids) + 1)
        size, which = np.ones(len(ids), np.int64), -1 - ids.take(bare)
        size[bare] = self.bare_size[which]
        out = np.repeat(ids, size)
        out[out < 0] = _gather(self.bare_pieces, self.bare_at[which], self.bare_size[which])
        return out, np.append(0, size.cumsum())


def others(logp: np.ndarray) -> np.ndarray:
    """Log probability of the other arcs of a node together, given those of one arc."""
    with np.errstate(divide="ignore"):
        return np.log(-np.expm1(logp))


def _chunk(chars: np.ndarray, sizes: np.ndarray, vocab: Vocabulary) -> dict[str, np.ndarray]:
    """The lattices of a few words: what a ``Lattice`` holds, and each node's number of arcs."""
    codes = np.where(chars == ord(" "), np.uint32(ord(MARK)), chars)
    n = len(codes)
    ends = np.cumsum(sizes)
    end = np.repeat(ends, sizes)
    left = end - np.arange(n)
    found = []  # by length: nodes with an arc, and its piece; a node has at most one of a length
    covered = np.zeros(n, dtype=bool)
    counts = np.zeros(n, np.int64)
    c = codes.astype(np.uint64) + np.uint64(1)
    live, h, most_left = np.arange(n), np.zeros(n, np.uint64), left
    for size in vocab.by_length:
        if size > 1:
            on = (most_left >= size).nonzero()[0]
            live, h, most_left = live.take(on), h.take(on), most_left.take(on)
        if not len(live):
            break
        h *= _P
        h += c.take(live + (size - 1))
        keys, pieces = vocab.by_length[size]
        start, most = vocab.near[size]
        sought = h * _M3
        at = start.take((sought >> np.uint64(64 - NEAR_BITS)).view(np.int64))
        for _ in range(most - 1):
            at += keys.take(at) < sought
        known = (keys.take(at) == sought).nonzero()[0]
        live, h, most_left, piece = live.take(known), h.take(known), most_left.take(known), pieces.take(at.take(known))
        hit = (piece >= 0).nonzero()[0]
        at, piece = live.take(hit), piece.take(hit)
        found.append((at, size, piece))
        counts[at] += 1
        if size == 1:
            covered[at] = True
    bare = np.flatnonzero(~covered)  # characters that are no piece: one arc of bytes
    spelled = [chr(x).encode("utf-8", "replace") for x in codes[bare]]
    bare_size = np.fromiter(map(len, spelled), np.int64, len(spelled))
    counts[bare] += 1
    # arcs node by node, the shorter ones first
    first = np.append(0, np.cumsum(counts))
    free = first[:-1].copy()
    dst, ids = np.empty(first[-1], np.int64), np.empty(first[-1], np.int64)
    for at, size, piece in ((bare, 1, -1 - np.arange(len(bare))), *found):
        to = free.take(at)
        dst[to], ids[to] = at + size, piece
        free[at] += 1
    weight = vocab.logp.take(np.maximum(ids, 0) if len(bare) else ids)
    if len(bare):
        spelt = np.flatnonzero(ids < 0)
        weight[spelt] = vocab.logp[vocab.byte_id[0]] * bare_size[-1 - ids[spelt]]
    # sums over all ways to the word's end, by distance from it; a word's end, which is no node, has 0
    beta = np.zeros(n)
    far = np.minimum(left, 0xFFFF).astype(np.uint16)
    by = np.argsort(far, kind="stable")  # in one linear pass
    if len(far) and far[by[-1]] == 0xFFFF:
        by = np.argsort(left, kind="stable")
    cuts = np.flatnonzero(np.append(True, left[by][1:] != left[by][:-1])) if n else np.zeros(0, np.int64)
    last = dst == np.repeat(end, counts)
    step = np.where(last, 0, dst)
    to_end = np.where(last, 0.0, 1.0)
    for a, b in zip(cuts, np.append(cuts[1:], len(by))):
        nodes = by[a:b]
        size = counts.take(nodes)
        ends_ = size.cumsum()
        arcs = np.arange(ends_[-1]) + np.repeat(first.take(nodes) - (ends_ - size), size)
        beta[nodes] = np.logaddexp.reduceat(weight.take(arcs) + beta.take(step.take(arcs)) * to_end.take(arcs), ends_ - size)
    weight += beta.take(step) * to_end
    weight -= np.repeat(beta, counts)
    logp = np.minimum(weight, 0.0, out=weight)  # of an arc, given its node
    # a node's likeliest arcs first
    order = np.empty(len(logp), np.int64)
    upto = np.ones(len(logp))
    by = np.argsort(counts.astype(np.uint16), kind="stable")
    cuts = np.flatnonzero(np.append(True, counts[by][1:] != counts[by][:-1])) if n else cuts
    for a, b in zip(cuts, np.append(cuts[1:], len(by))):
        own, wide = first[by[a:b]], int(counts[by[a]])
        if wide == 1:
            order[own] = own
        elif wide == 2:
            better = logp.take(own + 1) > logp.take(own)
            order[own], order[own + 1] = own + better, own + ~better
            upto[own] = np.exp(logp.take(own + better))
        else:
            arcs = own[:, None] + np.arange(wide)
            own_logp = logp.take(arcs)
            sorted_ = np.argsort(-own_logp, axis=1, kind="stable")
            order[arcs] = sorted_ + own[:, None]
            share = np.cumsum(np.exp(np.take_along_axis(own_logp, sorted_, 1)), axis=1)
            share[:, -1] = 1.0
            upto[arcs] = share
    return {"start": ends - sizes, "end": ends, "counts": counts, "dst": dst.take(order), "logp": logp.take(order), "upto": upto,
            "piece": ids.take(order), "bare_size": bare_size,
            "bare_pieces": vocab.byte_id[np.frombuffer(b"".join(spelled), np.uint8)]}


def _gather(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The concatenation of ``data[s:s + n]``."""
    ends = np.cumsum(size)
    return data[np.arange(ends[-1] if len(ends) else 0) + np.repeat(start - (ends - size), size)]


def noise(key: np.ndarray, path: np.ndarray, place: np.ndarray, stream: int) -> np.ndarray:
    """Uniform numbers in (0, 1), a hash of all that is given (arrays, which wrap around)."""
    return _mixed(_base(key, path, stream) + place.astype(np.uint64) * _M2)


def _base(key: np.ndarray, path: np.ndarray, stream: int) -> np.ndarray:
    """What is the same at every place."""
    x = key.astype(np.uint64) * _M3 + path.astype(np.uint64) * _M1
    x += np.array([stream], np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    return x


def _mixed(x: np.ndarray) -> np.ndarray:
    """A uniform number from each sum of a base and a place times ``_M2``; overwrites them."""
    for m in (_M1, _M2):
        x ^= x >> np.uint64(30)
        x *= m
    x ^= x >> np.uint64(31)
    x >>= np.uint64(11)
    out = x.astype(np.float64)
    out += 0.5
    out *= 2.0 ** -53
    return np.minimum(out, _BELOW_ONE, out=out)  # half a unit above the largest number is one


def _follow(lat: Lattice, word: np.ndarray, node: np.ndarray, key: np.ndarray, path: int,
            place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Random arcs from each word occurrence's node to its end: (occurrence, arc), in text order."""
    who, arcs = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    todo = np.flatnonzero(node < lat.end[word])
    for lo in range(0, len(todo), FOLLOWED):
        occ = todo[lo:lo + FOLLOWED]
        at, end = node[occ], lat.end[word[occ]]
        base = _base(key[occ], np.array([path]), 1) + (place[occ] - lat.start[word[occ]]).astype(np.uint64) * _M2
        live = np.arange(len(occ))
        each, taken = [], []
        while len(live):
            u = _mixed(base + at.astype(np.uint64) * _M2)
            arc = lat.first.take(at)
            miss = (u > lat.upto.take(arc)).nonzero()[0]
            u, other = u.take(miss), arc.take(miss)
            while len(miss):
                other += 1
                more = (u > lat.upto.take(other)).nonzero()[0]
                if len(more) < len(miss):
                    arc[miss] = other
                    miss, u, other = miss.take(more), u.take(more), other.take(more)
            each.append(live)
            taken.append(arc)
            at = lat.dst.take(arc)
            on = (at < end).nonzero()[0]
            live, at, end, base = live.take(on), at.take(on), end.take(on), base.take(on)
        steps = np.bincount(np.concatenate(each), minlength=len(occ))
        free = np.cumsum(steps) - steps
        out = np.empty(steps.sum(), np.int64)
        for step, (live, arc) in enumerate(zip(each, taken)):
            out[free.take(live) + step] = arc
        who.append(np.repeat(occ, steps))
        arcs.append(out)
    return np.concatenate(who), np.concatenate(arcs)


class _Path:
    """A segmentation: its arcs, the word occurrence of each, and its perturbed score."""

    __slots__ = ("arcs", "occ", "score", "number")

    def __init__(self, arcs, occ, score, number):
        self.arcs, self.occ, self.score, self.number = arcs, occ, score, number


def _siblings(lat: Lattice, path: _Path, key: np.uint64, since: int, most: int) -> list[tuple]:
    """The best ``most`` subtrees that leave the path at step ``since`` or later.

    Each is (score, path, step, arcs already taken there). A subtree is at most as likely as the path up to it, so no
    step is looked at from where even the largest noise is too little for one of the best."""
    base, logp = _base(np.array([key]), np.array([path.number]), 2), lat.logp[path.arcs]
    before, far = np.concatenate(([0.0], logp.cumsum())), _NEAR
    while True:
        steps = max(since, int((-before).searchsorted(far)))  # log probabilities only add up downwards
        rest = others(logp[since:steps])
        open_ = (rest > _SURE).nonzero()[0]
        where = before[open_ + since] + rest[open_]
        u = _mixed(base + (open_ + since).astype(np.uint64) * _M2)
        late = np.log(-np.log(u)) - where  # the lower, the higher is the score
        best = late.argpartition(most)[:most] if len(late) > most else np.arange(len(late))
        best = best[late[best].argsort()]
        if steps >= len(logp) or (len(best) == most and late[best[-1]] < _EARLIEST - before[steps]):
            break
        far *= 4
    score = -np.logaddexp(-path.score, late[best])
    return [(float(x), path, int(o) + since, (int(path.arcs[o + since]),)) for x, o in zip(score, open_[best])]


def _all_siblings(lat: Lattice, paths: list[_Path], keys: np.ndarray, since: list[int], most: int) -> list[list[tuple]]:
    """``_siblings`` of many paths with one number: those found on the first ``NEAR_STEPS`` steps are looked for together,
    the others one by one."""
    out: list = [None] * len(paths)
    wide = max(NEAR_STEPS, most + 1)
    for lo in range(0, len(paths), NEAR_PATHS):
        some = paths[lo:lo + NEAR_PATHS]
        size = np.array([min(len(p.arcs), wide) for p in some])[:, None]
        step = np.arange(wide)
        on = step < size
        arcs = np.zeros(on.shape, np.int64)
        arcs[on] = np.concatenate([p.arcs[:wide] for p in some])
        logp = np.where(on, lat.logp[arcs], 0.0)
        before = np.zeros((len(some), wide + 1))
        np.cumsum(logp, axis=1, out=before[:, 1:])
        near = on & (step >= np.array(since[lo:lo + NEAR_PATHS])[:, None]) & (before[:, :-1] > -_NEAR)
        row, col = near.nonzero()
        rest = others(logp[row, col])
        open_ = rest > _SURE
        row, col, rest = row[open_], col[open_], rest[open_]
        base = _base(keys[lo:lo + NEAR_PATHS], np.array([some[0].number]), 2)
        late = np.full(on.shape, np.inf)
        late[row, col] = np.log(-np.log(_mixed(base[row] + col.astype(np.uint64) * _M2))) - (before[row, col] + rest)
        best = np.argpartition(late, most, axis=1)[:, :most]
        best = np.take_along_axis(best, np.argsort(np.take_along_axis(late, best, 1), axis=1), 1)
        late = np.take_along_axis(late, best, 1)
        score = -np.logaddexp(-np.array([p.score for p in some])[:, None], late)
        # the log probability up to the first step that was not looked at, and whether there is one
        left = np.argmax(np.append(before[:, :-1] <= -_NEAR, np.ones((len(some), 1), bool), axis=1), axis=1)
        unseen = left < np.array([len(p.arcs) for p in some])
        sure = ~unseen | (late[:, -1] < _EARLIEST - before[np.arange(len(some)), left])
        for i, p in enumerate(some):
            out[lo + i] = [(x, p, o, (int(p.arcs[o]),)) for x, o, y in zip(score[i].tolist(), best[i].tolist(), late[i].tolist())
                           if y < np.inf] if sure[i] else _siblings(lat, p, keys[lo + i], since[lo + i], most)
    return out


def sample(texts: list[str], keys: np.ndarray, vocab: Vocabulary, k: int = K, seed: int = SEED) -> list[list[tuple]]:
    """For each text its segmentations: (ids, log probability, perturbed score, inclusion score)."""
    words, flat, counts = _words(texts)
    keys = noise(keys.astype(np.uint64), np.zeros(len(keys)), np.full(len(keys), seed), 3).view(np.uint64)
    if not len(words):
        return [[(np.zeros(0, np.int64), 0.0, 0.0, 1.0)] for _ in texts]
    lat = Lattice(words, vocab)
    ends = np.cumsum(counts)
    key = np.repeat(keys, counts)
    size = (lat.end - lat.start)[flat]
    place = np.cumsum(size) - size
    place -= np.repeat(np.append(place, 0)[np.minimum(ends - counts, len(place))], counts)
    root = -np.log(-np.log(noise(keys, np.zeros(len(keys)), np.zeros(len(keys)), 4)))
    who, arcs = _follow(lat, flat, lat.start[flat], key, 0, place)
    cut = np.searchsorted(who, np.append(0, ends))
    paths = [[_Path(arcs[a:b], who[a:b], float(g), 0)] for a, b, g in zip(cut, cut[1:], root)]
    queues = _all_siblings(lat, [p[0] for p in paths], keys, [0] * len(paths), k)
    for i in range(1, k):
        heads = []  # (text, parent path, step, arc, score, arcs taken)
        node = lat.end[flat]  # words that are not drawn anew start at their end
        firsts = []
        for d, queue in enumerate(queues):
            if queue:
                queue.sort(key=lambda x: -x[0])
                firsts.append((d, *queue.pop(0)))
        at = np.array([x[0] for x in firsts], np.int64)
        steps = np.array([x[3] for x in firsts], np.int64)
        draws, more = (noise(keys[at], np.array([i]), steps, stream).tolist() for stream in (5, 6))
        for (d, score, parent, step, taken), u in zip(firsts, draws):
            at = lat.src(parent.arcs[step])
            some = np.array([x for x in range(lat.first[at], lat.first[at + 1]) if x not in taken])
            p = np.exp(lat.logp[some])
            arc = int(some[min(np.searchsorted(np.cumsum(p) / p.sum(), u), len(some) - 1)])
            occ = int(parent.occ[step])
            heads.append((d, parent, step, arc, score, taken))
            node[occ] = lat.dst[arc]
            node[occ + 1:ends[d]] = lat.start[flat[occ + 1:ends[d]]]
        who, arcs = _follow(lat, flat, node, key, i, place)
        cuts = np.searchsorted(who, [(ends[x[0]] - counts[x[0]], ends[x[0]]) for x in heads]).tolist() if heads else []
        new = []
        for (d, parent, step, arc, score, taken), (a, b), u in zip(heads, cuts, more):
            path = _Path(np.concatenate((parent.arcs[:step], [arc], arcs[a:b])),
                         np.concatenate((parent.occ[:step + 1], who[a:b])), score, i)
            paths[d].append(path)
            new.append(path)
            at = lat.src(arc)
            left = [x for x in range(lat.first[at], lat.first[at + 1]) if x not in (*taken, arc)]
            if left:  # what is still untaken at this node
                where = lat.logp[parent.arcs[:step]].sum() + np.logaddexp.reduce(lat.logp[left])
                queues[d].append((float(-np.logaddexp(-score, np.log(-np.log(u)) - where)), path, step, (*taken, arc)))
        new = _all_siblings(lat, new, keys[[x[0] for x in heads]], [x[2] + 1 for x in heads], k) if new else []
        for (d, *_), found in zip(heads, new):
            queues[d] = sorted([*queues[d], *found], key=lambda x: -x[0])[:k]
    out = []
    arcs = np.concatenate([p.arcs for found in paths for p in found])
    ids, at = lat.pieces_and_ends(arcs)
    logps, hi = lat.logp.take(arcs), 0
    for found, queue in zip(paths, queues):
        threshold = max((x[0] for x in queue), default=-np.inf)
        rows = []
        for p in found:
            lo, hi = hi, hi + len(p.arcs)
            logp = float(logps[lo:hi].sum())
            inclusion = 1.0 if threshold == -np.inf else float(-np.expm1(-np.exp(min(logp - threshold, 50.0))))
            rows.append((ids[at[lo]:at[hi]], logp, p.score, inclusion))
        out.append(rows)
    return out


RESULT = "sample int, ids binary, log_prob double, perturbed double, inclusion double, decoded boolean"


def sample_segmentations(docs: DataFrame, key_col: str = "doc_id", text_col: str = "text", k: int = K,
                         seed: int = SEED, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Up to ``k`` rows per text: ``keep``, the path's number, its ids (little-endian unsigned
    32 bits), its log probability, perturbed and inclusion score, and whether it decodes to the text."""
    names = [*keep]
    src = docs.select(*names, F.coalesce(F.col(key_col).cast("long"), F.lit(0)).alias("_sp_key"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("_sp_text"))
    schema = src.select(*names).schema

    def rows(kept: list, keys: list, texts: list, types: list) -> pa.RecordBatch:
        vocab = vocabulary()
        found = sample(texts, np.array(keys, np.int64), vocab, k, seed)
        of = [at for at, paths in enumerate(found) for _ in paths]
        each = [x for paths in found for x in paths]
        ids = np.concatenate([x[0] for x in each])
        ends = np.cumsum([0, *(len(x[0]) for x in each)])
        spelled = vocab.spelled.take(pa.array(ids)).cast(pa.large_binary())
        at = np.frombuffer(spelled.buffers()[1], np.int64, len(ids) + 1)[ends].tolist()
        data = memoryview(spelled.buffers()[2] or b"").cast("B")
        own = [t.encode() for t in texts]
        decoded = [data[a + 1:b] == own[d] for d, a, b in zip(of, at, at[1:])]  # without the space in front
        packed = ids.astype("<u4")
        cols = [*([kept[d][i] for d in of] for i in range(len(names))), [i for paths in found for i in range(len(paths))],
                [packed[a:b].tobytes() for a, b in zip(ends.tolist(), ends[1:].tolist())],
                *([x[i] for x in each] for i in (1, 2, 3)), decoded]
        kinds = [*types, pa.int32(), pa.binary(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)],
                                          names=[*names, "sample", "ids", "log_prob", "perturbed", "inclusion",
                                                 "decoded"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            types = [b.schema.field(n).type for n in names]
            kept, keys, texts, held = [], [], [], 0
            for row in zip(*(b.column(n).to_pylist() for n in (*names, "_sp_key", "_sp_text"))):
                kept.append(row[:-2])
                keys.append(row[-2])
                texts.append(row[-1])
                held += len(row[-1])
                if held >= BATCH:
                    yield rows(kept, keys, texts, types)
                    kept, keys, texts, held = [], [], [], 0
            if texts:
                yield rows(kept, keys, texts, types)

    return src.mapInArrow(run, ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), RESULT]))
