"""Language-model scores from a weighted backoff automaton.

The model is a smoothed bigram model over lower-cased words and an end mark,
learned from the documents of the training folds. As an automaton: a state for
each word seen as a context, one for the start of a text, and the root. State
``u`` has an arc for every ``v`` seen after it and a failure arc to the root:

    arc u -> v:    (c(uv) + MASS * p(v)) / (c(u) + MASS)
    failure of u:  MASS / (c(u) + MASS)
    root, v:       p(v) = (c(v) + 1) / (N + V + 1)

A text is read once from left to right: the state's arc is taken if there is
one, else its failure arc and the root's; the log10 weights add up and the word
read is the next state (unseen words lead to the root). With the root's share
for one unseen word each state's weights sum to one.

No task holds the model. Documents are dealt into blocks; a block sends the
distinct words and word pairs of its texts, with their training counts, to
shards dealt by hash (a frequent word or pair is one entry per block); a shard
adds the counts up and answers each block; the block builds the part of the
automaton that its own texts can reach and walks them. Words are told apart by
64-bit hashes, pairs by 48 bits within their shard.

Defined results: a null or empty text is its end mark alone; without training
documents N and V are 0 and every unseen token costs nothing at the root;
repeated rows count as often as they occur; a null id is never held out; an
empty table gives an empty result. Other columns pass through.
"""

from __future__ import annotations

import struct
from collections import defaultdict

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Weight of the lower order in every context, in tokens.
MASS = 500.0
BLOCK_BYTES = 12 << 20
#: Mean entries in one packet from a block to a shard, at least.
PACKET = 512
_END, _START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)
_A, _B = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)


def held_out(doc_id: Column) -> Column:
    """Fold rule: crc32 of the id as text, modulo 7, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit hash of an ordered pair of hashes."""
    h = (a ^ (a >> np.uint64(31))) * _A + b
    h = (h ^ (h >> np.uint64(29))) * _B
    return h ^ (h >> np.uint64(32))


class Block:
    """Tokens of a block's texts as numbers of distinct words and pairs."""

    def __init__(self, texts: list[bytes], train: np.ndarray):
        import xxhash

        ids: defaultdict[bytes, int] = defaultdict()
        ids.default_factory = ids.__len__
        seqs = [np.fromiter(map(ids.__getitem__, t.lower().split()), np.int32) for t in texts]
        hashes = np.fromiter((xxhash.xxh64_intdigest(w) for w in ids), np.uint64, len(ids))
        hashes = np.append(hashes, [_END])
        n = len(ids)
        del ids
        sizes = np.array([len(s) + 1 for s in seqs], dtype=np.int64)
        self.ends = np.cumsum(sizes)
        tokens = np.full(int(sizes.sum()), n, dtype=np.int32)
        inside = np.ones(len(tokens), dtype=bool)
        inside[self.ends - 1] = False
        if seqs:
            tokens[inside] = np.concatenate(seqs)
        del seqs
        first = np.zeros(len(tokens), dtype=bool)
        first[self.ends - sizes] = True
        self.words, number = np.unique(hashes, return_inverse=True)
        self.token = number.astype(np.int32)[tokens]
        context = np.where(first, _START, np.roll(self.words[self.token], 1))
        # the context's own number; the start of a text has none
        self.context = np.where(first, -1, np.roll(self.token, 1))
        self.pairs, self.pair = np.unique(mix(context, self.words[self.token]), return_inverse=True)
        used = np.repeat(train, sizes)
        self.word_counts = np.bincount(self.token[used], minlength=len(self.words))
        self.pair_counts = np.bincount(self.pair[used], minlength=len(self.pairs))
        self.starts = int(train.sum())


def pack(*arrays: np.ndarray) -> bytes:
    return b"".join(struct.pack("<q", a.nbytes) + a.tobytes() for a in arrays)


def unpack(data: bytes, *dtypes: str) -> list[np.ndarray]:
    out, at = [], 0
    for d in dtypes:
        size = struct.unpack_from("<q", data, at)[0]
        out.append(np.frombuffer(data, d, size // np.dtype(d).itemsize, at + 8))
        at += 8 + size
    return out


def _small(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Counts as bytes; those of 255 and more follow whole."""
    return np.minimum(counts, 255).astype("u1"), counts[counts >= 255].astype("<i8")


def _whole(small: np.ndarray, large: np.ndarray) -> np.ndarray:
    out = small.astype(np.int64)
    out[out == 255] = large
    return out


def _low48(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h.astype("<u8").view("u1").reshape(-1, 8)[:, :6]).ravel()


def _from48(b: np.ndarray) -> np.ndarray:
    out = np.zeros((len(b) // 6, 8), np.uint8)
    out[:, :6] = b.reshape(-1, 6)
    return out.view("<u8").ravel()


def _cuts(sorted_hashes: np.ndarray, bits: int) -> np.ndarray:
    shard = (sorted_hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(sorted_hashes), np.int64)
    return np.searchsorted(shard, np.arange((1 << bits) + 1))


def _block_of(pdf: pd.DataFrame) -> Block:
    return Block([bytes(t) for t in pdf["_lm_text"]], ~pdf["held_out"].to_numpy(bool))


def _ask(bits: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        b = _block_of(pdf)
        wc, pc = _cuts(b.words, bits), _cuts(b.pairs, bits)
        block = int(pdf["_lm_block"].iloc[0])
        rows = [(block, s, b.starts, pack(
            b.words[w0:w1].astype("<u8"), *_small(b.word_counts[w0:w1]),
            _low48(b.pairs[p0:p1]), *_small(b.pair_counts[p0:p1])))
            for s, (w0, w1, p0, p1) in enumerate(zip(wc, wc[1:], pc, pc[1:]))]
        return pd.DataFrame(rows, columns=["block", "shard", "starts", "data"])
    return run


def _total(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[list[np.ndarray], np.ndarray]:
    """Each part's total counts, and the totals by distinct key."""
    unique, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.zeros(len(unique), np.int64)
    np.add.at(total, inverse, np.concatenate(counts))
    return np.split(total[inverse], np.cumsum([len(k) for k in keys])[:-1]), total


def _answer(pdf: pd.DataFrame) -> pd.DataFrame:
    """A shard's sums for every packet; with each its share of N and V, and the training documents."""
    parts = [unpack(x, "<u8", "u1", "<i8", "u1", "u1", "<i8") for x in pdf["data"]]
    words, all_words = _total([p[0] for p in parts], [_whole(p[1], p[2]) for p in parts])
    pairs, _ = _total([_from48(p[3]) for p in parts], [_whole(p[4], p[5]) for p in parts])
    return pd.DataFrame({
        "block": pdf["block"], "shard": pdf["shard"], "n": int(all_words.sum()), "v": int((all_words > 0).sum()),
        "starts": int(pdf["starts"].sum()),
        "data": [pack(*_small(w), *_small(p)) for w, p in zip(words, pairs)]})


class Automaton:
    """The states and arcs that a block's texts can reach."""

    def __init__(self, words: np.ndarray, pairs: np.ndarray, starts: int, n: int, v: int):
        self.known = words > 0
        self.root = (words + 1) / (n + v + 1)
        self.seen = np.append(words, starts)  # of every state; the start is the last, number -1
        self.pairs = pairs

    def walk(self, state: np.ndarray, word: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """log10 weight of each step: from ``state`` reading ``word``."""
        seen = self.seen[state]
        low = self.root[word]
        arc = (self.pairs[pair] + MASS * low) / (seen + MASS)
        fail = np.log10(MASS / (seen + MASS)) + np.log10(low)
        # a context that was never seen is the root: no failure arc to pay for
        return np.where(self.pairs[pair] > 0, np.log10(arc), np.where(seen > 0, fail, np.log10(low)))


def _score(keep: list[str]):
    def run(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        cols = [*keep, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if not len(docs):
            return pd.DataFrame(columns=cols)
        b = _block_of(docs)
        answers = answers.sort_values("shard")
        parts = [unpack(x, "u1", "<i8", "u1", "<i8") for x in answers["data"]]
        words = np.concatenate([_whole(p[0], p[1]) for p in parts])
        pairs = np.concatenate([_whole(p[2], p[3]) for p in parts])
        del parts
        n, v, starts = int(answers["n"].sum()), int(answers["v"].sum()), int(answers["starts"].iloc[0])
        model = Automaton(words, pairs, starts, n, v)
        begin = b.ends - np.diff(np.append(0, b.ends))
        base = np.log10((words + 1) / (n + v + 1))
        out = docs[keep].reset_index(drop=True)
        out["held_out"] = docs["held_out"].to_numpy(bool)
        out["n_tokens"] = b.ends - begin
        out["n_known"] = np.add.reduceat(model.known[b.token].astype(np.int64), begin)
        out["train_tokens"] = n
        out["base_score"] = np.add.reduceat(base[b.token], begin)
        out["score"] = np.add.reduceat(model.walk(b.context, b.token, b.pair), begin)
        return out
    return run


def score(docs: DataFrame, held: Column, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The columns of ``keep`` with ``held_out``, ``n_tokens``, ``n_known``,
    ``train_tokens``, ``base_score`` and ``score`` of every text."""
    total = docs.agg(F.coalesce(F.sum(F.octet_length(text_col)), F.lit(0))).first()[0]
    n_blocks = max(1, -(-total // block_bytes))
    bits = max(0, min(n_blocks - 1, max(1, min(total, block_bytes) // 8 // PACKET))).bit_length()
    blocked = docs.select(
        *keep, held.alias("held_out"), F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("_lm_text"),
        F.pmod(F.xxhash64(*keep, text_col), F.lit(n_blocks)).cast("int").alias("_lm_block")
    ).repartition(n_blocks, "_lm_block")
    asked = blocked.groupBy("_lm_block").applyInPandas(_ask(bits), "block int, shard int, starts long, data binary")
    answers = asked.repartition(1 << bits, "shard").groupBy("shard").applyInPandas(
        _answer, "block int, shard int, n long, v long, starts long, data binary")
    schema = (docs.select(*keep).schema.add("held_out", "boolean").add("n_tokens", "long").add("n_known", "long")
              .add("train_tokens", "long").add("base_score", "double").add("score", "double"))
    return blocked.groupBy("_lm_block").cogroup(answers.groupBy("block")).applyInPandas(_score(list(keep)), schema)
