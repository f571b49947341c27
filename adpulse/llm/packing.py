"""Order-preserving packing into fixed windows by dynamic programming.

Documents are laid end to end in id order, each as its token ids and one end
id. Windows of at most ``max_len`` tokens are cut from this stream; a window is
padded to ``max_len`` unless its length is a power of two. Cuts fall on
document ends or sentence ends (a sentence longer than a window is also cut
every ``max_len`` tokens). Over all cut positions ``p`` of a block of stream

    cost(p) = penalty(p) + min over q of cost(q) + padding(p - q)

is minimised exactly: padding to ``max_len`` is linear in ``q``, so the best
``q`` of the last ``max_len`` tokens is kept in a monotone queue, and the few
power-of-two lengths, which cost no padding, are looked up one by one. Cutting
inside a document costs ``CUT_SENTENCE`` padding tokens, inside a sentence
``CUT_INSIDE``, between documents nothing.

One shuffle deals the documents into ranges of ids; tokenising and packing run
in the same pass over each sorted range, in blocks of about ``BLOCK`` tokens,
so a task holds one block. Windows don't cross blocks.

Defined results: a null or empty text is its end id alone; null ids come first;
rows of equal ids stand in the order of their texts' hashes; an empty table
gives no windows. The window number is unique and grows with the stream.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import released_after

MAX_LEN = 1024
END_ID = 0
BLOCK = 1 << 18
CUT_SENTENCE = 8
CUT_INSIDE = 64
#: Words whose ids a worker remembers; beyond it starts anew.
CACHE_WORDS = 400_000
#: White space of two characters: there the text does not fall apart at single ones.
_ODD_SPACE = re.compile(r"\s\s")


class Tokenizer:
    """Byte-level BPE ids of whole texts, repeated words looked up.

    The vocabulary's own pattern never joins words over a single space or line
    feed, so a text falls apart into its first word and pieces that start with
    one of the two, whose ids are remembered. The unknown pieces of a text are
    encoded in one call: only a piece's first token starts with its space or
    line feed. Texts with two white-space characters in a row are encoded whole.
    The file's added tokens are found in a text before anything else and part it.
    """

    def __init__(self, name: str = "byte_bpe_50k"):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bpe = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                     special_tokens={})
        with open(public_tokenizers.path(f"{name}.json"), encoding="utf-8") as f:
            self.added = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
        longest = sorted(self.added, key=len, reverse=True)
        self.parts = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if longest else None
        ends = (".", "!", "?", "。", "！", "？", "\n")
        #: By id: whether the token can end a sentence.
        n = max(*ranks.values(), *self.added.values()) + 1
        self.ends = np.zeros(n, dtype=bool)
        for piece, i in ranks.items():
            self.ends[i] = piece.decode("utf-8", "ignore").endswith(ends)
        self.starts = {c: np.zeros(n, dtype=bool) for c in " \n"}
        for piece, i in ranks.items():
            if piece[:1] in (b" ", b"\n"):
                self.starts[chr(piece[0])][i] = True
        #: White space that ends a text stands alone.
        self.alone = {"": self._whole(" ").tobytes(), "\n": self._whole("\n").tobytes()}
        #: Ids by word, as little-endian unsigned 32-bit bytes, ready to be joined.
        self.known: dict[str, bytes] = dict(self.alone)

    def _learn(self, words: list[str], mark: str) -> None:
        """Remembers the ids of ``words`` as they follow ``mark``; after a line feed
        the words carry it themselves."""
        if words:
            lead = " " if mark == " " else ""
            ids = self._whole("".join([lead + w for w in words]))
            at = [*(np.flatnonzero(self.starts[mark][ids]) * 4).tolist(), len(ids) * 4]
            data = ids.tobytes()
            self.known.update((w, data[a:b]) for w, a, b in zip(words, at[:-1], at[1:], strict=True))

    def _whole(self, text: str) -> np.ndarray:
        return np.asarray(self.bpe.encode_ordinary(text), dtype="<u4")

    def encode(self, text: str) -> np.ndarray:
        if self.parts and self.parts.search(text):
            return np.concatenate([np.array([self.added[x]], dtype="<u4") if x in self.added else self._plain(x)
                                   for x in self.parts.split(text) if x])
        return self._plain(text)

    def _plain(self, text: str) -> np.ndarray:
        if _ODD_SPACE.search(text):
            return self._whole(text)
        first, *rest = text.replace("\n", " \n").split(" ")
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
            self.known.update(self.alone)
        new = set(rest).difference(self.known)
        self._learn([w for w in new if w[:1] != "\n"], " ")
        self._learn([w for w in new if w[:1] == "\n"], "\n")
        data = b"".join([self._whole(first).tobytes(), *map(self.known.__getitem__, rest)])
        return np.frombuffer(data, dtype="<u4")


@lru_cache(maxsize=1)
def tokenizer(name: str = "byte_bpe_50k") -> Tokenizer:
    return Tokenizer(name)


def cut_positions(lengths: list[int], sentence_ends: np.ndarray, max_len: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted places (token counts) where a window may end, and their penalties."""
    doc_ends = np.cumsum(lengths)
    at = np.union1d(doc_ends, sentence_ends)
    gaps = np.diff(np.concatenate(([0], at)))
    extra = [np.arange(p - g + max_len, p, max_len) for p, g in zip(at[gaps > max_len], gaps[gaps > max_len])]
    inside = np.concatenate(extra) if extra else np.zeros(0, np.int64)
    at = np.union1d(at, inside)
    penalty = np.full(len(at), CUT_SENTENCE, dtype=np.int64)
    penalty[np.isin(at, inside)] = CUT_INSIDE
    penalty[np.isin(at, doc_ends)] = 0
    return at, penalty


def best_cuts(at: np.ndarray, penalty: np.ndarray, max_len: int) -> list[int]:
    """The chosen window ends: least padding plus penalties over the whole block."""
    powers = [1 << b for b in range(max_len.bit_length()) if 1 << b <= max_len]
    places = [0, *at.tolist()]
    fines = [0, *penalty.tolist()]
    index = {p: i for i, p in enumerate(places)}
    cost, came = [0] * len(places), [0] * len(places)
    queue: deque[int] = deque([0])  # candidates, cost + place rising
    for i in range(1, len(places)):
        p = places[i]
        while places[queue[0]] < p - max_len:
            queue.popleft()
        q = queue[0]
        best, frm = cost[q] + max_len - p + places[q], q
        for size in powers:
            j = index.get(p - size)
            if j is not None and cost[j] < best:
                best, frm = cost[j], j
        cost[i], came[i] = best + fines[i], frm
        key = cost[i] + p
        while queue and cost[queue[-1]] + places[queue[-1]] >= key:
            queue.pop()
        queue.append(i)
    cuts, i = [], len(places) - 1
    while i:
        cuts.append(places[i])
        i = came[i]
    return cuts[::-1]


def pack_block(ids: list[np.ndarray], ends: np.ndarray, max_len: int) -> Iterator[tuple[int, int, int, int, int]]:
    """(document, start, length, window, offset) of every piece, in stream order.

    ``ids`` are the documents' ids with their end id, ``ends`` the sentence marks by id.
    """
    lengths = [len(x) for x in ids]
    starts = np.concatenate(([0], np.cumsum(lengths)))
    marks = np.flatnonzero(ends[np.concatenate(ids)]) + 1
    cuts = best_cuts(*cut_positions(lengths, marks, max_len), max_len)
    doc, begin = 0, 0
    for window, end in enumerate(cuts):
        p = begin
        while p < end:
            stop = min(end, int(starts[doc + 1]))
            yield doc, p - int(starts[doc]), stop - p, window, p - begin
            p = stop
            if p == starts[doc + 1]:
                doc += 1
        begin = end


PIECES = "start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_len: int = MAX_LEN,
         block: int = BLOCK) -> DataFrame:
    """The pieces of all documents: id, place in document, ids (little-endian
    unsigned 32 bits), and window and place there."""
    ranged = (docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_pk_text"))
              .withColumn("_pk_tie", F.xxhash64("_pk_text"))
              .repartitionByRange(id_col, "_pk_tie").sortWithinPartitions(id_col, "_pk_tie"))

    def flush(schema: pa.Schema, keys: list, ids: list[np.ndarray], ends: np.ndarray, first: int) -> tuple:
        rows = list(pack_block(ids, ends, max_len))
        data = [ids[d][s:s + n].tobytes() for d, s, n, _, _ in rows]
        cols = [[keys[r[0]] for r in rows], [r[1] for r in rows], [r[2] for r in rows], data,
                [len(ids[r[0]]) for r in rows], [first + r[3] for r in rows], [r[4] for r in rows]]
        return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(cols, schema)],
                                          schema=schema), rows[-1][3] + 1

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer()
        window = TaskContext.get().partitionId() << 40
        keys, ids, held, schema = [], [], 0, None
        for b in batches:
            schema = schema or pa.schema([(id_col, b.schema.field(id_col).type), ("start", pa.int64()),
                                          ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64()),
                                          ("sequence_id", pa.int64()), ("offset", pa.int64())])
            for key, text in zip(b.column(id_col), b.column("_pk_text")):
                keys.append(key.as_py())
                ids.append(np.append(tok.encode(text.as_py()), np.uint32(END_ID)))
                held += len(ids[-1])
                if held >= block:
                    out, n = flush(schema, keys, ids, tok.ends, window)
                    yield out
                    keys, ids, held, window = [], [], 0, window + n
        if ids:
            yield flush(schema, keys, ids, tok.ends, window)[0]

    kind = dict(docs.dtypes)[id_col]
    return ranged.mapInArrow(released_after(run), f"`{id_col}` {kind}, {PIECES}")


def with_crc(pieces: DataFrame) -> DataFrame:
    """The pieces with ``ids_crc32`` in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def ids_crc(ids: np.ndarray) -> int:
    return zlib.crc32(np.asarray(ids, dtype="<u4").tobytes())
