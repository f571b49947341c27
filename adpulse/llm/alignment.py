"""Alignment of two tokenizers' tokens over the same bytes.

``A`` is a byte-level BPE over a space and the text, ``B`` a SentencePiece model
over the text (it adds that space itself). Both id lists cut the same bytes. The
cumulative ends of either list go into a dictionary from end to index; the
intersection of the two key sets, sorted, holds every place where both end, and
consecutive places slice both lists into groups. In a slice only the last tokens
end together and are linked: every entry has at least one byte.

A single space between two other characters is such a place in any text: neither
vocabulary has an entry with white space after its first character's. So a text
is aligned piece by piece between single spaces, and a worker remembers the
alignment of repeated pieces (at most ``CACHE_PIECES``, none longer than
``CACHE_CHARS``); a text without single spaces is one piece.

How often two ids are linked is counted over the whole table. Texts are encoded
once, in blocks of about ``BLOCK`` bytes written to the shared folder: a document
keeps the numbers of its pieces, the block their distinct links with the block's
counts. Totals per id pair, and the highest per B id, are ordinary aggregations
over the blocks' links; each block gets the totals of its own links back and sums
them per document. A frequent link is one row per block, a document's texts never
meet in one task, and nothing passes through the driver.

Defined results: a text that is null, empty or not UTF-8, or whose tokens' bytes
differ from space and text (as with U+2581, which B reads as a space), has no
tokens: zeros and an empty group string. Special tokens' strings are plain text.
Equal rows are rows of their own; an empty table gives an empty result. A kept
column with the name of a result comes out with ``_in`` appended.
"""

from __future__ import annotations

import base64
import gc
import hashlib
import re
import uuid
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adpulse.llm.common import free_names, released_after, released_pair, shared_dir

#: The vocabulary of byte_bpe_50k.json as ranks.
A_FILE = "byte_bpe_50k.tiktoken"
B_FILE = "piece_bpe_32k.model"
BLOCK = 8 << 20
CACHE_PIECES = 250_000
#: Pieces encoded in one call.
TOGETHER = 2000
CACHE_CHARS = 64
#: A pair of ids as one number: A's id above, B's in the low bits.
B_BITS = 20
COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
RESULTS = [*COUNTS, "n_best", "count_sum", "groups", "groups_sha256"]

_SINGLE = re.compile(r"(?<=\S) (?=\S)")
_ODD = re.compile(r"\s\s")
_PLAIN = re.compile(r"[^\s▁]+")


def align(a_ends: Sequence[int], b_ends: Sequence[int]) -> tuple[list[int], list[int]]:
    """How many tokens of A and of B lie up to each place where both end, given the tokens'
    ends; what follows the last such place is in no group."""
    a_at = dict(zip(a_ends, range(1, len(a_ends) + 1)))
    b_at = dict(zip(b_ends, range(1, len(b_ends) + 1)))
    common = sorted(a_at.keys() & b_at.keys())
    return list(map(a_at.__getitem__, common)), list(map(b_at.__getitem__, common))


def pieces(text: str) -> list[str]:
    """The text cut at single spaces, which are left out; each piece follows one space."""
    if _ODD.search(text) or text[:1].isspace() or text[-1:].isspace():
        return _SINGLE.split(text)
    return text.split(" ")


#: A piece whose bytes differ.
_UNLIKE = (bytes(8 * len(COUNTS)), None, b"")


class TokenPair:
    """Both tokenizers, with the alignment of pieces seen before.

    Pieces without white space (and U+2581) are encoded many at a time, joined by
    single spaces: a piece begins where a token begins with one. The others are
    encoded one by one.
    """

    def __init__(self, a_path: str, b_path: str, pattern: str):
        import sentencepiece
        import tiktoken

        with open(a_path, "rb") as f:
            ranks = {base64.b64decode(x): int(y) for x, y in map(bytes.split, f)}
        self.a = tiktoken.Encoding("a", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for piece, i in ranks.items():
            self.a_bytes[i] = piece
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(map(self.b.id_to_piece, range(self.b.vocab_size())))]
        if any(b" " in t.lstrip(b" ") for t in self.b_bytes):
            raise ValueError("the model has pieces that go on after a space")
        self.sizes = [np.array(list(map(len, t)), np.int64) for t in (self.a_bytes, self.b_bytes)]
        self.opens = [np.array([t[:1] == b" " for t in x]) for x in (self.a_bytes, self.b_bytes)]
        #: Every id before each sign that may follow it.
        self.words = [f"{i}{sign}" for i in range(max(len(self.a_bytes), len(self.b_bytes))) for sign in (",", "|", ";", "")]
        self.known: dict[str, tuple] = {}

    def _encoded(self, texts: list[str], plain: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Ids of A and of B, and where each piece's ids end."""
        if plain:
            ids = [np.array(self.a.encode_ordinary(" " + " ".join(texts)), np.int64),
                   np.array(self.b.encode(" ".join(texts), num_threads=1), np.int64)]
            ends = [np.append(np.flatnonzero(o[x])[1:], len(x)) for o, x in zip(self.opens, ids, strict=True)]
            if all(len(e) == len(texts) for e in ends):
                return ids, ends
        each = [[self.a.encode_ordinary(" " + t) for t in texts], [self.b.encode(t, num_threads=1) for t in texts]]
        return ([np.array([i for x in lists for i in x], np.int64) for lists in each],
                [np.cumsum([len(x) for x in lists], dtype=np.int64) for lists in each])

    def _aligned(self, texts: list[str], plain: bool) -> list[tuple[bytes, str | None, bytes]]:
        """Of each piece its counts (``COUNTS`` as longs), group string and links (longs); where bytes
        differ, zeros, None and no links."""
        (a, b), stops = self._encoded(texts, plain)
        whole = "".join([" " + t for t in texts]).encode()
        if (b"".join(map(self.a_bytes.__getitem__, a.tolist())) != whole
                or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != whole):
            if len(texts) == 1:
                return [_UNLIKE]
            half = len(texts) // 2
            return self._aligned(texts[:half], plain) + self._aligned(texts[half:], plain)
        # all pieces' bytes follow one another in both lists, and every piece ends in both
        to = [np.array(x, np.int64) for x in align(*[np.cumsum(s[x]).tolist() for s, x in zip(self.sizes, (a, b), strict=True)])]
        # A's and B's ids group by group: an id moves by what the other list has before it, and the sign
        # that follows it says whether its list goes on in the group, or the group, or the piece ends
        shown = np.empty(len(a) + len(b), np.int64)
        group = [np.repeat(np.arange(len(t)), np.diff(t, prepend=0)) for t in to]
        signs = [np.zeros(len(x), np.int64) for x in (a, b)]
        signs[0][to[0] - 1], signs[1][to[1] - 1], signs[1][stops[1] - 1] = 1, 2, 3
        shown[np.arange(len(a)) + np.concatenate(([0], to[1]))[group[0]]] = a * 4 + signs[0]
        shown[np.arange(len(b)) + to[0][group[1]]] = b * 4 + signs[1]
        words = list(map(self.words.__getitem__, shown.tolist()))
        # no token is without bytes: in a group only the last of either list end together
        linked = (a[to[0] - 1] << B_BITS | b[to[1] - 1]).tobytes()
        groups = np.searchsorted(to[0], stops[0], "right")
        counts = np.diff(np.stack([*stops, groups, groups], axis=1), axis=0, prepend=0).tobytes()
        at = (stops[0] + stops[1]).tolist()
        size, links = 8 * len(COUNTS), (8 * groups).tolist()
        return [(counts[size * i:size * i + size], "".join(words[w0:w1]), linked[l0:l1])
                for i, (w0, w1, l0, l1) in enumerate(zip([0, *at], at, [0, *links], links))]

    def learn(self, texts: list[str]) -> list[tuple]:
        """The pieces' alignments, from memory where they are known."""
        new = [t for t in texts if t not in self.known]
        easy = {t for t in new if _PLAIN.fullmatch(t)}
        found: dict[str, tuple] = {}
        for plain, some in ((True, list(easy)), (False, [t for t in new if t not in easy])):
            for at in range(0, len(some), TOGETHER):
                part = some[at:at + TOGETHER]
                found.update(zip(part, self._aligned(part, plain), strict=True))
        out = [found[t] if t in found else self.known[t] for t in texts]
        if len(self.known) + len(found) > CACHE_PIECES:
            self.known.clear()
        self.known.update((t, e) for t, e in found.items() if len(t) <= CACHE_CHARS)
        return out


@lru_cache(maxsize=1)
def token_pair(a_path: str, b_path: str, pattern: str) -> TokenPair:
    return TokenPair(a_path, b_path, pattern)


def _sums(values: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``ends``."""
    return np.diff(np.concatenate(([0], np.cumsum(values)))[ends])


def _ends(sizes) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(np.asarray(sizes, dtype=np.int64))))


def encode_block(texts: list[bytes | None], pair: TokenPair, with_groups: bool) -> tuple[list, dict]:
    """Per document ``(piece numbers, group string or its digest)``, and the block's table:
    counts per piece, links per piece, distinct links and how often the block has them."""
    cuts = []
    for raw in texts:
        try:
            text = (raw or b"").decode()
        except UnicodeDecodeError:
            text = ""
        cuts.append(pieces(text) if text else [])
    names = list(set().union(*cuts))
    entries = pair.learn(names)
    local = dict(zip(names, range(len(names)), strict=True))
    shown_of = [e[1] for e in entries]
    docs = []
    for cut in cuts:
        ids = list(map(local.__getitem__, cut))
        shown = list(map(shown_of.__getitem__, ids))
        if None in shown:
            ids, shown = [], []
        groups = ";".join(shown)
        if groups and not with_groups:
            groups = hashlib.sha256(groups.encode()).hexdigest()
        docs.append((np.array(ids, dtype="<i4"), groups))
    del cuts, local, names
    sizes = np.frombuffer(b"".join([e[0] for e in entries]), np.int64).reshape(-1, len(COUNTS))
    ends = _ends(sizes[:, 3])
    codes = np.frombuffer(b"".join([e[2] for e in entries]), np.int64)
    used = np.bincount(np.concatenate([d[0] for d in docs]) if docs else [], minlength=len(entries)).astype(np.int64)
    pairs, link = np.unique(codes, return_inverse=True)
    counts = np.zeros(len(pairs), np.int64)
    np.add.at(counts, link, np.repeat(used, sizes[:, 3]))
    return docs, {"sizes": sizes, "ends": ends, "links": link, "pairs": pairs, "counts": counts}


_PACKED = {"_al_block": "long", **{f"_al_{c}": "long" for c in COUNTS}, "_al_groups": "string",
           "_al_pieces": "binary", "_al_pairs": "array<long>", "_al_counts": "array<long>",
           "_al_ends": "binary", "_al_links": "binary"}


def _encoder(keep: list[str], files: tuple[str, str, str], with_groups: bool, block: int):
    def pack(part: pa.RecordBatch, number: int) -> pa.RecordBatch:
        docs, table = encode_block(part.column("_al_text").to_pylist(), token_pair(*files), with_groups)
        n = len(docs)
        ends = _ends([len(d[0]) for d in docs])
        flat = np.concatenate([d[0] for d in docs])
        sums = [_sums(table["sizes"][flat, k], ends) for k in range(4)]
        cols = [pa.concat_arrays([part.column(c), pa.nulls(1, part.column(c).type)]) for c in keep]
        cols += [pa.array([number] * (n + 1), pa.int64()),
                 *[pa.array([*s.tolist(), None], pa.int64()) for s in sums],
                 pa.array([*[d[1] for d in docs], None], pa.string()),
                 pa.array([*[d[0].tobytes() for d in docs], None], pa.binary()),
                 pa.array([*[None] * n, table["pairs"]], pa.list_(pa.int64())),
                 pa.array([*[None] * n, table["counts"]], pa.list_(pa.int64())),
                 pa.array([*[None] * n, table["ends"].astype("<i8").tobytes()], pa.binary()),
                 pa.array([*[None] * n, table["links"].astype("<i4").tobytes()], pa.binary())]
        return pa.RecordBatch.from_arrays(cols, names=[*keep, *_PACKED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for b in batches:
            sizes = _ends([len(t.as_py() or b"") for t in b.column("_al_text")])[1:]
            start = 0
            while start < b.num_rows:
                done = sizes[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(sizes, done + block, "right")))
                gc.disable()  # hundreds of thousands of small objects, none in a cycle
                try:
                    out = pack(b.slice(start, stop - start), number)
                finally:
                    gc.enable()
                yield out
                number += 1
                start = stop
    return run


def _judge(keep: list[str]):
    def run(packed: pa.Table, answers: pa.Table) -> pa.Table:
        is_block = packed.column("_al_pairs").is_valid()
        table, docs = packed.filter(is_block), packed.filter(packed.column("_al_pairs").is_null())
        ends = np.frombuffer(table.column("_al_ends")[0].as_py(), "<i8")
        link = np.frombuffer(table.column("_al_links")[0].as_py(), "<i4")
        at = answers.column("at").to_numpy()
        known = np.zeros((len(table.column("_al_pairs")[0]), 2), np.int64)
        known[at, 0] = answers.column("total").to_numpy()
        known[at, 1] = answers.column("best").to_numpy()
        by_doc = [np.frombuffer(x, "<i4") for x in docs.column("_al_pieces").to_pylist()]
        doc_ends = _ends([len(x) for x in by_doc])
        flat = np.concatenate(by_doc) if by_doc else np.zeros(0, np.int32)
        total, best = (_sums(_sums(known[link, k], ends)[flat], doc_ends) for k in range(2))
        cols = [docs.column(c) for c in [*keep, *[f"_al_{c}" for c in COUNTS]]]
        return pa.table([*cols, pa.array(best), pa.array(total), docs.column("_al_groups")],
                        names=[*keep, *COUNTS, "n_best", "count_sum", "_al_groups"])
    return run


def align_tokens(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text_col: str = "text",
                 a_path: str | None = None, b_path: str | None = None, pattern: str | None = None,
                 with_groups: bool = True, block: int = BLOCK) -> DataFrame:
    """One row per document: ``keep``, ``n_a, n_b, n_groups, n_links, n_best, count_sum`` and
    ``groups`` (``a1,a2|b1;a3|b2`` in ids) or, without ``with_groups``, ``groups_sha256`` alone."""
    import public_tokenizers
    spark = docs.sparkSession
    a_path = a_path or public_tokenizers.path(A_FILE)
    b_path = b_path or public_tokenizers.path(B_FILE)
    pattern = pattern or public_tokenizers.PATTERN
    names = free_names(list(keep), RESULTS)
    src = docs.select(*[F.col(c).alias(n) for c, n in names.items()], F.col(text_col).cast("binary").alias("_al_text"))
    kept = list(names.values())
    # a block's own row has no kept columns, so none may be declared free of nulls
    own = [T.StructField(f.name, f.dataType) for f in src.select(*kept).schema.fields]
    packed_schema = T.StructType([*own,
                                  *[T.StructField(n, T.DataType.fromDDL(kind)) for n, kind in _PACKED.items()]])
    folder = f"{shared_dir(spark).rstrip('/')}/alignment-{uuid.uuid4().hex}"
    (src.mapInArrow(released_after(_encoder(kept, (a_path, b_path, pattern), with_groups, block)), packed_schema)
     .write.parquet(folder))
    packed = spark.read.schema(packed_schema).parquet(folder)

    linked = (packed.where("_al_pairs is not null")
              .select(F.col("_al_block").alias("block"), F.posexplode(F.arrays_zip("_al_pairs", "_al_counts")).alias("at", "e"))
              .select("block", "at", F.col("e._al_pairs").alias("pair"), F.col("e._al_counts").alias("n")))
    totals = linked.groupBy("pair").agg(F.sum("n").alias("total")).withColumn(
        "b", F.col("pair").bitwiseAND(F.lit((1 << B_BITS) - 1)))
    highest = totals.groupBy("b").agg(F.max("total").alias("most"))
    judged = totals.join(highest, "b").select("pair", "total", (F.col("total") == F.col("most")).cast("long").alias("best"))
    answers = linked.join(judged, "pair").select("block", "at", "total", "best")

    shown = "groups" if with_groups else "groups_sha256"
    out_schema = T.StructType(own)
    for c in [*COUNTS, "n_best", "count_sum"]:
        out_schema = out_schema.add(c, "long")
    return (packed.groupBy("_al_block").cogroup(answers.groupBy("block"))
            .applyInArrow(released_pair(_judge(kept)), out_schema.add("_al_groups", "string"))
            .withColumnRenamed("_al_groups", shown))
