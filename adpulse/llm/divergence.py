"""How far each source's words lie from those of the other sources of its language.

Terms are runs of letters (A-Z lower-cased, every character beyond ASCII counts
as a letter). A language keeps the terms that occur in at least ``min_df`` of its
documents. A group is a language and a source; it gives each kept term the
probability ``p = 1 + floor(10^9 (count + 1) / (N + V))`` in units of 10^-9, and
the divergence of ``p`` from ``q`` at a term is ``floor((p - q)^2 / q)``.

Vectors come from Spark ML's ``CountVectorizer`` with ``minDF`` and the largest
vocabulary size it takes. A term carries its language, so a fit counts documents
within that language and every language has columns of its own, however many
languages there are. The vocabulary of a fit passes through the driver and is
broadcast, so the terms are dealt by hash into shards of about ``SHARD_TERMS``
distinct ones, each fitted alone: memory is bounded, and one pass over the texts
deals the terms of all shards. They are tallied slice by slice and dealt together for
as many slices as a task can hold the tallies of. Since a fit only asks whether
``min_df`` documents have a term, it is given a term once for each document among those
that has it, up to ``min_df`` times. The vectors are of the tallied groups, one for each
binary digit of the terms' counts, so that a term is looked up once per digit and not
once per occurrence. Their sums travel packed and are kept as sparse rows (language,
source, term, count).

The sum over all kept terms for a pair of sources is evaluated from the sparse
rows: ``V`` times the divergence of two absent terms, corrected by one value per
distinct count of either side, corrected where both sides have the term. Only
the last part looks at terms, in blocks of whole terms; no pair of rows leaves a
block, only one sum per pair of sources. All arithmetic is on integers.

Defined results: null language, source or text reads as ''; a group without terms
is there, with every count zero; a language without kept terms has the value zero
for every pair; equal rows are documents of their own; an empty table gives an
empty result; columns other than the three are never read, so names can't clash.
A long that overflows raises an error (counts up to 9 * 10^18 don't).
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from adpulse.llm.common import checkpointed, shared_dir

#: UTF-8 bytes as terms have them: A-Z lower-cased, what parts terms a space. Every byte of a character
#: beyond ASCII has its top bit set.
_LETTERS = bytes(b if b >= 0x80 or chr(b).islower() else ord(chr(b).lower()) if chr(b).isupper() else 0x20
                 for b in range(256))
MIN_DF = 3
TOP = 200
UNIT = 1_000_000_000
MAX_VOCAB = (1 << 31) - 1
#: Distinct terms of a shard, as estimated: bounds what one fit sends to the driver and broadcasts.
SHARD_TERMS = 1_000_000
#: Sparse rows of a block of the pair evaluation, and cells of its count matrix.
BLOCK_ROWS = 200_000
CELLS = 1 << 21
#: Bytes of text whose terms are dealt at a time.
SLICE = 4 << 20
#: Smallest hashes from which the distinct terms are estimated.
SKETCH = 1024
#: Entries of vectors that a task holds before it adds them up, and rows it returns at a time.
HELD = 1 << 22
ROWS_OUT = 1 << 17
#: A group's terms that a task holds before it deals them, and terms dealt at a time.
HELD_TERMS = 1 << 21
TERMS_OUT = 1 << 16
#: Indices whose sums make a row (divides 2^32), and such rows returned at a time.
WIDTH = 1 << 13
BLOCKS_OUT = 1 << 8
_P = np.uint64(0x9E3779B97F4A7C15)
#: Parts the term from its language; no term holds it.
MARK = "\x00"


def _terms(texts: list[bytes]) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of the texts, one after another, and the text that each is from."""
    # seen as strings, which the split asks for without looking at more than ASCII
    split = pc.ascii_split_whitespace(pa.array([t.translate(_LETTERS).strip() for t in texts], pa.binary()).view(pa.string()))
    found = split.flatten().view(pa.binary())
    text = np.repeat(np.arange(len(texts)), np.diff(split.offsets.to_numpy()))
    some = pc.greater(pc.binary_length(found), 0)
    if not pc.all(some).as_py():  # texts without a term
        found, text = found.filter(some), text[some.to_numpy(zero_copy_only=False)]
    return found.dictionary_encode(), text


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], list[str], list[bytes]]]:
    """Languages, sources and texts, about ``SLICE`` bytes of text at a time."""
    for b in batches:
        sizes = np.cumsum([len(t.as_py()) for t in b.column("text")])
        start = 0
        while start < b.num_rows:
            done = sizes[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(sizes, done + SLICE, "right")))
            part = b.slice(start, stop - start)
            yield tuple(part.column(c).to_pylist() for c in ("lang", "source", "text"))
            start = stop


def _hashes(keys: pa.Array) -> np.ndarray:
    """A 64-bit hash of every key's bytes, of which each has some."""
    if not len(keys):
        return np.zeros(0, np.uint64)
    ends = np.frombuffer(keys.buffers()[1], np.int32, len(keys) + 1, 4 * keys.offset).astype(np.int64)
    size, start = np.diff(ends), ends[:-1] - ends[0]
    data = np.frombuffer(keys.buffers()[2], np.uint8)[ends[0]:ends[-1]].astype(np.uint64)
    power = np.full(int(size.max()), _P, np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    data += np.uint64(1)
    data *= power.take(np.arange(len(data)) - np.repeat(start, size))
    return _mixed(np.add.reduceat(data, start))


def _mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of a hash depends on all of them."""
    for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
        h = (h ^ h >> np.uint64(30)) * np.uint64(m)
    return h ^ h >> np.uint64(31)


def _least_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ``SKETCH`` smallest hashes of the distinct (term, language) pairs of a partition."""
    least = np.zeros(0, np.uint64)
    for langs, _, texts in _slices(batches):
        for lang in set(langs):
            found = _hashes(_terms([t for x, t in zip(langs, texts, strict=True) if x == lang])[0].dictionary)
            new = _mixed(found + _hashes(pa.array([MARK.encode() + lang.encode("utf-8", "replace")], pa.binary())))
            if len(least) == SKETCH:
                new = new[new < least[-1]]
            least = np.unique(np.concatenate((least, new)))[:SKETCH]
    yield pa.RecordBatch.from_arrays([pa.array((least >> np.uint64(1)).astype(np.int64))], names=["h"])


def distinct_terms(docs: DataFrame) -> int:
    """Distinct (term, language) pairs, estimated within a few per cent from the smallest hashes of all."""
    least = [r.h for r in docs.mapInArrow(_least_hashes, "h long").distinct().orderBy("h").limit(SKETCH).collect()]
    return len(least) if len(least) < SKETCH else int((SKETCH - 1) * float(1 << 63) / least[-1])


class _Tally:
    """Terms of some texts: the keys (term and language), how many documents have each, the groups,
    and how often a group has a key."""

    def __init__(self, keys: pa.Array, having: np.ndarray, groups: list[tuple[str, str]], key: np.ndarray,
                 group: np.ndarray, n: np.ndarray):
        self.keys, self.having, self.groups, self.key, self.group, self.n = keys, having, groups, key, group, n


def _added(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys in order, and the sum of each one's numbers."""
    order = np.argsort(key)
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=-1))  # no key is below zero
    return key[first], np.add.reduceat(n[order], first) if len(first) else n[:0]


def _tally(langs: list[str], sources: list[str], texts: list[bytes]) -> _Tally:
    coded, doc = _terms(texts)
    # with documents of a group and of a language together, one sort of (term, document) has all in order
    by = sorted(range(len(texts)), key=lambda d: (langs[d], sources[d]))
    place = np.empty(len(by), np.int64)
    place[by] = np.arange(len(by))
    lang_of, lang_names = pd.factorize(np.array([langs[d] for d in by], dtype=object))
    group_of, groups = pd.factorize(pd.Series([(langs[d], sources[d]) for d in by], dtype=object))
    pair = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * len(by) + place[doc]
    pair.sort()
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    times = np.diff(first, append=len(pair))
    term, doc = pair[first] // max(1, len(by)), pair[first] % max(1, len(by))
    new_key = (np.diff(term, prepend=-1) != 0) | (np.diff(lang_of[doc], prepend=-1) != 0)
    key = np.cumsum(new_key) - 1
    start = np.flatnonzero(new_key | (np.diff(group_of[doc], prepend=-1) != 0))
    tails = pa.array([(MARK + x).encode("utf-8", "replace") for x in lang_names], pa.binary())
    joined = pc.binary_join_element_wise(coded.dictionary.take(pa.array(term[new_key])),
                                         tails.take(pa.array(lang_of[doc[new_key]])), b"")
    try:
        keys = joined.cast(pa.string())
    except pa.ArrowInvalid:  # bytes that are no UTF-8
        keys = pa.array([k.decode("utf-8", "replace") for k in joined.to_pylist()], pa.string())
    return _Tally(keys, np.bincount(key), list(groups), key[start], group_of[doc[start]],
                  np.add.reduceat(times, start) if len(start) else times)


def _merged(tallies: list[_Tally]) -> _Tally:
    """The tally of all their texts; every document is in one of them."""
    coded = pa.concat_arrays([t.keys for t in tallies]).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    width, groups = max(1, len(coded.dictionary)), {}
    having = np.zeros(width, np.int64)
    np.add.at(having, code, np.concatenate([t.having for t in tallies]))
    at, start = [], 0
    for t in tallies:
        of = np.zeros(len(t.groups), np.int64)
        for g in np.unique(t.group).tolist():
            of[g] = groups.setdefault(t.groups[g], len(groups))
        at.append(of[t.group] * width + code[start:start + len(t.keys)][t.key])
        start += len(t.keys)
    at, n = _added(np.concatenate(at), np.concatenate([t.n for t in tallies]))
    return _Tally(coded.dictionary, having[:len(coded.dictionary)], list(groups), at % width, at // width, n)


def _lists(row: np.ndarray, rows: int, kind: np.ndarray, keys: pa.Array) -> pa.ListArray:
    """The keys of each of ``rows`` rows; ``row`` is sorted."""
    ends = np.concatenate(([0], np.cumsum(np.bincount(row, minlength=rows))))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), keys.take(pa.array(kind)))


def _dealt(found: _Tally, shards: int, min_df: int) -> pa.RecordBatch:
    """One row per shard, group and binary digit of a count: the group's terms whose count has that
    digit, which counts ``times``. And per shard ``min_df`` rows to fit on, the ``r``-th with the
    terms that more than ``r`` documents have."""
    keys, having = found.keys, found.having
    shard_of = (_hashes(keys) % np.uint64(shards)).astype(np.int64)
    wide = max(1, len(found.groups))
    at = shard_of[found.key] * wide + found.group
    order = np.argsort(at, kind="stable")
    at, key, n = at[order], found.key[order], found.n[order]
    by_shard = np.argsort(shard_of, kind="stable")

    parts = []
    for bit in range(int(n.max(initial=0)).bit_length()):
        some = np.flatnonzero(n >> bit & 1)
        new = np.diff(at[some], prepend=-1) > 0
        group = at[some][new]
        parts.append((_lists(np.cumsum(new) - 1, len(group), key[some], keys), group % wide, group // wide, 1 << bit))
    for r in range(min_df):
        some = by_shard[having[by_shard] > r]
        shard = np.unique(shard_of[some])
        parts.append((_lists(np.searchsorted(shard, shard_of[some]), len(shard), some, keys), np.full(len(shard), -1), shard, 0))
    lists, group, shard, times = zip(*parts)
    group, shard = np.concatenate(group), np.concatenate(shard)
    named = [pa.array([g[i] for g in found.groups], pa.string()).take(pa.array(group, mask=group < 0)) for i in range(2)]
    return pa.RecordBatch.from_arrays(
        [*named, pa.concat_arrays(lists), pa.array(np.repeat(times, [len(x) for x in lists]), pa.int64()),
         pa.array(shard.astype(np.int32))], names=["lang", "source", "terms", "times", "shard"])


def _deal(langs: list[str], sources: list[str], texts: list[bytes], shards: int, min_df: int) -> pa.RecordBatch:
    """The terms of one slice as they are dealt."""
    return _dealt(_tally(langs, sources, texts), shards, min_df)


def _dealer(shards: int, min_df: int):
    def dealt(held: list[_Tally]) -> Iterator[pa.RecordBatch]:
        out = _dealt(_merged(held), shards, min_df)
        step = max(1, out.num_rows * TERMS_OUT // max(1, len(out.column("terms").flatten())))
        for lo in range(0, out.num_rows, step):
            yield out.slice(lo, step)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for langs, sources, texts in _slices(batches):
            held.append(_tally(langs, sources, texts))
            if sum(len(t.n) for t in held) >= HELD_TERMS:
                yield from dealt(held)
                held = []
        if held:
            yield from dealt(held)
    return run


class _Sums:
    """Numbers by language, source and index, added up now and then."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.parts, self.held = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], 0

    def add(self, langs: list, sources: list, sizes: np.ndarray, index: np.ndarray, n: np.ndarray) -> None:
        """Rows of ``sizes`` entries, one after another."""
        of = np.array([self.groups.setdefault(g, len(self.groups)) for g in zip(langs, sources, strict=True)], np.int64)
        self.parts.append((np.repeat(of, sizes) << 32 | index.astype(np.int64), n))
        self.held += len(n)
        if self.held >= HELD:
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct ``group << 32 | index`` in order, and their sums."""
        if self.held:
            self.parts, self.held = [_added(*map(np.concatenate, zip(*self.parts)))], 0
        return self.parts[0]

    def named(self, group: np.ndarray) -> list[pa.Array]:
        names = list(self.groups)
        return [pa.array([g[i] for g in names], pa.string()).take(pa.array(group)) for i in range(2)]


def _group_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sums of a partition's sparse vectors by language and source: a row per ``WIDTH`` indices, which holds those
    that occur and their sums as little-endian 32 and 64 bits."""
    sums = _Sums()
    for b in batches:
        indices, values = b.column("indices"), b.column("values")
        sizes = np.diff(indices.offsets.to_numpy())
        sums.add(b.column("lang").to_pylist(), b.column("source").to_pylist(), sizes, indices.flatten().to_numpy(),
                 values.flatten().to_numpy().astype(np.int64) * np.repeat(b.column("times").to_numpy(), sizes))
    key, total = sums.total()
    start = np.append(np.flatnonzero(np.diff(key // WIDTH, prepend=-1)), len(key))
    index, total = (key & 0xFFFFFFFF).astype("<u4"), total.astype("<i8")
    for lo in range(0, len(start) - 1, BLOCKS_OUT):
        cut = start[lo:lo + BLOCKS_OUT + 1]
        first = key[cut[:-1]]
        packed = [pa.BinaryArray.from_buffers(pa.binary(), len(first), [
            None, pa.py_buffer(((cut - cut[0]) * x.itemsize).astype(np.int32)), pa.py_buffer(x[cut[0]:cut[-1]])])
            for x in (index, total)]
        yield pa.RecordBatch.from_arrays([*sums.named(first >> 32), pa.array(((first & 0xFFFFFFFF) // WIDTH).astype(np.int32)),
                                          *packed], names=["lang", "source", "part", "idx", "n"])


def _packed(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Numbers in each row, and all of them."""
    offsets = np.frombuffer(column.buffers()[1], np.int32, len(column) + 1, 4 * column.offset).astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0]:offsets[-1]]
    return np.diff(offsets) // np.dtype(kind).itemsize, np.frombuffer(data.tobytes(), kind)


def _whole_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``_group_sums`` found in all partitions, added up and as sparse rows."""
    sums = _Sums()
    for b in batches:
        if b.num_rows:
            sizes, index = _packed(b.column("idx"), "<u4")
            sums.add(b.column("lang").to_pylist(), b.column("source").to_pylist(), sizes, index, _packed(b.column("n"), "<i8")[1])
    key, total = sums.total()
    for lo in range(0, len(key), ROWS_OUT):
        k = key[lo:lo + ROWS_OUT]
        yield pa.RecordBatch.from_arrays(
            [*sums.named(k >> 32), pa.array((k & 0xFFFFFFFF).astype(np.int32)), pa.array(total[lo:lo + ROWS_OUT])],
            names=["lang", "source", "idx", "n"])


def _prob(count: str, total: str, size: str) -> Column:
    """``1 + floor(10^9 (count + 1) / (total + size))``, exact for counts beyond 10^9."""
    return F.expr(f"1 + (cast({count} + 1 as decimal(19,0)) * {UNIT}BD) div cast({total} + {size} as decimal(19,0))")


def _probs(counts: np.ndarray, total: int, size: int) -> np.ndarray:
    """The same for an array of counts, in Python's integers once per distinct count."""
    each, at = np.unique(counts, return_inverse=True)
    return np.array([1 + UNIT * (c + 1) // (total + size) for c in each.tolist()], np.int64)[at]


def _gap(p: str, q: str) -> Column:
    return F.expr(f"(({p}) - ({q})) * (({p}) - ({q})) div ({q})")


def _gaps(p, q):
    return (p - q) * (p - q) // q


def group_counts(docs: DataFrame, min_df: int = MIN_DF, shard_terms: int = SHARD_TERMS) -> tuple[DataFrame, DataFrame]:
    """``(vocabulary, counts)``: kept terms as (shard, idx, lang, term) and the sparse group
    sums as (shard, idx, lang, source, n), both written to the shared folder."""
    spark = docs.sparkSession
    folder = f"{shared_dir(spark).rstrip('/')}/divergence-{uuid.uuid4().hex}"
    docs = docs.withColumn("text", F.col("text").cast("binary"))
    shards = max(1, -(-distinct_terms(docs) // shard_terms))
    columns = "lang string, source string, terms array<string>, times long, shard int"
    docs.mapInArrow(_dealer(shards, min_df), columns).write.partitionBy("shard").parquet(f"{folder}/terms")
    # three documents of a term that can't occur: a fit without a single kept term raises an error
    none = spark.range(min_df).select(F.array(F.lit(MARK)).alias("terms"))
    vectorizer = CountVectorizer(inputCol="terms", outputCol="vector", minDF=float(min_df), vocabSize=MAX_VOCAB)
    for s in range(shards):
        part = spark.read.schema(columns).parquet(f"{folder}/terms").where(F.col("shard") == s)
        model = vectorizer.fit(part.where("times = 0").select("terms").unionByName(none))
        model.write().save(f"{folder}/models/{s}")
        (spark.read.parquet(f"{folder}/models/{s}/data").select(F.posexplode("vocabulary").alias("idx", "key"))
         .where(F.col("key") != MARK)
         .select("idx", F.substring_index("key", MARK, 1).alias("term"),
                 F.expr("substr(key, instr(key, '\\0') + 1)").alias("lang"))
         .write.parquet(f"{folder}/vocabulary/shard={s}"))
        vector = F.unwrap_udt("vector")
        (model.transform(part.where("times > 0").select("lang", "source", "terms", "times"))
         .select("lang", "source", "times", vector["indices"].alias("indices"), vector["values"].alias("values"))
         .mapInArrow(_group_sums, "lang string, source string, part int, idx binary, n binary")
         .repartition("lang", "source", "part").mapInArrow(_whole_sums, "lang string, source string, idx int, n long")
         .write.parquet(f"{folder}/counts/shard={s}"))
    return (spark.read.schema("idx int, term string, lang string, shard int").parquet(f"{folder}/vocabulary"),
            spark.read.schema("lang string, source string, idx int, n long, shard int").parquet(f"{folder}/counts"))


_NO_ROWS = pd.DataFrame({**{c: pd.Series(dtype=object) for c in ("lang", "source", "part", "item")},
                         **{c: pd.Series(dtype=np.int64) for c in ("shard", "idx", "value")}})


def _block(top: int):
    """Over the terms of one block of a language, whose groups come beside it: per ordered pair of
    sources that share terms, the sum of what both having a term changes against the value of
    either alone (part ``pair``); and each group's leading terms (part ``term``), every term with
    the value of the ``top``-th included, since ties are only ranked by their texts."""
    def run(rows: pd.DataFrame, groups: pd.DataFrame) -> pd.DataFrame:
        if rows.empty:
            return _NO_ROWS
        lang, size, all_n = groups["lang"].iloc[0], int(groups["v"].iloc[0]), int(groups["all_n"].iloc[0])
        source, sources = pd.factorize(rows["source"])
        term, terms = pd.factorize(rows["shard"].to_numpy(np.int64) << 32 | rows["idx"].to_numpy(np.int64))
        order = np.argsort(term, kind="stable")
        term, source, n = term[order], source[order], rows["n"].to_numpy(np.int64)[order]
        total = groups.set_index("source")["total"].to_dict()
        absent = np.array([1 + UNIT // (total[s] + size) for s in sources], np.int64)
        p = np.empty(len(n), np.int64)
        for g, s in enumerate(sources):
            p[source == g] = _probs(n[source == g], total[s], size)
        out = []

        whole = np.zeros(len(terms), np.int64)
        np.add.at(whole, term, n)
        q = _probs(whole, all_n, size)[term]
        for g, s in enumerate(sources):
            ahead = np.flatnonzero((source == g) & (p > q))
            value = _gaps(p[ahead], q[ahead])
            if len(value) > top:
                best = value >= np.partition(value, len(value) - top)[len(value) - top]
                ahead, value = ahead[best], value[best]
            out.append(pd.DataFrame({"source": s, "part": "term", "item": None, "shard": terms[term[ahead]] >> 32,
                                     "idx": terms[term[ahead]] & 0xFFFFFFFF, "value": value}))

        change = np.zeros((len(sources), len(sources)), np.int64)
        step = max(1, CELLS // len(sources))
        for lo in range(0, len(terms), step):
            a, b = np.searchsorted(term, [lo, lo + step])
            grid = np.zeros((min(step, len(terms) - lo), len(sources)), np.int64)
            grid[term[a:b] - lo, source[a:b]] = p[a:b]
            for h in range(len(sources)):
                own = grid[grid[:, h] > 0]
                at, g = np.nonzero(own)
                x, y = own[at, g], own[at, h]
                np.add.at(change[:, h], g, _gaps(x, y) - _gaps(x, absent[h]) - _gaps(absent[g], y) + _gaps(absent[g], absent[h]))
        g, h = np.nonzero(~np.eye(len(sources), dtype=bool))
        out.append(pd.DataFrame({"source": sources.take(g), "part": "pair", "item": sources.take(h), "shard": 0, "idx": 0,
                                 "value": change[g, h]}))
        return pd.concat(out, ignore_index=True).assign(lang=lang).astype(_NO_ROWS.dtypes)[list(_NO_ROWS)]
    return run


def source_divergence(docs: DataFrame, min_df: int = MIN_DF, top: int = TOP, shard_terms: int = SHARD_TERMS,
                      block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows ``lang, source, part, item, value, rank``: part ``pair`` holds every other source of the
    language by divergence, part ``term`` the ``top`` terms by which the source leads its language."""
    docs = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    vocabulary, counts = group_counts(docs, min_df, shard_terms)
    size = vocabulary.groupBy("lang").agg(F.count("*").alias("v"))
    # how many terms a group has how often: all that a pair's value takes where one side lacks the term
    kinds = checkpointed(counts.groupBy("lang", "source", "n").agg(F.count("*").alias("k")))
    totals = kinds.groupBy("lang", "source").agg(F.sum(F.col("n") * F.col("k")).alias("total"))
    groups = checkpointed(
        docs.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(size, "lang", "left")
        .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("v", F.lit(0)).alias("v"))
        .withColumn("p0", F.when(F.col("v") > 0, _prob("0L", "total", "v")).otherwise(F.lit(1))))

    blocks = max(1, -(-(kinds.agg(F.sum("k").alias("n")).first()["n"] or 0) // block_rows))
    whole = groups.groupBy("lang").agg(F.sum("total").alias("all_n"))
    beside = (groups.join(whole, "lang").select(F.col("lang").alias("of"), "lang", "source", "total", "v", "all_n",
                                                F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")))
    dealt = counts.withColumn("block", F.pmod(F.xxhash64("shard", "idx"), F.lit(blocks)).cast("int"))
    found = checkpointed(
        dealt.groupBy("lang", "block").cogroup(beside.groupBy("of", "block")).applyInPandas(
            _block(top), "lang string, source string, part string, item string, shard int, idx int, value long"))

    best = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    leading = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    lead = (found.where("part = 'term'").withColumn("least", F.rank().over(leading)).where(F.col("least") <= top)
            .join(vocabulary.drop("lang"), ["shard", "idx"])
            .select("lang", "source", F.col("term").alias("item"), "value")
            .withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= top))

    g, h = groups.alias("g"), groups.alias("h")
    other = (F.col("g.lang") == F.col("h.lang")) & (F.col("g.source") != F.col("h.source"))
    named = [F.col("g.lang"), F.col("g.source"), F.col("h.source").alias("item")]
    alone = g.join(h, other).select(*named, (F.col("g.v") * _gap("g.p0", "h.p0")).alias("value"))
    seen = kinds.join(groups, ["lang", "source"]).withColumn("p", _prob("n", "total", "v")).select(
        "lang", "source", "p", "p0", "k")
    left = seen.alias("g").join(h, other).select(
        *named, (F.col("k") * (_gap("g.p", "h.p0") - _gap("g.p0", "h.p0"))).alias("value"))
    right = g.join(seen.alias("h"), other).select(
        *named, (F.col("k") * (_gap("g.p0", "h.p") - _gap("g.p0", "h.p0"))).alias("value"))
    shared = found.where("part = 'pair'").select("lang", "source", "item", "value")
    pairs = alone
    for x in (left, right, shared):
        pairs = pairs.unionByName(x.groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))
    pairs = pairs.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("rank", F.row_number().over(best))
    order = ["lang", "source", "part", "item", "value", "rank"]
    return (pairs.withColumn("part", F.lit("pair")).select(*order)
            .unionByName(lead.withColumn("part", F.lit("term")).select(*order)))
