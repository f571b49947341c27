"""Segmentations, sharding, packing, substring removal, archives and the pipeline."""

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F


def enumerate_paths(vocab, text):
    pieces = {vocab.bytes[i].decode(): i for i in vocab.bytes if i not in set(vocab.byte_id.tolist())}
    s, out = " " + text, []

    def go(at, ids, w):
        if at == len(s):
            out.append((tuple(ids), w))
            return
        for end in range(at + 1, len(s) + 1):
            if (i := pieces.get(s[at:end])) is not None:
                go(end, [*ids, i], w + vocab.logp[i])
        if s[at] not in pieces:
            own = [int(vocab.byte_id[b]) for b in s[at].encode()]
            go(at + 1, [*ids, *own], w + vocab.logp[own[0]] * len(own))
    go(0, [], 0.0)
    z = np.logaddexp.reduce([w for _, w in out])
    return {ids: w - z for ids, w in out}


@pytest.mark.parametrize("text", ["the cat", "hé中", "a  b ", "x\ny"])
def test_sampling_matches_the_distribution(text):
    from adpulse.llm.sentencepiece_sampling import sample, vocabulary
    v, n = vocabulary(), 3000
    exact = enumerate_paths(v, text)
    found = sample([text] * n, np.arange(n), v, 3)
    first, weight = {}, []
    for rows in found:
        assert len({tuple(r[0]) for r in rows}) == len(rows) == min(3, len(exact))
        assert all(a[2] >= b[2] for a, b in zip(rows, rows[1:]))
        for ids, logp, _, _ in rows:
            assert abs(exact[tuple(ids)] - logp) < 1e-6 and v.decode(ids) == text
        first[tuple(rows[0][0])] = first.get(tuple(rows[0][0]), 0) + 1
        weight.append(sum(np.exp(r[1]) / r[3] for r in rows))
    for ids, logp in exact.items():
        assert abs(first.get(ids, 0) / n - np.exp(logp)) < 0.04
    assert abs(np.mean(weight) - 1) < 0.05  # p over inclusion adds up to one on average


def test_sampling_table(docs, rows, empty):
    from adpulse.llm.sentencepiece_sampling import sample_segmentations
    out = sample_segmentations(docs, k=2).collect()
    assert all(r.decoded for r in out)
    again = sample_segmentations(docs.repartition(3), k=2).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))  # by row key, wherever it lies
    assert {r.doc_id for r in out} == {x[0] for x in rows}
    assert sample_segmentations(empty).count() == 0


def test_sampling_query_has_every_sample(spark, docs, monkeypatch):
    from adpulse.llm import queries as Q
    from adpulse.llm.sentencepiece_sampling import K
    monkeypatch.setattr(Q, "read_table", lambda *a: docs.where("doc_id in (1, 4)"))
    out = Q.QUERIES["op1_sentencepiece"](spark, "").collect()
    assert all(r.decoded for r in out) and {(r.doc_id, r.sample) for r in out} == {(d, i) for d in (1, 4) for i in range(K)}
    ids = {}
    for r in out:
        ids.setdefault((r.doc_id, r.ids_crc32, r.log_prob), set()).add(r.sample)
    assert all(len(x) == 1 for x in ids.values())  # no path twice
    assert {s for x in ids.values() for s in x} == set(range(K))


@pytest.mark.parametrize("n", [1, 2, 3, 17, 1000])
def test_feistel_is_a_bijection(n):
    from adpulse.llm.sharding import permute
    p = permute(np.arange(n), n, 7)
    assert sorted(p.tolist()) == list(range(n))
    assert permute(p, n, 7, inverse=True).tolist() == list(range(n))
    if n == 1000:
        assert abs(np.corrcoef(p, np.arange(n))[0, 1]) < 0.1


def test_sharding_table(docs, rows, empty):
    from adpulse.llm.sharding import feistel_shards
    light = docs.select("doc_id", F.crc32(F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("c"))
    out = feistel_shards(light, ["doc_id", "c"], 4).collect()
    sizes = [sorted(r.slot for r in out if r.shard == s) for s in range(4)]
    assert len(out) == len(rows) and all(s == list(range(len(s))) for s in sizes)
    assert max(map(len, sizes)) - min(map(len, sizes)) <= 1
    again = feistel_shards(light.repartition(7), ["doc_id", "c"], 4).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    assert feistel_shards(empty.select("doc_id"), ["doc_id"], 4).count() == 0


def test_tokens_equal_the_library():
    import random

    import public_tokenizers
    from tokenizers import Tokenizer

    from adpulse.llm.packing import tokenizer
    lib = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    r = random.Random(5)
    chars = list(" \n  \n\tabcdeéßñ中文字.,!?'sdt0123456789#$%<|>_-  \x85😀\x00\x1c\r")
    for i in range(4000):
        t = "".join(r.choice(chars) for _ in range(r.randint(0, 40)))
        if i % 7 == 0:  # the added token, first, last, twice or inside
            t = r.choice(["{0}<|endoftext|>x", "<|endoftext|>{0}", "{0}<|endoftext|>", "{0} <|endoftext|><|endoftext|> {0}"]).format(t)
        assert tokenizer().encode(t).tolist() == lib.encode(t, add_special_tokens=False).ids, repr(t)
    assert tokenizer().encode("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    assert len(tokenizer().ends) == 50257


def test_cuts_are_optimal():
    from adpulse.llm.packing import best_cuts
    r = np.random.default_rng(8)
    for _ in range(200):
        at = np.cumsum(r.integers(1, 9, r.integers(1, 14)))
        fine = r.integers(0, 3, len(at)) * 2
        places, cost = [0, *at.tolist()], [0]
        for i in range(1, len(places)):
            cost.append(min(cost[j] + (0 if (n := places[i] - places[j]) & (n - 1) == 0 else 16 - n)
                            for j in range(i) if places[i] - places[j] <= 16) + fine[i - 1])
        cuts = [0, *best_cuts(at, fine, 16)]
        own = sum((0 if (n := b - a) & (n - 1) == 0 else 16 - n) + fine[at.tolist().index(b)]
                  for a, b in zip(cuts, cuts[1:]))
        assert own == cost[-1] and cuts[-1] == at[-1]


def test_packing_table(docs, rows, empty):
    from adpulse.llm.packing import pack, tokenizer
    out = pack(docs, block=2000).collect()
    windows = {}
    for r in out:
        windows.setdefault(r.sequence_id, []).append(r)
    for w in windows.values():
        w.sort(key=lambda r: r.offset)
        assert [r.offset for r in w] == np.cumsum([0, *[r.length for r in w[:-1]]]).tolist()
        assert sum(r.length for r in w) <= 1024
    by = {}
    for r in sorted(out, key=lambda r: (str(r.doc_id), r.start)):
        by.setdefault(r.doc_id, []).append(r)
    for d, t, *_ in rows:
        if sum(x[0] == d for x in rows) == 1:
            ids = np.append(tokenizer().encode(t or ""), 0).astype("<u4").tobytes()
            assert b"".join(r.ids for r in by[d]) == ids and by[d][0].doc_tokens * 4 == len(ids)
    assert len([r for r in by[1] if r.start == 0]) == 3 and pack(empty).count() == 0


def brute_repeats(rows, length=50):
    low = {}
    for d, t, *_ in rows:
        b, d = (t or "").encode(), (1 << 63) - 1 if d is None else d
        for i in range(len(b) - length + 1):
            s = b[i:i + length]
            low[s] = min(low.get(s, d), d)
    out = []
    for d, t, *_ in rows:
        b, own = (t or "").encode(), (1 << 63) - 1 if d is None else d
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if low[b[i:i + length]] < own:
                gone[i:i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((d, len(b), sum(gone), bytes(gone).replace(b"\0\0", b"\0").count(b"\0\1") + (gone[:1] == b"\1"),
                    hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("block,hot", [(1 << 20, 4096), (4000, 4096), (4000, 2)])
def test_repeated_strings(docs, rows, empty, block, hot):
    from adpulse.llm.substring_dedup import remove_repeats
    out = remove_repeats(docs, block_bytes=block, hot_blocks=hot).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept_bytes")).cast("int"),
        F.size("spans") / 2, F.sha2("kept_bytes", 256)).collect()
    want = brute_repeats(rows)
    assert sorted([tuple(int(x) if isinstance(x, float) else x for x in r) for r in out], key=str) == sorted(want, key=str)
    assert remove_repeats(empty).count() == 0


def test_hot_passage_is_one_entry_per_block():
    import pandas as pd
    from adpulse.llm import substring_dedup as S
    text = bytes(np.random.default_rng(4).integers(97, 123, 3000).astype("u1"))
    docs = pd.DataFrame({"_sd_text": [text] * 200, "_sd_rid": range(200), "_sd_id": range(200), "_sd_block": 0})
    block = S._Block([text], np.zeros(1, np.int64), S.LENGTH, S.GRAM)
    for state in (1, 2):  # shared, hot
        answers = pd.DataFrame({"block": [0], "shard": [0], "state": [bytes([state]) * len(block.unique)]})
        sent = S._send(S.LENGTH, S.GRAM, 0)(docs, answers)
        entries = sum(len(S._unpack(x, "<u8")[0]) for x in sent[sent["shard"] >= 0]["data"])
        assert entries == (len(block.m) if state == 1 else len(text) - S.LENGTH + 1)


@pytest.mark.parametrize("block,hot", [(1 << 20, 4096), (4000, 2), (1 << 20, 0)])
def test_repeats_of_a_hot_text(spark, block, hot):
    """Copies in one block, within one document and under one id, of texts whose parts differ."""
    from adpulse.llm.substring_dedup import remove_repeats
    r = np.random.default_rng(5)
    a, b, c = ("".join(map(chr, r.integers(97, 123, n))) for n in (700, 160, 90))
    rows = [(i, a) for i in range(60, 10, -1)] + [(5, b + c + b), (5, c + b), (5, c + b), (3, c), (70, a + b + a), (70, a[:300] + c + c)]
    rows += [(70, a), (None, a + b), (None, b + c + "tail" + c), (None, None), (2, "x" * 900), (9, "x" * 700 + b), (9, "x" * 700 + b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out = remove_repeats(docs, block_bytes=block, hot_blocks=hot).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept_bytes")).cast("int"),
        (F.size("spans") / 2).cast("int"), F.sha2("kept_bytes", 256)).collect()
    assert sorted(map(tuple, out), key=str) == sorted(brute_repeats(rows), key=str)


@pytest.mark.parametrize("alphabet,piece", [(2, 1 << 16), (4, 64), (26, 64)])
def test_least_ids_sorts_only_what_may_be_shared(monkeypatch, alphabet, piece):
    """Least ids equal brute force, whatever the pieces; texts that share less than a string's length reach no sort."""
    from adpulse.llm import substring_dedup as S
    monkeypatch.setattr(S, "PIECE", piece)
    length, gram, r, sorted_bytes = 24, 10, np.random.default_rng(alphabet), []
    whole = S.suffix_array
    monkeypatch.setattr(S, "suffix_array", lambda t: sorted_bytes.append(len(t)) or whole(t))

    def least(texts, ids):
        ids = np.array(ids)
        b = S._Block(texts, ids, length, gram)
        assert {(d, x) for d, a, n in zip(b.doc, b.start, b.strings) for x in range(a, a + n)} == {
            (d, x) for d, t in enumerate(texts) for x in range(len(t) - length + 1)}
        assert b.unique.tolist() == sorted(set(b.m.tolist())) and (b.unique[b.inverse] == b.m).all()
        size = b.strings + length - 1
        data = S._gather(b.data, b.base[b.doc] + b.start, size)
        kind = S._kinds(b.m, np.cumsum(size) - size, size, data)
        at = np.lexsort((ids[b.doc], kind))
        one = at[np.append(True, np.diff(kind[at]) > 0)]  # distinct stretches, each with its smallest id
        found = S.least_ids(b.m[one], ids[b.doc[one]], (np.cumsum(size) - size)[one], size[one], data, length, gram)
        strings = [texts[b.doc[i]][x:x + length] for i in one for x in range(b.start[i], b.start[i] + b.strings[i])]
        want = {}
        for t, i in zip(texts, ids.tolist()):
            for x in range(len(t) - length + 1):
                want[t[x:x + length]] = min(i, want.get(t[x:x + length], i))
        assert found.tolist() == [want[x] for x in strings]

    def text(n):
        return bytes(r.integers(97, 97 + alphabet, n).astype("u1"))

    common = [text(n) for n in (30, 60, 150)]
    least([b"".join((text(r.integers(0, 40)), common[r.integers(3)], text(r.integers(0, 40)))) for _ in range(80)]
          + [b"", text(5), b"a" * 300, b"ab" * 200, b"a" * 90 + text(30)], list(range(85))[::-1])
    assert sorted_bytes
    del sorted_bytes[:]
    if alphabet > 4:
        part = text(gram + 4)
        least([text(30) + part + text(30) for _ in range(40)], list(range(40)))
        assert not sorted_bytes


def test_suffix_array_and_prefixes():
    from adpulse.llm.suffix_array import MAX_SYMBOLS, common_prefixes, suffix_array
    r = np.random.default_rng(1)
    for i in range(300):
        t = r.integers(1, [3, 6, 300, MAX_SYMBOLS + 50][i % 4], r.integers(0, 60))
        t = np.append(np.tile(t, 1 + i % 3), 0)
        sa = suffix_array(t)
        assert sa.tolist() == sorted(range(len(t)), key=lambda j: t[j:].tolist())
        p = common_prefixes(t, sa, 20)
        for a, b in zip(sa[1:], sa[:-1]):
            n = 0
            while n < 20 and a + n < len(t) and b + n < len(t) and t[a + n] == t[b + n]:
                n += 1
            assert p[a] == n


def test_suffix_array_induces_at_every_alphabet(monkeypatch):
    """Texts with more names than MAX_SYMBOLS, and gaps among the symbols, need no other sort."""
    from adpulse.llm import suffix_array as S
    monkeypatch.setattr(S.np, "lexsort", None)
    r = np.random.default_rng(2)
    for high, n in ((5, 4000), (256, 9000), (5000, 4000), (1 << 40, 500)):
        t = np.append(r.integers(1, high, n), 0)
        t = np.concatenate([t[:n // 2], t])
        sa, wide = S.suffix_array(t), t.astype(">i8").tobytes()
        assert sa.tolist() == sorted(range(len(t)), key=lambda j: wide[8 * j:])


def test_warc_round_trip(spark, empty):
    from adpulse.llm import warc as W
    big, r = "<p>" + "x" * 1200, np.random.default_rng(2)
    pages = [(i, "u", "<html>" + "".join(map(chr, r.integers(97, 122, 1500)))) for i in range(60)]
    pages += [(100 + i, "u", big) for i in range(40)] + [(300, "u", "small"), (301, "u", "small"), (302, "u", None),
                                                        (None, "u", big), (7, "u", pages[7][2])]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(4)
    manifest, folder = W.archive(spark, df)
    got = sorted(map(tuple, W.read_archive(manifest, folder).collect()), key=str)
    want = []
    for i, _, h in pages:
        b = (h or "").encode()
        same = [j for j, _, x in pages if x == h and j is not None and len(b) >= 1000]
        last = max(same, default=None)
        revisit = last is not None and (i is None or i < last)
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response",
                     last if revisit else None))
    assert got == sorted(want, key=str)
    name = manifest.first()["name"]
    fs, base = W._filesystem(folder)
    with fs.open_input_stream(f"{base}/{name}") as f:
        assert f.read(4) == (0x184D2A5D).to_bytes(4, "little")  # the dictionary leads
    none = spark.createDataFrame([], "page_id long, url string, html string")
    manifest, folder = W.archive(spark, none)
    assert W.read_archive(manifest, folder).count() == 0


def test_pipeline_stages(spark, docs, rows, empty, tmp_path):
    import corpus_pipeline as P
    names = [n for n, _ in P.STAGES]
    assert names == ["quality_rules", "simhash_near_dedup", "suffix_array_dedup", "pii", "packing"]
    base = docs.drop("score")
    kept = P.quality(spark, base, "")
    kept.write.parquet(f"{tmp_path}/1")
    kept = spark.read.parquet(f"{tmp_path}/1")
    near = P.near_duplicates(spark, kept, "")
    ids = [r.doc_id for r in near.collect()]
    assert len(ids) == len(set(ids)) and 1 in ids  # equal rows and copies: one stays
    assert near.columns == base.columns
    from adpulse.llm.simhash import simhash_classes
    assert near.count() == simhash_classes(kept).select("class_fp").distinct().count()
    cut = P.repeated_passages(spark, near, "")
    want = {d: (n, gone) for d, n, gone, *_ in brute_repeats([(r.doc_id, r.text) for r in near.collect()])}
    for r in cut.collect():
        n, gone = want[r.doc_id]
        assert 0 <= n - gone - len((r.text or "").encode()) <= 8  # split characters go whole
    masked = P.personal_data(spark, cut, "")
    assert masked.count() == near.count() and masked.columns == base.columns
    text = " ".join(r.text or "" for r in masked.collect())
    assert "<EMAIL>" in text and "jo.doe@" not in text and "4111 1111" not in text
    assert all(r.n_chars == len(r.text) for r in masked.collect())
    packed = P.packing(spark, masked, "")
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in masked.collect()}
    stage = empty
    for _, f in P.STAGES:
        stage = f(spark, stage, "")
    assert stage.count() == 0


def test_equal_crc():
    from adpulse.llm.packing import ids_crc
    assert ids_crc(np.array([1, 2])) == zlib.crc32(b"\1\0\0\0\2\0\0\0")
