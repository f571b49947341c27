"""Token alignment, embedding near-duplicates and source divergence."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F


# ------------------------------------------------------------ token alignment
def whole_text_tokens(text):
    """Both tokenizers over the whole text: ids and byte sizes, or None where bytes differ."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    global _TOOLS
    if "_TOOLS" not in globals():
        a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
        a.encode_special_tokens = True
        _TOOLS = a, sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    a, b = _TOOLS
    if not text:
        return None
    whole = (" " + text).encode()
    enc = a.encode(" " + text, add_special_tokens=False)
    a_sizes, at = [], 0
    table = {**{c: c for c in range(0x21, 0x7F)}, **{c: c for c in range(0xA1, 0xAD)}, **{c: c for c in range(0xAE, 0x100)}}
    rest = iter(range(256, 512))
    letter = {chr(table[c]) if c in table else chr(next(rest)): c for c in range(256)}
    for t in enc.tokens:
        raw = bytes(letter[c] for c in t)
        assert whole[at:at + len(raw)] == raw
        a_sizes.append(len(raw))
        at += len(raw)
    b_ids = b.encode(text, num_threads=1)
    parts = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()
             for i, p in ((i, b.id_to_piece(i)) for i in b_ids)]
    if b"".join(parts) != whole or at != len(whole):
        return None
    return enc.ids, a_sizes, b_ids, list(map(len, parts))


def brute_alignment(texts):
    docs, count = [], Counter()
    for text in texts:
        found = whole_text_tokens(text)
        if not found:
            docs.append((0, 0, [], []))
            continue
        a, a_sizes, b, b_sizes = found
        a_ends, b_ends = np.cumsum(a_sizes).tolist(), np.cumsum(b_sizes).tolist()
        link = [(a[i], b[b_ends.index(e)]) for i, e in enumerate(a_ends) if e in set(b_ends)]
        groups, i, j = [], 0, 0
        for e in sorted(set(a_ends) & set(b_ends)):
            i2, j2 = a_ends.index(e) + 1, b_ends.index(e) + 1
            groups.append(",".join(map(str, a[i:i2])) + "|" + ",".join(map(str, b[j:j2])))
            i, j = i2, j2
        count.update(link)
        docs.append((len(a), len(b), groups, link))
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    return [(na, nb, len(g), len(link), sum(count[p] == top[p[1]] for p in link), sum(count[p] for p in link),
             hashlib.sha256(";".join(g).encode()).hexdigest() if g else "") for na, nb, g, link in docs]


ODD = ["x▁y", "a <|endoftext|> b", "<s> a </s> <0x41> <unk>", "  two  spaces ", " lead", "trail ", " ", "\n", "a\n b\n\nc",
       "tab\tand nbsp 　wide", "é é ﬁ", "\x1c a\x1cb", "한국어 \U0001f600\U0001f600", "it's we'll 's", "y" * 5000, "\x00 z"]


def test_alignment_matches_whole_texts(spark, docs, rows, empty):
    from adpulse.llm.alignment import align_tokens
    r = random.Random(5)
    signs = ["a", "the", "ing", " ", " ", "  ", "\n", "\t", "'s", "9", "é", " ", " ", ".", "<", "\U0001f600"]
    texts = [x[1] for x in rows] + ODD + ["".join(r.choice(signs) for _ in range(r.randint(1, 60))) for _ in range(150)]
    src = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, n_links int").repartition(3)
    want = brute_alignment(texts)
    for block in (8 << 20, 2000):
        out = align_tokens(src, keep=("doc_id", "n_links"), with_groups=False, block=block)
        assert out.columns[1] == "n_links_in" and [f.dataType.simpleString() for f in out.schema][2:8] == ["bigint"] * 6
        got = {x.doc_id: tuple(x)[2:] for x in out.collect()}
        assert all(got[i] == w for i, w in enumerate(want)), [(texts[i], got[i], w) for i, w in enumerate(want) if got[i] != w][:3]
    shown = {x.doc_id: x.groups for x in align_tokens(src).collect()}
    assert all((hashlib.sha256(shown[i].encode()).hexdigest() if shown[i] else "") == w[-1] for i, w in enumerate(want))
    assert align_tokens(empty).count() == 0
    assert align_tokens(docs, keep=("doc_id", "score")).count() == len(rows)


def test_align():
    from adpulse.llm.alignment import align
    assert align([2, 3, 6, 7], [1, 2, 5, 6, 9]) == ([1, 3], [2, 4]) and align([], [1]) == ([], [])


def test_alignment_query(spark):
    from adpulse.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    out = QUERIES["op11_token_alignment"](spark, sf).toPandas().set_index("doc_id")
    src = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    for x, want in zip(src, brute_alignment([x.text for x in src])):
        assert tuple(out.loc[x.doc_id]) == want


# ------------------------------------------------------------ source divergence
def brute_divergence(rows, min_df=3, top=200):
    docs = [(lang or "", source or "", [re.sub("[A-Z]+", lambda m: m[0].lower(), t) for t in
             re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]) for _, text, lang, source, *_ in rows]
    df = Counter((lang, t) for lang, _, terms in docs for t in set(terms))
    kept = defaultdict(list)
    for (lang, t), n in df.items():
        if n >= min_df:
            kept[lang].append(t)
    count = {(lang, s): Counter() for lang, s, _ in docs}
    for lang, s, terms in docs:
        count[lang, s].update(t for t in terms if df[lang, t] >= min_df)
    p = {}
    for (lang, s), c in count.items():
        n, v = sum(c.values()), len(kept[lang])
        p[lang, s] = {t: 1 + 10**9 * (c[t] + 1) // (n + v) for t in kept[lang]}
    out = set()
    for (lang, s), c in count.items():
        pairs = sorted((-sum((x - y) ** 2 // y for x, y in zip(p[lang, s].values(), p[o].values())), o[1].encode())
                       for o in count if o[0] == lang and o[1] != s)
        out |= {(lang, s, "pair", o.decode(), -v, i) for i, (v, o) in enumerate(pairs, 1)}
        whole = sum((count[o] for o in count if o[0] == lang), Counter())
        n = sum(whole.values())
        terms = []
        for t in kept[lang]:
            x, q = p[lang, s][t], 1 + 10**9 * (whole[t] + 1) // (n + len(kept[lang]))
            if c[t] and x > q:
                terms.append((-((x - q) ** 2 // q), t.encode()))
        out |= {(lang, s, "term", t.decode(), -v, i) for i, (v, t) in enumerate(sorted(terms)[:top], 1)}
    return out


@pytest.mark.parametrize("shard_terms,block_rows", [(1_000_000, 200_000), (60, 50)])
def test_divergence_matches_brute_force(spark, rows, shard_terms, block_rows):
    from adpulse.llm.divergence import source_divergence
    r = random.Random(8)
    mixed = [(i, t, r.choice(["en", "de", None, "x\x00y"]), r.choice(["s0", "s0", "s1", "é", "", None]), 0)
             for i, (_, t, *_) in enumerate(rows)] + [(0, "", "zz", "s0", 0), (1, None, "zz", "s1", 0), (2, "rare", "one", "s", 0)]
    src = spark.createDataFrame(mixed, "doc_id long, text string, lang string, source string, n_chars long")
    src = src.withColumns({"part": F.lit("x"), "value": F.lit(3), "shard": F.lit(1), "total": F.lit(0)}).repartition(4)
    out = source_divergence(src, top=40, shard_terms=shard_terms, block_rows=block_rows).collect()
    want = brute_divergence(mixed, top=40)
    assert len(out) == len(want) and {tuple(x) for x in out} == want
    assert {x.value for x in out if x.lang == "zz"} == {0}


def test_divergence_deals_a_term_once_per_digit_of_its_count():
    """A slice's terms are added up by group before they are dealt; a fit sees each term's documents, up to ``min_df``."""
    from collections import Counter
    from adpulse.llm.divergence import MARK, _deal
    r = np.random.default_rng(8)
    docs = [("ab"[r.integers(2)], "xyz"[r.integers(3)], " ".join("w" * int(k) for k in r.geometric(0.3, 200))) for _ in range(50)]
    rows = _deal(*[list(c) for c in zip(*docs)][:2], [t.encode() for _, _, t in docs], 3, 3).to_pylist()
    dealt, fit = Counter(), Counter()
    for row in rows:
        assert len(set(row["terms"])) == len(row["terms"])
        for t in row["terms"]:
            (fit if not row["times"] else dealt)[(t,) if not row["times"] else (row["lang"], row["source"], t)] += row["times"] or 1
    assert dealt == Counter((a, b, w + MARK + a) for a, b, t in docs for w in t.split())
    assert fit == {k: min(3, n) for k, n in Counter((w + MARK + a,) for a, _, t in docs for w in set(t.split())).items()}
    assert sum(len(row["terms"]) for row in rows) < 50 * 200 / 10


def test_divergence_deals_the_terms_of_many_slices_together(monkeypatch):
    """Slices are tallied alone and dealt as one: the same terms, counts and documents, in fewer entries."""
    import pyarrow as pa
    from adpulse.llm import divergence as D
    r = np.random.default_rng(4)
    docs = [(["en", "", "x\x00y"][r.integers(3)], "xyz"[r.integers(3)], " ".join("Wé"[i % 2] * int(k) for i, k in enumerate(
        r.geometric(0.3, 200)))) for _ in range(60)] + [("en", "q", ""), ("lone", "q", " . ")]
    batch = pa.RecordBatch.from_arrays([pa.array([d[0] for d in docs]), pa.array([d[1] for d in docs]),
                                        pa.array([d[2].encode() for d in docs])], names=["lang", "source", "text"])
    monkeypatch.setattr(D, "SLICE", 4000)
    entries = []
    for held in (1 << 21, 300, 1):
        monkeypatch.setattr(D, "HELD_TERMS", held)
        dealt, fit, shards = Counter(), Counter(), defaultdict(set)
        rows = [x for b in D._dealer(3, 3)(iter([batch, batch])) for x in b.to_pylist()]
        for row in rows:
            for t in row["terms"]:
                shards[t].add(row["shard"])
                (fit if not row["times"] else dealt)[(t,) if not row["times"] else (row["lang"], row["source"], t)] += row["times"] or 1
        assert dealt == Counter((a, b, w.lower() + D.MARK + a) for a, b, t in docs * 2 for w in t.split() if w.strip("."))
        df = Counter((w + D.MARK + a,) for a, _, t in docs * 2 for w in set(t.lower().split()) if w.strip("."))
        assert fit.keys() == df.keys() and all(min(3, n) <= fit[k] <= n for k, n in df.items())
        assert all(len(x) == 1 for x in shards.values())
        entries.append(sum(len(row["terms"]) for row in rows))
    assert entries[0] < entries[2] / 4


def test_divergence_sums_stay_whole_when_packed(monkeypatch):
    import pyarrow as pa
    from adpulse.llm import divergence as D
    r, want, packed = np.random.default_rng(2), Counter(), []
    monkeypatch.setattr(D, "WIDTH", 8)
    monkeypatch.setattr(D, "BLOCKS_OUT", 3)
    monkeypatch.setattr(D, "HELD", 50)
    for _ in range(4):
        rows = [("ab"[r.integers(2)], "cd"[r.integers(2)], sorted(r.choice(60, 9, False).tolist()), int(2 ** r.integers(40)))
                for _ in range(30)] + [("e", "f", [], 1)]
        for a, b, index, times in rows:
            want.update({(a, b, i): times for i in index})
        batch = pa.RecordBatch.from_arrays([
            *(pa.array([x[i] for x in rows]) for i in range(2)), pa.array([x[2] for x in rows], pa.list_(pa.int32())),
            pa.array([[1.0] * len(x[2]) for x in rows], pa.list_(pa.float64())), pa.array([x[3] for x in rows], pa.int64())],
            names=["lang", "source", "indices", "values", "times"])
        packed += list(D._group_sums(iter([batch.slice(0, 11), batch.slice(11)])))
    assert all(len(i) <= 4 * 8 for b in packed for i in b.column("idx").to_pylist())
    got = [tuple(x.values()) for b in D._whole_sums(iter(packed)) for x in b.to_pylist()]
    assert len(got) == len(want) and {x[:3]: x[3] for x in got} == want
    assert not list(D._group_sums(iter([]))) and not list(D._whole_sums(iter([])))


def test_divergence_of_empty_tables(spark, empty):
    from adpulse.llm.divergence import source_divergence
    assert source_divergence(empty).count() == 0
    one = empty.union(spark.createDataFrame([(1, "alone", "en", "s", 5)], empty.schema))
    assert source_divergence(one).count() == 0


def test_divergence_probability_of_large_counts(spark):
    from adpulse.llm.divergence import _prob
    n = 3 * 10**17
    df = spark.createDataFrame([(n, 10**18, 5)], "n long, t long, v long").select(_prob("n", "t", "v").alias("p"))
    assert df.first().p == 1 + 10**9 * (n + 1) // (10**18 + 5)


# ------------------------------------------------------------ embedding near-duplicates
def brute_vectors(rows, threshold=0.9):
    """Links by cosine over all pairs, classes by union; rows are (id, vector)."""
    ok = [bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    units = [np.array(v, float) / np.abs(np.array(v, float)).max() if g else None for (_, v), g in zip(rows, ok)]
    units = [u / np.linalg.norm(u) if u is not None else None for u in units]
    n = len(rows)
    near = [[j for j in range(n) if j != i and ok[i] and ok[j] and len(units[i]) == len(units[j])
             and units[i] @ units[j] >= threshold] for i in range(n)]
    label = list(range(n))
    for i in range(n):
        todo = [i]
        while todo:
            x = todo.pop()
            for y in near[x]:
                if label[y] > label[i]:
                    label[y] = label[i]
                    todo.append(y)
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(n) if label[j] == label[i] and rows[j][0] is not None]
        low = min(ids) if ids else None
        out.append((key, len(near[i]), low, key == low))
    return out


def vector_rows():
    r = np.random.default_rng(3)
    base = [r.normal(size=16) for _ in range(60)]
    rows = list(base)
    for k, b in enumerate(base[:30]):  # copies at every distance around the threshold, and chains
        for s in (0.02, 0.1, 0.3, 0.45, 0.5):
            rows.append(b + s * np.linalg.norm(b) / 4 * r.normal(size=16))
    rows += [base[0]] * 40 + [base[0] + 0.03 * r.normal(size=16) for _ in range(120)]
    rows += [base[1] * 1e-200, base[1] * 1e200, -base[2], base[3].astype(np.float32)]
    rows += [[1.0, 2.0], [2.0, 4.0], [1.0, 2.0, 0.0]] + [[1.0] + [0.0] * 15, [0.9, 0.19 ** 0.5] + [0.0] * 14]
    rows = [[float(x) for x in v] for v in rows]
    rows += [None, [], [0.0] * 16, [0.0] * 16, [float("nan")] * 16, [1.0, None] + [0.0] * 14, [float("inf")] * 16, [None] * 16]
    ids = r.permutation(len(rows)).tolist()
    rows = list(zip(ids, rows))
    return rows + [(None, rows[0][1]), (None, [float(x) for x in r.normal(size=16)]), rows[5], rows[5]]


@pytest.mark.parametrize("cell,block", [(8000, 8192), (15, 7)])
def test_vectors_match_brute_force(spark, cell, block):
    from adpulse.llm.embedding_dedup import near_duplicate_vectors
    rows = vector_rows()
    src = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                "vec_id long, embedding array<double>, n_links int, uid string").repartition(5)
    out = near_duplicate_vectors(src, keep=("n_links", "uid"), cell=cell, block=block)
    assert out.columns == ["vec_id", "n_links_in", "uid", "n_links", "component_id", "kept"]
    got = sorted([(x.vec_id, x.n_links, x.component_id, x.kept) for x in out.collect()], key=str)
    assert got == sorted(brute_vectors(rows), key=str)


def test_vectors_on_both_sides_of_many_planes(spark):
    """Isotropic vectors in few dimensions: pairs across cells are the rule."""
    from adpulse.llm.embedding_dedup import near_duplicate_vectors
    r = np.random.default_rng(9)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(r.normal(size=(700, 5)))]
    src = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = near_duplicate_vectors(src, cell=20, block=16).collect()
    assert sorted((x.vec_id, x.n_links, x.component_id, x.kept) for x in out) == sorted(brute_vectors(rows))
    fewer = near_duplicate_vectors(src, cell=20, block=16, reach=0.5).collect()
    assert 0.9 * sum(x.n_links for x in out) <= sum(x.n_links for x in fewer) <= sum(x.n_links for x in out)


def test_vectors_of_empty_and_unusable_tables(spark):
    from adpulse.llm.embedding_dedup import near_duplicate_vectors
    schema = "vec_id long, embedding array<float>"
    assert near_duplicate_vectors(spark.createDataFrame([], schema)).count() == 0
    bad = near_duplicate_vectors(spark.createDataFrame([(1, None), (2, [0.0]), (None, [])], schema)).collect()
    assert sorted(map(tuple, bad), key=str) == sorted([(1, 0, 1, True), (2, 0, 2, True), (None, 0, None, True)], key=str)
    one = near_duplicate_vectors(spark.createDataFrame([(4, [1.0, 2.0])], schema)).collect()
    assert list(map(tuple, one)) == [(4, 0, 4, True)]


def test_vectors_query_finds_every_link(spark):
    from adpulse.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    rows = [(x.vec_id, list(x.embedding) if x.embedding is not None else None)
            for x in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    out = QUERIES["op12_embedding_dedup"](spark, sf).collect()
    assert sorted(map(tuple, out)) == sorted(brute_vectors(rows))
