"""Quality rules, fingerprints, personal data and scores against brute force."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def key(x):
    return (x is None, x)


def test_quality_rules_base_counts(docs, rows, empty):
    from adpulse.llm.quality_rules import clean_documents, quality_rules
    want = []
    for d, t, *_ in rows:
        t = t or ""
        w = WORD.findall(t)
        c = Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i in range(len(w) - 2) if c[tuple(w[i:i + 3])] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        want.append((d, len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t), len(lines) - len(set(lines)),
                     len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)))
    out = quality_rules(docs)
    got = [tuple(r) for r in out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                        "n_repeat_words", "base_failed").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert "score" in out.columns and quality_rules(empty).count() == 0
    clean = {r.doc_id: r.clean_text for r in clean_documents(docs).collect()}
    by = {r.doc_id: r for r in out.collect()}
    assert set(clean) - {None} == {d for d, r in by.items() if r.kept} - {None}
    assert any("All rights" in (r.text or "") and "All rights" not in clean[d] for d, r in by.items() if d in clean)
    assert not any("na | na" in t for t in clean.values())
    clash = docs.withColumn("n_words", F.lit("own")).withColumn("clean_text", F.lit(0)).withColumn("kept", F.lit(7))
    one = clean_documents(clash).where("doc_id = 4").first()
    assert (one.n_words, one.kept) == ("own", 7) and one.clean_text == clean[4]


def test_quality_rules_long_text_path(docs, monkeypatch):
    """Texts with more windows than packed positions take the pair sort, with equal results."""
    from adpulse.llm import quality_rules as Q
    a = Q.quality_rules(docs).select("doc_id", "n_repeat_words").collect()
    monkeypatch.setattr(Q, "POS_BITS", 6)
    b = Q.quality_rules(docs).select("doc_id", "n_repeat_words").collect()
    assert sorted(a, key=str) == sorted(b, key=str)


def shingles(t, n):
    w = (t or "").encode().lower().split()
    return [b" ".join(w[i:i + n]) for i in range(max(1, len(w) - n + 1))] if w else []


def brute_fp(t):
    import xxhash
    hs = [xxhash.xxh64_intdigest(s, 42) for s in shingles(t, 3)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def test_simhash_classes(docs, rows, empty):
    from adpulse.llm.simhash import simhash_classes
    fps = [(d, brute_fp(t)) for d, t, *_ in rows]
    distinct = sorted({f for _, f in fps})
    parent = {f: f for f in distinct}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in distinct:
        for b in distinct:
            if (a ^ b).bit_count() <= 3:
                parent[find(a)] = find(b)
    low = {}
    for d, f in fps:
        if d is not None:
            low[find(f)] = min(low.get(find(f), 1 << 60), d)
    out = simhash_classes(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")), "component_id").collect()
    want = [(d, f"{f:016x}", low.get(find(f))) for d, f in fps]
    assert sorted(map(tuple, out), key=str) == sorted(want, key=str)
    assert simhash_classes(empty).count() == 0


def test_simhash_links_lose_none(spark):
    """A tight group of fingerprints and random ones: every pair within 3 bits, once."""
    from adpulse.llm.simhash import components, links
    r = np.random.default_rng(4)
    seed = int(r.integers(0, 1 << 63))
    fps = {seed ^ sum(1 << int(b) for b in r.choice(63, r.integers(0, 4), replace=False)) for _ in range(120)}
    fps = sorted(fps | {int(x) for x in r.integers(0, 1 << 63, 100)} | {-5, -6, 0, 1, (1 << 62) + 1})
    got = [tuple(x) for x in links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()]
    want = [(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if ((a ^ b) & (2 ** 64 - 1)).bit_count() <= 3]
    assert sorted(got) == sorted(want)
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    assert {r.label for r in components(spark, chain).collect()} == {0, 100}


def test_sketch(docs, rows, spark, empty):
    from adpulse.llm import sketch as S
    d = S.add_sketch(docs, F.col("text"), "sk")
    a, b = d.select("doc_id", "sk").alias("a"), d.select("doc_id", "sk").alias("b")
    some = [1, 4, 10, 13, 91, 94, 112]
    pairs = (a.where(F.col("doc_id").isin(some)).join(b.where(F.col("doc_id").isin(some)))
             .select("a.doc_id", "b.doc_id", S.resemblance(F.col("a.sk"), F.col("b.sk")),
                     S.containment(F.col("a.sk"), F.col("b.sk")), S.distinct_shingles(F.col("a.sk")),
                     F.col("a.sk") == F.col("b.sk")).collect())
    text = {x[0]: x[1] for x in rows}
    for x, y, like, inside, n, same in pairs:
        p, q = set(shingles(text[x], 5)), set(shingles(text[y], 5))
        assert abs(like - (len(p & q) / len(p | q) if p | q else 1)) < 0.25
        assert abs(inside - (len(p & q) / len(p) if p else 1)) < 0.35
        assert abs(n - len(p)) <= 0.5 * len(p) + 1
        assert same or text[x] != text[y]
    half = S.add_sketch(S.add_sketch(docs.where("doc_id = 1"), F.lit("a b c d e f g"), "p"), F.lit("f g h i j k"), "q")
    both = half.select(S.merge(F.col("p"), F.col("q")).alias("m")).first().m
    assert len(both) == 5 and both == sorted(both)
    assert S.add_sketch(empty, F.col("text"), "sk").count() == 0


def test_with_next_wraps_over_buckets(spark, monkeypatch, empty):
    from adpulse.llm import sketch as S
    monkeypatch.setattr(S, "BUCKET_ROWS", 7)
    ids = sorted(set(np.random.default_rng(1).integers(0, 10 ** 9, 200).tolist()), reverse=True)
    df = spark.createDataFrame([(i, f"t{i}") for i in ids], "doc_id long, text string").repartition(6)
    got = {r.doc_id: r.next_text for r in S.with_next(df, "doc_id", ["text"]).collect()}
    assert got == {i: f"t{ids[(n + 1) % len(ids)]}" for n, i in enumerate(ids)}
    assert S.with_next(empty, "doc_id", ["text"]).count() == 0
    one = spark.createDataFrame([(None, "x")], "doc_id long, text string")
    assert S.with_next(one, "doc_id", ["text"]).first().next_text == "x"
    out = one.select(S.edited(F.lit("abcdefg"), F.lit("é")), S.edited(F.lit(None), F.lit("x"))).first()
    assert tuple(out) == ("abcdeé", "")


def test_pii_gradients_and_spans(docs, rows, empty):
    from adpulse.llm import pii as P
    r = np.random.default_rng(3)
    p, x, y = P.init_model(), r.integers(0, P.N_CLASSES, (6, 3)), r.integers(0, len(P.TAGS), (6, 3))
    _, g = P.loss_and_grads(p, x, y)
    for k in p:
        at = tuple(r.integers(0, s) for s in p[k].shape)
        up, down = ({n: v.copy() for n, v in p.items()} for _ in range(2))
        up[k][at] += 1e-5
        down[k][at] -= 1e-5
        slope = (P.loss_and_grads(up, x, y)[0] - P.loss_and_grads(down, x, y)[0]) / 2e-5
        assert abs(slope - g[k][at]) < 1e-6
    texts = [t for _, t, *_ in rows if t]
    held = P.training_windows(texts, seed=5)[:400]
    model = P.train(P.training_windows(texts, seed=1))
    hit = total = 0
    for text, spans in held:
        total += len(spans)
        hit += len(set(spans) & set(P.viterbi(P.tag_scores(model, [text])[0], model["trans"])))
    assert hit / total > 0.6  # held-out spans, to the character
    for r in P.find_pii(docs, model).select("text", "base_spans", "spans").collect():
        t = r.text or ""
        want = [(k, m.start(), m.end()) for k in P.KINDS for m in P.PATTERNS[k].finditer(t) if P.passes(k, m.group())]
        base = [(s.kind, s.start, s.end) for s in r.base_spans or []]
        assert base == want and set(base) <= {(s.kind, s.start, s.end) for s in r.spans or []}
    assert P.find_pii(empty, model).count() == 0


def test_ip_parts_of_any_length(spark):
    from adpulse.llm import pii as P
    long, zeros = "7" * 5000, "0" * 5000
    texts = [f"at 1.2.3.{long} or 10.0.0.255", f"{long}.1.2.3", f"{zeros}.0.00.{zeros}255", f"1.2.3.{zeros}256", "1.2.3.256"]
    want = [[("ip", 5013, 5023)], [], [("ip", 0, 10009)], [], []]
    assert [[s for s in P.base_spans(t) if s[0] == "ip"] for t in texts] == want
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = P.find_pii(docs, P.init_model()).orderBy("doc_id").collect()
    assert [[tuple(s) for s in r.base_spans if s.kind == "ip"] for r in found] == want


def test_viterbi_is_best_path():
    from itertools import product

    from adpulse.llm import pii as P
    r = np.random.default_rng(2)
    for _ in range(5):
        e, trans = r.normal(0, 2, (4, 9)), r.normal(0, 2, (9, 9))
        ok = P._allowed()
        def total(path):
            if P.TAGS[path[0]][0] == "I":
                return -1e18
            return sum(e[i, t] for i, t in enumerate(path)) + sum(trans[a, b] + ok[a, b] for a, b in zip(path, path[1:]))
        best = max(product(range(9), repeat=4), key=total)
        spans = []
        for i, t in enumerate(best):
            if P.TAGS[t][0] == "B":
                spans.append([P.TAGS[t][2:], i, i + 1])
            elif P.TAGS[t][0] == "I":
                spans[-1][2] = i + 1
        assert P.viterbi(e, trans) == [tuple(s) for s in spans]


def brute_scores(rows, mass):
    tok = [((t or "").encode().lower().split() + [None]) for _, t, *_ in rows]
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, *_ in rows]
    c, pairs, starts = Counter(), Counter(), 0
    for t, h in zip(tok, held):
        if not h:
            c.update(t)
            pairs.update(zip(["^", *t[:-1]], t))
            starts += 1
    n, v, out = sum(c.values()), len(c), []
    for (d, *_), t, h in zip(rows, tok, held):
        base = sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t)
        score = 0
        for a, b in zip(["^", *t[:-1]], t):
            low, seen = (c[b] + 1) / (n + v + 1), starts if a == "^" else c[a]
            score += math.log10((pairs[a, b] + mass * low) / (seen + mass))
        out.append((d, h, len(t), sum(c[w] > 0 for w in t), n, round(base, 6), round(score, 6)))
    return out


@pytest.mark.parametrize("block", [1 << 20, 3000])
def test_lm_scores(docs, rows, empty, block):
    from adpulse.llm import lm
    cols = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    got = [tuple(round(x, 6) if isinstance(x, float) else x for x in r) for r in
           lm.score(docs.drop("score"), lm.held_out(F.col("doc_id")), block_bytes=block).select(cols).collect()]
    assert sorted(got, key=str) == sorted(brute_scores(rows, lm.MASS), key=str)
    assert lm.score(empty, lm.held_out(F.col("doc_id"))).count() == 0


def test_base_patterns_are_linear_and_leftmost():
    import random
    import re
    import time

    from adpulse.llm import pii as P
    plain = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}
    r = random.Random(2)
    for chars in ("a@.-_b1", "12.. ", "0123456789 -+.@", "+1 ().-9@a."):
        for _ in range(1500):
            t = "".join(r.choice(chars) for _ in range(r.randint(0, 40)))
            want = [(k, m.start(), m.end()) for k in P.KINDS for m in re.finditer(plain[k], t) if P.passes(k, m.group())]
            assert P.base_spans(t) == want, t
    for t in ("1" * 1_000_000, "1." * 500_000, "a@" + "b-" * 500_000, "a" * 1_000_000 + "@", "a@b" * 300_000, "+" * 500_000,
              "1 " * 500_000, "+1" + "(" * 500_000):
        began = time.process_time()
        P.base_spans(t)
        assert time.process_time() - began < 3, t[:10]


def test_lattice_is_the_same_wherever_a_word_lies():
    """Arcs, their order and their sums don't depend on the words before or on the chunks, to the last bit."""
    from adpulse.llm import sentencepiece_sampling as P
    vocab, r = P.vocabulary(), np.random.default_rng(6)
    words = ["".join(map(chr, r.integers(97, 123, r.integers(1, 14)))) for _ in range(300)]
    words += ["", "a", P.MARK * 3 + "deep", "naïve", "中文\U0001F600x", "\x00", "internationalization" * 5]
    whole = P.Lattice(words, vocab)
    for i in (*range(0, 300, 37), *range(300, len(words))):
        alone = P.Lattice([words[i]], vocab)
        a, b = whole.start[i], whole.end[i]
        x, y = whole.first[a], whole.first[b]
        assert (alone.dst + a).tolist() == whole.dst[x:y].tolist()
        for name in ("logp", "upto", "rest"):
            assert getattr(alone, name).tolist() == getattr(whole, name)[x:y].tolist()
        assert alone.pieces(np.arange(y - x)).tolist() == whole.pieces(np.arange(x, y)).tolist()
    parts = P.Lattice(words, vocab, 7)
    assert parts.__dict__.keys() == whole.__dict__.keys()
    assert all((parts.__dict__[k] == whole.__dict__[k]).all() for k in whole.__dict__)


def test_subtrees_are_sought_where_they_can_be(monkeypatch):
    """The best subtrees that leave a path are those of a search along all of it, but only its likely beginning is searched."""
    from adpulse.llm import sentencepiece_sampling as P
    vocab, r, k = P.vocabulary(), np.random.default_rng(8), 3
    known = ["the", "internationalization", "of", "understanding", "naïve\n", "\n中文", "x", "reconsiderations"]
    texts = [" ".join(known[i] for i in r.integers(0, len(known), n)) for n in (1, 2, 5, 40, 300, 3000, 3000, 20000)]
    looked, others = [], P.others
    monkeypatch.setattr(P, "others", lambda logp: looked.append(logp.size) or others(logp))
    found = P.sample(texts, np.arange(len(texts)), vocab, k)
    total = sum(len(rows[0][0]) for rows in found)
    assert 0 < sum(looked) < 0.5 * total  # not k times all of it
    assert all(vocab.decode(ids) == t for t, rows in zip(texts, found) for ids, *_ in rows)

    lat = P.Lattice(P.units(texts[5]), vocab)
    word = np.arange(len(P.units(texts[5])))
    keys = np.arange(60, dtype=np.uint64) * np.uint64(977)
    paths = []
    for key in keys:
        occ, arcs = P._follow(lat, word, lat.start, np.full(len(word), key), 1, lat.start)
        paths.append(P._Path(arcs, occ, 0.7, 1))
    for since in (0, 7, 300, len(paths[0].arcs) - 5):
        every = P._all_siblings(lat, paths, keys, [since] * len(paths), k)
        for path, key, best in zip(paths, keys, every):
            logp = lat.logp[path.arcs]
            rest = lat.rest[path.arcs]
            at = np.array([i for i in range(since, len(logp)) if rest[i] > P._SURE], np.int64)
            where = np.append(0, np.cumsum(logp))[at] + rest[at]
            score = -np.logaddexp(-0.7, np.log(-np.log(P.noise(np.array([key]), np.array([1]), at, 2))) - where)
            want = sorted(zip(score.tolist(), at.tolist()), reverse=True)[:k]
            assert [(x, o) for x, _, o, _ in best] == want
            assert P._siblings(lat, path, key, since, k) == best
