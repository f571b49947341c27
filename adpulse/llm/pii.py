"""Personal data: base patterns, and a character BiLSTM with CRF transitions.

Base spans come from the patterns of the four kinds. A tagger adds spans the
patterns miss (dots in a card number, a phone without its plus, ...): characters
are embedded, read by one LSTM in each direction, and scored for the tags
``O``, ``B-kind`` and ``I-kind``; a linear-chain CRF adds learned transition
scores. It is trained in numpy, by exact gradients of the CRF likelihood, on
labelled spans: windows around base spans of a bounded sample of documents
(``TRAIN_DOCS``; it may be short of a kind, so made-up spans of every kind and
variant are planted into the same windows).

At use, overlapping windows of ``WINDOW`` characters run over each stretch of
text that can hold a span. Every kind needs a digit or an ``@``, so places
farther than ``MARGIN`` from one can't be in any. The windows' emission scores
are blended, each character's by its distance from the window's edge, into one
score table per stretch, and a single Viterbi path over the whole stretch
reconciles all windows. A predicted span counts if it passes its kind's own
check, is no part of a base span and touches none.

Defined results: a null or empty text has no spans; very long texts are tagged
stretch by stretch; ids may be null or repeated; with no labelled span in the
sample the made-up ones alone train the model; an empty table gives an empty
result, and the columns of a document pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
# The base pattern of each kind.
PATTERNS = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}
TAGS = ("O", *(f"{p}-{k}" for k in KINDS for p in "BI"))
CHARS = "@.+-() _%:/,"
HIDDEN, EMBED = 12, 10
WINDOW, STEP, MARGIN = 96, 48, 40
TRAIN_DOCS, TRAIN_WINDOWS, EPOCHS, BATCH = 400, 1500, 10, 96
#: Windows run through the network together.
RUN = 512


_NAME = re.compile(r"[A-Za-z0-9._%+-]+")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 if i % 2 else 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if c in "0123456789")


def passes(kind: str, s: str) -> bool:
    """The kind's own check of a whole match."""
    n = _digits(s)
    if kind == "ip":
        parts = s.split(".")
        # int() refuses very long parts, so only the last digits of one that can pass are read
        return len(parts) == 4 and all(re.fullmatch("0*[0-9]{1,3}", p) and int(p[-3:]) <= 255 for p in parts)
    if kind == "card":
        return 16 <= len(n) <= 19 and _luhn(n)
    if kind == "phone":
        return 8 <= len(n) <= 15
    return "@" in s and "." in s.rpartition("@")[2]


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind, then start; failing matches are dropped, not retried."""
    found = {"email": _emails(text) if "@" in text else (),
             "ip": _dotted(text) if "." in text else (),
             "card": (m.span() for m in PATTERNS["card"].finditer(text)),
             "phone": (m.span() for m in PATTERNS["phone"].finditer(text)) if "+" in text else ()}
    return [(kind, a, b) for kind in KINDS for a, b in found[kind] if kind == "email" or passes(kind, text[a:b])]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost matches of the email pattern, judged from each @ outwards: the name is the run of
    its characters that ends there, as far as no match has taken it, so no character is scanned again
    for every place where a match could begin."""
    done = 0
    for name in _NAME.finditer(text):
        domain = _DOMAIN.match(text, name.end())
        if domain and max(name.start(), done) < name.end():
            yield max(name.start(), done), domain.end()
            done = domain.end()


def _dotted(text: str) -> Iterator[tuple[int, int]]:
    """The leftmost matches of the ip pattern: four runs of digits with one dot between each and the
    next. A match takes whole runs, so each run is looked at a few times at most."""
    runs = [m.span() for m in _DIGITS.finditer(text)]
    i = 0
    while i + 3 < len(runs):
        four = runs[i:i + 4]
        if all(b[0] == a[1] + 1 and text[a[1]] == "." for a, b in zip(four, four[1:])):
            yield four[0][0], four[3][1]
            i += 4
        else:
            i += 1


# --- network ---------------------------------------------------------------

def classes(text: str) -> np.ndarray:
    """Character classes: digits, lower, upper, a few marks, line feed, other."""
    code = np.frombuffer(text.encode("utf-32-le"), "<u4")
    return _table()[np.minimum(code, 256)]


@lru_cache(maxsize=1)
def _table() -> np.ndarray:
    t = np.full(257, 3, dtype=np.int64)
    for i in range(256):
        c = chr(i)
        t[i] = (0 if c in "0123456789" else 1 if c.islower() else 2 if c.isupper() else
                5 + CHARS.index(c) if c in CHARS else 4 if c.isspace() else 3)
    t[256] = 1  # letters of other scripts read like prose
    return t


N_CLASSES = 5 + len(CHARS)


def init_model(seed: int = 7) -> dict[str, np.ndarray]:
    r = np.random.default_rng(seed)
    k = len(TAGS)
    p = {"embed": r.normal(0, .5, (N_CLASSES, EMBED)), "out": r.normal(0, .2, (2 * HIDDEN, k)),
         "bias": np.zeros(k), "trans": np.zeros((k, k))}
    for d in "fb":
        p[f"wx{d}"] = r.normal(0, .3, (EMBED, 4 * HIDDEN))
        p[f"wh{d}"] = r.normal(0, .3, (HIDDEN, 4 * HIDDEN))
        p[f"b{d}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    return {n: v.astype(np.float64) for n, v in p.items()}


def _sig(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _lstm(p: dict, d: str, x: np.ndarray) -> tuple[np.ndarray, list]:
    """States of one direction over ``x`` (time, batch) of classes, and what the gradient needs."""
    table = p["embed"] @ p[f"wx{d}"] + p[f"b{d}"]
    h = np.zeros((x.shape[1], HIDDEN))
    c, states, tape = h, np.empty((*x.shape, HIDDEN)), []
    for t in range(len(x)) if d == "f" else range(len(x) - 1, -1, -1):
        z = table[x[t]] + h @ p[f"wh{d}"]
        i, f, o = (_sig(z[:, n * HIDDEN:(n + 1) * HIDDEN]) for n in range(3))
        g = np.tanh(z[:, 3 * HIDDEN:])
        c2 = f * c + i * g
        tc = np.tanh(c2)
        tape.append((t, h, c, i, f, o, g, tc))
        h, c = o * tc, c2
        states[t] = h
    return states, tape


def emissions(p: dict, x: np.ndarray) -> np.ndarray:
    """Tag scores (time, batch, tag) of windows of classes (time, batch)."""
    both = np.concatenate([_lstm(p, "f", x)[0], _lstm(p, "b", x)[0]], axis=2)
    return both @ p["out"] + p["bias"]


def _logsum(a: np.ndarray, axis: int) -> np.ndarray:
    m = a.max(axis=axis, keepdims=True)
    return np.squeeze(m, axis) + np.log(np.exp(a - m).sum(axis=axis))


def loss_and_grads(p: dict, x: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Mean negative log likelihood of the tag paths ``y``, and its exact gradients."""
    n, batch = x.shape
    sf, tf = _lstm(p, "f", x)
    sb, tb = _lstm(p, "b", x)
    both = np.concatenate([sf, sb], axis=2)
    e = both @ p["out"] + p["bias"]
    a = np.empty_like(e)
    a[0] = e[0]
    for t in range(1, n):
        a[t] = e[t] + _logsum(a[t - 1][:, :, None] + p["trans"], 1)
    z = _logsum(a[-1], 1)
    b = np.zeros_like(e)
    g = {k: np.zeros_like(v) for k, v in p.items()}
    for t in range(n - 2, -1, -1):
        s = p["trans"] + (e[t + 1] + b[t + 1])[:, None, :]
        b[t] = _logsum(s, 2)
        g["trans"] += np.exp(a[t][:, :, None] + s - z[:, None, None]).sum(0)
    de = np.exp(a + b - z[None, :, None])
    rows = np.arange(batch)
    gold = e[np.arange(n)[:, None], rows, y].sum() + p["trans"][y[:-1], y[1:]].sum()
    de[np.arange(n)[:, None], rows, y] -= 1
    np.add.at(g["trans"], (y[:-1], y[1:]), -1)
    g["out"] += np.tensordot(both, de, axes=([0, 1], [0, 1]))
    g["bias"] += de.sum((0, 1))
    dboth = de @ p["out"].T
    for d, tape, part in (("f", tf, dboth[:, :, :HIDDEN]), ("b", tb, dboth[:, :, HIDDEN:])):
        dh = dc = np.zeros((batch, HIDDEN))
        dtable = np.zeros((N_CLASSES, 4 * HIDDEN))
        for t, h, c, i, f, o, gg, tc in reversed(tape):
            dh = dh + part[t]
            dc = dc + dh * o * (1 - tc * tc)
            dz = np.concatenate([dc * gg * i * (1 - i), dc * c * f * (1 - f), dh * tc * o * (1 - o),
                                 dc * i * (1 - gg * gg)], axis=1)
            np.add.at(dtable, x[t], dz)
            g[f"wh{d}"] += h.T @ dz
            dh, dc = dz @ p[f"wh{d}"].T, dc * f
        g["embed"] += dtable @ p[f"wx{d}"].T
        g[f"wx{d}"] += p["embed"].T @ dtable
        g[f"b{d}"] += dtable.sum(0)
    return float((z.sum() - gold) / batch), {k: v / batch for k, v in g.items()}


def train(windows: list[tuple[str, list[tuple[str, int, int]]]], seed: int = 7) -> dict[str, np.ndarray]:
    """The model after ``EPOCHS`` passes of Adam over (window, spans) of ``WINDOW`` characters."""
    x = np.stack([classes(w) for w, _ in windows], axis=1)
    y = np.zeros(x.shape, np.int64)
    for j, (_, spans) in enumerate(windows):
        for kind, a, b in spans:
            tag = TAGS.index(f"B-{kind}")
            y[a, j], y[a + 1:b, j] = tag, tag + 1
    p, r = init_model(seed), np.random.default_rng(seed)
    m = {k: np.zeros_like(v) for k, v in p.items()}
    v2 = {k: np.zeros_like(v) for k, v in p.items()}
    step = 0
    for _ in range(EPOCHS):
        order = r.permutation(x.shape[1])
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            _, g = loss_and_grads(p, x[:, pick], y[:, pick])
            step += 1
            for k in p:
                m[k] = .9 * m[k] + .1 * g[k]
                v2[k] = .999 * v2[k] + .001 * g[k] ** 2
                p[k] -= .02 * (1 - step / (EPOCHS * -(-len(order) // BATCH) + 1)) * (m[k] / (1 - .9 ** step)) / (np.sqrt(v2[k] / (1 - .999 ** step)) + 1e-8)
    return p


def _made_up(r: np.random.Generator, kind: str) -> str:
    """A span of the kind in one of its spellings, usual or unusual."""
    def num(n: int) -> str:
        return "".join(str(d) for d in r.integers(0, 10, n))

    def word(a: int, b: int) -> str:
        return "".join(chr(97 + c) for c in r.integers(0, 26, r.integers(a, b)))
    if kind == "email":
        return f"{word(3, 9)}{r.choice(['', '.', '_', '-'])}{num(int(r.integers(0, 4)))}@{word(3, 8)}.{r.choice(['com', 'org', 'net'])}"
    if kind == "ip":
        return ".".join(str(x) for x in r.integers(0, 256, 4))
    if kind == "phone":
        return r.choice([f"+1 ({num(3)}) {num(3)}-{num(4)}", f"({num(3)}) {num(3)}-{num(4)}",
                         f"{num(3)}-{num(3)}-{num(4)}", f"+{num(2)} {num(3)} {num(6)}"])
    body = "4" + num(14)
    for d in "0123456789":
        if _luhn(body + d):
            body += d
            break
    return r.choice(["", " ", "-", ".", "/"]).join(body[i:i + 4] for i in range(0, 16, 4))


def training_windows(texts: list[str], seed: int = 7) -> list[tuple[str, list[tuple[str, int, int]]]]:
    """Labelled windows: real base spans in place, and made-up spans planted into prose."""
    r, out, prose = np.random.default_rng(seed), [], []
    for t in texts:
        spans = sorted(base_spans(t), key=lambda s: s[1])
        for kind, a, b in spans:
            if b - a <= WINDOW - 16 and len(out) < TRAIN_WINDOWS // 3:
                at = max(0, min(a - int(r.integers(4, WINDOW - (b - a) - 4)), len(t) - WINDOW))
                inside, end = [], at
                for k, s, e in spans:
                    if s >= max(at, end) and e <= at + WINDOW:
                        inside.append((k, s - at, e - at))
                        end = e
                out.append((t[at:at + WINDOW].ljust(WINDOW), inside))
        plain = t[:4 * WINDOW]
        if len(plain) >= WINDOW and not spans:
            prose.append(plain[:WINDOW])
    prose = prose or ["lorem ipsum dolor sit amet, " * 4]
    while len(out) < TRAIN_WINDOWS:
        host = prose[int(r.integers(len(prose)))].ljust(WINDOW)[:WINDOW]
        roll = r.random()
        if roll < .15:
            out.append((host, []))
        elif roll < .3:  # numbers that are no personal data
            n = "".join(str(d) for d in r.integers(0, 10, r.integers(1, 7)))
            at = int(r.integers(2, WINDOW - 12))
            out.append((f"{host[:at]} {n} {host[at:]}"[:WINDOW], []))
        else:
            kind = KINDS[int(r.integers(4))]
            s = str(_made_up(r, kind))
            at = int(r.integers(2, WINDOW - len(s) - 4))
            out.append((f"{host[:at]} {s} {host[at:]}"[:WINDOW], [(kind, at + 1, at + 1 + len(s))]))
    return out


def fit(docs: DataFrame, text_col: str = "text") -> dict[str, np.ndarray]:
    """A model from the ``TRAIN_DOCS`` documents, at most, of smallest text hash
    that hold a digit or an @, and as many without; 8 kB around the first mark of each."""
    text = F.col(text_col)
    marked = text.rlike("[0-9@]")
    at = F.greatest(F.regexp_instr(text, F.lit("[0-9@]")) - 2000, F.lit(1))
    found = docs.where(text.isNotNull()).select(F.xxhash64(text_col).alias("h"), marked.alias("m"), text_col)
    some = []
    for m in (True, False):
        # bare hashes first, so that no task sends texts that are then dropped
        n = TRAIN_DOCS // (1 if m else 8)
        of = found.where(F.col("m") == m)
        least = [r[0] for r in of.select("h").orderBy("h").limit(n).collect()]
        if least:
            some += sorted(of.where(F.col("h") <= least[-1]).select(F.substring(text, at, F.lit(8000)))
                           .distinct().limit(n).collect())
    return train(training_windows([r[0] for r in some]))


# --- use -------------------------------------------------------------------

_ANCHOR = re.compile(r"[0-9@]")


def stretches(text: str) -> list[tuple[int, int]]:
    """Maximal stretches within ``MARGIN`` of a digit or @."""
    out: list[list[int]] = []
    for m in _ANCHOR.finditer(text):
        a, b = max(0, m.start() - MARGIN), min(len(text), m.end() + MARGIN)
        if out and a <= out[-1][1]:
            out[-1][1] = b
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def tag_scores(p: dict, parts: list[str]) -> list[np.ndarray]:
    """Blended emission scores (character, tag) of every part, from overlapping windows."""
    where = [(j, at) for j, s in enumerate(parts)
             for at in range(0, max(1, len(s) - (WINDOW - STEP)), STEP)]
    known = [classes(s) for s in parts]
    total = [np.zeros((len(s), len(TAGS))) for s in parts]
    weight = [np.zeros((len(s), 1)) for s in parts]
    edge = np.minimum(np.arange(WINDOW) + 1, np.arange(WINDOW, 0, -1)).astype(float)[:, None]
    for k in range(0, len(where), RUN):
        some = where[k:k + RUN]
        x = np.full((WINDOW, len(some)), 4, dtype=np.int64)
        for i, (j, at) in enumerate(some):
            c = known[j][at:at + WINDOW]
            x[:len(c), i] = c
        e = emissions(p, x)
        for i, (j, at) in enumerate(some):
            n = min(WINDOW, len(parts[j]) - at)
            total[j][at:at + n] += e[:n, i] * edge[:n]
            weight[j][at:at + n] += edge[:n]
    return [t / np.maximum(w, 1e-9) for t, w in zip(total, weight)]


@lru_cache(maxsize=1)
def _allowed() -> np.ndarray:
    """0 where a tag may follow another, else a great penalty: I-kind only after its own kind."""
    k = len(TAGS)
    out = np.zeros((k, k))
    for j, t in enumerate(TAGS):
        if t[0] == "I":
            out[:, j] = -1e9
            out[j - 1, j] = out[j, j] = 0
    return out


def viterbi(scores: np.ndarray, trans: np.ndarray) -> list[tuple[str, int, int]]:
    """The spans of the best tag path over a whole stretch."""
    n = len(scores)
    step, best = trans + _allowed(), scores[0] + np.where([t[0] == "I" for t in TAGS], -1e9, 0)
    back = np.zeros((n, len(TAGS)), np.int64)
    for t in range(1, n):
        s = best[:, None] + step
        back[t] = s.argmax(0)
        best = s.max(0) + scores[t]
    tag, path = int(best.argmax()), []
    for t in range(n - 1, -1, -1):
        path.append(tag)
        tag = int(back[t][tag])
    path.reverse()
    out, t = [], 0
    while t < n:
        if TAGS[path[t]][0] == "B":
            end = t + 1
            while end < n and path[end] == path[t] + 1:
                end += 1
            out.append((TAGS[path[t]][2:], t, end))
            t = end
        else:
            t += 1
    return out


def all_spans(p: dict, texts: list[str]) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, both by kind, then start."""
    base = [base_spans(t) for t in texts]
    where = [(i, a, b) for i, t in enumerate(texts) for a, b in stretches(t)]
    more: list[list] = [[] for _ in texts]
    for k in range(0, len(where), RUN):
        some = where[k:k + RUN]
        for (i, a, _), s in zip(some, tag_scores(p, [texts[i][a:b] for i, a, b in some])):
            for kind, x, y in viterbi(s, p["trans"]):
                x, y = x + a, y + a
                if passes(kind, texts[i][x:y]) and not any(x < e and b < y for _, b, e in base[i]):
                    more[i].append((kind, x, y))
    rank = {k: n for n, k in enumerate(KINDS)}
    return [(b, sorted(b + m, key=lambda s: (rank[s[0]], s[1]))) for b, m in zip(base, more)]


SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                                 T.StructField("end", T.LongType())]))


def find_pii(docs: DataFrame, model: dict | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of (kind, start, end) in code points."""
    model = model if model is not None else fit(docs, text_col)
    columns = [c for c in docs.columns if c not in ("base_spans", "spans")]

    @F.pandas_udf(T.StructType([T.StructField("base", SPAN), T.StructField("all", SPAN)]))
    def tag(texts: pd.Series) -> pd.DataFrame:
        out = all_spans(model, ["" if t is None else t for t in texts])
        return pd.DataFrame({"base": [[{"kind": k, "start": a, "end": b} for k, a, b in s] for s, _ in out],
                             "all": [[{"kind": k, "start": a, "end": b} for k, a, b in s] for _, s in out]})

    # texts without a digit or an @ can't hold a span and stay out of Python
    marked = F.when(F.col(text_col).rlike("[0-9@]"), F.col(text_col))
    found = docs.select(*columns, tag(marked).alias("_pii"))
    return found.select(*columns, F.col("_pii.base").alias("base_spans"), F.col("_pii.all").alias("spans"))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with every span replaced by ``<KIND>``; overlapping spans by the first one's kind."""
    kept, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= at:
            kept += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*kept, text[at:]])


def mask(spark: SparkSession, docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with every span replaced (see ``masked``). One function finds and replaces: two in a row
    would keep two Python workers for each running task."""
    model = fit(docs, text_col)

    @F.pandas_udf(T.StringType())
    def cut(texts: pd.Series) -> pd.Series:
        found = all_spans(model, ["" if t is None else t for t in texts])
        return pd.Series([None if t is None else masked(t, spans) for t, (_, spans) in zip(texts, found)], dtype=object)

    marked = F.when(F.col(text_col).rlike("[0-9@]"), F.col(text_col))
    return docs.withColumn(text_col, F.coalesce(cut(marked), F.col(text_col)))


def span_list(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
