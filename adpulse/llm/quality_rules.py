"""Quality rules, line first: bad lines go, then documents that lose too much.

Every line of a document is judged on its own:

* navigation: at least ``NAV_BARS`` separator bars, one for every five words or
  more;
* symbols: more than three symbol characters for every ten words;
* punctuation: shouted words (``!!`` after at least half of three or more
  words), or ten words and more without a sentence mark anywhere;
* boilerplate: a line of up to 40 words with a licence, cookie, copyright or
  script notice.

The lines that fail are removed. A document is rejected when its base checks
fail (fewer than 50 words, or more than half of its words in repeated 3-word
windows) or when over half of its word characters went with the removed lines.

Everything is a DataFrame expression on the one row: no shuffle, no Python.

Defined results: a null or empty text has no words, all counts are 0 and it is
rejected; ids may be null or repeated, each row is judged alone; an empty table
gives an empty result; other columns pass through untouched (names starting
with ``_qr_`` are reserved).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adpulse.llm.common import WORD

SYMBOLS = r"[#*$%&|<>]"
NAV_BARS = 3
MIN_WORDS = 50
MAX_REPEAT_PCT = 50
MAX_LOST_PCT = 50
BOILERPLATE_MAX_WORDS = 40
# Phrases, in lower case, that mark a notice rather than prose.
BOILERPLATE = (
    "licensed under", "all rights reserved", "copyright", "©", "cookie policy", "privacy policy",
    "terms of use", "terms of service", "enable javascript", "subscribe to our", "click here",
    "lorem ipsum", "sign up for",
)
#: Low bits of a packed window that hold its position.
POS_BITS = 20


def _count(text: Column, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(text, F.lit(f"({pattern})"), F.lit(0)))


def _notice(text: Column) -> Column:
    low, found = F.lower(text), F.lit(False)
    for phrase in BOILERPLATE:
        found = found | low.contains(phrase)
    return found


def _line_fails(line: Column, n: Column) -> Column:
    """True where a line of ``n`` words breaks a rule. Lines without words never fail.

    The ``_qr_has_*`` columns say whether the text holds the mark at all, so
    plain prose skips the costlier counts; the verdict does not depend on them.
    """
    bars, shout = _count(line, r"\|"), _count(line, "!!")
    nav = F.col("_qr_has_bar") & (bars >= NAV_BARS) & (bars * 5 >= n)
    symbols = (F.col("n_symbols") > 0) & (_count(line, SYMBOLS) * 10 > n * 3)
    shouting = F.col("_qr_has_shout") & (shout >= 3) & (shout * 2 >= n)
    unmarked = (n >= 10) & ~line.rlike(r"[.!?。！？…:;]")
    notice = F.col("_qr_has_notice") & (n <= BOILERPLATE_MAX_WORDS) & _notice(line)
    return (n > 0) & (nav | symbols | shouting | unmarked | notice)


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words in 3-word windows that occur twice or more.

    Windows are compared by the 64-bit hash of their three words. To sort plain
    longs, the position replaces the low bits of the hash; neighbours with the
    same high bits are repeats once their whole hashes agree. A text where they
    do not all agree, or that has more windows than positions fit, sorts
    (hash, position) pairs instead.
    """
    low = (1 << POS_BITS) - 1
    df = df.withColumn("_qr_h", F.expr(
        "CASE WHEN size(_qr_w) >= 4 THEN transform(sequence(0, size(_qr_w) - 3), "
        "i -> xxhash64(_qr_w[i], _qr_w[i + 1], _qr_w[i + 2])) END"))
    df = df.withColumn("_qr_p", F.expr(
        f"CASE WHEN size(_qr_h) <= {low} THEN sort_array(transform(_qr_h, "
        f"(x, i) -> (x & {~low}L) | i)) END"))
    df = df.withColumn("_qr_q", F.expr(
        f"filter(_qr_p, (x, j) -> shiftright(x, {POS_BITS}) <=> shiftright(get(_qr_p, j - 1), {POS_BITS}) "
        f"OR shiftright(x, {POS_BITS}) <=> shiftright(get(_qr_p, j + 1), {POS_BITS}))"))
    # neighbours of one high part whose whole hashes differ
    df = df.withColumn("_qr_clash", F.expr(
        f"size(filter(_qr_q, (x, j) -> j > 0 AND shiftright(x, {POS_BITS}) = shiftright(get(_qr_q, j - 1), {POS_BITS}) "
        f"AND get(_qr_h, int(x & {low})) != get(_qr_h, int(get(_qr_q, j - 1) & {low})))) > 0"))
    df = df.withColumn("_qr_s", F.expr(
        "CASE WHEN _qr_h IS NOT NULL AND (_qr_p IS NULL OR _qr_clash) THEN "
        "sort_array(transform(_qr_h, (x, i) -> struct(x AS h, i AS i))) END"))
    df = df.withColumn("_qr_i", F.expr(
        "sort_array(CASE WHEN _qr_s IS NULL THEN "
        f"transform(_qr_q, x -> int(x & {low})) ELSE "
        "transform(filter(_qr_s, (x, j) -> x.h <=> get(_qr_s, j - 1).h OR x.h <=> get(_qr_s, j + 1).h), "
        "x -> x.i) END)"))
    return df.withColumn("n_repeat_words", F.expr(
        "coalesce(aggregate(_qr_i, named_struct('n', 0L, 'last', -3), "
        "(a, x) -> named_struct('n', a.n + least(3, x - a.last), 'last', x), a -> a.n), 0L)"
    )).drop("_qr_h", "_qr_p", "_qr_q", "_qr_clash", "_qr_s", "_qr_i")


def quality_rules(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with the base counts, ``base_failed``, ``kept``, ``clean_text``,
    ``n_removed_lines`` and ``n_lost_chars`` appended."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    odd = r"[\x09\x0B-\x0D]"
    df = (docs.withColumn("_qr_lines", F.split(text, "\n", -1))
          .withColumn("_qr_lw", F.expr("transform(_qr_lines, l -> filter(split("
                      f"CASE WHEN l RLIKE r'{odd}' THEN regexp_replace(l, r'{odd}', ' ') ELSE l END, ' '), "
                      "x -> x != ''))"))
          .withColumn("_qr_w", F.flatten("_qr_lw")))
    df = _repeat_words(df)
    df = (df.withColumn("n_words", F.size("_qr_w").cast("long"))
          .withColumn("word_chars", F.length(F.array_join("_qr_w", "")).cast("long"))
          .withColumn("n_symbols", F.when(text.rlike(SYMBOLS), _count(text, SYMBOLS)).otherwise(0).cast("long"))
          .withColumn("_qr_has_bar", text.contains("|"))
          .withColumn("_qr_has_shout", text.contains("!!"))
          .withColumn("_qr_has_notice", _notice(text))
          .withColumn("_qr_worded", F.filter("_qr_lines", lambda x: x.rlike(WORD)))
          .withColumn("n_dup_lines", (F.size("_qr_worded") - F.size(F.array_distinct("_qr_worded"))).cast("long"))
          .withColumn("_qr_bad", F.expr("sequence(0, size(_qr_lines) - 1)"))
          .withColumn("_qr_bad", F.filter("_qr_bad", lambda i: _line_fails(
              F.get("_qr_lines", i), F.size(F.get("_qr_lw", i))))))
    df = (df.withColumn("n_removed_lines", F.size("_qr_bad").cast("long"))
          .withColumn("clean_text", F.when(F.size("_qr_bad") == 0, text).otherwise(F.array_join(
              F.filter("_qr_lines", lambda x, i: ~_line_fails(x, F.size(F.get("_qr_lw", i)))), "\n")))
          .withColumn("n_lost_chars", F.coalesce(F.length(F.array_join(F.flatten(F.transform(
              "_qr_bad", lambda i: F.get("_qr_lw", i))), "")), F.lit(0)).cast("long"))
          .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                      | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT))
          .withColumn("kept", ~F.col("base_failed")
                      & (F.col("n_lost_chars") * 100 <= F.col("word_chars") * MAX_LOST_PCT)))
    return df.drop(*[c for c in df.columns if c.startswith("_qr_")])


def clean_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that are kept, with ``clean_text``; the other columns as they
    were, also where they share a name with a count.

    The verdict is taken by exploding an array of one or no texts: a plain
    filter would be pushed below the counts it depends on, each of which would
    then be worked out again for every place that mentions it.
    """
    own = docs.select(F.struct(*docs.columns).alias("_cd_own"), F.col(text_col).alias("_cd_text"))
    judged = quality_rules(own, "_cd_text")
    texts = F.when(F.col("kept"), F.array("clean_text")).otherwise(F.array().cast("array<string>"))
    rest = [F.col(f"_cd_own.`{c}`") for c in docs.columns if c != "clean_text"]
    return judged.select(*rest, F.explode(texts).alias("clean_text"))
