"""Document fingerprints: bottom-k sketches of shingle hashes.

A text's fingerprint holds the ``k`` smallest distinct hashes of its word
shingles. Two sketches merge into the sketch of the united shingle sets by
keeping the ``k`` smallest of both, so parts of a text or table can be sketched
apart. From sketches alone one estimates

* resemblance: of the merged sketch, the share that lies in both;
* containment of A in B: the estimated common shingles over those of A;
* the number of distinct shingles: the sketch size while it is not full, else
  ``(k - 1) / u`` with ``u`` the place of the k-th hash in the hash range.

All of it is DataFrame expressions.

Defined results: a null or empty text has the empty sketch; two empty sketches
resemble each other fully, an empty and a non-empty one not at all; fewer words
than a shingle make one shingle of them all; equal texts have equal sketches.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adpulse.llm.common import lower_ascii

K = 64
SHINGLE = 5
#: Documents per bucket of neighbours in ``with_next``.
BUCKET_ROWS = 1500
#: Buckets at most for which bounds are kept in the plan.
MAX_BOUNDS = 200_000


def add_sketch(df: DataFrame, text: Column, name: str, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """``df`` with the sketch of ``text``: its sorted bottom ``k`` hashes as longs."""
    flat = F.regexp_replace(lower_ascii(text), r"[\x09-\x0D]", " ")
    df = df.withColumn("_sk_w", F.filter(F.split(flat, " "), lambda x: x != ""))
    picked = ", ".join(f"get(_sk_w, i + {j})" for j in range(shingle))
    df = df.withColumn("_sk_h", F.expr(
        f"CASE WHEN size(_sk_w) = 0 THEN array() "
        f"WHEN size(_sk_w) < {shingle} THEN array(xxhash64(concat_ws(' ', _sk_w))) "
        f"ELSE transform(sequence(0, size(_sk_w) - {shingle}), i -> xxhash64({picked})) END"))
    return df.withColumn(name, F.slice(F.array_sort(F.array_distinct("_sk_h")), 1, k)).drop("_sk_w", "_sk_h")


def merge(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of the union of two sketched sets."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness of the sketched sets, 0 to 1."""
    both = F.array_intersect(merge(a, b, k), F.array_intersect(a, b))
    size = F.least(F.size(F.array_union(a, b)), F.lit(k))
    return F.when(size == 0, 1.0).otherwise(F.size(both) / size)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles."""
    place = (F.element_at(a, -1).cast("double") + F.lit(2.0 ** 63)) / F.lit(2.0 ** 64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / place)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of A's shingles that B has, 0 to 1."""
    common = resemblance(a, b, k) * distinct_shingles(merge(a, b, k), k)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.least(F.lit(1.0), common / distinct_shingles(a, k)))


def sketch_text(a: Column) -> Column:
    """A sketch as text: 16 hexadecimal digits for each hash."""
    return F.array_join(F.transform(a, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), "")


def with_next(df: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """``df`` with ``next_<c>`` for each column: its value in the row next in
    descending order of ``id_col`` (after the last: of the first).

    Ids are cut into buckets of about ``BUCKET_ROWS`` rows at quantiles; rows
    are shuffled once, by bucket. The largest row of each bucket is also dealt
    to the bucket above it, where it comes last: the neighbour of that bucket's
    smallest row. The wrap takes the largest row of all to the lowest bucket.
    Ids are taken as unique; rows of equal ids are ordered by the first column.
    """
    spark = df.sparkSession
    key = F.coalesce(F.col(id_col), F.lit(-(1 << 62)).cast("long"))
    n = df.count()
    parts = min(MAX_BOUNDS, max(1, -(-n // BUCKET_ROWS)))
    cuts = sorted(set(df.select(key.cast("double").alias("k")).approxQuantile(
        "k", [i / parts for i in range(1, parts)], 1 / (4 * parts)))) if parts > 1 else []
    cuts = [int(c) for c in cuts]
    tagged = df.withColumn("_nx_bucket", _cuts_below(key, cuts))
    tops = [(r[0], r[1]) for r in tagged.groupBy("_nx_bucket").agg(F.max(key)).orderBy("_nx_bucket").collect()]
    # per bucket its largest id and the bucket above (the lowest for the topmost), looked up like the cuts
    above = dict(zip([b for b, _ in tops], [b for b, _ in tops[1:] + tops[:1]], strict=True))
    size = tops[-1][0] + 1 if tops else 1
    top = _lookup({b: k for b, k in tops}, size, F.col("_nx_bucket"))
    own = F.struct(F.col("_nx_bucket").alias("b"), F.lit(0).alias("ghost"))
    copy = F.struct(_lookup(above, size, F.col("_nx_bucket")).cast("int").alias("b"), F.lit(1).alias("ghost"))
    tagged = tagged.withColumn("_nx_copy", F.explode(F.when(key == top, F.array(own, copy)).otherwise(F.array(own))))
    tagged = tagged.withColumn("_nx_b", F.col("_nx_copy.b")).withColumn("_nx_ghost", F.col("_nx_copy.ghost"))
    w = Window.partitionBy("_nx_b").orderBy("_nx_ghost", F.col(id_col).desc(), columns[0])
    # one select, so that one window and one exchange serve every column
    tagged = tagged.select("*", *[F.lead(c).over(w).alias(f"next_{c}") for c in columns])
    return (tagged.where("_nx_ghost = 0")
            .drop("_nx_bucket", "_nx_copy", "_nx_b", "_nx_ghost"))


def _lookup(values: dict[int, int], size: int, at: Column) -> Column:
    """``values[at]`` from one literal, folded while planning."""
    text = ",".join(str(values.get(i, 0)) for i in range(size))
    return F.get(F.split(F.lit(text), ",").cast("array<bigint>"), at)


def _cuts_below(key: Column, cuts: list[int]) -> Column:
    """How many of the sorted cuts are at or below ``key``, looked up in two steps."""
    if not cuts:
        return F.lit(0)
    step = isqrt(len(cuts)) + 1
    groups = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    firsts = F.lit([g[0] for g in groups]).cast("array<bigint>")
    group = F.size(F.filter(firsts, lambda c: c <= key))
    members = F.get(F.lit(groups).cast("array<array<bigint>>"), group - 1)
    return F.when(group == 0, 0).otherwise(
        (group - 1) * step + F.size(F.filter(members, lambda c: c <= key))).cast("int")


def edited(text: Column, following: Column) -> Column:
    """``text`` with its last third of code points replaced by the first as many
    (or all) of the following text."""
    t, f = F.coalesce(text, F.lit("")), F.coalesce(following, F.lit(""))
    n = F.floor(F.length(t) / 3).cast("int")
    return F.concat(F.substring(t, F.lit(1), F.length(t) - n), F.substring(f, F.lit(1), n))
