"""SimHash near-duplicates by multi-index hashing.

A document's fingerprint has bit ``i`` set when over half of its shingle hashes
(XXH64, seed 42, of three lower-cased words joined by spaces; repeats count)
have it. Two documents are linked when their fingerprints differ in at most
``max_bits`` bits, and a class is what such links connect.

Links are sought between distinct fingerprints, each with the number of its
copies collapsed. The 64 bits are cut into two segments; fingerprints within
three bits of each other agree on one segment up to one bit. Each fingerprint
is stored in one table per segment under the segment's value and asks each
table for every value in the small Hamming ball around its own; the complete
distance is verified inside that join, so only true links leave it, each once.
A fingerprint has at most ``C(64,1)+C(64,2)+C(64,3)`` neighbours, whatever the
size of its class.

Classes come from repeated rounds over the links: the smallest label among the
neighbours, then twice the label's own label. Each round is checkpointed in the
shared folder; the driver sees one count per round.

Defined results: a null or empty text, or one of white space alone, has the
fingerprint zero and is linked like any other; one or two words make one
shingle; a null id never becomes a class id unless the whole class has null
ids; equal rows are in one class; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.llm.common import checkpointed

SEED = 42
SEGMENTS = 2
#: Rows of bits unpacked at a time, so that a very long text stays small.
CHUNK = 1 << 14


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """The 64-bit fingerprint of one UTF-8 text.

    ``bytes.lower`` touches A-Z alone, ``bytes.split`` cuts at space and the
    characters tab to CR alone: the contract's letters and words.
    """
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    parts = (map(b" ".join, zip(*(words[i:] for i in range(shingle)))) if len(words) >= shingle
             else [b" ".join(words)])
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        bits = np.unpackbits(hashes[at:at + CHUNK].astype("<u8").view(np.uint8).reshape(-1, 8),
                             axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, keep: list[str], text_col: str = "text", shingle: int = 3) -> DataFrame:
    """The columns of ``keep`` and ``fp``, the fingerprint as a signed long."""
    src = docs.select(*keep, F.col(text_col).cast("binary").alias("_sh_text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column("_sh_text")], dtype=np.uint64)
            cols = [b.column(c) for c in keep] + [pa.array(fp.view(np.int64))]
            yield pa.RecordBatch.from_arrays(cols, names=[*keep, "fp"])

    schema = src.select(*keep).schema.add("fp", "long")
    return src.mapInArrow(run, schema)


def _ball(bits: int, radius: int) -> list[int]:
    """All masks of up to ``radius`` set bits out of ``bits``."""
    return [sum(1 << i for i in c) for r in range(radius + 1) for c in combinations(range(bits), r)]


def links(fps: DataFrame, max_bits: int = 3, segments: int = SEGMENTS) -> DataFrame:
    """Pairs ``(a, b)``, a < b, of the distinct fingerprints ``fp`` within ``max_bits``."""
    width, radius = 64 // segments, max_bits // segments
    low = (1 << width) - 1
    seg = [F.shiftrightunsigned("fp", s * width).bitwiseAND(F.lit(low)) for s in range(segments)]
    tables = F.explode(F.array(*[F.struct(F.lit(s).alias("s"), seg[s].alias("v")) for s in range(segments)]))
    stored = fps.select(F.col("fp").alias("b"), tables.alias("t")).select("b", "t.s", "t.v")
    masks = F.array(*[F.lit(m).cast("long") for m in _ball(width, radius)])
    asked = (fps.select("fp", tables.alias("t"))
             .select(F.col("fp").alias("a"), "t.s", F.explode(masks).alias("m"), F.col("t.v").alias("own"))
             .select("a", "s", F.col("own").bitwiseXOR(F.col("m")).alias("v")))
    diff = F.col("a").bitwiseXOR(F.col("b"))
    # found before: an earlier table already answers this pair
    before = F.lit(False)
    for s in range(segments - 1):
        part = F.bit_count(F.shiftrightunsigned(diff, s * width).bitwiseAND(F.lit(low))) <= radius
        before = before | ((F.col("q.s") > s) & part)
    return (asked.alias("q").join(stored.alias("t"), (F.col("q.s") == F.col("t.s")) & (F.col("q.v") == F.col("t.v"))
                                  & (F.col("a") < F.col("b")) & (F.bit_count(diff) <= max_bits) & ~before)
            .select("a", "b"))


def components(spark: SparkSession, edges: DataFrame) -> DataFrame:
    """``(node, label)`` for every node of the edges ``(a, b)``: the smallest node reachable.

    A node's degree is bounded, so joins on the edges meet no hot key. Joins on
    the label, which a large class shares, have a plain scan on either side and
    can be split by adaptive execution.
    """
    both = checkpointed(edges.union(edges.select(F.col("b"), F.col("a"))))
    label = checkpointed(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                         .select("node", F.least("node", "m").alias("label")))
    while True:
        near = (both.join(label, both.b == label.node).groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("m")))
        step = checkpointed(label.join(near, "node").select(
            "node", F.least("label", "m").alias("label"), F.col("label").alias("was")))
        to = step.select(F.col("node").alias("label"), F.col("label").alias("next"))
        after = checkpointed(step.join(to, "label").select("node", F.col("next").alias("label"), "was"))
        changed = after.where("label != was").limit(1).count()
        label = after.select("node", "label")
        if not changed:
            return label


def simhash_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 3, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: id, ``keep`` columns, ``fp``, ``class_fp``
    (one fingerprint of the class, the same for all of it) and ``component_id``."""
    spark = docs.sparkSession
    prints = checkpointed(fingerprints(docs, [id_col, *keep], text_col, shingle))
    first = checkpointed(prints.groupBy("fp").agg(F.min(id_col).alias("first")))
    label = components(spark, links(first.select("fp"), max_bits))
    of = first.join(label.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "label", F.coalesce("label", "fp"))
    ids = of.groupBy("label").agg(F.min("first").alias("component_id"))
    classes = checkpointed(of.join(ids, "label").select("fp", F.col("label").alias("class_fp"), "component_id"))
    return prints.join(classes, "fp")
