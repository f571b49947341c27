"""A corpus pipeline: quality rules, near-duplicates, repeated passages, personal data, packing.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns
of ``documents``. ``run`` writes what a stage returns to the shared folder and
reads it as the next one's documents, so a lost executor costs one stage's work
at most.

Every stage takes nulls in any column, empty and very long texts, equal rows and
empty tables; the operators' docstrings define the results.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.llm.common import read_table, shared_dir
from adpulse.llm.packing import pack, with_crc
from adpulse.llm.pii import mask
from adpulse.llm.quality_rules import clean_documents
from adpulse.llm.simhash import simhash_classes
from adpulse.llm.substring_dedup import remove_repeats
from adpulse.session import ship_package


#: Text of a block of the substring removal: half of the operator's own, since the workers of the other
#: stages are still there.
BLOCK_BYTES = 4 << 20


def _with_text(docs: DataFrame, text, columns: list[str]) -> DataFrame:
    """The documents' columns with another text and its length."""
    out = docs.withColumn("text", text)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*columns)


def _aside(docs: DataFrame, taken: tuple[str, ...]) -> tuple[DataFrame, list]:
    """``docs`` with columns that an operator names its results like put under other names, and the
    columns that bring them back, the text and its length left out."""
    names = {c: f"_pl_{i}" if c.lower() in taken else c for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), [
        F.col(f"`{n}`").alias(c) for c, n in names.items() if c not in ("text", "n_chars")]


def _with_new_text(out: DataFrame, text, own: list, columns: list[str]) -> DataFrame:
    """An operator's rows as documents again: own columns, the new text and its length."""
    out = out.select(*own, text.alias("text"))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*[f"`{c}`" for c in columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the rules keep, without the lines that failed."""
    return _with_text(clean_documents(docs), F.col("clean_text"), docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash class (3-word shingles, up to 3 bits): that
    with the smallest id; without any id, or among equal rows, any one of them."""
    ship_package(spark)
    keyed = docs.withColumn("_pl_key", F.xxhash64("doc_id", "text"))
    classes = simhash_classes(keyed, shingle=3, max_bits=3, keep=("_pl_key",))
    rank = F.struct(F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)).alias("id"), "_pl_key")
    keys = classes.groupBy("class_fp", "_pl_key").agg(F.min(rank).alias("r"), F.count("*").alias("copies"))
    best = keys.groupBy("class_fp").agg(F.min(F.struct("r", "copies")).alias("b")).select(
        F.col("b.r._pl_key").alias("_pl_key"), F.col("b.copies").alias("_pl_copies"))
    single = keyed.join(best.where("_pl_copies = 1"), "_pl_key", "left_semi")
    equal = keyed.join(best.where("_pl_copies > 1"), "_pl_key", "left_semi").dropDuplicates(["_pl_key"])
    return single.unionByName(equal).select(*docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that start in one with a smaller id."""
    ship_package(spark)
    aside, own = _aside(docs, ("spans", "n_bytes", "kept_bytes"))
    return _with_new_text(remove_repeats(aside, whole_chars=True, block_bytes=BLOCK_BYTES), F.col("kept_bytes").cast("string"), own, docs.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with personal data replaced by its kind."""
    ship_package(spark)
    return _with_text(mask(spark, docs), F.col("text"), docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in windows of at most 1024 tokens, in order."""
    ship_package(spark)
    return with_crc(pack(docs))


STAGES = [
    ("quality_rules", quality),
    ("simhash_near_dedup", near_duplicates),
    ("suffix_array_dedup", repeated_passages),
    ("pii", personal_data),
    ("packing", packing),
]

#: Suffix arrays, the trained tagger and the tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage returns for the ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    folder = f"{shared_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
