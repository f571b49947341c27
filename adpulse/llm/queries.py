"""One registered query per operator: the whole table in, the digest columns out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adpulse.llm.common import read_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@_query
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adpulse.llm.quality_rules import quality_rules
    out = quality_rules(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      "base_failed", "kept", "n_removed_lines", "n_lost_chars")


@_query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adpulse.llm.sharding import feistel_shards
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    out = feistel_shards(docs, ["doc_id", "text_crc32", "size"], 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


@_query
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adpulse.llm.warc import archive, read_archive
    manifest, folder = archive(spark, read_table(spark, sf_dir, "pages"))
    return read_archive(manifest.repartition(max(1, spark.sparkContext.defaultParallelism)), folder)


@_query
def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adpulse.llm.simhash import simhash_classes
    out = simhash_classes(read_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adpulse.llm import sketch as S
    docs = read_table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = S.with_next(S.add_sketch(docs, F.col("text"), "sketch"), "doc_id", ["text", "sketch"])
    docs = docs.withColumn("edited", S.edited(F.col("text"), F.col("next_text")))
    docs = S.add_sketch(docs, F.col("edited"), "edited_sketch")
    return docs.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"),
        S.sketch_text(F.col("sketch")).alias("fingerprint"),
        S.sketch_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        S.resemblance(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        S.resemblance(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


@_query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adpulse.llm.packing import pack, with_crc
    return with_crc(pack(read_table(spark, sf_dir, "documents"))).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@_query
def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adpulse.llm.substring_dedup import remove_repeats
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = remove_repeats(docs)
    return out.select("doc_id", "n_bytes",
                      (F.col("n_bytes") - F.octet_length("kept_bytes")).alias("n_removed"),
                      (F.size("spans") / 2).cast("long").alias("n_spans"),
                      F.sha2("kept_bytes", 256).alias("kept_sha256"))


@_query
def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adpulse.llm.pii import KINDS, find_pii, span_list
    found = find_pii(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", *[F.expr(f"size(filter(base_spans, s -> s.kind = '{k}'))").cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(span_list(F.col("base_spans")), 256).alias("base_sha256"),
        span_list(F.col("spans")).alias("spans"))


@_query
def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adpulse.llm.lm import held_out, score
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return score(docs, held_out(F.col("doc_id")))


@_query
def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adpulse.llm.sentencepiece_sampling import sample_segmentations
    out = sample_segmentations(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "sample", (F.octet_length("ids") / 4).cast("long").alias("n_pieces"),
                      F.crc32("ids").alias("ids_crc32"), "log_prob", "perturbed", "inclusion", "decoded")


@_query
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adpulse.llm.alignment import align_tokens
    return align_tokens(read_table(spark, sf_dir, "documents"), with_groups=False)


@_query
def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adpulse.llm.embedding_dedup import near_duplicate_vectors
    return near_duplicate_vectors(read_table(spark, sf_dir, "embeddings"))


@_query
def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    from adpulse.llm.divergence import source_divergence
    return source_divergence(read_table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from adpulse.llm.oracle import ORACLE
    return dict(ORACLE)
