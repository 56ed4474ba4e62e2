"""Queries that bind the operators of this package to the test tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm import (bpe, ledger, licenses, lines, metric_join, minhash, mixing, negatives, packing, quality, spotsigs,
                          suffix, trie)
from wardline.llm.common import stage_table, table_of
from wardline.llm.oracle import ORACLE_SQL

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Target weights of the mix: domains by the hash of the source, then languages.
DOMAINS = 4
WEIGHTS = {(f"d{i}",): w for i, w in enumerate((4, 3, 2, 1))} | {
    (f"d{i}", lang): w for i in range(DOMAINS) for lang, w in (("en", 4), ("de", 2), ("fr", 2), ("es", 1))}


def mix_levels():
    domain = F.concat(F.lit("d"), (F.crc32(F.coalesce("source", F.lit("")).cast("binary")) % DOMAINS).cast("string"))
    return [domain, F.col("lang"), F.col("source")]


def op1_pack_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of 2048 packed ids: a digest of each, its segment bounds, resets and documents."""
    out = packing.pack(table_of(spark, sf_dir, "documents"), RANKS, PATTERN)
    return out.select("shard", "row", "n_tokens", F.sha2("tokens", 256).alias("tokens_sha256"), "cu_seqlens", "resets", "doc_ids", "starts")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text, and the bytes that they decode to, as digests."""
    return bpe.digests(bpe.encode(table_of(spark, sf_dir, "documents"), RANKS, PATTERN, decoded=True), "doc_id")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and runs removed per document, and a digest of the bytes left."""
    out = suffix.remove_repeats(table_of(spark, sf_dir, "documents"))
    spans = F.col("spans")
    size = F.aggregate(F.sequence(F.lit(0), F.size(spans) - 1), F.lit(0).cast("long"),
                       lambda t, i: t + F.when(i % 2 == 1, spans[i]).otherwise(-spans[i]))
    return out.select("doc_id", "n_bytes", F.when(F.size(spans) > 0, size).otherwise(F.lit(0).cast("long")).alias("n_removed"),
                      (F.size(spans) / 2).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confirmed licenses of every document."""
    out = licenses.scan(table_of(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_blocks", F.size("matches").cast("long").alias("n_matches"),
                      F.array_join(F.array_sort(F.array_distinct("matches.license")), ",").alias("licenses"),
                      F.aggregate("matches.differences", F.lit(0).cast("long"), lambda t, x: t + x).alias("n_differences"),
                      F.col("matches.line").alias("lines"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines kept and removed per document, with a digest of the remaining text."""
    out = lines.dedup_lines(table_of(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op6_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate group of every document; one document of each group is kept."""
    return minhash.near_duplicates(table_of(spark, sf_dir, "documents")).drop("uid")


def op7_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents selected for a mix of 1.5 times the tokens present, four epochs at most."""
    out = mixing.mix(table_of(spark, sf_dir, "documents"), mix_levels(), WEIGHTS, budget_share=1.5, max_epochs=4, fill=True)
    return out.select("doc_id", F.array_join("path", "/").alias("leaf"), "n_tokens", "epochs")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table_of(spark, sf_dir, "documents")
    forest = quality.train(docs, table_of(spark, sf_dir, "labels"))
    return quality.score(docs, forest).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_metric_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and component of every vector at a cosine of 0.9."""
    return metric_join.near_vectors(table_of(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


def op10_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and their likenesses."""
    return spotsigs.with_neighbours(table_of(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector's positives, where every 7th row has another label."""
    rows = table_of(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return negatives.hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op12_rule_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and verdicts of every document, with the ablation of the rule that alone rejects it."""
    rows = stage_table(ledger.ledger(table_of(spark, sf_dir, "documents")), "ledger")
    alone = ledger.ablations(rows).filter(F.col("policy") == list(ledger.POLICIES)[-1]).select(
        F.col("bit").alias("caught"), F.col("rule").alias("only_rule"), F.col("n_alone").alias("only_rule_docs"))
    base = F.col("failed").bitwiseAND(F.lit(ledger.POLICIES["v1"])) != 0
    return ledger.apply_policies(rows).join(F.broadcast(alone), "caught", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"),
        (F.col("caught") == 0).alias("kept"), "failed", F.array_join("kept_by", ",").alias("kept_by"), "only_rule", "only_rule_docs")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of the conversations, each with the first turns of one in a hundred."""
    convs = stage_table(trie.ordered_turns(table_of(spark, sf_dir, "conversations")), "turns")
    c = F.col("conv_id")
    return trie.prefix_trie(trie.with_shared_heads(convs, c - c % 100, F.crc32(c.cast("string").cast("binary")) % 6, c % 100 == 0, most=5))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pack_tokens, op2_bpe, op3_suffix_dedup, op4_license_scan, op5_line_dedup, op6_bagminhash, op7_mix, op8_quality,
                             op9_metric_join, op10_spotsigs, op11_hard_negatives, op12_rule_ledger, op13_prefix_trie)
}
__all__ = ["ORACLE_SQL", "QUERIES"]
