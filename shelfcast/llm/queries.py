"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.alignment import token_alignment
from shelfcast.llm.common import in_training
from shelfcast.llm.decontamination import decontaminate
from shelfcast.llm.katz import katz_scores
from shelfcast.llm.line_dedup import line_dedup
from shelfcast.llm.mixing import mix
from shelfcast.llm.packing import pack
from shelfcast.llm.pii import surrogates
from shelfcast.llm.quality_rules import quality_rules
from shelfcast.llm.simhash import simhash_components
from shelfcast.llm.sql import DECONTAMINATION, LINE_DEDUP, SUBSTRING_DEDUP
from shelfcast.llm.substring_dedup import substring_dedup
from shelfcast.llm.toxicity import fit as fit_toxicity
from shelfcast.llm.toxicity import score_toxicity
from shelfcast.llm.url_filter import Rule, filter_urls
from shelfcast.llm.whitening import fit_whitening, whitened_components


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


URL_RULES = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
             Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/")]


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored; learnt from labels of rows whose id's crc32 mod 4 is not 2."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_toxicity(docs, labels, lambda c: in_training(c, 4, 2))
    return score_toxicity(docs, model, threshold=0.3).select(
        "doc_id", (~in_training(F.col("doc_id"), 4, 2)).alias("held_out"), "score", "predicted",
        F.size("passages").alias("n_passages"))


def op2_katz_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents scored by a Katz bigram model of the rows whose id's crc32 mod 7 is not 2."""
    got = katz_scores(table(spark, sf_dir, "documents"), in_training(F.col("doc_id"), 7, 2)).scores
    return got.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url by the rules, the rest by the character models."""
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "llr")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three-line windows over all documents: cleaned texts."""
    return line_dedup(table(spark, sf_dir, "documents")).select("doc_id", "text", "n_lines", "n_removed")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents searched for the 10-word windows of all benchmark items."""
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=4096, end_id=1)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-first quality rules over all documents."""
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "n_lines_removed", "kept_chars")


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Surrogates for all entities of all documents; the key is a parameter of the deployment."""
    return surrogates(table(spark, sf_dir, "documents"), key="public-example-key").select("doc_id", "text", "n_entities")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line hashing over all documents, every line with a word: texts without repeated passages, and the spans cut out."""
    return substring_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "n_units", "n_removed", F.to_json("spans").alias("spans"))


def op10_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components over all documents: 3-word shingles, 2 bits."""
    return simhash_components(table(spark, sf_dir, "documents"), shingle=3, radius=2).select(
        "doc_id", "fingerprint", "component_id")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings on the first 16 principal components of the distinct integer vectors."""
    return whitened_components(fit_whitening(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", components=16))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by both tokenizers; groups, links and corpus-wide pair counts."""
    return token_alignment(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"),
                           tokenizer_path("piece_bpe_32k.model"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to 150 % of their words, sources weighing 5, 2, 1 in turn, at most twice each."""
    return mix(table(spark, sf_dir, "documents"), weights=(5, 2, 1), budget=1.5, most=2).select(
        "doc_id", "source", "size", "source_size", "target", "taken")


QUERIES = (op1_toxicity, op2_katz_backoff, op3_url_filter, op4_line_dedup, op5_decontamination, op6_packing, op7_quality_rules,
           op8_pii_surrogates, op9_substring_dedup, op10_simhash_dedup, op11_whitening, op12_token_alignment, op13_mixing)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op4_line_dedup": LINE_DEDUP, "op5_decontamination": DECONTAMINATION, "op9_substring_dedup": SUBSTRING_DEDUP}
