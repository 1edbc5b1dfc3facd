"""The registered queries of this subpackage, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rentscope.llm import fingerprints, language_id, licenses, mixing, neighbours, ngram_join, packing, prefix_trie, quality, sentencepieces, suffix_dedup, token_counts, vector_codes
from rentscope.plans.shipping import ship_package

Query = Callable[[SparkSession, str], DataFrame]


BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
WORD_BPE = "word_bpe_49k.json"


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer file; every executor has the package that holds them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_scores(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(_documents(spark, sf_dir))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_documents(spark, sf_dir), tokenizer_path(BYTE_BPE))


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepieces.round_trip(_documents(spark, sf_dir), tokenizer_path(PIECE_BPE))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_components(_documents(spark, sf_dir), words=3, percent=90)


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_documents(spark, sf_dir))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(_documents(spark, sf_dir))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(_documents(spark, sf_dir))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes_with_digests(_table(spark, sf_dir, "embeddings"))


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_documents(spark, sf_dir), tokenizer_path(WORD_BPE))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.conversation_trie(_table(spark, sf_dir, "conversations"), shared_heads=True)


def queries() -> dict[str, Query]:
    return {
        "op1_quality": op1_quality,
        "op2_mixing": op2_mixing,
        "op3_suffix_dedup": op3_suffix_dedup,
        "op4_token_counts": op4_token_counts,
        "op5_sentencepiece": op5_sentencepiece,
        "op6_ngram_join": op6_ngram_join,
        "op7_neighbours": op7_neighbours,
        "op8_language_id": op8_language_id,
        "op9_fingerprints": op9_fingerprints,
        "op10_license_scan": op10_license_scan,
        "op11_vector_codes": op11_vector_codes,
        "op12_packing": op12_packing,
        "op13_prefix_trie": op13_prefix_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_mixing": mixing.MIX_SQL,
        "op3_suffix_dedup": suffix_dedup.REPEATED_SQL,
        "op6_ngram_join": ngram_join.SIMILAR_SQL,
        "op11_vector_codes": vector_codes.CODES_SQL,
        "op13_prefix_trie": prefix_trie.TRIE_SQL,
    }
