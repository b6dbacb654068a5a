"""The operators bound to the tables with production parameters: ``opN_<name>``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from logonlens.llm import (
    ann, byte_bpe, collocations, gru_lm, license_scan, line_dedup, mixing, oracle, packed_ids, quality, simhash,
    suffix_dedup, token_align, token_counts,
)
from logonlens.llm.common import table
from logonlens.session import scratch_path

MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.digests(table(spark, sf_dir, "documents"), MULTI_RANKS, public_tokenizers.PATTERN)


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"), spread_cols=("text",))


def op3_gru_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gru_lm.lm_scores(table(spark, sf_dir, "documents"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op5_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_ids.write_and_read(spark, table(spark, sf_dir, "documents"), scratch_path(spark, "idpk"),
                                     public_tokenizers.path("byte_bpe_50k.json"), end_id=2)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"),
                                     public_tokenizers.path("piece_bpe_32k.model"), limit=4096)


def op8_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=3, max_bits=2)


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_align.alignment_figures(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                                         public_tokenizers.path("piece_bpe_32k.model"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_mixing": op2_mixing,
    "op3_gru_lm": op3_gru_lm,
    "op4_license_scan": op4_license_scan,
    "op5_packed_ids": op5_packed_ids,
    "op6_quality": op6_quality,
    "op7_token_counts": op7_token_counts,
    "op8_ann": op8_ann,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_simhash": op10_simhash,
    "op11_token_align": op11_token_align,
    "op12_collocations": op12_collocations,
    "op13_line_dedup": op13_line_dedup,
}

#: DuckDB statements for the queries that SQL can express; the others have brute-force tests.
ORACLE: dict[str, str] = dict(oracle.ORACLE)
