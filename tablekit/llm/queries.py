"""The registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablekit.llm import (byte_bpe, chat_perspectives, decontaminate, hard_negatives, katz, license_scan, pii, quality_rules,
                          simhash, substring_dedup, suffix_dedup, token_alignment, toxicity)
from tablekit.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_chat_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dialogue from the perspective of every participant."""
    return chat_perspectives.rotate(table(spark, sf_dir, "conversations"))


ORACLE["op1_chat_perspectives"] = chat_perspectives.ROTATE_SQL


@register
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and fuzzy notices of every document."""
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def public_vocabulary(name: str = "byte_bpe_multi_50k.tiktoken") -> byte_bpe.Vocabulary:
    import public_tokenizers

    return byte_bpe.Vocabulary.load(public_tokenizers.path(name), public_tokenizers.PATTERN)


@register
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, and their decoding."""
    return byte_bpe.digests(table(spark, sf_dir, "documents"), public_vocabulary())


@register
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of every document and the verdict of the learned decision list."""
    return quality_rules.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return pii.digests(table(spark, sf_dir, "documents"))


@register
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    return decontaminate.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op8_decontaminate"] = decontaminate.DIGEST_SQL


@register
def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@register
def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the word windows of documents with smaller ids."""
    return substring_dedup.digests(table(spark, sf_dir, "documents"))


ORACLE["op9_substring_dedup"] = substring_dedup.DIGEST_SQL


@register
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the byte strings that occur anywhere else."""
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


@register
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity categories of every document."""
    return toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@register
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the stated anchors against all rows."""
    return hard_negatives.op13_rows(table(spark, sf_dir, "embeddings"))


ORACLE["op13_hard_negatives"] = hard_negatives.MINE_SQL


@register
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alignment of two tokenizers over every document, with corpus-wide pair counts."""
    import public_tokenizers as public

    files = token_alignment.Tokenizers.load(public.path("byte_bpe_50k.json"), public.path("piece_bpe_32k.model"))
    return token_alignment.align(table(spark, sf_dir, "documents"), files)


@register
def op12_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document under a Katz bigram model of the training fold."""
    return katz.op12_rows(table(spark, sf_dir, "documents"))
