"""The corpus pipeline: five stages, each on all that the stage before it kept.

    quality           documents that the quality rules reject go
    near_duplicates   one document of each SimHash component stays
    decontaminate     documents with a benchmark passage go
    pii               personal data is replaced by its kind
    tokens            token ids are added (the ids decode to the text's bytes)

Every stage is written as Parquet to the shared folder and read again as the next
one's ``docs``, so a lost executor repeats tasks of one stage only.

``ORACLE_SQL`` is None: the learned list, XXH64 fingerprints and byte-pair merges
have no SQL form; ``tests/llm/test_pipeline.py`` holds ``run`` against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablekit.llm import byte_bpe, decontaminate, pii, quality_rules, simhash
from tablekit.llm.common import Staging, table
from tablekit.llm.queries import public_vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rules = quality_rules.learn(docs, table(spark, sf_dir, "labels"))
    judged = quality_rules.judge(docs, rules, into="quality__verdict")
    return judged.where("quality__verdict.kept").select(*_columns(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def without_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = pii.redact(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with ``ids`` (little-endian 32-bit token ids), ``n_tokens``, and whether
    they decode to the text."""
    vocabulary = public_vocabulary()
    coded = byte_bpe.round_trip(docs, vocabulary)
    return coded.select(*_columns(docs), "ids", (F.length("ids") / 4).cast("long").alias("n_tokens"),
                        (F.col("decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("decodes"))


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", without_benchmark),
          ("pii", without_pii), ("tokens", tokens)]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; a stage's table is removed when the next one is written."""
    staging, docs, before = Staging(spark, "corpus-pipeline"), table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = staging.put(name, stage(spark, docs, sf_dir))
        if before:
            staging.drop(before)
        before = name
    return docs
