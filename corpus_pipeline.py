"""A training corpus from `documents`: rules, near-duplicates, benchmark, secrets, mixture.

Each stage takes what its predecessor kept, written as Parquet and read again. Documents go by the quality rules, all but
one of a near-duplicate group, and those that hold a benchmark item; live secrets are masked; the mixture then chooses
copies of documents, so its rows are documents with an `epoch`.

`ORACLE_SQL` is None: learned rules and fingerprint components cannot be said in SQL. `tests/llm` holds the whole against
a brute-force version.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tidemark.llm import containment, mixing, quality_rules, secret_scan, simhash_anchors
from tidemark.llm.common import read
from tidemark.llm.registry import MIX
from tidemark.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs, read(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Near copies are those of op10: fingerprints of three-word shingles, linked at 3 bits. Most texts whose five-word
    shingles have a Jaccard similarity of 0.8 or more lie further apart and all stay; the README has the measured share."""
    return simhash_anchors.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return containment.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Owners are counted over the documents that the pipeline starts from: of the copies of an example but one is left
    here. `n_chars` follows the masked text; a text that stays keeps its own."""
    masked = secret_scan.mask_live(docs, corpus=read(spark, sf_dir, "documents"))
    marked = F.contains("text", F.lit(secret_scan.MASK))
    return masked.withColumn("n_chars", F.when(marked, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(docs, mixing.domain_tree(), **MIX)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("secrets", secrets), ("mixture", mixture),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = read(spark, sf_dir, "documents"), scratch_path(spark, "pipeline")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
