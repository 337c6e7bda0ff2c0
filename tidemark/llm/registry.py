"""The queries of the subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    compression_quality, containment, conversation_audit, digest_index, license_diagonals, mixing, quality_rules, recurrent_lm, secret_scan,
    simhash_anchors, source_divergence, token_counts, toxicity_crf,
)
from tidemark.llm.common import read
from tidemark.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLE[run.__name__] = sql
        return run

    return register


@query()
def op1_compression_quality(spark, sf_dir):
    return compression_quality.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query()
def op2_token_counts(spark, sf_dir):
    import public_tokenizers  # the vocabulary's place; only this query needs it

    return token_counts.token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), limit=512)


@query()
def op3_license_diagonals(spark, sf_dir):
    return license_diagonals.scan(read(spark, sf_dir, "documents"))


@query()
def op4_toxicity_crf(spark, sf_dir):
    return toxicity_crf.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query()
def op5_quality_rules(spark, sf_dir):
    out = quality_rules.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return out.select(*first, "rule")


@query()
def op6_containment(spark, sf_dir):
    return containment.contained(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query()
def op7_recurrent_lm(spark, sf_dir):
    return recurrent_lm.score(read(spark, sf_dir, "documents"))


MIX = {"share": 0.6, "epochs": 3, "seed": 7}


@query(mixing.oracle(**MIX))
def op8_mixing(spark, sf_dir):
    return mixing.mix(read(spark, sf_dir, "documents"), mixing.domain_tree(), **MIX)


@query()
def op9_secret_scan(spark, sf_dir):
    return secret_scan.scan(read(spark, sf_dir, "documents"))


@query()
def op10_simhash_anchors(spark, sf_dir):
    return simhash_anchors.near_duplicates(read(spark, sf_dir, "documents"))


@query()
def op11_conversation_audit(spark, sf_dir):
    conversations = conversation_audit.damaged(read(spark, sf_dir, "conversations"))
    return conversation_audit.with_digest(conversation_audit.repair(conversations, live=conversations["live"]))


@query(digest_index.oracle())
def op12_digest_index(spark, sf_dir):
    index = digest_index.DigestIndex(spark, scratch_path(spark, "digest-index"))
    return digest_index.deduplicate(read(spark, sf_dir, "documents"), index, batch="documents")


@query(source_divergence.ORACLE)
def op13_source_divergence(spark, sf_dir):
    return source_divergence.divergence(read(spark, sf_dir, "documents"))
