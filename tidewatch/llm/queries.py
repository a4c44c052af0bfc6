"""The corpus operators as named queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidewatch.llm import ann, bpe, divergence, jaccard, ledger, lines, lz, merkle, mixing, neighbours, quality, repair, suffix
from tidewatch.llm.tables import read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

RANKS = "byte_bpe_multi_50k.tiktoken"
TOKENIZER = "byte_bpe_50k.json"


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix.dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query
def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.round_trip(read(spark, sf_dir, "documents"), vocabulary(TOKENIZER))


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lz.dedup(read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.report(read(spark, sf_dir, "documents"))


ORACLES["op5_line_dedup"] = lines.ORACLE


@query
def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(read(spark, sf_dir, "embeddings"))


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), vocabulary(RANKS), pattern())


@query
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(read(spark, sf_dir, "documents"))


@query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "quality_score", "keep")


@query
def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(read(spark, sf_dir, "embeddings"))


@query
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(read(spark, sf_dir, "documents"))


ORACLES["op11_divergence"] = divergence.ORACLE


@query
def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.digests(read(spark, sf_dir, "documents"))


ORACLES["op12_secrets"] = ledger.ORACLE


@query
def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.report(read(spark, sf_dir, "documents"))


ORACLES["op13_manifest"] = merkle.ORACLE
