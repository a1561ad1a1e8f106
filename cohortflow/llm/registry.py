"""The registered queries of the operators, each over its whole table, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from cohortflow.llm import collocations, exact, language, lines, merkle, mixing, near, pieces, privacy, quality, shards, sketches, sql, toxicity
from cohortflow.llm.common import read

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixed(read(spark, sf_dir, "documents"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(read(spark, sf_dir, "documents"))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return privacy.pseudonymised(read(spark, sf_dir, "documents")).select("doc_id", "text", "n_entities")


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(read(spark, sf_dir, "documents"), words=2)


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_decode(read(spark, sf_dir, "documents"), pieces.tokenizer_model())


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_dedup(read(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "text")


def op7_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprints(read(spark, sf_dir, "documents"))


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_table(read(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(read(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(read(spark, sf_dir, "documents"), quality.trusted_ids(read(spark, sf_dir, "labels")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, QueryFn]:
    return {f.__name__: f for f in (op1_source_mixing, op2_exact_dedup, op3_pii_surrogates, op4_minhash_near_dedup, op5_sentencepiece, op6_line_dedup, op7_document_fingerprints, op8_sharding, op9_language_id, op10_toxicity,
                                op11_phrase_collocations, op12_merkle_manifest, op13_quality_rules, pipeline)}


def oracle_sql() -> dict[str, str]:
    more = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return {"op2_exact_dedup": sql.OP2_SQL, "op11_phrase_collocations": sql.OP11_SQL,
            "op12_merkle_manifest": sql.OP12_SQL, "op13_quality_rules": sql.OP13_SQL, **more}
