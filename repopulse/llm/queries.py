"""One query per operator, each over its whole table with production settings."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from repopulse.llm import collocations, decontaminate, fingerprints, language, licenses, line_dedup, near_dedup, packing, phrase_parsing, quality, secrets, token_files, vector_codes
from repopulse.llm.common import table
from repopulse.llm.tokens import vocabulary_path
from repopulse.session import scratch_path


def op1_zstd_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op2_hyperminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.find_near_duplicates(table(spark, sf_dir, "documents"))


def op3_seeded_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontaminate.find_leaks(docs, benchmark)


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = vocabulary_path("word_bpe_49k.json")
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary, end_id=1)


def op5_winnowed_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", "text")


def op6_hierarchical_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.predict_language(docs, language.learn(docs))


def op7_rule_ensemble_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score_documents(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def op8_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_documents(table(spark, sf_dir, "documents"))


def op9_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digest(licenses.find_licenses(table(spark, sf_dir, "documents")))


def op10_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    vocabulary = vocabulary_path("byte_bpe_50k.json")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary, end_id=2)
    return token_files.read_token_files(spark, path, with_ids=False)


def op11_bounded_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_prefix_free_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_parsing.remove_repeats(table(spark, sf_dir, "documents"))


def op13_suffix_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    query.__name__: query
    for query in (
        op1_zstd_secret_scan,
        op2_hyperminhash_near_dedup,
        op3_seeded_decontamination,
        op4_best_fit_packing,
        op5_winnowed_line_dedup,
        op6_hierarchical_language,
        op7_rule_ensemble_quality,
        op8_chunk_fingerprints,
        op9_license_rules,
        op10_rans_token_files,
        op11_bounded_vector_codes,
        op12_prefix_free_dedup,
        op13_suffix_collocations,
        pipeline,
    )
}
ORACLE = {
    "op2_hyperminhash_near_dedup": near_dedup.ORACLE,
    "op5_winnowed_line_dedup": line_dedup.ORACLE,
    "op11_bounded_vector_codes": vector_codes.ORACLE,
    "op13_suffix_collocations": collocations.ORACLE,
}
