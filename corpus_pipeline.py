"""From raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a table; ``run`` writes each result
to the shared scratch folder and rereads it as the next stage's documents. All stages
but the last return the columns they were given.

    quality            drops documents that the rule ensemble rejects
    line_dedup         cuts repeated runs of lines; a document cut to nothing is dropped
    near_dedup         keeps the smallest doc_id of each group of near copies
    decontamination    drops documents that hold a benchmark item
    packing            deals the token ids of what is left to sequences

Defined cases are those of the operators. Stages keep columns they do not know. A
document with empty text from the start passes line dedup unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.llm import decontaminate, line_dedup, near_dedup, packing, quality
from repopulse.llm.common import stored, table
from repopulse.llm.tokens import vocabulary_path

VOCABULARY = "word_bpe_49k.json"
END_ID = 1


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.accepted(docs, quality.learn(docs, table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    counted = line_dedup.dedup_lines(docs)
    removed, text = F.col(counted.columns[-1]), F.col("text")
    kept = counted.where((removed == 0) | (F.length(text) > 0))
    if "n_chars" in docs.columns:
        n_chars = F.when(removed > 0, F.length(text)).otherwise(F.col("n_chars"))
        kept = kept.withColumn("n_chars", n_chars.cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.keep_one_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, vocabulary_path(VOCABULARY), END_ID)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_stage),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

# The classifier, the tokenizer and the packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
