"""The corpus pipeline: five stages, each one of the operators of flatwatch.llm on what the stage before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flatwatch.llm.best_fit_reduction import pack_documents
from flatwatch.llm.common import table
from flatwatch.llm.neighbour_votes import stage_quality
from flatwatch.llm.qgram_decontam import decontaminate
from flatwatch.llm.sentence_spans import stage_sentence_spans
from flatwatch.llm.simhash_ball import keep_one
from flatwatch.session import materialize


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return stage_quality(spark, docs, sf_dir)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest id."""
    return keep_one(docs, words=4, max_bits=4, seed=42)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sentence runs that occurred before are cut from the texts; texts that were nothing else go."""
    return stage_sentence_spans(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as token pieces packed into sequences of 1,024."""
    return pack_documents(docs, 1024)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("substring_dedup", substrings),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", packing),
]

#: The classifier, fingerprints, sentence cuts and token ids are beyond SQL; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the shared folder and read by the next one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
