"""Corpus cleaning from raw documents to packed training sequences, one written table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from railfeed.llm.common import staged, table
from railfeed.llm.decontaminate import drop_contaminated
from railfeed.llm.lines import drop_repeated_runs
from railfeed.llm.packing import pack, tokenizer_path
from railfeed.llm.quality import keep_good, train
from railfeed.llm.simhash import drop_near_duplicates


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored under 0.7 go; the model learns from the labelled ones among ``docs``.

    NULL and empty texts are scored like any other; an empty table stays empty.
    """
    return keep_good(docs, train(docs, table(spark, sf_dir, "labels")), threshold=0.7)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of 50 words or more are cut out of the texts; every document stays.

    Rows whose id or text is NULL stay as they are, empty texts too.
    """
    return drop_repeated_runs(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays, the one with the smallest id.

    NULL and empty texts are one group; a NULL id stays only where no row of its group has one.
    """
    return drop_near_duplicates(docs, shingle=3, radius=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; NULL and empty texts hold none and stay."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all remaining token ids in sequences of at most 4096; a NULL or empty text is its end id alone."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"), end_id=1, capacity=4096)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("line_dedup", line_dedup),
    ("simhash_dedup", simhash_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("best_fit_packing", best_fit_packing),
]

#: No SQL: learned scores and tokenizer ids are beyond it. tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
