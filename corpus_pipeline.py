"""From raw documents to a training mix: five stages over the corpus operators.

Every stage takes (spark, docs, sf_dir) and works on all documents that the stage
before has kept; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martline.llm import decontaminate, mixing, quality, runindex, simhash
from martline.llm.common import stored


#: Words of a passage that counts as a repeat: over 50, whatever their bytes.
PASSAGE_WORDS = 51


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates."""
    return simhash.keep_one(docs)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without passages of over 50 words that occur more than once; emptied ones stay, with an empty text."""
    return runindex.remove_repeats(docs, runindex.word_rule(PASSAGE_WORDS))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap no benchmark item."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What the mix takes from each document."""
    return mixing.mix_sources(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("simhash near-dedup", one_of_each),
    ("suffix-array dedup", without_repeats),
    ("benchmark decontamination", without_benchmark),
    ("mixing to target weights", mix),
]

#: The classifier and the mix's draws have no SQL form; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
