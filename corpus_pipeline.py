"""A corpus pipeline: quality rules, line dedup, n-gram Jaccard join, benchmark decontamination, best-fit packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last have the columns of ``docs``. A stage's
result is written as Parquet and read again as the next one's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, line_dedup, ngram_join, packing, quality_rules
from tidemark.llm.common import Scratch, documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or the learned list reject go."""
    return quality_rules.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that a document with a smaller doc_id holds go; n_chars follows the text. No document goes."""
    return line_dedup.replace_texts(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by 80 % equal five-word shingles, directly or by others, the one with the smallest doc_id stays."""
    return ngram_join.keep_one_of_each(docs, n=5, num=4, den=5)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality),
    ("line dedup", lines),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", benchmark),
    ("best-fit packing", packed),
]

#: SQL cannot express the learned list, the latent search and the packing; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's result over the documents of ``sf_dir``."""
    scratch, docs = Scratch(spark), documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = scratch.table(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
