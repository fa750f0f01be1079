"""A corpus pipeline of five stages: documents in, packed sequences out.

Every stage works on all rows that the one before kept. Between stages the rows are
written as Parquet in the shared folder and read again, so an executor that is lost costs
a stage's tasks and not the run.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftlink.llm import linecrf, linededup, mixing, ngramjoin, packing, queries, storage


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the line classifier scores under 0.5; it learns outside the held-out third."""
    chain = linecrf.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return linecrf.keep_good(docs, chain)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop lines that an earlier line has within two edits, and documents that have no others but blank ones."""
    return linededup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group linked by five-word shingles at 0.8."""
    return ngramjoin.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or thin out documents so that their sources come near the target weights."""
    return mixing.mixed_documents(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2048 tokens."""
    return packing.pack_documents(docs, queries.tokenizer_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("mixing sources", mix_sources),
    ("best-fit packing", best_fit_packing),
]

#: The classifier, the edit join and the tokenizer are beyond SQL; tests hold stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = storage.cut(docs, "stage")
    return docs
