"""Corpus pipeline: five stages over ``documents``, each one operator of ``demandlab.llm``.

Every stage but the last returns rows with the columns of documents; its result
is written as Parquet and read again as the next stage's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandlab.llm import queries
from demandlab.llm.decontaminate import keep_clean
from demandlab.llm.ngram_join import one_per_component
from demandlab.llm.quality import keep_good
from demandlab.llm.token_shards import token_shards
from demandlab.session import scratch_table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go; a quarter of the labels is never learnt from."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    return keep_good(docs, queries.table(spark, sf_dir, "labels"), held_out)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a Jaccard similarity of 0.8 or more on five-word shingles one stays."""
    return one_per_component(docs, k=5, num=4, den=5)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return keep_clean(docs, queries.table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of each leaf's token prefix, once for each epoch that takes them, in whole."""
    return queries.mixed(docs).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order; one row for each record."""
    return token_shards(docs, *queries.byte_bpe())


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontaminate", decontaminate), ("mix", mix), ("tokens", tokens)]

#: The learnt classifier and the tokenizer can't be written in SQL; tests compare every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_table(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
