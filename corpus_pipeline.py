"""From raw documents to shards: five stages, each an operator of ``cardtide.llm``.

A stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; it is written as Parquet and read
again as the next one's documents. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cardtide.llm import decontaminate, mixing, nbsvm, partenum, sharding
from cardtide.llm.common import new_folder, table
from cardtide.llm.queries import ship

#: Near copies: words per n-gram and least similarity.
NEAR_WORDS, NEAR_SIMILAR = 5, partenum.Fraction(80, 100)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier predicts to be good."""
    ship(spark)
    classifier = nbsvm.fit(docs, table(spark, sf_dir, "labels"))
    return nbsvm.kept_documents(docs, classifier)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ship(spark)
    return partenum.drop_near_copies(docs, NEAR_WORDS, NEAR_SIMILAR)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    ship(spark)
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the fitted rates say."""
    ship(spark)
    return mixing.mixed_documents(docs, table(spark, sf_dir, "labels"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of every document."""
    ship(spark)
    return sharding.assign_shards(docs)


STAGES = [
    ("quality", keep_quality),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("mixing", mix),
    ("sharding", shard),
]

#: No stage but the last has an equivalent in SQL; tests compare each with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, with a table in the shared folder between them."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
