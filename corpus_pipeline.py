"""The corpus pipeline: five stages over ``documents``, each written and read again."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ringlens.llm.common import table
from ringlens.llm.decontam import decontaminate
from ringlens.llm.mix import mixed_documents
from ringlens.llm.shard import sharded_documents
from ringlens.llm.simhash import near_dedup
from ringlens.llm.toxicity import drop_toxic
from ringlens.session import shared_dir


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score as toxic go."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest id."""
    return near_dedup(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with at least a twentieth of their words in benchmark windows go."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions: a row for each time a document is taken."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A uniform shuffle into shards of equal row counts: all columns, shard and slot."""
    return sharded_documents(docs)


#: (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame.
STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]

#: Trained scores, 64-bit fingerprints and random draws have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what each one returns is settled as Parquet for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = shared_dir(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
