"""From documents to training shards: rules, near-duplicates, benchmark, mixture, shards.

Each stage works on all that the one before it kept, and all but the last return the columns of
documents. Between stages the rows are stored as Parquet, which cuts the lineage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from salespanel.llm import automaton, quality_rules, ring, temperature, tensored
from salespanel.params import cut_lineage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no quality rule rejects."""
    return quality_rules.filter_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five words, similarity of 0.8)."""
    return tensored.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; those that are mostly benchmark go."""
    return automaton.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The flattest mix of sources that reads each document once or twice; a document read
    twice is two rows."""
    mix = temperature.Mixture(max_epochs=2.0, budget="all")
    return temperature.mix_sources(docs, mix).select(*docs.columns)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with law, shard and slot."""
    return ring.place_on_ring(docs, "doc_id")


STAGES = [
    ("quality rules", quality),
    ("near-duplicates", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("source mixture", mixture),
    ("shards", shards),
]

#: Near-duplicate groups and the walk on the ring are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for n, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if n + 1 < len(STAGES):
            docs = cut_lineage(docs, f"stage-{n + 1}")
    return docs
