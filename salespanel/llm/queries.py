"""The registered queries over the text tables, each through its operator."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..workloads.registry import Registry
from . import (
    arc, automaton, jacobi, licenses, multi_index, periods, quality_rules, ring, sketch_dedup, subsequence, suffix,
    temperature, tensored,
)

query = Registry()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query()
def op1_quality_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return quality_rules.quality_decisions(docs, table(spark, sf_dir, "labels"))


@query()
def op2_count_min_passages(spark, sf_dir):
    return sketch_dedup.removal(table(spark, sf_dir, "documents"))


@query()
def op3_temperature_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return temperature.mix_sources(docs, temperature.Mixture(max_epochs=2.0)).drop("text")


@query()
def op4_suffix_automaton(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return automaton.contamination(docs, table(spark, sf_dir, "benchmark"))


@query()
def op5_legacy_archives(spark, sf_dir):
    return arc.archive_pages(table(spark, sf_dir, "pages"))


@query()
def op6_license_paragraphs(spark, sf_dir):
    return licenses.scan(table(spark, sf_dir, "documents"))


@query()
def op7_suffix_array_strings(spark, sf_dir):
    return suffix.removal(table(spark, sf_dir, "documents"))


@query()
def op8_main_text(spark, sf_dir):
    return subsequence.main_texts(table(spark, sf_dir, "pages"))


@query()
def op9_tensored_minhash(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return tensored.near_duplicates(docs, tensored.Likeness(words=3, percent=85))


@query()
def op10_ring_shards(spark, sf_dir):
    return ring.shard_documents(table(spark, sf_dir, "documents"))


@query()
def op11_jacobi_davidson(spark, sf_dir):
    return jacobi.whiten(table(spark, sf_dir, "embeddings"))


@query()
def op12_periodic_runs(spark, sf_dir):
    return periods.periodic_runs(table(spark, sf_dir, "documents"))


@query()
def op13_multi_index(spark, sf_dir):
    return multi_index.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def all_queries() -> dict:
    return dict(query.queries)


def all_sql() -> dict[str, str]:
    return dict(query.sql)
