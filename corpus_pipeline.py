"""From raw documents to sharded training data: five stages, each written and read again.

Every stage takes what its predecessor kept. Repeated rows, nulls, empty texts and empty tables are
handled by the operators as their modules say; columns of ``documents`` are carried through.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skilltide.llm import bottomk, histsort, mixing, quality, winnow
from skilltide.llm._rows import fresh, without
from skilltide.llm.queries import table
from skilltide.session import saved


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules and the thresholds of their language and source. Signals get
    columns of their own beside those of the documents, whatever these are called."""
    clash = {c: fresh(docs, f"{c}_") for c in docs.columns if c not in without(docs, quality.OUTPUT).columns}
    named = docs.withColumnsRenamed(clash)
    kept = quality.quality_rules(named).filter("kept")
    return kept.select(*named.columns).withColumnsRenamed({v: k for k, v in clash.items()})


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return bottomk.near_dedup(docs, num=80, den=100)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark."""
    return winnow.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their rate says."""
    return mixing.mix(docs, table(spark, sf_dir, "labels"))


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and place in it."""
    return histsort.shards(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("source_mixing", mix),
    ("sharding", shard),
]

# Classifier posteriors, gradient steps and splitters are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
