"""N-1, N-13, N-14: the vocabulary as a table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skilltide.functions.text import clean_key
from skilltide.operators.positions import global_position
from skilltide.schemas import VOCAB

EVOLVING = ("tech_stack", "soft_skills", "job_position")


def with_keys(entries: DataFrame) -> DataFrame:
    """Vocabulary rows (category, value, ord) with their cleaned key."""
    order = F.col("ord").cast("bigint").alias("ord")
    return entries.select("category", "value", order, clean_key("value").alias("key"))


def load_vocab(spark: SparkSession, path: str) -> DataFrame:
    """N-1: a JSON object of category to list of terms. A missing file is an empty vocabulary."""
    try:
        text = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], VOCAB)
    lists = text.select(F.explode(F.from_json("value", "map<string,array<string>>")))
    return with_keys(
        lists.select(F.col("key").alias("category"), F.posexplode("value").alias("ord", "value"))
    )


def key_table(vocab: DataFrame) -> DataFrame:
    """One row per cleaned key: the last value wins, the key keeps its first place."""
    return vocab.groupBy("category", "key").agg(
        F.max_by("value", "ord").alias("target"), F.min("ord").alias("first_ord")
    )


def new_values(mapping: DataFrame) -> DataFrame:
    """N-14: values no tier matched, per category."""
    return mapping.filter("is_new").select("category", "value").distinct()


def evolve_vocab(
    vocab: DataFrame, added: DataFrame, evolving: tuple[str, ...] = EVOLVING
) -> DataFrame:
    """N-13: the next version. A category that gained values is distinct and sorted again, the
    others stay as they are; frozen categories gain none."""
    entries = vocab.select("category", "value", "ord")
    added = added.filter(F.col("category").isin(*evolving)).select("category", "value")
    grown = [row["category"] for row in added.select("category").distinct().collect()]
    grows = F.col("category").isin(*grown)  # at most the evolving categories
    members = entries.filter(grows).select("category", "value").unionByName(added).distinct()
    ranked = global_position(members, ["category", "value"], "ord")
    return with_keys(entries.filter(~grows).unionByName(ranked.select("category", "value", "ord")))
