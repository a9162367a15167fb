"""Shapes as the library's DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skilltide.operators.demand import Serving
from skilltide.operators.vocab import with_keys
from skilltide.registry.core import shape
from skilltide.session import saved


def _list(column: str) -> Column:
    empty = F.array().cast("array<string>")
    return F.when(F.col(column) == "", empty).otherwise(F.split(column, ";"))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the items of a job are brought together before they are listed: lists made where the items lie would hold one item
    # each and be sorted, sent and sorted again
    rows = shape(spark, sf_dir, "posting_rows", items=shape(spark, sf_dir, "items").repartition("job_id"))
    return rows.select(
        "_id", "job_title", "company_name", "location", "posted_date", "url", "update_date",
        "salary", _list("levels").alias("seniority_level"), "job_position",
        _list("tech").alias("tech_stack"), _list("soft").alias("soft_skills"),
        _list("majors").alias("major"),
    )


def saved_postings(spark: SparkSession, sf_dir: str, *columns: str, where: str = "true") -> DataFrame:
    """The postings, or columns and rows of them, made once: for queries that read them more than once."""
    return saved(postings(spark, sf_dir).filter(where).select(*(columns or "*")), "postings")


def vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_keys(shape(spark, sf_dir, "vocab"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shape(spark, sf_dir, "request_rows")

    def listed(column: str) -> Column:
        return F.when(F.col(column) != "", F.split(column, ";"))

    return rows.select(
        "request_id", "job_title", listed("places").alias("locations"),
        listed("ranks").alias("levels"), "updated_after", "last_freq", "last_name",
        F.col("page").cast("int").alias("limit"),
    )


def serving(spark: SparkSession, sf_dir: str) -> Serving:
    return Serving(*[shape(spark, sf_dir, n) for n in ("jobs", "skills", "job_skills", "alias")])
