"""L-4, L-5: constraints of the serving tables as queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def _report(df: DataFrame, table: str, rule: str, violations: Column) -> DataFrame:
    return df.agg(F.coalesce(violations, F.lit(0)).cast("bigint").alias("violations")).select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule"), "violations"
    )


def _not_null(df: DataFrame, table: str, columns: list[str]) -> DataFrame:
    """One pass over the table for all its columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = F.array(
        *[
            F.struct(F.lit(f"{c} not null").alias("rule"), F.col(c).alias("violations"))
            for c in columns
        ]
    )
    return counts.select(F.inline(rows)).select(
        F.lit(table).alias("table_name"), "rule", "violations"
    )


def _unique(df: DataFrame, table: str, key: list[str]) -> DataFrame:
    repeated = df.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1")
    return _report(repeated, table, f"{', '.join(key)} unique", F.count("*"))


def _foreign(df: DataFrame, table: str, column: str, parent: DataFrame) -> DataFrame:
    """Rows per key are counted before the join, so a key held by many rows is one row there."""
    used = df.groupBy(column).agg(F.count("*").alias("n")).filter(F.col(column).isNotNull())
    orphans = used.join(parent.select(F.col("id").alias(column)), column, "left_anti")
    return _report(orphans, table, f"{column} exists", F.sum("n"))


def check_constraints(
    jobs: DataFrame, skills: DataFrame, job_skills: DataFrame, alias: DataFrame
) -> DataFrame:
    """L-4: (table_name, rule, violations), a row per rule."""
    bad_type = ~F.col("type").isin("soft", "tech")
    reports = [
        _not_null(jobs, "jobs", ["id", "job_title", "location", "seniority_level"]),
        _unique(jobs, "jobs", ["id", "seniority_level"]),
        _not_null(skills, "skills", ["id", "name", "type"]),
        _unique(skills, "skills", ["id"]),
        _unique(skills, "skills", ["name"]),
        _report(skills.filter(bad_type), "skills", "type in (soft, tech)", F.count("*")),
        _not_null(job_skills, "job_skills", ["job_id", "skill_id"]),
        _unique(job_skills, "job_skills", ["job_id", "skill_id"]),
        _foreign(job_skills, "job_skills", "job_id", jobs),
        _foreign(job_skills, "job_skills", "skill_id", skills),
        _not_null(alias, "keyword_alias", ["job_word", "keyword"]),
        _unique(alias, "keyword_alias", ["job_word", "keyword"]),
    ]
    return reduce(DataFrame.unionByName, reports)


def cascade_delete(child: DataFrame, deleted: DataFrame, on: str) -> DataFrame:
    """L-5: the child rows that stay once the parents in ``deleted`` (column ``id``) are gone."""
    gone = deleted.select(F.col("id").alias(on))
    return child.join(gone, on, "left_anti")
