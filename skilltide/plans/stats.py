"""Q-18 as a kept view: partial counts per month, merged when they are read.

A month that is loaded again, or emptied, replaces its own part. Pairs are joined and counted for the months at
hand only. Of all months just the distinct ids are looked through, for those that come back: the ids of a
group that an earlier month has too are kept as ``again`` and taken off the sum of the months' distinct counts,
so the distinct count stays exact without any id being shuffled at read time.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skilltide.functions.text import percent
from skilltide.session import saved
from skilltide.sources.files import commit, read_layer, read_staged, snapshot, stage_layer

GROUP = ["job_title", "location", "seniority_level"]
LAYER = "stats"
EVER = (dt.date(1, 1, 1), dt.date(9999, 12, 31))
UNDATED = dt.date(1, 1, 1)  # the month of postings without a date


def _joined(a: DataFrame, b: DataFrame, columns: list[str], how: str) -> DataFrame:
    """A join on equal columns, nulls being equal; the others of ``b`` come after those of ``a``."""
    other = b.withColumnsRenamed({c: f"__{c}" for c in columns})
    same = F.lit(True)
    for c in columns:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return a.join(other, same, how).drop(*[f"__{c}" for c in columns])


def refresh_stats(jobs: DataFrame, job_skills: DataFrame, root: str, first: dt.date | str, last: dt.date | str) -> None:
    """Make ``jobs`` (with ``posted_date``) the postings of the months from ``first`` to ``last``, in one step. Postings
    without a date belong to the month of ``UNDATED``."""
    spark = jobs.sparkSession
    lo, hi = (dt.date.fromisoformat(str(x)).replace(day=1) for x in (first, last))
    month = F.coalesce(F.trunc("posted_date", "month"), F.lit(str(UNDATED)).cast("date"))
    inside = F.col("month").between(F.lit(str(lo)).cast("date"), F.lit(str(hi)).cast("date"))
    rows = jobs.select(*GROUP, "id", month.alias("month")).filter(inside)
    span = (lo, hi)
    # the members are staged first: what follows reads them back
    members = stage_layer(rows.filter("id IS NOT NULL").distinct(), root, LAYER, "members", None, span)
    now = read_staged(spark, root, members)
    counts = (
        rows.select("month", *GROUP, F.col("id").alias("job_id")).join(job_skills, "job_id")
        .groupBy("month", *GROUP, "skill_id").agg(F.count("*").alias("n"))
    )
    totals = now.groupBy("month", *GROUP).agg(F.count("*").alias("n"))
    staged = [members, stage_layer(counts, root, LAYER, "counts", None, span), stage_layer(totals, root, LAYER, "totals", None, span)]

    held = read_layer(spark, root, LAYER, "members", schema=now.schema)
    ids = [*GROUP, "id"]
    touched = held.filter(inside).select(*ids).unionByName(now.select(*ids)).distinct()
    others = _joined(held.filter(~inside), touched, ids, "left_semi")
    met = others.unionByName(now.select(*others.columns))
    owner = met.groupBy(*ids).agg(F.min("month").alias("owner"), F.count("*").alias("of")).filter("of > 1")
    back = _joined(met, owner, ids, "inner").filter("month > owner").drop("owner", "of")
    stays = _joined(read_layer(spark, root, LAYER, "again", schema=now.schema), touched, ids, "left_anti")
    again = saved(back.unionByName(stays.select(*back.columns)), "again")
    staged.append(stage_layer(again, root, LAYER, "again", None, EVER))
    commit(spark, root, staged)


def read_stats(spark: SparkSession, root: str, skills: DataFrame) -> DataFrame:
    """The rows of Q-18 from the parts of all months."""
    if f"{LAYER}/counts" not in snapshot(spark, root):
        raise ValueError(f"no statistics were kept in {root}")
    counts, totals, again = (read_layer(spark, root, LAYER, t) for t in ("counts", "totals", "again"))
    fewer = again.groupBy("month", *GROUP).agg((-F.count("*")).alias("n"))
    jobs = totals.select(*GROUP, "n").unionByName(fewer.select(*GROUP, "n")).groupBy(*GROUP).agg(F.sum("n").alias("total_jobs"))
    pairs = counts.groupBy(*GROUP, "skill_id").agg(F.sum("n").alias("skill_count"))
    named = skills.select(F.col("id").alias("skill_id"), F.col("name").alias("skill_name"), F.col("type").alias("skill_type"))
    return (
        pairs.join(named, "skill_id")
        .join(jobs, GROUP)
        .withColumn("frequency_percent", percent("skill_count", "total_jobs"))
        .drop("skill_id", "total_jobs")
    )
