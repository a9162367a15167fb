"""M-1..M-9: facts, dimensions and bridges from silver postings, and the serving tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from skilltide.functions.postings import surrogate_key
from skilltide.functions.text import tokens

FACT_COLUMNS = (
    "job_title", "company_name", "posted_date", "url", "update_date", "salary", "location",
)


def _months(df: DataFrame) -> list[str]:
    """The month column, where a frame holds many months."""
    return [c for c in df.columns if c == "month"]


def job_fact(silver: DataFrame) -> DataFrame:
    """M-1: a row per posting and level; a null or empty level list is one null level."""
    return silver.select(
        F.col("_id").alias("id"),
        *FACT_COLUMNS,
        *_months(silver),
        F.explode_outer("seniority_level").alias("seniority_level"),
    )


def with_position_id(
    fact: DataFrame, silver: DataFrame, dim: DataFrame | None
) -> DataFrame:
    """M-2: the id of each posting's position; no dimension gives null ids.

    Adaptive execution broadcasts the dimension by its run-time size. ``job_table`` needs no join.
    """
    if dim is None:
        return fact.withColumn("position_id", F.lit(None).cast("string"))
    ids = dim.select(F.col("name").alias("job_position"), F.col("id").alias("position_id"))
    positions = (
        silver.filter(F.col("job_position").isNotNull())
        .select(F.col("_id").alias("id"), "job_position")
        .join(ids, "job_position", "left")
        .select("id", "position_id")
    )
    return fact.join(positions, "id", "left")


def job_table(silver: DataFrame) -> DataFrame:
    """M-1 and M-2 in one pass: the id of a position is a function of its name, so no join."""
    return silver.select(
        F.col("_id").alias("id"),
        *FACT_COLUMNS,
        *_months(silver),
        F.explode_outer("seniority_level").alias("seniority_level"),
        surrogate_key("job_position").alias("position_id"),
    )


def list_dim(silver: DataFrame, column: str, keep_null_member: bool = False) -> DataFrame:
    """M-3: distinct members of a list column. ``keep_null_member`` keeps the one null row that
    empty lists and null items give."""
    exploded = F.explode_outer if keep_null_member else F.explode
    members = silver.filter(F.col(column).isNotNull()).select(
        *_months(silver), exploded(column).alias("name")
    )
    if not keep_null_member:
        members = members.filter("name IS NOT NULL")
    return members.distinct().withColumn("id", surrogate_key("name"))


def dim_tech_skill(silver: DataFrame, keep_null_member: bool = False) -> DataFrame:
    return list_dim(silver, "tech_stack", keep_null_member)


def dim_soft_skill(silver: DataFrame, keep_null_member: bool = False) -> DataFrame:
    return list_dim(silver, "soft_skills", keep_null_member)


def dim_major(silver: DataFrame, keep_null_member: bool = False) -> DataFrame:
    return list_dim(silver, "major", keep_null_member)


def dim_position(silver: DataFrame) -> DataFrame:
    """M-4"""
    names = silver.select(*_months(silver), F.col("job_position").alias("name"))
    return names.filter("name IS NOT NULL").distinct().withColumn("id", surrogate_key("name"))


def bridge(
    silver: DataFrame,
    column: str,
    member_id: str,
    dim: DataFrame | None = None,
    distinct: bool = False,
) -> DataFrame:
    """M-5: (posting, member) pairs; two items that became one value give two pairs.

    A dimension built by this module keys its members by name, so pairs need no join. For a
    dimension with other ids the join stays, and a member it lacks drops its pairs.
    """
    pairs = silver.select(
        F.col("_id").alias("job_id"), *_months(silver), F.explode(column).alias("name")
    ).filter("name IS NOT NULL")
    if dim is None:
        out = pairs.withColumn(member_id, surrogate_key("name"))
    else:
        ids = dim.select("name", F.col("id").alias(member_id))
        out = pairs.join(ids, "name")
    out = out.select("job_id", *_months(silver), member_id)
    return out.distinct() if distinct else out


def bridge_tech_skill(silver: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    return bridge(silver, "tech_stack", "tech_skill_id", dim)


def bridge_soft_skill(silver: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    return bridge(silver, "soft_skills", "soft_skill_id", dim)


def bridge_major(silver: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    return bridge(silver, "major", "major_id", dim)


#: Gold tables whose rows come each from one posting.
ROW_BY_ROW = ("job_description_table", "job_tech_skill_mapping", "job_soft_skill_mapping", "job_major_mapping")


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    """The eight gold tables by warehouse name."""
    return {
        "job_description_table": job_table(silver),
        "tech_skill_table": dim_tech_skill(silver),
        "job_tech_skill_mapping": bridge_tech_skill(silver),
        "soft_skill_table": dim_soft_skill(silver),
        "job_soft_skill_mapping": bridge_soft_skill(silver),
        "major_table": dim_major(silver),
        "job_major_mapping": bridge_major(silver),
        "job_position_table": dim_position(silver),
    }


def with_metrics(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """M-7: the row count is observed while ``df`` is written, not by a pass of its own."""
    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("row_count")), observation


def metrics_of(df: DataFrame, observation: Observation, partition: str) -> dict[str, object]:
    """M-7: the run record, after an action on the observed frame."""
    rows = observation.get["row_count"]
    return {
        "row_count": rows,
        "column_count": len(df.columns),
        "partition": partition,
        "status": "success" if rows else "empty",
    }


def joined_positions(fact: DataFrame) -> DataFrame:
    """M-8"""
    return fact.agg(F.count("position_id").alias("joined"))


def serving_tables(gold: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """M-9: jobs, skills and job_skills for the demand queries.

    A name that is both a technical and a soft skill counts as technical.
    """
    jobs = gold["job_description_table"].select(
        "id",
        "job_title",
        "location",
        "seniority_level",
        F.col("posted_date").try_cast("date").alias("posted_date"),
        "update_date",
        tokens("job_title").alias("title_tokens"),
    )
    tech = gold["tech_skill_table"].select("id", "name", F.lit("tech").alias("type"))
    soft = gold["soft_skill_table"].select("id", "name", F.lit("soft").alias("type"))
    skills = (
        tech.unionByName(soft)
        .filter("name IS NOT NULL")
        .groupBy("id", "name")
        .agg(F.max("type").alias("type"))  # 'tech' sorts after 'soft'
    )
    tech_id, soft_id = F.col("tech_skill_id"), F.col("soft_skill_id")
    tech_pairs = gold["job_tech_skill_mapping"].select("job_id", tech_id.alias("skill_id"))
    soft_pairs = gold["job_soft_skill_mapping"].select("job_id", soft_id.alias("skill_id"))
    pairs = tech_pairs.unionByName(soft_pairs).distinct()
    return {"jobs": jobs, "skills": skills, "job_skills": pairs}
