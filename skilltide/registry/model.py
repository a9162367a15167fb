"""M-1..M-9 and L-4, L-5 over orders as silver postings."""

from __future__ import annotations

from pyspark.sql import functions as F

from skilltide.operators import checks
from skilltide.operators import model as m
from skilltide.registry import shapes
from skilltide.registry.core import query, shape, table, with_shapes
from skilltide.session import scratch_dir

# (posting, position, member) of each list column, blank items never occur here.
MEMBERS = {
    "tech_stack": "tech",
    "soft_skills": "soft",
    "major": "majors",
}


def pairs_sql(column: str) -> str:
    given = MEMBERS[column]
    return (
        f"(SELECT _id AS job_id, unnest(string_split({given}, ';')) AS name"
        f" FROM posting_rows WHERE {given} <> '')"
    )


def dim_sql(column: str) -> str:
    return f"SELECT DISTINCT name, md5(name) AS id FROM {pairs_sql(column)}"


def bridge_sql(column: str, member: str) -> str:
    return f"SELECT job_id, md5(name) AS {member} FROM {pairs_sql(column)}"


LEVELS_SQL = """
  exploded AS (
    SELECT *, unnest(string_split(levels, ';')) AS seniority_level FROM posting_rows WHERE levels <> ''
    UNION ALL SELECT *, NULL FROM posting_rows WHERE coalesce(levels, '') = ''),
  fact AS (
    SELECT _id AS id, job_title, company_name, posted_date, url, update_date, salary, location,
           seniority_level, md5(job_position) AS position_id FROM exploded)
"""
_FACT = "id, job_title, company_name, posted_date, url, update_date, salary, location, seniority_level"
DIM_POSITION_SQL = (
    "SELECT DISTINCT job_position AS name, md5(job_position) AS id FROM posting_rows"
    " WHERE job_position IS NOT NULL"
)


def _sql(body: str) -> str:
    return with_shapes("posting_rows", body)


@query("m1_job_fact", _sql(f"WITH {LEVELS_SQL.strip()} SELECT {_FACT} FROM fact"))
def m1(spark, sf_dir):
    return m.job_fact(shapes.postings(spark, sf_dir))


@query("m2_with_position_id", _sql(f"WITH {LEVELS_SQL.strip()} SELECT {_FACT}, position_id FROM fact"))
def m2(spark, sf_dir):
    silver = shapes.postings(spark, sf_dir)
    return m.with_position_id(m.job_fact(silver), silver, m.dim_position(silver))


@query("m2_job_table", _sql(f"WITH {LEVELS_SQL.strip()} SELECT {_FACT}, position_id FROM fact"))
def m2_direct(spark, sf_dir):
    return m.job_table(shapes.postings(spark, sf_dir))


@query("m3a_dim_tech_skill", _sql(dim_sql("tech_stack")))
def m3a(spark, sf_dir):
    return m.dim_tech_skill(shapes.postings(spark, sf_dir))


@query("m3b_dim_soft_skill", _sql(dim_sql("soft_skills")))
def m3b(spark, sf_dir):
    return m.dim_soft_skill(shapes.postings(spark, sf_dir))


@query("m3c_dim_major", _sql(dim_sql("major")))
def m3c(spark, sf_dir):
    return m.dim_major(shapes.postings(spark, sf_dir))


@query(
    "m3_list_dim_null_member",
    _sql(
        dim_sql("tech_stack")
        + " UNION SELECT NULL, NULL FROM posting_rows WHERE tech = ''"
    ),
)
def m3_null(spark, sf_dir):
    return m.list_dim(shapes.postings(spark, sf_dir), "tech_stack", keep_null_member=True)


@query("m4_dim_position", _sql(DIM_POSITION_SQL))
def m4(spark, sf_dir):
    return m.dim_position(shapes.postings(spark, sf_dir))


@query("m5_bridge_distinct", _sql(bridge_sql("major", "member_id").replace("SELECT job_id", "SELECT DISTINCT job_id", 1)))
def m5(spark, sf_dir):
    return m.bridge(shapes.postings(spark, sf_dir), "major", "member_id", distinct=True)


@query("m5a_bridge_tech_skill", _sql(bridge_sql("tech_stack", "tech_skill_id")))
def m5a(spark, sf_dir):
    silver = shapes.postings(spark, sf_dir)
    return m.bridge_tech_skill(silver, m.dim_tech_skill(silver))


@query("m5b_bridge_soft_skill", _sql(bridge_sql("soft_skills", "soft_skill_id")))
def m5b(spark, sf_dir):
    return m.bridge_soft_skill(shapes.postings(spark, sf_dir))


@query("m5c_bridge_major", _sql(bridge_sql("major", "major_id")))
def m5c(spark, sf_dir):
    return m.bridge_major(shapes.postings(spark, sf_dir))


@query("m6_surrogate_key", "SELECT p_partkey, md5(p_name) AS id FROM part")
def m6(spark, sf_dir):
    return table(spark, sf_dir, "part").select("p_partkey", m.surrogate_key("p_name").alias("id"))


@query(
    "m7_run_metrics",
    _sql(
        f"""WITH {LEVELS_SQL.strip()}
        SELECT 'all' AS partition, 'success' AS status, count(*) AS row_count, CAST(10 AS BIGINT) AS column_count
        FROM fact"""
    ),
)
def m7(spark, sf_dir):
    fact, seen = m.with_metrics(m.job_table(shapes.postings(spark, sf_dir)), "job_fact")
    fact.write.parquet(scratch_dir(spark, "metrics"))
    record = m.metrics_of(fact, seen, "all")
    schema = "partition STRING, status STRING, row_count BIGINT, column_count BIGINT"
    row = tuple(record[c] for c in ("partition", "status", "row_count", "column_count"))
    return spark.createDataFrame([row], schema)


@query("m8_joined_positions", _sql(f"WITH {LEVELS_SQL.strip()} SELECT count(position_id) AS joined FROM fact"))
def m8(spark, sf_dir):
    return m.joined_positions(m.job_table(shapes.postings(spark, sf_dir)))


def _serving(spark, sf_dir):
    return m.serving_tables(m.gold_tables(shapes.postings(spark, sf_dir)))


@query(
    "m9_serving_jobs",
    _sql(
        f"""WITH {LEVELS_SQL.strip()} SELECT id, job_title, location, seniority_level, posted_date,
            job_title AS title_tokens FROM fact"""
    ),
)
def m9_jobs(spark, sf_dir):
    jobs = _serving(spark, sf_dir)["jobs"].drop("update_date")
    return jobs.withColumn("posted_date", F.col("posted_date").cast("string")).withColumn(
        "title_tokens", F.array_join("title_tokens", " ")
    )


@query(
    "m9_serving_skills",
    _sql(
        f"""SELECT name, md5(name) AS id, max(type) AS type FROM (
              SELECT name, 'tech' AS type FROM {pairs_sql('tech_stack')}
              UNION ALL SELECT name, 'soft' FROM {pairs_sql('soft_skills')}) GROUP BY name"""
    ),
)
def m9_skills(spark, sf_dir):
    return _serving(spark, sf_dir)["skills"]


@query(
    "m9_serving_job_skills",
    _sql(
        f"""SELECT DISTINCT job_id, md5(name) AS skill_id FROM (
              SELECT * FROM {pairs_sql('tech_stack')} UNION ALL SELECT * FROM {pairs_sql('soft_skills')})"""
    ),
)
def m9_job_skills(spark, sf_dir):
    return _serving(spark, sf_dir)["job_skills"]


# Broken copies: every fact is stored twice, skills of one kind have a wrong type, the pairs
# keep their repeats, and the skills with an even name length are missing from the parents.
_BROKEN_SQL = """
  bad_jobs AS (SELECT id, job_title, CASE seniority_level WHEN '1-URGENT' THEN NULL ELSE location END AS location,
                      seniority_level FROM jobs
               UNION ALL SELECT id, job_title, location, seniority_level FROM jobs WHERE location = 'NATION_4'),
  bad_skills AS (SELECT id, name, CASE type WHEN 'soft' THEN 'SOFT' ELSE type END AS type FROM skills
                 WHERE name NOT LIKE 'red%'
                 UNION ALL SELECT concat(id, '2'), name, NULL FROM skills WHERE name LIKE 'old%'),
  pairs AS (SELECT l_orderkey AS job_id, md5(p_name) AS skill_id FROM lineitem JOIN part ON p_partkey = l_partkey
            UNION ALL SELECT -o_orderkey - 1, NULL FROM orders),
  bad_alias AS (SELECT job_word, nullif(keyword, 'rr') AS keyword FROM alias)
"""


def _dups(name: str, key: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, '{key} unique' AS rule, count(*) AS violations"
        f" FROM (SELECT {key} FROM bad_{name} GROUP BY {key} HAVING count(*) > 1)"
    )


def _nulls(name: str, column: str) -> str:
    return (
        f"SELECT '{name}', '{column} not null', count(*) FROM bad_{name} WHERE {column} IS NULL"
    )


@query(
    "l4_check_constraints",
    with_shapes(
        "jobs skills alias",
        f"""WITH {_BROKEN_SQL.strip()}, bad_job_skills AS (SELECT * FROM pairs), bad_keyword_alias AS (SELECT * FROM bad_alias)
        """
        + " UNION ALL ".join(
            [_dups("jobs", "id, seniority_level"), _dups("skills", "id"), _dups("skills", "name"),
             _dups("job_skills", "job_id, skill_id"), _dups("keyword_alias", "job_word, keyword")]
            + [_nulls("jobs", c) for c in ("id", "job_title", "location", "seniority_level")]
            + [_nulls("skills", c) for c in ("id", "name", "type")]
            + [_nulls("job_skills", c) for c in ("job_id", "skill_id")]
            + [_nulls("keyword_alias", c) for c in ("job_word", "keyword")]
            + [
                "SELECT 'skills', 'type in (soft, tech)', count(*) FROM bad_skills WHERE type NOT IN ('soft', 'tech')",
                "SELECT 'job_skills', 'job_id exists', count(*) FROM pairs WHERE job_id NOT IN (SELECT id FROM bad_jobs)",
                "SELECT 'job_skills', 'skill_id exists', count(*) FROM pairs WHERE skill_id IS NOT NULL"
                " AND skill_id NOT IN (SELECT id FROM bad_skills)",
            ]
        ),
    ),
)
def l4(spark, sf_dir):
    jobs = shape(spark, sf_dir, "jobs").select("id", "job_title", "location", "seniority_level")
    urgent = F.col("seniority_level") == "1-URGENT"
    bad_jobs = jobs.withColumn("location", F.when(~urgent, F.col("location"))).unionByName(
        jobs.filter("location = 'NATION_4'")
    )
    skills = shape(spark, sf_dir, "skills")
    shouted = F.when(F.col("type") == "soft", F.lit("SOFT")).otherwise(F.col("type"))
    twice = skills.filter("name LIKE 'old%'").select(
        F.concat("id", F.lit("2")).alias("id"), "name", F.lit(None).cast("string").alias("type")
    )
    bad_skills = skills.filter("name NOT LIKE 'red%'").withColumn("type", shouted).unionByName(twice)
    lines, parts = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    pairs = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("job_id"), F.md5("p_name").alias("skill_id")
    )
    lost = table(spark, sf_dir, "orders").select(
        (-F.col("o_orderkey") - 1).alias("job_id"), F.lit(None).cast("string").alias("skill_id")
    )
    alias = shape(spark, sf_dir, "alias").withColumn("keyword", F.nullif("keyword", F.lit("rr")))
    return checks.check_constraints(bad_jobs, bad_skills, pairs.unionByName(lost), alias)


@query(
    "l5_cascade_delete",
    with_shapes(
        "jobs skills job_skills",
        """
        SELECT job_id, skill_id FROM job_skills
        WHERE job_id NOT IN (SELECT id FROM jobs WHERE location = 'NATION_4')
          AND skill_id NOT IN (SELECT id FROM skills WHERE name LIKE 'red%')""",
    ),
)
def l5(spark, sf_dir):
    gone_jobs = shape(spark, sf_dir, "jobs").filter("location = 'NATION_4'")
    gone_skills = shape(spark, sf_dir, "skills").filter("name LIKE 'red%'")
    kept = checks.cascade_delete(shape(spark, sf_dir, "job_skills"), gone_jobs, "job_id")
    return checks.cascade_delete(kept, gone_skills, "skill_id")
