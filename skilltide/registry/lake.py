"""L-1..L-3 and J-1..J-4: loads and whole runs, written to a scratch folder and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skilltide.operators import model as m
from skilltide.operators.normalize import LIST_FIELDS
from skilltide.plans import lake
from skilltide.registry import shapes
from skilltide.registry.core import query, shape, with_shapes
from skilltide.registry.model import DIM_POSITION_SQL, LEVELS_SQL, bridge_sql, dim_sql
from skilltide.registry.fuzzy import recursive
from skilltide.registry.normalize import FUZZY_SILVER, SILVER, silver_text
from skilltide.registry.parse import DOC_WORDS, PHRASES, term_vocab
from skilltide.schemas import WAREHOUSE
from skilltide.session import scratch_dir
from skilltide.sources.files import read_layer
from skilltide.sources.warehouse import load_table, read_table, register_tables

MONTH = "2000-03-01"
_IN_MONTH = "posted_date >= '2000-03-01' AND posted_date < '2000-04-01'"


def _month_sql(body: str, names: str = "posting_rows") -> str:
    """``body`` over the postings of the month."""
    rows = f"month_rows AS (SELECT * FROM posting_rows WHERE {_IN_MONTH})"
    body = body.replace("posting_rows", "month_rows")
    body = body[5:] if body.startswith("WITH ") else f"result AS ({body}) SELECT * FROM result"
    return with_shapes(names, f"WITH {rows}, {body}")


def _loaded(spark, sf_dir, table: str) -> DataFrame:
    """The month of one gold table after two loads of it and one of another month."""
    root = scratch_dir(spark, "warehouse")
    postings = shapes.saved_postings(spark, sf_dir, where=f"posted_date >= '{MONTH}' AND posted_date < '2000-05-01'")
    for month, following in ((MONTH, "2000-04-01"), ("2000-04-01", "2000-05-01"), (MONTH, "2000-04-01")):
        silver = postings.filter((F.col("posted_date") >= month) & (F.col("posted_date") < following))
        load_table(m.gold_tables(silver)[table], root, table, month)
    return read_table(spark, root, table, MONTH).select(*WAREHOUSE[table].columns)


_FACT_SQL = f"WITH {LEVELS_SQL.strip()} SELECT * FROM fact"


@query("l1_load_table", _month_sql(dim_sql("major")))
def l1(spark, sf_dir):
    return _loaded(spark, sf_dir, "major_table")


@query(
    "l2_read_table",
    with_shapes("skills", "SELECT id, name FROM skills"),
)
def l2(spark, sf_dir):
    root = scratch_dir(spark, "warehouse")
    load_table(shape(spark, sf_dir, "skills"), root, "tech_skill_table")
    missing = read_table(spark, root, "soft_skill_table").select("id", "name")
    return read_table(spark, root, "tech_skill_table").unionByName(missing)


@query(
    "l3_contracts",
    with_shapes(
        "posting_rows",
        "SELECT 'job_position_table' AS name, count(*) AS n FROM (" + DIM_POSITION_SQL + ")",
    ),
)
def l3(spark, sf_dir):
    root = scratch_dir(spark, "warehouse")
    load_table(m.dim_position(shapes.postings(spark, sf_dir)), root, "job_position_table")
    schema = root.rsplit("/", 1)[-1].replace("-", "_")
    register_tables(spark, root, schema)
    rows = spark.table(f"{schema}.job_position_table")
    out = rows.agg(F.count("*").alias("n")).select(F.lit("job_position_table").alias("name"), "n")
    return out


def _register_loads() -> None:
    loads = {
        "job_description_table": _FACT_SQL,
        "tech_skill_table": dim_sql("tech_stack"),
        "job_tech_skill_mapping": bridge_sql("tech_stack", "tech_skill_id"),
        "soft_skill_table": dim_sql("soft_skills"),
        "job_soft_skill_mapping": bridge_sql("soft_skills", "soft_skill_id"),
        "major_table": dim_sql("major"),
        "job_major_mapping": bridge_sql("major", "major_id"),
        "job_position_table": DIM_POSITION_SQL,
    }
    for letter, (name, sql) in zip("abcdefgh", loads.items()):

        def run(spark, sf_dir, name=name):
            return _loaded(spark, sf_dir, name)

        query(f"l3{letter}_load_{name}", _month_sql(sql))(run)


_register_loads()


def _digest(text: Column) -> Column:
    """A sum over rows that both engines can take: it tells contents apart, whatever their order."""
    return F.coalesce(F.sum(F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")), F.lit(0))


def _digest_sql(name: str, text: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS name, count(*) AS n, CAST(coalesce(sum(CAST(concat('0x', substr(md5({text}), 1, 8))"
        f" AS BIGINT)), 0) AS BIGINT) AS digest FROM {source}"
    )


_SILVER_FIELDS = ("_id", "job_title", "posted_date", "location", "job_position", *LIST_FIELDS)


def _lake_sql(where: str, with_silver: bool = True) -> str:
    """Count and digest of the rows of each table, dimensions being distinct per month."""

    def pairs(column: str) -> str:
        return (
            f"(SELECT _id, substr(posted_date, 1, 7) AS month, unnest(string_split({column}, ';')) AS name"
            f" FROM silver WHERE {column} <> '')"
        )

    whole = "concat_ws('|', " + ", ".join(f"coalesce({c}, '-')" for c in _SILVER_FIELDS) + ")"
    parts = [_digest_sql("silver", whole, "silver")] if with_silver else []
    for column, dim, bridge in (
        ("tech_stack", "tech_skill_table", "job_tech_skill_mapping"),
        ("soft_skills", "soft_skill_table", "job_soft_skill_mapping"),
        ("major", "major_table", "job_major_mapping"),
    ):
        members = f"(SELECT DISTINCT month, name FROM {pairs(column)})"
        parts.append(_digest_sql(dim, "concat(month, '|', md5(name), '|', name)", members))
        parts.append(_digest_sql(bridge, "concat(month, '|', _id, '|', md5(name))", pairs(column)))
    positions = (
        "(SELECT DISTINCT substr(posted_date, 1, 7) AS month, job_position AS name FROM silver WHERE job_position IS NOT NULL)"
    )
    parts.append(_digest_sql("job_position_table", "concat(month, '|', md5(name), '|', name)", positions))
    fact = (
        "(SELECT s._id, substr(s.posted_date, 1, 7) AS month, s.job_position, s.location, c.company_name,"
        " unnest(CASE WHEN coalesce(c.levels, '') = '' THEN [NULL] ELSE string_split(c.levels, ';') END) AS level"
        " FROM silver s JOIN chosen c USING (_id))"
    )
    text = (
        "concat(month, '|', _id, '|', coalesce(level, '-'), '|', coalesce(md5(job_position), '-'), '|',"
        " coalesce(location, '-'), '|', company_name)"
    )
    parts.append(_digest_sql("job_description_table", text, fact))
    silver = SILVER.strip().replace("posting_rows", "chosen")
    return with_shapes(
        "posting_rows vocab",
        f"WITH chosen AS (SELECT * FROM posting_rows WHERE {where}), {silver} " + " UNION ALL ".join(parts),
    )


def _contents(frames: dict[str, DataFrame]) -> DataFrame:
    month = F.substring(F.col("month").cast("string"), 1, 7)

    def text_of(name: str, df: DataFrame) -> Column:
        if name == "job_description_table":
            fields = [month, "id", F.coalesce("seniority_level", F.lit("-")), F.coalesce("position_id", F.lit("-"))]
            return F.concat_ws("|", *fields, F.coalesce("location", F.lit("-")), "company_name")
        if name.endswith("_mapping"):
            return F.concat_ws("|", month, "job_id", next(c for c in df.columns if c not in ("job_id", "month")))
        return F.concat_ws("|", month, "id", "name")

    def row(name: str, df: DataFrame) -> DataFrame:
        if name == "silver":
            df = silver_text(df)
            text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in _SILVER_FIELDS])
        else:
            text = text_of(name, df)
        return df.agg(F.count("*").alias("n"), _digest(text).alias("digest")).select(F.lit(name).alias("name"), "n", "digest")

    return reduce(DataFrame.unionByName, [row(name, df) for name, df in frames.items()])


def _lake_contents(spark, root, month=None) -> DataFrame:
    texts = T.ArrayType(T.StringType())
    silver = [T.StructField(c, texts if c in LIST_FIELDS else T.StringType()) for c in _SILVER_FIELDS]

    def layer(name: str, table: str, fields: list[T.StructField]) -> DataFrame:
        # a layer whose months are all gone has no file to take a schema from
        schema = T.StructType([*fields, T.StructField("month", T.DateType())])
        return read_layer(spark, root, name, table, month, schema)

    frames = {"silver": layer("silver", "job_descriptions", silver)}
    for t, contract in WAREHOUSE.items():
        frames[t] = layer("gold", t, [T.StructField(c, T.StringType()) for c in contract.columns])
    return _contents(frames)


@query("j1_run_datalake", _lake_sql(_IN_MONTH))
def j1(spark, sf_dir):
    root = scratch_dir(spark, "lake")
    postings, vocab = shapes.saved_postings(spark, sf_dir), shapes.vocab(spark, sf_dir)
    # twice, first with all postings of the month said twice over: the second run's rows are all that stay
    again = postings.withColumn("_id", F.concat(F.lit("again-"), "_id"))
    lake.run_datalake(postings.unionByName(again), vocab, root, MONTH, threshold=None)
    lake.run_datalake(postings, vocab, root, MONTH, threshold=None)
    return _lake_contents(spark, root, MONTH)


@query(
    "j1_run_datalake_emptied",
    "SELECT name, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS digest FROM (VALUES "
    + ", ".join(f"('{t}')" for t in ("silver", *WAREHOUSE)) + ") AS t(name)",
)
def j1_emptied(spark, sf_dir):
    root = scratch_dir(spark, "lake")
    postings, vocab = shapes.saved_postings(spark, sf_dir), shapes.vocab(spark, sf_dir)
    lake.run_datalake(postings, vocab, root, MONTH, threshold=None)
    lake.run_datalake(postings.filter(f"NOT ({_IN_MONTH})"), vocab, root, MONTH, threshold=None)
    return _lake_contents(spark, root, MONTH)


@query(
    "j1_run_datalake_fuzzy",
    recursive(_month_sql(f"WITH {FUZZY_SILVER} SELECT * FROM silver", "posting_rows vocab")),
)
def j1_fuzzy(spark, sf_dir):
    root = scratch_dir(spark, "lake")
    lake.run_datalake(shapes.postings(spark, sf_dir), shapes.vocab(spark, sf_dir), root, MONTH)
    return silver_text(read_layer(spark, root, "silver", "job_descriptions", MONTH))


@query("j2_run_warehouse", _lake_sql(_IN_MONTH, with_silver=False))
def j2(spark, sf_dir):
    root = scratch_dir(spark, "lake")
    postings, vocab = shapes.postings(spark, sf_dir), shapes.vocab(spark, sf_dir)
    lake.run_datalake(postings, vocab, f"{root}/lake", MONTH, threshold=None)
    lake.run_warehouse(spark, f"{root}/lake", f"{root}/warehouse", MONTH)
    lake.run_warehouse(spark, f"{root}/lake", f"{root}/warehouse", MONTH)  # a load can be repeated
    return _contents({t: read_table(spark, f"{root}/warehouse", t, MONTH) for t in WAREHOUSE})


@query(
    "j3_run_parse",
    with_shapes(
        "raw parsed",
        f"""WITH {PHRASES.strip()},
        todo AS (
          SELECT *, CASE WHEN job_title <> '' THEN concat(job_title, chr(10), chr(10), full_text_jd)
                    ELSE full_text_jd END AS text
          FROM raw WHERE _id NOT IN (SELECT _id FROM parsed)),
        words AS (SELECT _id, {DOC_WORDS} AS words FROM todo),
        hits AS (
          SELECT DISTINCT _id, category, value FROM words
          JOIN terms ON contains(words, concat(' ', term, ' '))),
        found AS (
          SELECT _id, string_agg(CASE category WHEN 'one' THEN value END, '|' ORDER BY value) AS tech_stack,
                 string_agg(CASE category WHEN 'two' THEN value END, '|' ORDER BY value) AS soft_skills,
                 min(CASE category WHEN 'three' THEN value END) AS job_position,
                 string_agg(CASE category WHEN 'more' THEN value END, '|' ORDER BY value) AS major
          FROM hits GROUP BY _id)
        SELECT t._id, t.job_title, t.company_name, t.location, t.posted_date, t.url,
               f.tech_stack, f.soft_skills, f.major, f.job_position
        FROM todo t LEFT JOIN found f USING (_id)""",
    ),
)
def j3(spark, sf_dir):
    fields = {"one": "tech_stack", "two": "soft_skills", "three": "job_position", "more": "major"}
    names = F.create_map(*[F.lit(x) for pair in fields.items() for x in pair])
    category = F.element_at(names, F.col("category")).alias("category")
    terms = term_vocab(spark, sf_dir).select(category, "value", F.col("value").alias("ord"))
    done = lake.run_parse(
        shape(spark, sf_dir, "raw"), shape(spark, sf_dir, "parsed"), terms, "2001-08-01"
    )
    return done.select(
        "_id", "job_title", "company_name", "location", "posted_date", "url", "job_position",
        *[F.array_join(c, "|").alias(c) for c in ("tech_stack", "soft_skills", "major")],
    )


@query("j4_backfill", _lake_sql("posted_date >= '1995-01-01' AND posted_date < '2001-09-01'"))
def j4(spark, sf_dir):
    root = scratch_dir(spark, "lake")
    postings, vocab = shapes.postings(spark, sf_dir), shapes.vocab(spark, sf_dir)
    lake.backfill(postings, vocab, root, "1995-01-01", "2001-08-01", threshold=None)
    return _lake_contents(spark, root)
