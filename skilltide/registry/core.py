"""Registry of queries and the input shapes they share.

Shapes are SQL over the given tables. Spark reads them as DataFrames, the comparison SQL as
common table expressions of the same text.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

AS_OF = "2001-08-01"

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(run, sql)
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# LISTED(x BY y) is the list of x in the order of the text y, joined with ';'.
SHAPES = {
    # Orders as jobs, part names as titles and skills, line items as job-skill pairs.
    "jobs": """
        SELECT o.o_orderkey AS id, p.p_name AS job_title, n.n_name AS location,
               o.o_orderpriority AS seniority_level, CAST(o.o_orderdate AS DATE) AS posted_date
        FROM orders o
        JOIN customer c ON c.c_custkey = o.o_custkey
        JOIN nation n ON n.n_nationkey = c.c_nationkey
        JOIN part p ON p.p_partkey = o.o_custkey""",
    "skills": """
        SELECT md5(p_name) AS id, p_name AS name,
               CASE WHEN p_name LIKE '%widget' OR p_name LIKE '%gizmo' OR p_name LIKE '%plate'
                         OR p_name LIKE '%anvil' THEN 'soft' ELSE 'tech' END AS type
        FROM part GROUP BY p_name""",
    "job_skills": """
        SELECT DISTINCT l.l_orderkey AS job_id, md5(p.p_name) AS skill_id
        FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey""",
    # Keywords are the initials of a name and the name turned round.
    "alias": """
        SELECT DISTINCT p_name AS job_word,
               concat(substr(p_name, 1, 1), substr(split_part(p_name, ' ', 2), 1, 1)) AS keyword
        FROM part
        UNION
        SELECT p_name AS job_word,
               concat(split_part(p_name, ' ', 2), ' ', split_part(p_name, ' ', 1)) AS keyword
        FROM part""",
    "names": "SELECT p_name AS name, min(p_partkey) AS first_part FROM part GROUP BY p_name",
    # Per name: alias word, plain title, typing error, filters, cursor, no match.
    "request_rows": """
        SELECT first_part * 10 AS request_id,
               concat(substr(name, 1, 1), substr(split_part(name, ' ', 2), 1, 1)) AS job_title,
               '' AS places, '' AS ranks, NULL AS updated_after,
               CAST(NULL AS DOUBLE) AS last_freq, NULL AS last_name, 10 AS page FROM names
        UNION ALL
        SELECT first_part * 10 + 1, upper(name), '', '', NULL, NULL, NULL, 10 FROM names
        UNION ALL
        SELECT first_part * 10 + 2, concat(split_part(name, ' ', 2), 't'),
               'NATION_1;NATION_7;NATION_12', '', NULL, NULL, NULL, 100 FROM names
        UNION ALL
        SELECT first_part * 10 + 3, name, '', '1-URGENT;2-HIGH', '1999-12-31', NULL, NULL, 3
        FROM names
        UNION ALL
        SELECT first_part * 10 + 4, split_part(name, ' ', 2), '', '5-LOW', '1998-05-01',
               6.5, name, 5 FROM names
        UNION ALL
        SELECT first_part * 10 + 5, concat('qqq ', split_part(name, ' ', 1), 'zzzzzzzzz'), '', '',
               NULL, NULL, NULL, 10 FROM names""",
    # Line items as raw list items, written in four ways.
    "items": """
        SELECT l.l_orderkey AS job_id, CAST(l.l_linenumber AS BIGINT) AS pos, p.p_name AS clean,
               p.p_type AS major,
               CASE WHEN p.p_name LIKE '%widget' OR p.p_name LIKE '%gizmo'
                         OR p.p_name LIKE '%plate' OR p.p_name LIKE '%anvil'
                    THEN 'soft_skills' ELSE 'tech_stack' END AS category,
               CASE WHEN l.l_returnflag = 'A' THEN p.p_name
                    WHEN l.l_linestatus = 'F' THEN concat('  ', p.p_name, '.')
                    WHEN l.l_returnflag = 'R' THEN concat(p.p_name, ' xq')
                    ELSE upper(p.p_name) END AS raw
        FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey""",
    "item_lists": """
        SELECT job_id,
               LISTED(CASE WHEN category = 'tech_stack' THEN raw END BY concat(pos, raw)) AS tech,
               LISTED(CASE WHEN category = 'soft_skills' THEN raw END BY concat(pos, raw)) AS soft,
               LISTED(lower(major) BY concat(pos, major)) AS majors
        FROM items GROUP BY job_id""",
    # Orders as parsed postings; lists are texts joined with ';', '' is the empty list.
    "posting_rows": """
        SELECT CAST(o.o_orderkey AS STRING) AS _id, p.p_name AS job_title,
               c.c_name AS company_name,
               CASE o.o_orderstatus WHEN 'O' THEN n.n_name
                    WHEN 'F' THEN concat(' ', lower(n.n_name), '.')
                    ELSE concat(replace(n.n_name, '_', ' '), ', Vietnam') END AS location,
               CAST(CAST(o.o_orderdate AS DATE) AS STRING) AS posted_date,
               concat('https://jobs.example.com/', o.o_orderkey) AS url,
               '2001-08-01' AS update_date, o.o_orderstatus AS salary,
               CASE WHEN o.o_orderstatus = 'P' THEN NULL
                    WHEN o.o_orderpriority = '5-LOW' THEN ''
                    WHEN o.o_orderstatus = 'F' THEN concat(o.o_orderpriority, ';ANY')
                    ELSE o.o_orderpriority END AS levels,
               CASE WHEN o.o_orderpriority = '1-URGENT' THEN NULL
                    WHEN o.o_orderstatus = 'O' THEN upper(p.p_name)
                    WHEN o.o_orderstatus = 'F' THEN concat(p.p_name, ' ')
                    ELSE concat('chief ', p.p_name, '!') END AS job_position,
               CASE WHEN o.o_orderpriority = '5-LOW' AND o.o_orderstatus = 'P' THEN ''
                    ELSE l.tech END AS tech,
               l.soft, l.majors
        FROM orders o
        JOIN customer c ON c.c_custkey = o.o_custkey
        JOIN nation n ON n.n_nationkey = c.c_nationkey
        JOIN part p ON p.p_partkey = o.o_custkey
        LEFT JOIN item_lists l ON l.job_id = o.o_orderkey""",
    # Names, a capitalised second spelling of each, places and majors.
    "vocab": """
        SELECT category, clean AS value, 2 * min(part_key) AS ord FROM vocab_items GROUP BY category, clean
        UNION ALL
        SELECT category, concat(upper(substr(clean, 1, 1)), substr(clean, 2)) AS value,
               2 * max(part_key) + 1 AS ord FROM vocab_items GROUP BY category, clean
        UNION ALL
        SELECT 'job_position' AS category, p_name AS value, min(p_partkey) AS ord
        FROM part GROUP BY p_name
        UNION ALL
        SELECT 'location' AS category, n_name AS value, CAST(n_nationkey AS BIGINT) AS ord FROM nation
        UNION ALL
        SELECT 'major' AS category, p_type AS value, min(p_partkey) AS ord FROM part GROUP BY p_type""",
    "vocab_items": """
        SELECT CASE WHEN p_name LIKE '%widget' OR p_name LIKE '%gizmo' OR p_name LIKE '%plate'
                         OR p_name LIKE '%anvil' THEN 'soft_skills' ELSE 'tech_stack' END AS category,
               p_name AS clean, p_partkey AS part_key FROM part""",
    # Documents as raw postings; the first line is the title.
    "raw": """
        SELECT CAST(doc_id AS STRING) AS _id, split_part(text, chr(10), 1) AS job_title,
               source AS company_name, lang AS location,
               concat('https://jobs.example.com/', lang, '-', doc_id) AS url,
               CASE WHEN lang = 'en' THEN '2001-07-15' ELSE '2001-06-30' END AS posted_date,
               text AS full_text_jd
        FROM documents""",
    # Labels as model output: one key overrides, one is null, one list repeats.
    "parsed": """
        SELECT CAST(doc_id AS STRING) AS _id,
               CASE WHEN toxic = 1 THEN NULL
                    ELSE concat('{"job_title": "title ', quality, '", "salary": "', doc_id,
                                '", "location": null, "tech_stack": ["a", {"b": ["c", "d"], "e": "f"}, "a"]}')
                    END AS body
        FROM labels""",
}

_LISTED = re.compile(r"LISTED\((.*?) BY (.*?\))\)")
_LIST_SQL = {
    "spark": r"listagg(\1, ';') WITHIN GROUP (ORDER BY \2)",
    "duckdb": r"string_agg(\1, ';' ORDER BY \2)",
}


def _ordered(names: list[str], seen: list[str]) -> list[str]:
    for name in names:
        if name in seen:
            continue
        words = set(re.findall(r"[a-z_]+", SHAPES[name]))
        _ordered([s for s in SHAPES if s in words and s != name], seen)
        seen.append(name)
    return seen


def _shape_ctes(names: list[str], dialect: str) -> list[tuple[str, str]]:
    return [(n, _LISTED.sub(_LIST_SQL[dialect], SHAPES[n])) for n in _ordered(names, [])]


def shape(spark: SparkSession, sf_dir: str, name: str, **made: DataFrame) -> DataFrame:
    """A shape as a DataFrame over the files; ``made`` are shapes it uses that are DataFrames already."""
    ctes = [(n, f"SELECT * FROM {{{n}}}" if n in made else text) for n, text in _shape_ctes([name], "spark")]
    words = set(re.findall(r"[a-z_]+", " ".join(text for _, text in ctes)))
    files = [
        (t, f"SELECT * FROM parquet.`{sf_dir.rstrip('/')}/{t}.parquet`")
        for t in TABLES
        if t in words
    ]
    body = ", ".join(f"{n} AS ({text})" for n, text in files + ctes)
    return spark.sql(f"WITH {body} SELECT * FROM {name}", **made)


def with_shapes(names: str, body: str) -> str:
    """Comparison SQL: the named shapes as common table expressions before ``body``, which may
    start with further ones."""
    ctes = ", ".join(f"{n} AS ({text})" for n, text in _shape_ctes(names.split(), "duckdb"))
    body = body.strip()
    return f"WITH {ctes}, {body[5:]}" if body[:5].upper() == "WITH " else f"WITH {ctes} {body}"
