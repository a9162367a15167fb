"""X-1..X-21 over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from skilltide.functions import postings as p
from skilltide.functions import text as t
from skilltide.functions.fuzzy import token_set_ratio
from skilltide.registry.core import AS_OF, query, table
from skilltide.registry.fuzzy import PAIR_SCORES, recursive

# The comparison SQL's accent folding and trimming.
FOLD = (
    "replace(replace(replace(replace(replace(replace(replace(replace(replace("
    "strip_accents(lower({0})), 'đ', 'd'), 'ø', 'o'), 'ł', 'l'), 'ħ', 'h'), 'ŧ', 't'),"
    " 'ı', 'i'), 'ß', 'ss'), 'æ', 'ae'), 'œ', 'oe')"
)
STRIP = r"regexp_replace({0}, '^[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+|[\s\x0b\x1c-\x1f\x{{85}}\p{{Z}}]+$', '', 'g')"
TOKENS = (
    "list_filter(string_split_regex({0}, '[^\\p{{L}}\\p{{N}}]+'), lambda w: length(w) > 0)"
)
TRIGRAMS = (
    "list_distinct(flatten(list_transform("
    "list_filter(string_split_regex(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: length(w) > 0),"
    " lambda w: list_transform(range(1, length(w) + 2),"
    " lambda i: substr(concat('  ', w, ' '), i, 3)))))"
)

HEADLINES = r"""
WITH headlines AS (
  SELECT page_id, trim(regexp_extract(html, '(?s)<title[^>]*>(.*?)</title>', 1)) AS title,
         regexp_replace(html, '<[^>]+>', ' ', 'g') AS body
  FROM pages)
"""


def _headlines(spark, sf_dir):
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.trim(F.regexp_extract(html, r"(?s)<title[^>]*>(.*?)</title>", 1)).alias("title"),
        F.regexp_replace(html, "<[^>]+>", " ").alias("body"),
    )


@query(
    "x1_posted_date",
    """
    WITH texts AS (
      SELECT event_id, CASE event_type WHEN 'view' THEN concat('Posted ', user_id, ' minutes ago')
             WHEN 'click' THEN concat(user_id, ' hours') WHEN 'error' THEN concat(user_id, ' day')
             WHEN 'signup' THEN 'yesterday' END AS posted
      FROM events)
    SELECT event_id, CAST(CAST(CASE WHEN posted IS NULL THEN NULL
        WHEN posted LIKE '%minutes%' THEN t0 - to_minutes(CAST(n AS BIGINT))
        WHEN posted LIKE '%hours%' THEN t0 - to_hours(CAST(n AS BIGINT))
        WHEN posted LIKE '%day' AND n <> '' THEN t0 - to_days(CAST(n AS INT))
        ELSE t0 END AS DATE) AS VARCHAR) AS posted_date
    FROM (SELECT event_id, posted, regexp_extract(posted, '([0-9]+)', 1) AS n,
                 TIMESTAMP '2024-02-01 01:30:00' AS t0 FROM texts)
    """,
)
def x1(spark, sf_dir):
    kind, user = F.col("event_type"), F.col("user_id").cast("string")
    posted = (
        F.when(kind == "view", F.concat(F.lit("Posted "), user, F.lit(" minutes ago")))
        .when(kind == "click", F.concat(user, F.lit(" hours")))
        .when(kind == "error", F.concat(user, F.lit(" day")))
        .when(kind == "signup", F.lit("yesterday"))
    )
    day = p.posted_date(posted, F.lit("2024-02-01 01:30:00"))
    return table(spark, sf_dir, "events").select("event_id", day.cast("string").alias("posted_date"))


@query(
    "x2_last_address_part",
    """
    SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Unknown' WHEN 'MACHINERY' THEN c_name
      WHEN 'FURNITURE' THEN '' ELSE concat('NATION_', c_nationkey) END AS place
    FROM customer
    """,
)
def x2(spark, sf_dir):
    segment, name = F.col("c_mktsegment"), F.col("c_name")
    address = (
        F.when(segment == "BUILDING", F.lit("  "))
        .when(segment == "MACHINERY", F.concat(name, F.lit(" ")))
        .when(segment == "FURNITURE", F.concat(name, F.lit(",")))
        .otherwise(F.concat(name, F.lit(", road, NATION_"), F.col("c_nationkey"), F.lit(" ")))
    )
    return table(spark, sf_dir, "customer").select(
        "c_custkey", p.last_address_part(address).alias("place")
    )


@query(
    "x3_source_id",
    """
    WITH links AS (SELECT page_id, concat('https://jobs.example.com/job-', page_id, '-', url) AS link FROM pages)
    SELECT page_id,
           string_split(rtrim(string_split(link, '?')[1], '/'), '-')[-1] AS id_path,
           string_split(string_split(link, '-')[-1], '?')[1] AS id_tail
    FROM links
    """,
)
def x3(spark, sf_dir):
    link = F.concat(F.lit("https://jobs.example.com/job-"), "page_id", F.lit("-"), "url")
    return table(spark, sf_dir, "pages").select(
        "page_id",
        p.source_id_path(link).alias("id_path"),
        p.source_id_tail(link).alias("id_tail"),
    )


@query("x4_url_without_query", "SELECT page_id, split_part(url, '?', 1) AS link FROM pages")
def x4(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", p.url_without_query("url").alias("link"))


@query(
    "x5_html_to_text",
    "SELECT page_id, "
    + STRIP.format(r"regexp_replace(regexp_replace(html, '<[^>]+>', chr(10), 'g'), '\n+', chr(10), 'g')")
    + " AS body FROM pages",
)
def x5(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", t.html_to_text("html").alias("body"))


@query(
    "x6_collapse_newlines",
    "SELECT doc_id, replace(concat(text, chr(10), chr(10), chr(10), text), concat(chr(10), chr(10)), chr(10)) AS body FROM documents",
)
def x6(spark, sf_dir):
    doubled = F.concat(F.col("text"), F.lit("\n\n\n"), F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", t.collapse_double_newline(doubled).alias("body")
    )


@query(
    "x7_title_before",
    HEADLINES + "SELECT page_id, " + STRIP.format("string_split(title, ' de ')[1]") + " AS title FROM headlines",
)
def x7(spark, sf_dir):
    return _headlines(spark, sf_dir).select("page_id", t.title_before("title", " de ").alias("title"))


@query("x8_fold", f"SELECT doc_id, {FOLD.format('text')} AS folded FROM documents")
def x8(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.fold("text").alias("folded"))


@query(
    "x9_client_fold",
    "SELECT doc_id, "
    + STRIP.format(r"regexp_replace(strip_accents(lower(text)), '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g')")
    + " AS folded FROM documents",
)
def x9(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.client_fold("text").alias("folded"))


@query(
    "x10_contains_either_way",
    HEADLINES
    + r"""SELECT page_id, CAST(contains(a, b) OR contains(b, a) AS INT) AS hit FROM (
      SELECT page_id, trim(regexp_replace(strip_accents(lower(title)), '\s+', ' ', 'g')) AS a,
             trim(regexp_replace(strip_accents(lower(body)), '\s+', ' ', 'g')) AS b FROM headlines)
    """,
)
def x10(spark, sf_dir):
    return _headlines(spark, sf_dir).select(
        "page_id", t.contains_either_way("title", "body").cast("int").alias("hit")
    )


@query(
    "x11_clean_key",
    "SELECT doc_id, "
    + STRIP.format(r"regexp_replace(lower(text), '[^\p{L}\p{N}_\s\x0b\x1c-\x1f\x{85}\p{Z}]', '', 'g')")
    + " AS key FROM documents",
)
def x11(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", t.clean_key("text").alias("key"))


@query(
    "x12_parse_list",
    """
    SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN concat(p_name, '|', p_brand)
      WHEN 'SMALL' THEN p_name WHEN 'LARGE' THEN '' WHEN 'PROMO' THEN concat('[', p_name) END AS items
    FROM part
    """,
)
def x12(spark, sf_dir):
    kind, name = F.col("p_type"), F.col("p_name")
    text = (
        F.when(kind == "ECONOMY", F.concat(F.lit(' ["'), name, F.lit('", "'), "p_brand", F.lit('"] ')))
        .when(kind == "SMALL", name)
        .when(kind == "LARGE", F.concat(F.lit("["), name, F.lit("]")))
        .when(kind == "PROMO", F.concat(F.lit("["), name))
    )
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(t.parse_list(text), "|").alias("items")
    )


_DOC_TOKENS = TOKENS.format(FOLD.format("text"))


@query(
    "x13_tokens",
    f"""
    SELECT doc_id, array_to_string(list_sort(list_distinct({_DOC_TOKENS})), ' ') AS tokens FROM documents
    """,
)
def x13(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(F.sort_array(t.tokens("text")), " ").alias("tokens")
    )


@query(
    "x14_all_terms_match",
    HEADLINES
    + f"""
    SELECT page_id, CAST(len(q) > 0 AND list_has_all(d, q) AS INT) AS hit FROM (
      SELECT page_id, {TOKENS.format(FOLD.format('body'))} AS d, {TOKENS.format(FOLD.format('title'))} AS q
      FROM headlines)
    UNION ALL
    SELECT page_id, CAST(len(q) > 0 AND list_has_all(d, q) AS INT) AS hit FROM (
      SELECT page_id, {TOKENS.format(FOLD.format('title'))} AS d, {TOKENS.format(FOLD.format('body'))} AS q
      FROM headlines)
    """,
)
def x14(spark, sf_dir):
    heads = _headlines(spark, sf_dir).select(
        "page_id", t.tokens("title").alias("title"), t.tokens("body").alias("body")
    )

    def hits(held, asked):
        return heads.select("page_id", t.all_terms_match(held, asked).cast("int").alias("hit"))

    return hits("body", "title").unionByName(hits("title", "body"))


@query(
    "x15_trigrams",
    f"SELECT conv_id, turn, array_to_string(list_sort({TRIGRAMS.format('text')}), '|') AS grams FROM conversations",
)
def x15(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.array_join(F.sort_array(t.trigrams("text")), "|").alias("grams")
    )


@query(
    "x16_similarity",
    HEADLINES
    + f"""SELECT page_id, CASE WHEN len(a) + len(b) = 0 THEN 0.0
             ELSE round(len(list_intersect(a, b)) / len(list_distinct(list_concat(a, b))), 9) END AS similarity
    FROM (SELECT page_id, {TRIGRAMS.format('title')} AS a, {TRIGRAMS.format('body')} AS b FROM headlines)
    """,
)
def x16(spark, sf_dir):
    return _headlines(spark, sf_dir).select(
        "page_id", F.round(t.trigram_similarity("title", "body"), 9).alias("similarity")
    )


@query(
    "x17_space_tokens",
    "SELECT conv_id, turn, array_to_string(string_split(text, ' '), '|') AS tokens FROM conversations",
)
def x17(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", F.array_join(t.space_tokens("text"), "|").alias("tokens")
    )


@query(
    "x18_token_set_ratio",
    recursive(
        f"""WITH pairs AS (
              SELECT p_partkey, concat(p_name, ' ', p_type) AS l,
                     concat(p_brand, '-', p_type, ' ', split_part(p_name, ' ', 2), 's') AS r FROM part),
            score_pairs AS (SELECT l, r FROM pairs), {PAIR_SCORES.strip()}
            SELECT p_partkey, score FROM pairs JOIN pair_scores USING (l, r)"""
    ),
)
def x18(spark, sf_dir):
    left = F.concat("p_name", F.lit(" "), "p_type")
    noun = F.split_part("p_name", F.lit(" "), F.lit(2))
    right = F.concat("p_brand", F.lit("-"), "p_type", F.lit(" "), noun, F.lit("s"))
    parts = table(spark, sf_dir, "part")
    return parts.select("p_partkey", token_set_ratio(left, right).alias("score"))


@query(
    "x19_percent",
    """
    SELECT l_partkey, CAST(p AS DOUBLE) AS percent, concat(CAST(p AS DECIMAL(20,1)), '%') AS label FROM (
      SELECT l_partkey, round(CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) * 100.0 / count(*)
                              AS DECIMAL(38,10)), 1) AS p
      FROM lineitem GROUP BY l_partkey)
    """,
)
def x19(spark, sf_dir):
    counts = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("n"), F.count("*").alias("total")
    )
    value = t.percent("n", "total")
    return counts.select(
        "l_partkey", value.cast("double").alias("percent"), t.percent_text(value).alias("label")
    )


@query(
    "x20_months_ago",
    "SELECT o_orderkey, CAST(CAST(CAST(o_orderdate AS DATE) - INTERVAL 6 MONTH AS DATE) AS VARCHAR) AS day FROM orders",
)
def x20(spark, sf_dir):
    day = p.months_ago(F.col("o_orderdate").cast("date"), 6)
    return table(spark, sf_dir, "orders").select("o_orderkey", day.cast("string").alias("day"))


@query(
    "x21_month_bucket",
    f"""
    SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS DATE) = DATE '{AS_OF}' THEN '0'
      WHEN m BETWEEN 23 AND 25 THEN '24' WHEN m BETWEEN 11 AND 13 THEN '12'
      WHEN m BETWEEN 5 AND 7 THEN '6' WHEN m BETWEEN 2 AND 4 THEN '3' ELSE '' END AS preset
    FROM (SELECT o_orderkey, o_orderdate,
                 (2001 * 12 + 8) - (year(o_orderdate) * 12 + month(o_orderdate)) AS m FROM orders)
    """,
)
def x21(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return table(spark, sf_dir, "orders").select("o_orderkey", p.month_bucket(day, AS_OF).alias("preset"))
