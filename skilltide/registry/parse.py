"""P-1..P-11 over documents as postings and labels as model output."""

from __future__ import annotations

from pyspark.sql import functions as F

from skilltide.functions import parsing
from skilltide.operators import extract as e
from skilltide.registry import shapes
from skilltide.registry.core import query, shape, table, with_shapes
from skilltide.registry.expressions import FOLD


@query(
    "p1_unparsed",
    with_shapes("raw parsed", "SELECT _id FROM raw WHERE _id NOT IN (SELECT _id FROM parsed)"),
)
def p1(spark, sf_dir):
    return e.unparsed(shape(spark, sf_dir, "raw"), shape(spark, sf_dir, "parsed")).select("_id")


@query(
    "p2_guard_size",
    with_shapes(
        "raw",
        """
        SELECT _id, CASE WHEN b > 4096 THEN 'Document too large to process' ELSE full_text_jd END AS full_text_jd,
               CASE WHEN b > 4096 THEN concat('Document too large to process: ', b, ' bytes') END AS error
        FROM (SELECT *, octet_length(encode(full_text_jd)) AS b FROM raw)""",
    ),
)
def p2(spark, sf_dir):
    return e.guard_size(shape(spark, sf_dir, "raw"), 4096).select("_id", "full_text_jd", "error")


@query(
    "p3_model_input",
    with_shapes(
        "raw",
        """
        SELECT _id, CASE WHEN company_name = 'src1' THEN full_text_jd
               ELSE concat(job_title, chr(10), chr(10), full_text_jd) END AS body
        FROM raw""",
    ),
)
def p3(spark, sf_dir):
    title = F.when(F.col("company_name") != "src1", F.col("job_title"))
    return shape(spark, sf_dir, "raw").select("_id", e.model_input(title, "full_text_jd").alias("body"))


_FORMAT = '{"tech_stack": []}'
_TERMS = "(SELECT string_agg(value, ', ' ORDER BY ord, value) FROM vocab WHERE category = '{0}')"


def _prompt_sql() -> str:
    rules = " || ".join(
        f"'- {rule}: ' || coalesce({_TERMS.format(category)}, '') || chr(10)"
        for category, rule in e.PROMPT_RULES
    )
    return with_shapes(
        "vocab",
        f"""
        WITH rules AS (SELECT {rules} AS g)
        SELECT doc_id, md5(concat('"', text, '"', chr(10), chr(10), '---', chr(10), chr(10),
          'Fill this JSON format from the posting above:', chr(10), '{_FORMAT}', chr(10), chr(10), g,
          '- Answer in English with valid JSON that has every field.', chr(10))) AS prompt
        FROM documents, rules""",
    )


@query("p4_render_prompt", _prompt_sql())
def p4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    prompts = e.render_prompt(docs, shapes.vocab(spark, sf_dir), _FORMAT, "text")
    return prompts.select("doc_id", F.md5("prompt").alias("prompt"))


@query(
    "p5_extract_json",
    """
    SELECT event_id, CASE WHEN event_type IN ('view', 'click', 'purchase')
      THEN json_extract_string(props, '$.k') END AS k FROM events
    """,
)
def p5(spark, sf_dir):
    kind, props = F.col("event_type"), F.col("props")
    text = (
        F.when(kind == "view", F.concat(F.lit("Here you are:\n```json\n"), props, F.lit("\n```")))
        .when(kind.isin("click", "purchase"), props)
        .when(kind == "error", F.concat(F.lit("{{"), props))
        .otherwise(F.lit("no object"))
    )
    found = parsing.extract_json(text)
    return table(spark, sf_dir, "events").select(
        "event_id", F.try_variant_get(found, "$.k", "string").alias("k")
    )


@query(
    "p6_flatten_dicts",
    """
    SELECT p_partkey, concat('name: ', p_name, '; ', p_type, '. brand: ', p_brand) AS top,
           concat('a: ', p_name, '|b: ', p_type, '; ', p_brand) AS nested,
           concat('k: ', p_name, '; ', p_type, '. m: ', p_brand) AS json_text
    FROM part
    """,
)
def p6(spark, sf_dir):
    name, kind, brand = F.col("p_name"), F.col("p_type"), F.col("p_brand")
    top = F.create_map(F.lit("name"), F.array(name, kind), F.lit("brand"), F.array(brand))
    nested = F.array(
        F.create_map(F.lit("a"), F.array(name)), F.create_map(F.lit("b"), F.array(kind, brand))
    )
    json = F.to_json(F.struct(F.array(name, kind).alias("k"), brand.alias("m")))
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        parsing.dict_to_text(top).alias("top"),
        F.array_join(parsing.flatten_dicts(nested), "|").alias("nested"),
        parsing.json_dict_text(json).alias("json_text"),
    )


@query(
    "p7_dedupe_list",
    with_shapes(
        "item_lists",
        """
        SELECT job_id, string_agg(v, ';' ORDER BY i) AS majors FROM (
          SELECT job_id, v, min(i) AS i FROM (
            SELECT job_id, unnest(string_split(majors, ';')) AS v, generate_subscripts(string_split(majors, ';'), 1) AS i
            FROM item_lists)
          GROUP BY job_id, v)
        GROUP BY job_id""",
    ),
)
def p7(spark, sf_dir):
    lists = shape(spark, sf_dir, "item_lists")
    return lists.select(
        "job_id", F.array_join(parsing.dedupe_list(F.split("majors", ";")), ";").alias("majors")
    )


# The second half: an object at the top, a list given as text, plain and nested unknown keys.
@query(
    "p8_merge_parsed",
    with_shapes(
        "raw parsed",
        """
        SELECT _id, json_extract_string(body, '$.job_title') AS job_title, company_name,
               CAST(NULL AS VARCHAR) AS location, posted_date, url, '2001-08-01' AS update_date,
               json_extract_string(body, '$.salary') AS salary, 'a|b: c; d. e: f' AS tech_stack,
               CAST(NULL AS VARCHAR) AS major, CAST(NULL AS VARCHAR) AS benefits, CAST(NULL AS BIGINT) AS days
        FROM raw JOIN parsed USING (_id) WHERE body IS NOT NULL
        UNION ALL
        SELECT _id, job_title, company_name, location, posted_date, url, '2001-08-01',
               concat('min: ', quality, '. max: ', doc_id, '; x'), concat('Scala ', doc_id), 'a|b',
               concat('tea ', toxic), CAST(quality AS BIGINT)
        FROM raw JOIN labels ON CAST(doc_id AS VARCHAR) = _id""",
    ),
)
def p8(spark, sf_dir):
    raw = shape(spark, sf_dir, "raw")
    second = table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("_id"),
        F.to_json(
            F.struct(
                F.struct(
                    F.col("quality").cast("string").alias("min"),
                    F.array(F.col("doc_id").cast("string"), F.lit("x")).alias("max"),
                ).alias("salary"),
                F.concat(F.lit("Scala "), "doc_id").alias("tech_stack"),
                F.lit('["a", "b"]').alias("major"),
                F.concat(F.lit("tea "), "toxic").alias("benefits"),
                F.struct(F.col("quality").alias("days")).alias("remote"),
            )
        ).alias("body"),
    )

    def merged(parsed):
        out = e.merge_parsed(raw, parsed, "2001-08-01")
        return out.select(
            *[c for c in out.columns if c not in e.LIST_FIELDS and c not in ("job_position", "rest")],
            F.array_join("tech_stack", "|").alias("tech_stack"),
            F.array_join("major", "|").alias("major"),
            F.try_variant_get("rest", "$.benefits", "string").alias("benefits"),
            F.try_variant_get("rest", "$.remote.days", "bigint").alias("days"),
        )

    return merged(shape(spark, sf_dir, "parsed")).unionByName(merged(second))


@query(
    "p9_parse_progress",
    """
    SELECT (SELECT count(*) FROM documents) AS raw, (SELECT count(*) FROM labels) AS parsed,
           (SELECT count(*) FROM documents ANTI JOIN labels USING (doc_id)) AS remaining,
           CAST(ceil((SELECT count(*) FROM documents ANTI JOIN labels USING (doc_id)) / 5) AS BIGINT) AS batches
    """,
)
def p9(spark, sf_dir):
    return e.parse_progress(shape(spark, sf_dir, "raw"), shape(spark, sf_dir, "parsed"), 5)


# Terms: the comma- or stop-separated phrases of the benchmark texts, by their number of words.
PHRASES = f"""
  phrases AS (
    SELECT item_id, trim(unnest(string_split_regex(text, '[.,\\n]+'))) AS value FROM benchmark),
  counted AS (
    SELECT item_id, value, list_filter(string_split_regex({FOLD.format('value')}, '[^\\p{{L}}\\p{{N}}_+#]+'),
           lambda w: length(w) > 0) AS w FROM phrases),
  terms AS (
    SELECT coalesce(['one', 'two', 'three'][len(w)], 'more') AS category, array_to_string(w, ' ') AS term,
           max(value) AS value
    FROM counted WHERE len(w) >= 1 GROUP BY ALL)
"""
DOC_WORDS = (
    "concat(' ', array_to_string(list_filter(string_split_regex("
    + FOLD.format("text")
    + ", '[^\\p{L}\\p{N}_+#]+'), lambda w: length(w) > 0), ' '), ' ')"
)


def term_vocab(spark, sf_dir):
    phrases = table(spark, sf_dir, "benchmark").select(
        F.explode(F.split("text", r"[.,\n]+")).alias("value")
    )
    size = F.size(e.words("value"))
    names = F.array(F.lit("one"), F.lit("two"), F.lit("three"))
    entries = phrases.select(F.trim("value").alias("value")).filter(size >= 1).distinct()
    # The order is only read to pick one spelling of a term.
    return entries.select(F.coalesce(F.get(names, size - 1), F.lit("more")).alias("category"), "value")


@query(
    "p10_extract_entities",
    f"""
    WITH {PHRASES}, words AS (SELECT doc_id, {DOC_WORDS} AS words FROM documents)
    SELECT doc_id, category, string_agg(value, '|' ORDER BY value) AS terms FROM (
      SELECT DISTINCT doc_id, category, value FROM words JOIN terms ON contains(words, concat(' ', term, ' ')))
    GROUP BY doc_id, category
    """,
)
def p10(spark, sf_dir):
    vocab = term_vocab(spark, sf_dir).withColumn("ord", F.col("value"))
    found = e.extract_entities(table(spark, sf_dir, "documents"), vocab, "doc_id", "text")
    return found.select("doc_id", "category", F.array_join("terms", "|").alias("terms"))


_LEVELS = ["Of the", "De la", "Und", "The", "Que la"]


@query(
    "p11_extract_levels",
    f"""
    SELECT doc_id, CASE WHEN found = '' THEN 'Else' ELSE found END AS levels FROM (
      SELECT doc_id, array_to_string(list_filter({_LEVELS},
               lambda l: contains(words, concat(' ', lower(l), ' '))), '|') AS found
      FROM (SELECT doc_id, {DOC_WORDS} AS words FROM documents))
    """,
)
def p11(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(e.extract_levels("text", _LEVELS), "|").alias("levels")
    )
