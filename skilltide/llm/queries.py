"""The queries of these operators over the given tables, with SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skilltide.llm import (
    bottomk, hardneg, histsort, hyperlang, layout, licenses, mixing, phrases, prefixcounts, quality, tokencodes, warc, winnow,
)
from skilltide.llm._rows import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return run

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

# --- 1: benchmark decontamination ---------------------------------------------------------------

_OP1_WORDS = f"list_filter(string_split_regex({_LOWER}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"

OP1_SQL = f"""
WITH iw AS (SELECT item_id, {_OP1_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0)
),
dw AS (SELECT doc_id, {_OP1_WORDS} AS w FROM documents),
lens AS (SELECT DISTINCT n FROM win),
runs AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)
),
hit AS (SELECT r.doc_id, r.n, r.i, win.item_id FROM runs r JOIN win ON win.n = r.n AND win.s = r.s),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id
)
SELECT dw.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op1_winnow_decontaminate", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = winnow.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


# --- 6: quality rules ---------------------------------------------------------------------------

_OP6_WORDS = "list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_OP6_SIGNALS = ", ".join(
    f"('{name}', CAST({e.replace(' DIV ', ' // ')} AS BIGINT), {slack}, {str(name in quality.TWO_SIDED).lower()})"
    for name, (e, slack) in quality.SIGNALS.items()
)
_MORE = f"greatest(length(bin(v)) - {quality.BITS + 1}, 0)"


def _op6_fences(by: str, name: str) -> str:
    """Fences of the sketches added up by the given columns."""
    over = f"PARTITION BY {by}signal"
    at = lambda q: f"min(CASE WHEN reached >= ceil({q} * docs) THEN value END)"
    return f"""
{name}_q AS (
  SELECT {by}signal, any_value(docs) AS docs, any_value(slack) AS slack, any_value(two_sided) AS two_sided,
         {at(0.5)} AS mid, {at(quality.HIGH)} AS up, {at(1 - quality.HIGH)} AS down
  FROM (SELECT *, sum(c) OVER ({over}) AS docs, sum(c) OVER ({over} ORDER BY value) AS reached
        FROM (SELECT {by}signal, value, any_value(slack) AS slack, any_value(two_sided) AS two_sided, sum(c) AS c
              FROM sketch GROUP BY {by}signal, value))
  GROUP BY {by}signal
),
{name} AS (
  SELECT {by}signal, docs, mid + greatest({quality.SPREAD} * (up - mid), slack) AS high,
         CASE WHEN two_sided THEN mid - greatest({quality.SPREAD} * (mid - down), slack) END AS low
  FROM {name}_q
)"""


OP6_SQL = f"""
WITH cut AS (
  SELECT doc_id, lang, source, {_OP6_WORDS} AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l,
         CAST(length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#*$%&|<>', '')) AS BIGINT) AS n_symbols
  FROM documents
),
runs AS (SELECT doc_id, i, array_to_string(w[i:i + 2], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM cut WHERE len(w) > 2)),
twice AS (SELECT doc_id, g FROM runs GROUP BY doc_id, g HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n FROM (
    SELECT doc_id, unnest(range(i, i + 3)) AS p FROM runs JOIN twice USING (doc_id, g)) GROUP BY doc_id
),
base AS (
  SELECT c.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, n_symbols, CAST(len(l) AS BIGINT) AS n_lines,
         CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM cut c LEFT JOIN covered USING (doc_id)
),
judged AS (SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
signal AS (
  SELECT j.doc_id, j.lang, j.source, x.* FROM judged j, LATERAL (VALUES {_OP6_SIGNALS}) AS x(signal, v, slack, two_sided)
  WHERE NOT base_failed
),
sketch AS (
  SELECT lang, source, signal, any_value(slack) AS slack, any_value(two_sided) AS two_sided,
         ((v >> CAST({_MORE} AS BIGINT)) << CAST({_MORE} AS BIGINT)) + ((CAST(1 AS BIGINT) << CAST({_MORE} AS BIGINT)) >> 1) AS value, count(*) AS c
  FROM signal GROUP BY lang, source, signal, value
),
{_op6_fences("lang, source, ", "own")},
{_op6_fences("lang, ", "of_lang")},
{_op6_fences("", "of_all")},
outside AS (
  SELECT DISTINCT s.doc_id
  FROM signal s
  JOIN own o ON o.lang IS NOT DISTINCT FROM s.lang AND o.source IS NOT DISTINCT FROM s.source AND o.signal = s.signal
  JOIN of_lang g ON g.lang IS NOT DISTINCT FROM s.lang AND g.signal = s.signal
  JOIN of_all a ON a.signal = s.signal
  WHERE s.v > CASE WHEN o.docs >= {quality.MIN_DOCS} THEN o.high WHEN g.docs >= {quality.MIN_DOCS} THEN g.high ELSE a.high END
     OR s.v < CASE WHEN o.docs >= {quality.MIN_DOCS} THEN o.low WHEN g.docs >= {quality.MIN_DOCS} THEN g.low ELSE a.low END
)
SELECT j.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND o.doc_id IS NULL AS kept
FROM judged j LEFT JOIN outside o USING (doc_id)
"""


@query("op6_adaptive_quality", OP6_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.quality_rules(table(spark, sf_dir, "documents"), carry=["doc_id"])
    return rows.select("doc_id", *quality.BASE, "base_failed", "kept")


# --- 9: near duplicates -------------------------------------------------------------------------

OP9_SQL = f"""
WITH RECURSIVE cut AS (
  SELECT doc_id, list_filter(string_split_regex({_LOWER}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w FROM documents
),
sets AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + least(len(w), 5) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM cut WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
linked AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n HAVING 100 * count(*) >= 85 * (p.n + q.n - count(*))
),
reach(x, y) AS (SELECT x, y FROM linked UNION SELECT r.x, l.y FROM reach r JOIN linked l ON l.x = r.y),
least_id AS (SELECT x, least(x, min(y)) AS component_id FROM reach GROUP BY x)
SELECT c.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, c.doc_id) AS component_id,
       coalesce(component_id, c.doc_id) = c.doc_id AS kept
FROM cut c LEFT JOIN sizes USING (doc_id) LEFT JOIN least_id ON least_id.x = c.doc_id
"""


@query("op9_bottomk_near_dedup", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = bottomk.near_duplicate_labels(table(spark, sf_dir, "documents"))
    return labels.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


# --- 3: sharding --------------------------------------------------------------------------------


@query("op3_histogram_shards")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = histsort.shards(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return placed.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


# --- 7: mixing ----------------------------------------------------------------------------------


@query("op7_soft_mixing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated, domains = mixing.mixture(docs, table(spark, sf_dir, "labels"), carry=["doc_id"])
    best = F.array_position("posterior", F.array_max("posterior")).cast("int")
    return rated.select(
        "doc_id", "n_tokens", F.element_at(F.lit(domains), best).alias("domain"),
        F.round(F.array_max("posterior"), 6).alias("membership"), F.round("rate", 6).alias("rate"), "copies",
    )


# --- 8: WARC ------------------------------------------------------------------------------------

_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_OP8_DIGEST = " || ".join(
    f"substr('{_BASE32}', 1 + ((CAST('0x' || substr(h, {i}, 5) AS BIGINT) >> {shift}) & 31), 1)"
    for i in range(1, 41, 5)
    for shift in (15, 10, 5, 0)
)

OP8_SQL = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS t FROM pages),
d AS (SELECT page_id, CAST(strlen(t) AS BIGINT) AS payload_bytes, sha1(t) AS h, max(page_id) OVER (PARTITION BY t) AS top FROM p)
SELECT page_id, payload_bytes, {_OP8_DIGEST} AS payload_digest,
       CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM d
"""


@query("op8_warc_round_trip", OP8_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.round_trip(spark, table(spark, sf_dir, "pages"))
    return read.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


# --- 2: token files -----------------------------------------------------------------------------


@query("op2_token_codes")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = tokencodes.round_trip(
        spark, table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), end_id=2, with_ids=False
    )
    return read.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.col("crc32").alias("ids_crc32"))


# --- 4: language --------------------------------------------------------------------------------


@query("op4_hyperdimensional_language")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    fold = docs.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False)))
    model = hyperlang.learn(fold.filter("NOT held_out"))
    return hyperlang.predict(fold.select("doc_id", "text", "held_out"), model)


# --- 10: page text ------------------------------------------------------------------------------


@query("op10_layout_text")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = layout.extract_text(table(spark, sf_dir, "pages").select("page_id", "html"))
    return found.select("page_id", "text", F.length("text").cast("long").alias("n_chars"))


# --- 5: licences --------------------------------------------------------------------------------


@query("op5_license_paragraphs")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.license_findings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    families = F.array_sort(F.array_distinct(F.transform("findings", lambda x: x["family"])))
    return found.select(
        "doc_id", "n_paragraphs", F.size(F.array_distinct(F.transform("findings", lambda x: x["paragraph"]))).cast("long").alias("n_license"),
        F.array_join(families, ",").alias("families"), F.round(F.array_max(F.transform("findings", lambda x: x["score"])), 4).alias("score"),
    )


# --- 11: token counts ---------------------------------------------------------------------------


@query("op11_prefix_token_counts")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prefixcounts.prefix_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return counts.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > 4096).alias("over_limit"))


# --- 12: hard negatives -------------------------------------------------------------------------

OP12_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
pairs AS (
  SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
pos AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
),
neg AS (
  SELECT p.anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) AS rank
  FROM pos p JOIN pairs n ON n.anchor_id = p.anchor_id AND label <> anchor_label
  WHERE 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3
"""


@query("op12_coordinate_pruned_negatives", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hardneg.hard_negatives(rows, F.col("vec_id") % 50 == 0)


# --- 13: phrases --------------------------------------------------------------------------------

OP13_SQL = f"""
WITH p AS (
  SELECT lang, unnest(string_split_regex(t, '[.,;:!?\\x0A-\\x0D]')) AS piece
  FROM (SELECT coalesce(lang, 'und') AS lang, {_LOWER} AS t FROM documents)
),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\\x20\\x09]+'), lambda x: x <> '') AS w FROM p),
f AS (
  SELECT lang, phrase, any_value(m) AS words, count(*) AS a
  FROM (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase FROM w, range(1, 4) AS r(m))
  GROUP BY lang, phrase
),
totals AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, words, a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND a >= 10),
cuts AS (
  SELECT c.lang, c.phrase, c.words, c.a, k, x.a AS l, y.a AS r, CAST(1000000 * CAST(c.a AS HUGEINT) * c.a // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, words)) AS k FROM cand) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
parts AS (
  SELECT lang, part, max(a) AS longer FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM cand WHERE words = 3)
  GROUP BY lang, part
),
kept AS (
  SELECT b.* FROM best b LEFT JOIN parts p ON p.lang = b.lang AND p.part = b.phrase
  WHERE p.longer IS NULL OR 100 * p.longer < 50 * b.a
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""


@query("op13_hat_trie_phrases", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"))
