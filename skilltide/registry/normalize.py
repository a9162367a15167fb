"""N-1..N-16 over line items as raw list items and part names as the vocabulary."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from skilltide.operators import normalize as n
from skilltide.operators import vocab as v
from skilltide.registry import shapes
from skilltide.registry.core import query, shape, with_shapes
from skilltide.registry.fuzzy import BEST_TERMS, recursive
from skilltide.session import scratch_dir

KEY = r"trim(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}_\s]', '', 'g'))"

# The tiers for each distinct raw value of ``vals (category, raw)``.
_KEYS = f"""
  vocab_keys AS (
    SELECT category, {KEY.format('value')} AS key, arg_max(value, ord) AS target, min(ord) AS first_ord
    FROM vocab GROUP BY 1, 2),
  keyed AS (
    SELECT DISTINCT category, trim(raw) AS raw, {KEY.format('trim(raw)')} AS key
    FROM vals WHERE trim(raw) <> '')
"""
_TIERS = """
  mapping AS (
    SELECT d.category, d.raw, e.value AS exact, k.target AS by_key,
           coalesce(e.value, k.target, f.fuzzy, d.raw) AS value,
           coalesce(e.value, k.target, f.fuzzy) IS NULL AS is_new
    FROM keyed d
    LEFT JOIN (SELECT DISTINCT category, value FROM vocab) e ON e.category = d.category AND e.value = d.raw
    LEFT JOIN vocab_keys k ON k.category = d.category AND k.key = d.key
    LEFT JOIN fuzzy f ON f.category = d.category AND f.key = d.key)
"""
_NO_FUZZY = "fuzzy AS (SELECT category, key, NULL AS fuzzy FROM keyed WHERE false)"
MAPPING = f"{_KEYS.strip()}, {_NO_FUZZY}, {_TIERS.strip()}"
FUZZY_MAPPING = f"{_KEYS.strip()}, {BEST_TERMS.strip()}, {_TIERS.strip()}"
_ITEM_VALS = "vals AS (SELECT category, raw FROM items)"

# The five fields of the postings as (posting, field, position, raw) and back as texts.
_FIELDS = """
  listed AS (
    SELECT _id, 'tech_stack' AS category, string_split(tech, ';') AS l FROM posting_rows WHERE tech <> ''
    UNION ALL SELECT _id, 'soft_skills', string_split(soft, ';') FROM posting_rows WHERE soft <> ''
    UNION ALL SELECT _id, 'major', string_split(majors, ';') FROM posting_rows WHERE majors <> ''
    UNION ALL SELECT _id, 'location', [location] FROM posting_rows WHERE location IS NOT NULL
    UNION ALL SELECT _id, 'job_position', [job_position] FROM posting_rows WHERE job_position IS NOT NULL),
  field_items AS (
    SELECT _id, category, unnest(l) AS raw, generate_subscripts(l, 1) AS pos FROM listed),
  vals AS (SELECT category, raw FROM field_items),
  MAPPING_TIERS,
  fields AS (
    SELECT i._id, i.category, string_agg(m.value, ';' ORDER BY i.pos) AS value
    FROM field_items i JOIN mapping m ON m.category = i.category AND m.raw = trim(i.raw)
    GROUP BY i._id, i.category)
"""
FIELDS = _FIELDS.replace("MAPPING_TIERS", MAPPING)
FUZZY_FIELDS = _FIELDS.replace("MAPPING_TIERS", FUZZY_MAPPING)


def _field_sql(category: str, given: str, empty: str, fields: str = FIELDS) -> str:
    """``given`` is the raw column; a list that is not null is at least empty."""
    return with_shapes(
        "posting_rows vocab",
        f"""WITH {fields.strip()}
        SELECT p._id, CASE WHEN p.{given} IS NOT NULL THEN coalesce(f.value, {empty}) END AS value
        FROM posting_rows p LEFT JOIN fields f ON f._id = p._id AND f.category = '{category}'""",
    )


def _raw_items(spark, sf_dir):
    """Distinct trimmed item values with their key."""
    items = shape(spark, sf_dir, "items")
    raw = n.strip("raw")
    return items.select("category", raw.alias("raw"), n.clean_key(raw).alias("key")).distinct()


def _text(column):
    return F.array_join(column, ";").alias("value")


@query(
    "n1_load_vocab",
    with_shapes(
        "vocab",
        f"""SELECT category, value, row_number() OVER (PARTITION BY category ORDER BY ord, value) - 1 AS ord,
                   {KEY.format('value')} AS key FROM vocab""",
    ),
)
def n1(spark, sf_dir):
    path = scratch_dir(spark, "vocab")
    entries = F.sort_array(F.collect_list(F.struct("ord", "value")))
    lists = shape(spark, sf_dir, "vocab").groupBy("category").agg(entries.alias("e"))
    whole = F.map_from_entries(
        F.collect_list(F.struct("category", F.transform("e", lambda x: x["value"])))
    )
    lists.agg(F.to_json(whole).alias("value")).coalesce(1).write.text(path)
    return v.load_vocab(spark, path)


@query(
    "n2_match_exact",
    with_shapes("items vocab", f"WITH {_ITEM_VALS}, {MAPPING.strip()} SELECT category, raw, exact FROM mapping"),
)
def n2(spark, sf_dir):
    matched = n.match_exact(_raw_items(spark, sf_dir), shapes.vocab(spark, sf_dir))
    return matched.select("category", "raw", "exact")


@query(
    "n3_match_key",
    with_shapes("items vocab", f"WITH {_ITEM_VALS}, {MAPPING.strip()} SELECT category, raw, by_key FROM mapping"),
)
def n3(spark, sf_dir):
    matched = n.match_key(_raw_items(spark, sf_dir), shapes.vocab(spark, sf_dir))
    return matched.select("category", "raw", "by_key")


@query(
    "n4_match_fuzzy",
    recursive(
        with_shapes(
            "items vocab",
            f"WITH {_ITEM_VALS}, {FUZZY_MAPPING} SELECT category, key, fuzzy, score FROM fuzzy",
        )
    ),
)
def n4(spark, sf_dir):
    return n.match_fuzzy(_raw_items(spark, sf_dir), shapes.vocab(spark, sf_dir))


@query(
    "n5_normalize_values",
    with_shapes(
        "items vocab",
        f"WITH {_ITEM_VALS}, {MAPPING.strip()} SELECT category, raw, value, CAST(is_new AS INT) AS is_new FROM mapping",
    ),
)
def n5(spark, sf_dir):
    values = shape(spark, sf_dir, "items").select("category", "raw")
    resolved = n.resolve_values(values, shapes.vocab(spark, sf_dir), None)
    return resolved.withColumn("is_new", F.col("is_new").cast("int"))


@query(
    "n5_normalize_values_fuzzy",
    recursive(
        with_shapes(
            "posting_rows vocab",
            f"""WITH {FUZZY_FIELDS.strip()}
            SELECT category, raw, value, CAST(is_new AS INT) AS is_new FROM mapping""",
        )
    ),
)
def n5_fuzzy(spark, sf_dir):
    mapping = n.field_mapping(shapes.postings(spark, sf_dir), shapes.vocab(spark, sf_dir))
    return mapping.withColumn("is_new", F.col("is_new").cast("int"))


@query("n6_normalize_scalar", _field_sql("location", "location", "NULL"))
def n6(spark, sf_dir):
    done = n.normalize_scalar(shapes.saved_postings(spark, sf_dir, "_id", "location"), "location", shapes.vocab(spark, sf_dir), None)
    return done.select("_id", F.col("normalized_location").alias("value"))


@query("n7_normalize_list", _field_sql("tech_stack", "tech", "''"))
def n7(spark, sf_dir):
    done = n.normalize_list(shapes.saved_postings(spark, sf_dir, "_id", "tech_stack"), "tech_stack", shapes.vocab(spark, sf_dir), None)
    return done.select("_id", _text("normalized_tech_stack"))


@query("n8_silver_location", _field_sql("location", "location", "NULL"))
def n8(spark, sf_dir):
    done = n.silver_location(shapes.saved_postings(spark, sf_dir, "_id", "location"), shapes.vocab(spark, sf_dir), None)
    return done.select("_id", F.col("normalized_location").alias("value"))


@query("n9_silver_major", _field_sql("major", "majors", "''"))
def n9(spark, sf_dir):
    done = n.silver_major(shapes.saved_postings(spark, sf_dir, "_id", "major"), shapes.vocab(spark, sf_dir), None)
    return done.select("_id", _text("normalized_major"))


@query("n10_silver_soft_skills", _field_sql("soft_skills", "soft", "''"))
def n10(spark, sf_dir):
    done = n.silver_soft_skills(shapes.saved_postings(spark, sf_dir, "_id", "soft_skills"), shapes.vocab(spark, sf_dir), None)
    return done.select("_id", _text("normalized_soft_skills"))


@query("n11_silver_tech_stack", _field_sql("tech_stack", "tech", "''"))
def n11(spark, sf_dir):
    done = n.silver_tech_stack(shapes.saved_postings(spark, sf_dir, "_id", "tech_stack"), shapes.vocab(spark, sf_dir), None)
    return done.select("_id", _text("normalized_tech_stack"))


@query(
    "n11_silver_tech_stack_fuzzy",
    recursive(_field_sql("tech_stack", "tech", "''", FUZZY_FIELDS)),
)
def n11_fuzzy(spark, sf_dir):
    done = n.silver_tech_stack(shapes.saved_postings(spark, sf_dir, "_id", "tech_stack"), shapes.vocab(spark, sf_dir))
    return done.select("_id", _text("normalized_tech_stack"))


@query("n12_silver_job_position", _field_sql("job_position", "job_position", "NULL"))
def n12(spark, sf_dir):
    done = n.silver_job_position(shapes.saved_postings(spark, sf_dir, "_id", "job_position"), shapes.vocab(spark, sf_dir), None)
    return done.select("_id", F.col("normalized_job_position").alias("value"))


_EVOLVED = f"""
  added AS (SELECT DISTINCT category, value FROM mapping WHERE is_new AND category <> 'location'
            AND category <> 'major'),
  evolved AS (
    SELECT category, value FROM vocab UNION SELECT category, value FROM added)
"""


@query(
    "n13_evolve_vocab",
    with_shapes(
        "posting_rows vocab",
        f"""WITH {FIELDS.strip()}, {_EVOLVED.strip()},
        ranked AS (
          SELECT category, value, row_number() OVER (PARTITION BY category ORDER BY value) - 1 AS place
          FROM evolved WHERE category IN (SELECT category FROM added)
          UNION ALL
          SELECT category, value, row_number() OVER (PARTITION BY category ORDER BY ord, value) - 1
          FROM vocab WHERE category NOT IN (SELECT category FROM added))
        SELECT category, value, place, {KEY.format('value')} AS key FROM ranked""",
    ),
)
def n13(spark, sf_dir):
    known = shapes.vocab(spark, sf_dir)
    mapping = n.field_mapping(shapes.postings(spark, sf_dir), known, threshold=None)
    evolved = v.evolve_vocab(known, v.new_values(mapping))
    # Only the order counts, so the check reads the rank within the (small) category.
    place = F.row_number().over(Window.partitionBy("category").orderBy("ord")) - 1
    return evolved.select("category", "value", place.cast("bigint").alias("place"), "key")


@query(
    "n14_new_values",
    with_shapes(
        "posting_rows vocab",
        f"WITH {FIELDS.strip()} SELECT DISTINCT category, value FROM mapping WHERE is_new",
    ),
)
def n14(spark, sf_dir):
    mapping = n.field_mapping(shapes.postings(spark, sf_dir), shapes.vocab(spark, sf_dir), threshold=None)
    return v.new_values(mapping)


_SILVER = """
  silver AS (
    SELECT p._id, p.job_title, p.posted_date,
           max(CASE f.category WHEN 'location' THEN f.value END) AS location,
           max(CASE f.category WHEN 'job_position' THEN f.value END) AS job_position,
           CASE WHEN any_value(p.tech) IS NOT NULL
                THEN coalesce(max(CASE f.category WHEN 'tech_stack' THEN f.value END), '') END AS tech_stack,
           CASE WHEN any_value(p.soft) IS NOT NULL
                THEN coalesce(max(CASE f.category WHEN 'soft_skills' THEN f.value END), '') END AS soft_skills,
           CASE WHEN any_value(p.majors) IS NOT NULL
                THEN coalesce(max(CASE f.category WHEN 'major' THEN f.value END), '') END AS major
    FROM posting_rows p LEFT JOIN fields f ON f._id = p._id
    GROUP BY p._id, p.job_title, p.posted_date)
"""
SILVER = f"{FIELDS.strip()}, {_SILVER.strip()}"
FUZZY_SILVER = f"{FUZZY_FIELDS.strip()}, {_SILVER.strip()}"
_SILVER_SQL = with_shapes("posting_rows vocab", f"WITH {SILVER.strip()} SELECT * FROM silver")


def silver_text(df):
    return df.select(
        "_id", "job_title", "posted_date", "location", "job_position",
        *[F.array_join(c, ";").alias(c) for c in n.LIST_FIELDS],
    )


@query("n15_silver_combine", _SILVER_SQL)
def n15(spark, sf_dir):
    bronze, known = shapes.saved_postings(spark, sf_dir), shapes.vocab(spark, sf_dir)
    mapping = n.field_mapping(bronze, known, threshold=None)
    sides = [n.apply_mapping(bronze, mapping, (f,), ()) for f in n.SCALAR_FIELDS]
    sides += [n.apply_mapping(bronze, mapping, (), (f,)) for f in n.LIST_FIELDS]
    return silver_text(n.promote_normalized(n.silver_combine(bronze, *sides)))


@query("n16_promote_normalized", _SILVER_SQL)
def n16(spark, sf_dir):
    bronze = shapes.saved_postings(spark, sf_dir)
    mapping = n.field_mapping(bronze, shapes.vocab(spark, sf_dir), threshold=None)
    return silver_text(n.silver_postings(bronze, mapping))
