"""N-2..N-12, N-15, N-16: field values onto the vocabulary, by distinct value.

Every distinct raw value is resolved once (exact, cleaned key, fuzzy, else new). The resolved
mapping is saved, so its size is known: while it is small, values are looked up in the posting rows; beyond,
the items meet it in a shuffle join, where adaptive execution splits hot values, and go back to
rows that do not move.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skilltide.functions.fuzzy import best_in_chunk
from skilltide.functions.text import clean_key, parse_list, strip
from skilltide.operators.vocab import key_table
from skilltide.session import BROADCAST_ROWS, is_small, saved, scratch_dir

THRESHOLD = 50
CHUNK = 8_000  # vocabulary keys one comparison row carries
KEYS = 100  # new keys about that a comparison row carries
IN_ROW_BYTES = 8 << 20
BUCKETS = 4_096

SCALAR_FIELDS = ("location", "job_position")
LIST_FIELDS = ("major", "soft_skills", "tech_stack")


def match_exact(values: DataFrame, vocab: DataFrame, small: bool | None = None) -> DataFrame:
    """N-2: adds ``exact``, the value itself when the vocabulary has it.

    ``small`` says whether the vocabulary may be broadcast; by default it is counted.
    """
    known = vocab.select("category", F.col("value").alias("raw"), F.col("value").alias("exact"))
    return values.join(_hinted(known.distinct(), vocab, small), ["category", "raw"], "left")


def match_key(values: DataFrame, vocab: DataFrame, small: bool | None = None) -> DataFrame:
    """N-3: adds ``by_key``, the last vocabulary value with the same cleaned key."""
    keys = key_table(vocab).select("category", "key", F.col("target").alias("by_key"))
    return values.join(_hinted(keys, vocab, small), ["category", "key"], "left")


def _hinted(side: DataFrame, vocab: DataFrame, small: bool | None) -> DataFrame:
    return F.broadcast(side) if (is_small(vocab) if small is None else small) else side


def match_fuzzy(
    values: DataFrame, vocab: DataFrame, threshold: int = THRESHOLD, small: bool | None = None
) -> DataFrame:
    """N-4: (category, key, fuzzy, score) for the distinct keys that reach the threshold.

    A row holds a group of keys and a chunk of the vocabulary, so a chunk is sent once per group and
    no pairs are emitted. In it an inverted index and letter counts bound the scores of a key's candidates,
    a few vector operations for all of them; those are compared from the highest bound on, many at once,
    until none can reach the best.
    """
    place = F.struct("first_ord", "key", "target")
    chunks = (
        key_table(vocab)
        .groupBy("category", F.floor(F.col("first_ord") / CHUNK).alias("chunk"))
        .agg(F.sort_array(F.collect_list(place)).alias("entries"))
    )
    keys = saved(
        values.select("category", "key").filter(F.col("key") != "").distinct(), "open-keys"
    )
    groups = max(1, -(-keys.count() // KEYS))
    grouped = keys.groupBy("category", F.pmod(F.xxhash64("key"), F.lit(groups)).alias("group")).agg(
        F.collect_list("key").alias("keys")
    )
    # a row is much work but few bytes: dealt by number, or adaptive execution gathers rows in one task
    spark = values.sparkSession
    tasks = max(
        int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism
    )
    if is_small(vocab) if small is None else small:
        pairs = grouped.repartitionById(tasks, F.col("group").cast("int")).join(F.broadcast(chunks), "category")
    else:
        pairs = grouped.join(chunks, "category")
        pairs = pairs.repartitionById(tasks, F.pmod(F.xxhash64("category", "group", "chunk"), F.lit(tasks)).cast("int"))
    best = best_in_chunk(threshold)(pairs["keys"], F.transform(pairs["entries"], lambda e: e["key"]))
    # candidates are looked up before the explode, whose rows would each carry the chunk
    scored = (
        pairs.withColumn("best", best)
        .select("category", F.transform(F.arrays_zip("keys", "best"), lambda x: F.struct(
            x["keys"].alias("key"), x["best"]["score"].alias("score"), F.get("entries", x["best"]["idx"]).alias("entry")
        )).alias("found"))
        .select("category", F.inline(F.filter("found", lambda x: x["score"] >= threshold)))
        .select("category", "key", "score", "entry.first_ord", "entry.target")
    )
    order = F.struct(F.col("score"), -F.col("first_ord"))
    return scored.groupBy("category", "key").agg(
        F.max_by("target", order).alias("fuzzy"), F.max("score").alias("score")
    )


def resolve_values(
    values: DataFrame, vocab: DataFrame, threshold: int | None = THRESHOLD
) -> DataFrame:
    """N-5: (category, raw, value, is_new) for each distinct non-blank value of (category, raw).

    ``threshold=None`` leaves the fuzzy tier out.
    """
    raw = strip("raw")
    distinct = values.select("category", raw.alias("raw")).filter(F.col("raw") != "").distinct()
    small = is_small(vocab)
    keyed = distinct.withColumn("key", clean_key("raw"))
    tiers = match_key(match_exact(keyed, vocab, small), vocab, small)
    candidates = [F.col("exact"), F.col("by_key")]
    if threshold is not None:
        tiers = saved(tiers, "tiers")
        open_values = tiers.filter(F.coalesce(*candidates).isNull())
        fuzzy = match_fuzzy(open_values, vocab, threshold, small).drop("score")
        matched = tiers.filter(F.coalesce(*candidates).isNotNull()).withColumn(
            "fuzzy", F.lit(None).cast("string")
        )
        tiers = matched.unionByName(open_values.join(fuzzy, ["category", "key"], "left"))
        candidates.append(F.col("fuzzy"))
    found = F.coalesce(*candidates)
    return tiers.select(
        "category", "raw", F.coalesce(found, "raw").alias("value"), found.isNull().alias("is_new")
    )


def _as_list(df: DataFrame, column: str) -> Column:
    """A list column; one that holds lists as text is read by X-12."""
    is_text = isinstance(df.schema[column].dataType, T.StringType)
    return parse_list(column) if is_text else F.col(column)


def _fields(df: DataFrame, scalars: tuple[str, ...], lists: tuple[str, ...]) -> Column:
    """An array of (field, items), for all fields."""
    columns = [(f, F.array(F.col(f))) for f in scalars] + [(f, _as_list(df, f)) for f in lists]
    return F.array(*[F.struct(F.lit(f).alias("field"), c.alias("items")) for f, c in columns])


def _items(df: DataFrame, scalars: tuple[str, ...], lists: tuple[str, ...], key: str) -> DataFrame:
    """(key, field, pos, raw) of all fields, trimmed, blanks dropped."""
    return (
        df.select(key, F.inline(_fields(df, scalars, lists)))
        .select(key, "field", F.posexplode("items").alias("pos", "raw"))
        .withColumn("raw", strip("raw"))
        .filter(F.col("raw") != "")
    )


def field_mapping(
    df: DataFrame,
    vocab: DataFrame,
    scalars: tuple[str, ...] = SCALAR_FIELDS,
    lists: tuple[str, ...] = LIST_FIELDS,
    threshold: int | None = THRESHOLD,
    key: str = "_id",
) -> DataFrame:
    """The saved mapping of every distinct value of the named columns. Values are made distinct as they stand, so that
    an item costs a look in a hash table and only what differs is trimmed."""
    values = df.select(F.inline(_fields(df, scalars, lists))).select(F.col("field").alias("category"), F.explode("items").alias("raw"))
    values = values.distinct()
    wanted = vocab.filter(F.col("category").isin(*scalars, *lists))
    return saved(resolve_values(values, wanted, threshold), "mapping")


def apply_mapping(
    df: DataFrame,
    mapping: DataFrame,
    scalars: tuple[str, ...] = SCALAR_FIELDS,
    lists: tuple[str, ...] = LIST_FIELDS,
    key: str = "_id",
    in_row: bool | None = None,
) -> DataFrame:
    """Add ``normalized_<field>`` columns. A null list stays null, order and repeats stay.

    While the mapping is small, values are looked up in the row and nothing is shuffled. Beyond,
    items of all fields are exploded together, looked up in a join and regrouped by row once.
    ``in_row`` says which; by default the mapping is measured.
    """
    if moves_no_row(mapping) if in_row is None else in_row:
        return _apply_in_row(df, mapping, scalars, lists)
    return _apply_by_items(df, mapping, scalars, lists)


def _apply_by_items(
    df: DataFrame, mapping: DataFrame, scalars: tuple[str, ...], lists: tuple[str, ...]
) -> DataFrame:
    """Only the items of the fields move: to the mapping by their value, and back to their rows, which were saved in
    buckets of the row number and stay where they are. The hash tables of that join are built of the items."""
    row = "_row"
    rows = _in_buckets(df.withColumn(row, F.monotonically_increasing_id()), row)
    lookup = mapping.select(F.col("category").alias("field"), "raw", "value")
    items = _items(rows, scalars, lists, row).join(lookup, ["field", "raw"])

    def of_field(name: str, value: Column) -> Column:
        return F.when(F.col("field") == name, value)

    found = items.groupBy(row).agg(
        *[F.first(of_field(f, F.col("value")), ignorenulls=True).alias(f"_{f}") for f in scalars],
        *[F.sort_array(F.collect_list(of_field(f, F.struct("pos", "value")))).alias(f"_{f}") for f in lists],
    )
    out = rows.join(found.hint("shuffle_hash"), row, "left")
    empty = F.array().cast("array<string>")
    names = {f"normalized_{f}": F.col(f"_{f}") for f in scalars}
    for f in lists:
        kept = F.transform(F.col(f"_{f}"), lambda p: p["value"])
        names[f"normalized_{f}"] = F.when(F.col(f).isNotNull(), F.coalesce(kept, empty))
    return out.withColumns(names).drop(row, *[f"_{f}" for f in (*scalars, *lists)])


def _in_buckets(df: DataFrame, key: str) -> DataFrame:
    """``df`` written in buckets of a key, without a shuffle. The catalog knows the table while it is read
    for the first time only; its files stay in the shared folder."""
    spark = df.sparkSession
    path = scratch_dir(spark, "buckets")
    name = f"buckets_{path.rsplit('-', 1)[1]}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(buckets, key).option("path", path).saveAsTable(name)
    table = spark.table(name)
    table.schema  # noqa: B018  resolved here, so that the name may go
    spark.sql(f"DROP TABLE {name}")
    return table


def moves_no_row(mapping: DataFrame) -> bool:
    """Whether ``apply_mapping`` looks values up in the rows, which then stay where they are."""
    return _fits_a_task(mapping)


def _fits_a_task(mapping: DataFrame) -> bool:
    """Whether a saved mapping may be shipped with the plan: by its rows and its bytes."""
    size = F.sum(F.octet_length("category") + F.octet_length("raw") + F.octet_length("value"))
    rows, chars = mapping.agg(F.count("*"), F.coalesce(size, F.lit(0))).first()
    return rows <= BROADCAST_ROWS and chars <= IN_ROW_BYTES


def _apply_in_row(
    df: DataFrame, mapping: DataFrame, scalars: tuple[str, ...], lists: tuple[str, ...]
) -> DataFrame:
    """The mapping as a scalar subquery: small maps by the hash of their keys, so that a look-up
    reads one of them."""
    entry = F.struct(F.concat_ws("\x00", "category", "raw").alias("key"), "value")
    keyed = mapping.select(entry.alias("e")).withColumn("at", _bucket(F.col("e.key")))
    buckets = keyed.groupBy("at").agg(F.collect_list("e").alias("m"))
    every = df.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("at"))
    found = every.join(buckets, "at", "left").agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("at", "m"))), lambda b: F.map_from_entries(b["m"])
        ).alias("a")
    )
    names = (*scalars, *lists)

    def looked_up(lookup: Column) -> Column:
        def value_of(key: Column) -> Column:
            return F.element_at(F.get(lookup, _bucket(key)), key)

        def keys_of(field: str) -> Column:
            trimmed = F.filter(F.transform(_as_list(df, field), strip), lambda v: v != "")
            return F.transform(trimmed, lambda v: F.concat(F.lit(f"{field}\x00"), v))

        single = [value_of(F.concat(F.lit(f"{f}\x00"), strip(f))).alias(f) for f in scalars]
        return F.struct(*single, *[F.transform(keys_of(f), value_of).alias(f) for f in lists])

    # A subquery may not stand inside a lambda, and a column with it would be copied into every row. It is read once, as
    # the one item of an array that a lambda goes over: so Catalyst puts it where it is read and rows do not carry it.
    lookup = F.transform(F.array("_lookup"), looked_up)
    out = df.withColumn("_lookup", found.scalar()).withColumn("_found", F.get(lookup, F.lit(0))).drop("_lookup")
    return out.withColumns({f"normalized_{f}": F.col(f"_found.{f}") for f in names}).drop("_found")


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def normalize_scalar(
    df: DataFrame,
    column: str,
    vocab: DataFrame,
    threshold: int | None = THRESHOLD,
    key: str = "_id",
) -> DataFrame:
    """N-6: the column's category has the column's name."""
    mapping = field_mapping(df, vocab, (column,), (), threshold, key)
    return apply_mapping(df, mapping, (column,), (), key)


def normalize_list(
    df: DataFrame,
    column: str,
    vocab: DataFrame,
    threshold: int | None = THRESHOLD,
    key: str = "_id",
) -> DataFrame:
    """N-7"""
    mapping = field_mapping(df, vocab, (), (column,), threshold, key)
    return apply_mapping(df, mapping, (), (column,), key)


def silver_location(
    df: DataFrame, vocab: DataFrame, threshold: int | None = THRESHOLD
) -> DataFrame:
    """N-8"""
    return normalize_scalar(df, "location", vocab, threshold).drop("location")


def silver_major(df: DataFrame, vocab: DataFrame, threshold: int | None = THRESHOLD) -> DataFrame:
    """N-9"""
    return normalize_list(df, "major", vocab, threshold).drop("major")


def silver_soft_skills(
    df: DataFrame, vocab: DataFrame, threshold: int | None = THRESHOLD
) -> DataFrame:
    """N-10"""
    return normalize_list(df, "soft_skills", vocab, threshold).drop("soft_skills")


def silver_tech_stack(
    df: DataFrame, vocab: DataFrame, threshold: int | None = THRESHOLD
) -> DataFrame:
    """N-11"""
    return normalize_list(df, "tech_stack", vocab, threshold).drop("tech_stack")


def silver_job_position(
    df: DataFrame, vocab: DataFrame, threshold: int | None = THRESHOLD
) -> DataFrame:
    """N-12"""
    return normalize_scalar(df, "job_position", vocab, threshold).drop("job_position")


def silver_combine(bronze: DataFrame, *normalized: DataFrame, key: str = "_id") -> DataFrame:
    """N-15: bronze rows with the ``normalized_*`` columns of each frame, by left joins.

    All joins share the key, so each side is shuffled once.
    """
    sides = [
        df.select(key, *[c for c in df.columns if c.startswith("normalized_")])
        for df in normalized
    ]
    return reduce(lambda left, right: left.join(right, key, "left"), sides, bronze)


def promote_normalized(df: DataFrame) -> DataFrame:
    """N-16: ``normalized_x`` replaces ``x``."""
    prefix = "normalized_"
    names = [c.removeprefix(prefix) for c in df.columns if c.startswith(prefix)]
    return df.drop(*names).withColumnsRenamed({prefix + n: n for n in names})


def silver_postings(df: DataFrame, mapping: DataFrame, in_row: bool | None = None) -> DataFrame:
    """All five fields in one pass, no combining joins between them."""
    return promote_normalized(apply_mapping(df, mapping, in_row=in_row))
