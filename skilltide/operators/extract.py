"""P-1..P-11: from raw postings to structured fields."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skilltide.functions._cols import ColumnOrName, col_of
from skilltide.functions.parsing import dedupe_list, json_dict_text, json_list_items
from skilltide.functions.text import fold
from skilltide.schemas import SENIORITY_LEVELS
from skilltide.session import is_small, saved

# Fixed value: the text that stands for an oversized one.
OVERSIZE_TEXT = "Document too large to process"

METADATA = ("job_title", "company_name", "location", "posted_date", "url")
TEXT_FIELDS = ("salary", "job_position")
LIST_FIELDS = ("seniority_level", "tech_stack", "soft_skills", "major")

# ``+`` and ``#`` belong to a token, so C, C++ and C# stay three terms.
_TOKEN_BREAK = r"[^\p{L}\p{N}_+#]+"

BITS = 24  # of a table of bits, by exponent: 2 MB
TERM_BYTES = 8 << 20  # of a vocabulary that is broadcast

PROMPT_RULES = [
    ("soft_skills", "Soft skills, preferably worded as"),
    ("seniority_level", "Seniority levels, one or more of"),
    ("major", "Majors, one or more of"),
    ("job_position", "Job position in English, preferably worded as"),
    ("tech_stack", "Technical terms by their official names, where they fit"),
]


def unparsed(raw: DataFrame, parsed: DataFrame, limit: int | None = None) -> DataFrame:
    """P-1"""
    todo = raw.join(parsed.select("_id"), "_id", "left_anti")
    return todo if limit is None else todo.limit(limit)


def guard_size(df: DataFrame, max_bytes: int, text: str = "full_text_jd") -> DataFrame:
    """P-2: an oversized text is replaced by a marker and named in ``error``."""
    size = F.octet_length(text)
    too_large = size > max_bytes
    return df.withColumns(
        {
            text: F.when(too_large, F.lit(OVERSIZE_TEXT)).otherwise(F.col(text)),
            "error": F.when(
                too_large,
                F.concat(F.lit(f"{OVERSIZE_TEXT}: "), size.cast("string"), F.lit(" bytes")),
            ),
        }
    )


def model_input(title: ColumnOrName, body: ColumnOrName) -> Column:
    """P-3: title, blank line, body; the body alone without a title."""
    titled = F.concat(col_of(title), F.lit("\n\n"), col_of(body))
    return F.when(F.coalesce(col_of(title), F.lit("")) != "", titled).otherwise(col_of(body))


def render_prompt(
    df: DataFrame,
    vocab: DataFrame,
    output_format: str,
    text: str,
    rules: Sequence[tuple[str, str]] = PROMPT_RULES,
) -> DataFrame:
    """P-4: one prompt per row with the vocabulary lists filled in, whatever their size.

    ``rules`` names the categories in order with what to say before each list. A prompt holds
    the lists whole, so they are one scalar subquery.
    """

    def terms(category: str) -> Column:
        rows = F.sort_array(
            F.collect_list(F.when(F.col("category") == category, F.struct("ord", "value")))
        )
        return F.array_join(F.transform(rows, lambda r: r["value"]), ", ")

    said = [
        F.concat(F.lit(f"- {rule}: "), terms(category), F.lit("\n")) for category, rule in rules
    ]
    guidelines = vocab.agg(F.concat(*said).alias("g")).scalar()
    prompt = F.concat(
        F.lit('"'),
        F.col(text),
        F.lit(f'"\n\n---\n\nFill this JSON format from the posting above:\n{output_format}\n\n'),
        guidelines,
        F.lit("- Answer in English with valid JSON that has every field.\n"),
    )
    return df.withColumn("prompt", prompt)


def merge_parsed(
    raw: DataFrame, parsed: DataFrame, at: dt.date | str, body: str = "body"
) -> DataFrame:
    """P-8: metadata and parsed fields in one row; a key the model gave wins, even as null.

    ``parsed`` holds ``_id`` and the model's JSON object as text; rows without one are dropped.
    An object in a text field becomes text (P-6), a list field given as text a list (X-12). Keys
    that are no column are kept in the variant ``rest``.
    """
    found = parsed.filter(F.col(body).isNotNull()).select("_id", body)
    joined = raw.select("_id", *METADATA).join(found, "_id")
    keys = F.json_object_keys(body)

    def given_text(name: str) -> Column:
        given = F.get_json_object(body, f"$.{name}")
        return F.when(F.startswith(given, F.lit("{")), json_dict_text(given)).otherwise(given)

    def field(name: str) -> Column:
        given = given_text(name)
        return F.when(F.array_contains(keys, name), given).otherwise(
            F.coalesce(F.col(name), F.lit(""))
        )

    return joined.select(
        "_id",
        *[field(name).alias(name) for name in METADATA],
        F.lit(str(at)).alias("update_date"),
        *[given_text(name).alias(name) for name in TEXT_FIELDS],
        *[dedupe_list(json_list_items(body, f"$.{name}")).alias(name) for name in LIST_FIELDS],
        _rest(body, keys).alias("rest"),
    )


def _rest(body: str, keys: Column) -> Column:
    """The keys of the model's object that have no column, as a variant; null without any."""
    known = F.array(*[F.lit(k) for k in ("_id", *METADATA, *TEXT_FIELDS, *LIST_FIELDS)])
    others = F.array_except(keys, known)
    values = F.from_json(body, "map<string,string>")

    def member(k: Column) -> Column:
        value = F.element_at(values, k)
        # a nested value is JSON already, a plain one is quoted as text
        nested = F.startswith(value, F.lit("{")) | F.startswith(value, F.lit("["))
        quoted = F.get_json_object(F.to_json(F.struct(F.array(value).alias("v"))), "$.v")
        inner = F.substring(quoted, F.lit(2), F.length(quoted) - 2)
        name = F.get_json_object(F.to_json(F.struct(F.array(k).alias("v"))), "$.v")
        text = F.when(value.isNull(), F.lit("null")).when(nested & F.try_parse_json(value).isNotNull(), value).otherwise(inner)
        return F.concat(F.substring(name, F.lit(2), F.length(name) - 2), F.lit(":"), text)

    joined = F.concat(F.lit("{"), F.array_join(F.transform(others, member), ","), F.lit("}"))
    return F.when(F.size(others) > 0, F.try_parse_json(joined))


def parse_progress(raw: DataFrame, parsed: DataFrame, batch_size: int) -> DataFrame:
    """P-9: counts of raw, parsed and remaining postings and of the batches they need."""
    sides = raw.select("_id", F.lit(1).alias("r"), F.lit(0).alias("p")).unionByName(
        parsed.select("_id", F.lit(0).alias("r"), F.lit(1).alias("p"))
    )
    per_id = sides.groupBy("_id").agg(F.sum("r").alias("r"), F.sum("p").alias("p"))
    remaining = F.sum(F.when(F.col("p") == 0, F.col("r")).otherwise(F.lit(0)))
    counts = per_id.agg(
        F.coalesce(F.sum("r"), F.lit(0)).alias("raw"),
        F.coalesce(F.sum("p"), F.lit(0)).alias("parsed"),
        F.coalesce(remaining, F.lit(0)).alias("remaining"),
    )
    return counts.withColumn("batches", F.ceil(F.col("remaining") / batch_size))


def words(c: ColumnOrName) -> Column:
    """Folded tokens of a text in order."""
    return F.array_remove(F.split(fold(c), _TOKEN_BREAK), "")


def _prefix(term: str = "term") -> Column:
    """The first two words of a term, or its only one."""
    return F.substring_index(term, " ", 2)


def _prefixes(tokens: str) -> Column:
    """All words of a text, then all pairs of neighbours; a null stands after the last pair."""
    after = F.slice(tokens, F.lit(2), F.size(tokens))
    return F.concat(tokens, F.zip_with(tokens, after, lambda a, b: F.concat(a, F.lit(" "), b)))


def _gram(at: Column, n: Column) -> Column:
    return F.array_join(F.slice("_words", at, n), " ")


def _hits_in_tree(texts: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """(key, category, value) of a broadcast vocabulary, which is a tree of three levels: the first word of terms, the
    first two and the first four. A text goes on to the next level only where it meets one, so a word that
    starts many terms costs little more than another, and long n-grams are built where four words fit.
    Nothing but hits leaves the scan's stage.

    The outer explode keeps Catalyst from filtering texts by the size of their word list first,
    which would split every text twice; the join drops the null word of an empty text.
    """
    first = terms.groupBy(F.substring_index("term", " ", 1).alias("first")).agg(F.collect_set(F.least("n", F.lit(2))).alias("steps"))
    second = terms.select(_prefix().alias("prefix"), F.least("n", F.lit(4)).alias("m")).distinct()
    node = terms.select(F.substring_index("term", " ", 4).alias("node"), "term", "n", "category", "value")
    place, size = F.col("_at") + 1, F.size("_words")
    begun = texts.select(key, "_words", F.posexplode_outer("_words").alias("_at", "first")).join(F.broadcast(first), "first")
    pair = F.concat("first", F.lit(" "), F.get("_words", place))
    met = begun.withColumn("step", F.explode("steps")).withColumn("prefix", F.when(F.col("step") == 1, F.col("first")).otherwise(pair))
    met = met.join(F.broadcast(second), "prefix")
    four = F.when(F.col("m") <= 2, F.col("prefix")).when(F.col("_at") + F.col("m") <= size, _gram(place, F.col("m")))
    found = met.withColumn("node", four).join(F.broadcast(node), "node")
    whole = (F.col("n") <= 4) | ((F.col("_at") + F.col("n") <= size) & (_gram(place, F.col("n")) == F.col("term")))
    return found.filter(whole).select(key, "category", "value")


def _bit_table(values: DataFrame) -> Column:
    """A bit for each hash of the one column, as a scalar array of ``2 ** BITS / 64`` longs: its size is fixed."""
    place = F.pmod(F.xxhash64(F.col(values.columns[0])), F.lit(1 << BITS))
    words = values.select(F.shiftright(place, 6).cast("int").alias("at"), place.bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    set_bits = words.groupBy("at").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("word"))
    every = values.sparkSession.range(1 << (BITS - 6)).select(F.col("id").cast("int").alias("at"))
    whole = every.join(set_bits, "at", "left").select("at", F.coalesce("word", F.lit(0).cast("long")).alias("word"))
    return whole.agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]).alias("bits")).scalar()


def _has_bit(bits: Column, value: Column) -> Column:
    place = F.pmod(F.xxhash64(value), F.lit(1 << BITS))
    word = F.get(bits, F.shiftright(place, 6).cast("int"))
    return value.isNotNull() & (F.getbit(word, place.bitwiseAND(F.lit(63)).cast("int")) == 1)


def _grams_with_bits(texts: DataFrame, terms: DataFrame, key: str) -> DataFrame:
    """(key, term) candidates of any vocabulary: where the bits say that terms begin, the n-grams whose bits say
    that they are terms. A miss leaves the scan's stage only where bits meet by chance."""
    long = sorted(row["n"] for row in terms.filter("n > 2").select("n").distinct().collect())  # a few small numbers
    starts, whole = _bit_table(terms.select(_prefix().alias("prefix")).distinct()), _bit_table(terms.select("term").distinct())
    begun = texts.select(key, "_words", F.posexplode_outer(_prefixes("_words")).alias("_at", "prefix")).filter(_has_bit(starts, F.col("prefix")))
    pair = F.col("_at") >= F.size("_words")
    place = F.col("_at") % F.size("_words") + 1
    lengths = F.when(pair, F.array(F.lit(2), *[F.lit(n) for n in long])).otherwise(F.array(F.lit(1)))
    gram = F.when(F.col("n") <= 2, F.col("prefix")).when(place + F.col("n") - 1 <= F.size("_words"), _gram(place, F.col("n")))
    return (
        begun.withColumn("n", F.explode(lengths)).select(key, gram.alias("term")).filter(_has_bit(whole, F.col("term")))
    )


def _bytes_of(terms: DataFrame) -> int:
    return terms.agg(F.coalesce(F.sum(F.octet_length("term") + F.octet_length("value")), F.lit(0))).first()[0]


def extract_entities(df: DataFrame, vocab: DataFrame, key: str, text: str) -> DataFrame:
    """P-10: the vocabulary terms in each text, per category, on whole-token boundaries.

    A text's words and pairs are looked up among the beginnings of terms, and n-grams are built only there. A
    vocabulary whose size was checked is broadcast; of a larger one bits are, so that hits alone are shuffled in the join.
    """
    terms = (
        vocab.withColumn("_tokens", words("value"))
        .filter(F.size("_tokens") > 0)
        .groupBy("category", F.array_join("_tokens", " ").alias("term"))
        .agg(F.max_by("value", "ord").alias("value"), F.max(F.size("_tokens")).alias("n"))
    )
    texts = df.select(key, words(text).alias("_words"))
    terms = saved(terms, "terms")
    if is_small(vocab) and _bytes_of(terms) <= TERM_BYTES:
        hits = _hits_in_tree(texts, terms, key)
    else:
        hits = _grams_with_bits(texts, terms, key).join(terms.drop("n"), "term")
    return hits.groupBy(key, "category").agg(F.sort_array(F.collect_set("value")).alias("terms"))


def extract_levels(text: ColumnOrName, levels: list[str] | None = None) -> Column:
    """P-11: the levels of the closed list that a text names, else ``Else``. No shuffle."""

    def padded(c: Column) -> Column:
        return F.concat(F.lit(" "), F.array_join(words(c), " "), F.lit(" "))

    # plain expressions over one body, which generated code computes once; in a lambda each level would split the text anew
    body = padded(col_of(text))
    none = F.array().cast("array<string>")
    given = [(level, F.coalesce(F.contains(body, padded(F.lit(level))), F.lit(False))) for level in levels or SENIORITY_LEVELS]
    found = [F.when(named, F.array(F.lit(level))).otherwise(none) for level, named in given]
    missing = reduce(Column.__and__, [~named for _, named in given], F.lit(True))
    return F.concat(*found, F.when(missing, F.array(F.lit("Else"))).otherwise(none))
