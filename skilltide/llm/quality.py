"""Quality rules with thresholds that follow each language and source (operator 6). JVM only.

Signals of a text are computed in its row, by built-in functions over arrays: no word is ever
exploded, so nothing is shuffled and memory follows the longest text.

Thresholds come from a mergeable quantile sketch per (language, source): a histogram over buckets
whose width is a fixed share of their value (as in Masson et al., "DDSketch", 2019; here the
leading bits of the integer, so that buckets are exact). Sketches are merged by adding counts:
partial sums are combined before the shuffle, and the sketch of a language or of everything is the sum
of its parts. A group with fewer than ``MIN_DOCS`` documents uses its language's sketch, a small
language the whole table's. The result does not depend on how rows are laid out.

A document is rejected if it fails the base rule, or if a signal lies beyond the fence of its group:
the median plus ``SPREAD`` times the distance from there to the upper quantile ``HIGH`` (for the
length of words also below, mirrored), at least ``SLACK`` of the signal away. A fence follows
the group, so a source whose texts all have many symbols keeps them; a source with few does not.

Null or empty text: no words, so the base rule rejects it. Null language or source: a group of
its own. Repeated rows and ids: each row is judged, and equal rows alike. Empty table: empty result.
Input columns called like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skilltide.llm._rows import without
from skilltide.session import saved

MIN_WORDS = 50
MIN_DOCS = 100
HIGH = 0.75
SPREAD = 6
BITS = 5  # a bucket is at most 1/32 of its value wide

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
OUTPUT = [*BASE, "n_lines", "base_failed", "kept"]
# signal: (integer per document, least distance of a fence from the median), per thousand
SIGNALS = {
    "chars_per_word": ("1000 * word_chars DIV nullif(n_words, 0)", 2000),
    "symbols_per_word": ("1000 * n_symbols DIV nullif(n_words, 0)", 300),
    "dup_line_share": ("1000 * n_dup_lines DIV nullif(n_lines, 0)", 500),
    "repeat_share": ("1000 * n_repeat_words DIV nullif(n_words, 0)", 300),
}
TWO_SIDED = {"chars_per_word"}

SPACE = "[ \\t-\\r]+"


def text_signals(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The carried columns (all by default) with the signals of each text."""
    keep = carry if carry is not None else without(docs, OUTPUT).columns
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    kept = [F.col(f"`{c}`") for c in keep]
    lines = F.filter(F.split("__text", "\n"), lambda x: x.rlike("[^ \\t-\\r]"))
    # spaces at the ends of a text leave an empty first or last part
    inner = F.expr(
        "slice(__parts, IF(get(__parts, 0) = '', 2, 1), "
        "greatest(0, size(__parts) - IF(get(__parts, 0) = '', 1, 0) - IF(get(__parts, size(__parts) - 1) = '', 1, 0)))"
    )
    row = docs.select(*kept, text.alias("__text")).select(
        *kept, F.split("__text", SPACE).alias("__parts"), lines.alias("__lines"),
        F.length(F.regexp_replace("__text", "[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
    )
    row = row.select(*kept, "n_symbols", "__lines", inner.alias("__words")).select(
        *kept, F.size("__words").cast("long").alias("n_words"),
        F.length(F.array_join("__words", "")).cast("long").alias("word_chars"), "n_symbols",
        F.size("__lines").cast("long").alias("n_lines"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            "sort_array(transform(slice(__words, 1, greatest(0, size(__words) - 2)), (x, i) -> "
            "struct(xxhash64(x, get(__words, i + 1), get(__words, i + 2)) AS h, i AS i)))"
        ).alias("__runs"),
    )
    # windows found twice stand next to each other; their places, in order, cover three words each
    twice = (
        "sort_array(transform(filter(__runs, (x, j) -> x.h <=> get(__runs, j - 1).h OR x.h <=> get(__runs, j + 1).h), x -> x.i))"
    )
    covered = (
        "aggregate(__twice, named_struct('n', 0, 'e', 0), (a, i) -> "
        "named_struct('n', a.n + i + 3 - greatest(i, a.e), 'e', i + 3), a -> a.n)"
    )
    plain = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    row = row.select(*kept, *plain, F.expr(twice).alias("__twice")).select(
        *kept, *plain, F.expr(covered).cast("long").alias("n_repeat_words")
    )
    return row.withColumn(
        "base_failed", F.expr(f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > 50 * n_words")
    )


def middle(value: str) -> str:
    """The middle of a whole number's bucket: all numbers with its leading ``BITS`` + 1 bits."""
    more = f"greatest(length(bin({value})) - {BITS + 1}, 0)"
    return f"shiftleft(shiftright({value}, {more}), {more}) + shiftright(shiftleft(1L, {more}), 1)"


def quantile_sketches(rows: DataFrame, lang: str, source: str) -> DataFrame:
    """Saved (lang, source, signal, value, c): ``c`` values in the bucket whose middle is ``value``."""
    signals = ", ".join(f"struct('{name}' AS signal, CAST({e} AS BIGINT) AS v)" for name, (e, _) in SIGNALS.items())
    seen = rows.filter("NOT base_failed").select(
        F.col(f"`{lang}`").alias("lang"), F.col(f"`{source}`").alias("source"), F.expr(f"explode(array({signals}))").alias("s")
    )
    counted = seen.select("lang", "source", "s.signal", F.expr(middle("s.v")).alias("value"))
    return saved(counted.groupBy("lang", "source", "signal", "value").agg(F.count("*").alias("c")), "sketches")


def merged(sketches: DataFrame, by: list[str]) -> DataFrame:
    """Fences (by..., signal, docs, low, high) of the sketches added up over what is not in ``by``."""
    summed = sketches.groupBy(*by, "signal", "value").agg(F.sum("c").alias("c"))
    # a group has at most a few hundred buckets whatever its size
    each = summed.groupBy(*by, "signal").agg(
        F.array_sort(F.collect_list(F.struct("value", "c"))).alias("b"), F.sum("c").alias("docs")
    )

    def at(q: float) -> str:
        return (
            f"aggregate(b, named_struct('left', CAST(ceil({q} * docs) AS BIGINT), 'v', CAST(NULL AS BIGINT)), (a, x) -> "
            "named_struct('left', a.left - x.c, 'v', coalesce(a.v, CASE WHEN a.left <= x.c THEN x.value END)), a -> a.v)"
        )

    slack = F.create_map(*[F.lit(y) for name, (_, s) in SIGNALS.items() for y in (name, s)])[F.col("signal")].cast("long")
    found = each.select(*by, "signal", "docs", F.expr(at(0.5)).alias("mid"), F.expr(at(HIGH)).alias("up"), F.expr(at(1 - HIGH)).alias("down"))
    return found.select(
        *by, "signal", "docs",
        F.when(F.col("signal").isin(*TWO_SIDED), F.col("mid") - F.greatest(SPREAD * (F.col("mid") - F.col("down")), slack)).alias("low"),
        (F.col("mid") + F.greatest(SPREAD * (F.col("up") - F.col("mid")), slack)).alias("high"),
    )


def _wide(fences: DataFrame, by: list[str]) -> DataFrame:
    """One row per group: docs, and the fences of each signal in an array."""
    return fences.groupBy(*by).agg(
        F.max("docs").alias("docs"),
        *[F.struct(*[F.max(F.when(F.col("signal") == s, F.col(c))).alias(c) for c in ("low", "high")]).alias(s) for s in SIGNALS],
    )


def adaptive_thresholds(rows: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """Saved (lang, source, <signal>: (low, high)): the fences that hold for each group."""
    sketches = quantile_sketches(rows, lang, source)
    names = list(SIGNALS)
    own = _wide(merged(sketches, ["lang", "source"]), ["lang", "source"])
    of_lang = _wide(merged(sketches, ["lang"]), ["lang"]).select(
        F.col("lang").alias("l"), F.col("docs").alias("lang_docs"), *[F.col(s).alias(f"l_{s}") for s in names]
    )
    whole = {r["signal"]: r for r in merged(sketches, []).collect()}  # one row per signal
    kind = "struct<low: bigint, high: bigint>"
    of_all = {
        s: F.struct(F.lit(whole[s]["low"]).cast("long"), F.lit(whole[s]["high"]).cast("long")).cast(kind) if whole else F.lit(None).cast(kind)
        for s in names
    }
    joined = own.join(of_lang, F.col("lang").eqNullSafe(F.col("l")), "left")
    return saved(
        joined.select("lang", "source", *[
            F.when(F.col("docs") >= MIN_DOCS, F.col(s)).when(F.col("lang_docs") >= MIN_DOCS, F.col(f"l_{s}")).otherwise(of_all[s]).alias(s)
            for s in names
        ]),
        "thresholds",
    )


def judged(rows: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``rows`` (saved, with signals) and ``kept``: a plain join with the thresholds of their group."""
    fences = adaptive_thresholds(rows, lang, source)
    f = fences.select(F.col("lang").alias("__l"), F.col("source").alias("__s"), *[F.col(s).alias(f"__{s}") for s in SIGNALS])
    joined = rows.join(f, F.col(f"`{lang}`").eqNullSafe(F.col("__l")) & F.col(f"`{source}`").eqNullSafe(F.col("__s")), "left")
    outside = F.lit(False)
    for name, (e, _) in SIGNALS.items():
        value = F.expr(e)
        beyond = (value > F.col(f"__{name}.high")) | (F.coalesce(value < F.col(f"__{name}.low"), F.lit(False)))
        outside = outside | F.coalesce(beyond, F.lit(False))
    kept = ~F.col("base_failed") & ~F.when(F.col("base_failed"), F.lit(False)).otherwise(outside)
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], kept.alias("kept"))


def quality_rules(
    docs: DataFrame, text_col: str = "text", lang: str = "lang", source: str = "source", carry: list[str] | None = None
) -> DataFrame:
    """The carried columns (all of ``docs`` by default), the signals, ``base_failed`` and ``kept``."""
    columns = carry if carry is not None else without(docs, OUTPUT).columns
    columns = [*columns, *[c for c in (lang, source) if c not in columns]]
    return judged(saved(text_signals(docs, text_col, columns), "signals"), lang, source)
