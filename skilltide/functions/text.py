"""Text expressions. Every function takes and returns a Column and stays native."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from skilltide.functions._cols import ColumnOrName, col_of

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# White space as a regex class that Java and RE2 read alike.
_WS_CLASS = r"\t-\r\x{1c}-\x{20}\x{85}\p{Z}"
NON_WORD = rf"[^\p{{L}}\p{{N}}_{_WS_CLASS}]"
NON_ALNUM = r"[^\p{L}\p{N}]+"

# Letters that accent folding maps although they do not decompose.
FOLD_SINGLE = {"đ": "d", "ø": "o", "ł": "l", "ħ": "h", "ŧ": "t", "ı": "i"}
FOLD_DOUBLE = {"ß": "ss", "æ": "ae", "œ": "oe"}


def _accent_table() -> tuple[str, str]:
    """Lower-case letters whose canonical decomposition is one base letter plus marks."""
    source, target = [], []
    for block in (range(0x00C0, 0x0530), range(0x1E00, 0x2000)):
        for point in block:
            char = chr(point)
            base = "".join(
                c for c in unicodedata.normalize("NFD", char) if not unicodedata.combining(c)
            )
            if len(base) == 1 and base != char and char == char.lower():
                source.append(char)
                target.append(base)
    return "".join(source), "".join(target)


_ACCENTED, _PLAIN = _accent_table()
_MARKS = "".join(chr(p) for p in range(0x0300, 0x0370))


def strip(c: ColumnOrName) -> Column:
    """Trim all white space, not only blanks."""
    return F.btrim(col_of(c), F.lit(WHITESPACE))


def fold(c: ColumnOrName) -> Column:
    """X-8: lower case without accents. Marks left over by decomposed input are deleted,
    because ``translate`` drops the characters that have no counterpart."""
    lower = F.lower(col_of(c))
    source = _ACCENTED + "".join(FOLD_SINGLE) + _MARKS
    target = _PLAIN + "".join(FOLD_SINGLE.values())
    out = F.translate(lower, source, target)
    for char, plain in FOLD_DOUBLE.items():
        out = F.replace(out, F.lit(char), F.lit(plain))
    return F.when(_is_ascii(lower), lower).otherwise(out)


def _is_ascii(c: Column) -> Column:
    """As many bytes as characters: a cheap test that spares plain text the character table."""
    return F.octet_length(c) == F.char_length(c)


def client_fold(c: ColumnOrName) -> Column:
    """X-9: strip decomposable accents, lower, collapse white space, trim."""
    lower = F.lower(col_of(c))
    folded = F.translate(lower, _ACCENTED + _MARKS, _PLAIN)
    plain = F.when(_is_ascii(lower), lower).otherwise(folded)
    return strip(F.regexp_replace(plain, f"[{_WS_CLASS}]+", " "))


def contains_either_way(a: ColumnOrName, b: ColumnOrName) -> Column:
    """X-10: accent-insensitive containment in either direction."""
    left, right = client_fold(a), client_fold(b)
    return F.contains(left, right) | F.contains(right, left)


def clean_key(c: ColumnOrName) -> Column:
    """X-11: lower case, only word characters and white space, trimmed; null becomes ''."""
    return F.coalesce(strip(F.regexp_replace(F.lower(col_of(c)), NON_WORD, "")), F.lit(""))


def tokens(c: ColumnOrName) -> Column:
    """X-13: distinct folded alphanumeric tokens of a title."""
    return F.array_distinct(F.array_remove(F.split(fold(c), NON_ALNUM), ""))


def all_terms_match(doc_tokens: ColumnOrName, query_tokens: ColumnOrName) -> Column:
    """X-14: every query token is a document token; an empty query matches nothing."""
    query = col_of(query_tokens)
    return (F.size(query) > 0) & (F.size(F.array_except(query, col_of(doc_tokens))) == 0)


def space_tokens(c: ColumnOrName) -> Column:
    """X-17: split at single blanks, empty tokens kept."""
    return F.split(col_of(c), " ")


def trigrams(c: ColumnOrName) -> Column:
    """X-15: distinct trigrams of the lower-case words, padded two left and one right."""
    words = F.array_remove(F.split(F.lower(col_of(c)), NON_ALNUM), "")

    def of_word(word: Column) -> Column:
        padded = F.concat(F.lit("  "), word, F.lit(" "))
        return F.transform(
            F.sequence(F.lit(1), F.length(word) + 1), lambda i: F.substring(padded, i, F.lit(3))
        )

    return F.array_distinct(F.flatten(F.transform(words, of_word)))


def trigram_similarity(a: ColumnOrName, b: ColumnOrName) -> Column:
    """X-16: shared trigrams over all trigrams, 0 when there are none."""
    return set_similarity(trigrams(a), trigrams(b))


def set_similarity(a: ColumnOrName, b: ColumnOrName) -> Column:
    union = F.size(F.array_union(col_of(a), col_of(b)))
    shared = F.size(F.array_intersect(col_of(a), col_of(b)))
    return F.when(union > 0, shared.cast("double") / union).otherwise(F.lit(0.0))


def html_to_text(c: ColumnOrName) -> Column:
    """X-5: each tag becomes a line break, runs of breaks collapse, ends are trimmed."""
    lines = F.regexp_replace(col_of(c), "<[^>]+>", "\n")
    return strip(F.regexp_replace(lines, "\n+", "\n"))


def collapse_double_newline(c: ColumnOrName) -> Column:
    """X-6: one pass over pairs of line breaks."""
    return F.replace(col_of(c), F.lit("\n\n"), F.lit("\n"))


def title_before(c: ColumnOrName, marker: str) -> Column:
    """X-7: the text before a marker phrase, trimmed."""
    return strip(F.substring_index(col_of(c), marker, 1))


def percent(n: ColumnOrName, total: ColumnOrName) -> Column:
    """X-19: ``100 * n / total`` with one decimal, half up.

    The tenths are counted in whole numbers, so no double or decimal rounds twice.
    """
    count, whole = col_of(n).cast("bigint"), col_of(total).cast("bigint")
    tenths = F.call_function("div", count * 2000 + whole, whole * 2)
    return (tenths.cast("decimal(20,0)") / F.lit(10)).cast("decimal(20,1)")


def percent_text(p: ColumnOrName) -> Column:
    return F.concat(col_of(p).cast("string"), F.lit("%"))


def parse_list(c: ColumnOrName) -> Column:
    """X-12: a list given as text. ``[...]`` is JSON, other text is one item, malformed is empty."""
    text = col_of(c)
    trimmed = strip(text)
    is_list = F.startswith(trimmed, F.lit("[")) & F.endswith(trimmed, F.lit("]"))
    parsed = F.coalesce(F.from_json(trimmed, "array<string>"), F.array().cast("array<string>"))
    return F.when(text.isNull(), F.lit(None).cast("array<string>")).otherwise(
        F.when(is_list, parsed).otherwise(F.array(text))
    )
