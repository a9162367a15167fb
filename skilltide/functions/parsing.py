"""Expressions on the text a model returns for a posting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skilltide.functions._cols import ColumnOrName, col_of
from skilltide.functions.text import parse_list


def extract_json(c: ColumnOrName) -> Column:
    """P-5: first ``{`` to last ``}`` as a variant; malformed or absent is null."""
    return F.try_parse_json(F.nullif(F.regexp_extract(col_of(c), r"(?s)\{.*\}", 0), F.lit("")))


def dict_to_text(c: ColumnOrName) -> Column:
    """P-6: a map of lists as ``key: a; b. key: c``."""
    rendered = F.transform(
        F.map_entries(col_of(c)),
        lambda e: F.concat(e["key"], F.lit(": "), F.array_join(e["value"], "; ")),
    )
    return F.array_join(rendered, ". ")


def flatten_dicts(c: ColumnOrName) -> Column:
    """P-6: the same inside a list of maps."""
    return F.transform(col_of(c), dict_to_text)


def json_list_items(c: ColumnOrName, path: str) -> Column:
    """A list field of the model output as strings. Inner objects become text by P-6, their
    values being text or a list of text; an absent field is null, other text is one item (X-12)."""
    raw = F.get_json_object(col_of(c), path)
    items = parse_list(raw)

    def item_text(item: Column) -> Column:
        return F.when(F.startswith(item, F.lit("{")), json_dict_text(item)).otherwise(item)

    return F.transform(items, item_text)


def json_dict_text(c: ColumnOrName) -> Column:
    """P-6 on a JSON object whose values are text or lists of text."""
    entries = F.map_entries(F.from_json(col_of(c), "map<string,string>"))

    def entry_text(entry: Column) -> Column:
        value = entry["value"]
        joined = F.array_join(F.from_json(value, "array<string>"), "; ")
        text = F.when(F.startswith(value, F.lit("[")), joined).otherwise(value)
        return F.concat(entry["key"], F.lit(": "), text)

    return F.array_join(F.transform(entries, entry_text), ". ")


def dedupe_list(c: ColumnOrName) -> Column:
    """P-7: first occurrences, order kept."""
    return F.array_distinct(col_of(c))
