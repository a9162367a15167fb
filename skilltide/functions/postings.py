"""Expressions on posting fields: dates, places, links, ids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from skilltide.functions._cols import ColumnOrName, col_of
from skilltide.functions.text import strip


def as_date(value: dt.date | str | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def posted_date(text: ColumnOrName, as_of: ColumnOrName) -> Column:
    """X-1: "Posted 3 days ago" relative to the instant ``as_of``; no match means that day."""
    now = col_of(as_of).cast("timestamp_ntz")

    def back(unit: str) -> tuple[Column, Column]:
        n = F.regexp_extract(col_of(text), rf"(\d+)\s+{unit}s?", 1)
        amount = n.try_cast("int")
        interval = F.make_interval(
            days=amount if unit == "day" else F.lit(0),
            hours=amount if unit == "hour" else F.lit(0),
            mins=amount if unit == "minute" else F.lit(0),
        )
        return n != "", (now - interval).cast("date")

    out = F.when(col_of(text).isNull(), F.lit(None).cast("date"))
    for unit in ("minute", "hour", "day"):
        found, day = back(unit)
        out = out.when(found, day)
    return out.otherwise(now.cast("date"))


def last_address_part(c: ColumnOrName) -> Column:
    """X-2: last comma segment; without a comma the whole text, or Unknown when blank."""
    text = col_of(c)
    whole = F.coalesce(F.nullif(strip(text), F.lit("")), F.lit("Unknown"))
    return F.when(F.contains(text, F.lit(",")), strip(F.substring_index(text, ",", -1))).otherwise(
        whole
    )


def url_without_query(c: ColumnOrName) -> Column:
    """X-4"""
    return F.substring_index(col_of(c), "?", 1)


def source_id_path(c: ColumnOrName) -> Column:
    """X-3, form 1: drop the query and trailing slashes, then take the last ``-`` segment."""
    return F.substring_index(F.rtrim(url_without_query(c), F.lit("/")), "-", -1)


def source_id_tail(c: ColumnOrName) -> Column:
    """X-3, form 2: take the last ``-`` segment, then drop the query."""
    return F.substring_index(F.substring_index(col_of(c), "-", -1), "?", 1)


def posting_hash(
    company: ColumnOrName, title: ColumnOrName, date: ColumnOrName, legacy_order: bool = False
) -> Column:
    """I-4: md5 of company, title and date as text; a missing value reads ``None``.

    One source hashes title before company (``legacy_order``), so its postings never met
    the same posting of another source.
    """
    parts = [title, company, date] if legacy_order else [company, title, date]
    return F.md5(
        F.concat(*[F.coalesce(col_of(p).cast("string"), F.lit("None")) for p in parts])
    )


def normalize_id(c: ColumnOrName) -> Column:
    """I-7: a plain id or ``{"$oid": ...}`` as text."""
    text = col_of(c).cast("string")
    wrapped = F.get_json_object(text, "$['$oid']")
    return F.when(F.startswith(strip(text), F.lit("{")), F.coalesce(wrapped, text)).otherwise(text)


def months_ago(as_of: dt.date | str | Column, months: int | Column) -> Column:
    """X-20: clamped to the end of a shorter month."""
    n = months if isinstance(months, Column) else F.lit(months)
    return F.add_months(as_date(as_of), -n)


def month_bucket(value: ColumnOrName, as_of: dt.date | str | Column) -> Column:
    """X-21: the preset (months) that a date stands for, one month of tolerance, else ''."""
    day, today = col_of(value), as_date(as_of)
    diff = (F.year(today) * 12 + F.month(today)) - (F.year(day) * 12 + F.month(day))
    out = F.when(day.isNull() | (day == today), F.lit("0"))
    for preset in (24, 12, 6, 3):
        out = out.when(diff.between(preset - 1, preset + 1), F.lit(str(preset)))
    return out.otherwise(F.lit(""))


def jsonld_date(html: ColumnOrName) -> Column:
    """I-14: ``datePosted`` of the first JSON-LD block, null when absent or invalid."""
    block = F.regexp_extract(
        col_of(html),
        r"""(?s)<script[^>]*type=["']application/ld\+json["'][^>]*>(.*?)</script>""",
        1,
    )
    value = F.get_json_object(block, "$.datePosted")
    return F.when(F.rlike(value, F.lit(r"^\d{4}-\d{1,2}-\d{1,2}$")), value.try_cast("date"))


def assemble_sections(blocks: ColumnOrName) -> Column:
    """I-15: keep the blocks (heading, text) about the job or its skills and render them."""
    wanted = F.filter(
        col_of(blocks),
        lambda b: F.contains(F.lower(b["heading"]), F.lit("job description"))
        | F.contains(F.lower(b["heading"]), F.lit("skills")),
    )
    rendered = F.transform(
        wanted, lambda b: F.concat(strip(b["heading"]), F.lit(":\n"), b["text"])
    )
    return F.array_join(rendered, "\n\n")


def surrogate_key(c: ColumnOrName) -> Column:
    """M-6: the same member has the same key in every month and on every retry."""
    return F.md5(col_of(c).cast("string"))
