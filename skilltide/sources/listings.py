"""I-10..I-13: landed listing answers and job pages as posting rows. JVM expressions only."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skilltide.functions._cols import ColumnOrName, col_of
from skilltide.functions.postings import (
    assemble_sections,
    last_address_part,
    posted_date,
    source_id_path,
    url_without_query,
)
from skilltide.functions.text import collapse_double_newline, html_to_text, strip, title_before
from skilltide.schemas import LISTING_A, LISTING_B

# The entities that page text holds, the ampersand last.
ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&nbsp;": "\xa0",
    "&amp;": "&",
}



def start_tag(tag: str, css_class: str | None = None, attribute: str | None = None) -> str:
    """Pattern of a start tag that has a class, maybe among others, and an attribute; attributes may be
    in any order. The group is the attribute's value."""
    has = ""
    if css_class is not None:
        name = re.escape(css_class)
        has = rf"""(?=[^>]*\sclass\s*=\s*["'](?:[^"']*\s)?{name}(?:\s[^"']*)?["'])"""
    value = "" if attribute is None else rf"""[^>]*?\s{attribute}\s*=\s*["']([^"']*)["']"""
    return rf"(?is)<{tag}\b{has}{value}[^>]*>"


def _element(tag: str, css_class: str) -> str:
    return rf"{start_tag(tag, css_class)}(.*?)</{tag}\s*>"


# Where a listing card of the third source holds its fields.
CARD = r"(?s)<li[^>]*>(.*?)</li>"
CARD_FIELDS = {
    "job_title": _element("h3", "base-search-card__title"),
    "company_name": _element("h4", "base-search-card__subtitle"),
    "location": _element("span", "job-search-card__location"),
    "posted_date": start_tag("time", None, "datetime"),
    "url": start_tag("a", "base-card__full-link", "href"),
}
# The attribute of a card of the fourth source that holds its link.
DATA_URL = start_tag("h3", None, "data-url")

# A section of a job page of the fourth source and its heading.
SECTION = ("div", "paragraph")
SECTION_HEADING = r"(?is)<h2[^>]*>(.*?)</h2>"

# The elements that hold the text of a job on the pages of the first and third source.
TEXT_ID = {"a": ("div", "JobDescription")}
TEXT_CLASS = {"c": ("div", "show-more-less-html__markup")}

# Marker, classes and labels on a job page of the fifth source.
JOB_PAGE = {
    "title_marker": "làm việc tại",
    "company_class": "company-name",
    "company_item_prefix": "company-",
    "company_value_class": "company-value",
    "info_class": "job-detail__info--section-content",
    "label_class": "job-detail__info--section-content-title",
    "value_class": "job-detail__info--section-content-value",
    "experience_label": "kinh nghiệm",
    "section_class": "job-description__item",
    "requirements_label": "yêu cầu ứng viên",
}


def _items(df: DataFrame, column: str, schema) -> DataFrame:
    parsed = F.from_json(col_of(column), schema)
    # A plain explode would parse each answer twice, once to filter empty ones.
    return df.select(F.explode_outer(parsed["data"]).alias("item")).filter("item IS NOT NULL")


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def from_listing_a(df: DataFrame, column: str = "body", source: str = "a") -> DataFrame:
    """I-10: nested paths, missing is '', ten characters of the date, last address part."""
    item = F.col("item")
    return _items(df, column, LISTING_A).select(
        _text(item["title"]).alias("job_title"),
        _text(item["company"]["display_name"]).alias("company_name"),
        _text(item["detail_url"]).alias("url"),
        F.substring(_text(item["refreshed"]["date"]), 1, 10).alias("posted_date"),
        F.coalesce(item["id"], F.lit("None")).alias("source_id"),
        last_address_part(_text(item["addresses"]["sort_addresses"])).alias("location"),
        F.lit(source).alias("source"),
    )


def from_listing_b(
    df: DataFrame, site: str, column: str = "body", source: str = "b"
) -> DataFrame:
    """I-11: first place of the list, link rebuilt from alias and id where it is missing."""
    item = F.col("item")
    rebuilt = F.concat(F.lit(f"{site}/"), item["alias"], item["jobId"], F.lit("-jv"))
    city = F.get(item["workingLocations"], F.lit(0))["cityNameVI"]
    return _items(df, column, LISTING_B).select(
        item["jobTitle"].alias("job_title"),
        item["companyName"].alias("company_name"),
        F.coalesce(F.nullif(item["jobUrl"], F.lit("")), rebuilt).alias("url"),
        F.substring(_text(item["approvedOn"]), 1, 10).alias("posted_date"),
        F.coalesce(item["jobId"], F.lit("None")).alias("source_id"),
        F.coalesce(city, F.lit("Unknown")).alias("location"),
        F.lit(source).alias("source"),
    )


def unescape(c: ColumnOrName) -> Column:
    out = col_of(c)
    for entity, char in ENTITIES.items():
        out = F.replace(out, F.lit(entity), F.lit(char))
    return out


def inner_text(c: ColumnOrName) -> Column:
    """Visible text of a fragment: tags dropped, entities decoded, trimmed."""
    return strip(unescape(F.regexp_replace(col_of(c), "<[^>]+>", "")))


def from_listing_html(
    df: DataFrame,
    html: str = "html",
    card: str = CARD,
    fields: dict[str, str] | None = None,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """I-12: one row per card; a card without one of the fields is dropped.

    So is the null card of a page without cards: a plain explode would search each page twice,
    once to filter it.
    """
    patterns = fields or CARD_FIELDS
    cards = df.select(
        *keep, F.explode_outer(F.regexp_extract_all(html, F.lit(card), 1)).alias("_card")
    )
    found = F.lit(True)
    for pattern in patterns.values():
        found = found & F.rlike(F.col("_card"), F.lit(pattern))
    return cards.filter(found).select(
        *keep,
        *[inner_text(F.regexp_extract("_card", p, 1)).alias(n) for n, p in patterns.items()],
    )


def page_title(html: ColumnOrName, marker: str) -> Column:
    """Text of the page title up to a marker phrase."""
    raw = F.regexp_extract(col_of(html), r"(?s)<title[^>]*>(.*?)</title>", 1)
    return title_before(strip(unescape(raw)), marker)


_MARK = "\x01\x02\x01"  # in the start tags of the elements looked for
_RUN = 64


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value computed once, also where it is used in lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running_sums(steps: Column) -> Column:
    """The sums of an array before each of its members, in runs, as an array that grows is copied by each step."""
    none = F.array(F.lit(0))

    def sums(values: Column) -> Column:
        return F.aggregate(values, none, lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + x)))

    runs = F.transform(
        F.sequence(F.lit(0), (F.size(steps) / _RUN).cast("int")), lambda b: sums(F.slice(steps, b * _RUN + 1, F.lit(_RUN)))
    )
    return _let(runs, lambda r: _let(sums(F.transform(r, lambda x: F.element_at(x, -1))), lambda before: F.flatten(
        F.transform(r, lambda x, b: F.transform(F.slice(x, F.lit(1), F.size(x) - 1), lambda y: y + F.get(before, b)))
    )))


def element_bodies(html: ColumnOrName, tag: str, css_class: str | None = None, start: str | None = None) -> Column:
    """What is inside each element of a class, whole: its end is where as many ends as starts of the tag were
    read. An element that is never closed ends with the page. The element's own tags, and those of elements of the class
    in it, come without attributes.

    The page is cut once at the tag's starts and ends, and the depth is carried over the pieces. In the order of
    depth and place each start is followed by its end.
    """
    begin = start or start_tag(tag, css_class)

    def cut(marked: Column) -> Column:
        # a page without the element is not cut
        ends = F.regexp_replace(marked, rf"(?i)</{tag}\s*>", f"</{tag}>")
        return F.when(F.contains(marked, F.lit(_MARK)), F.split(ends, rf"(?i)(?=<{tag}\b|</{tag}>)"))

    def bodies(pieces: Column) -> Column:
        steps = F.transform(pieces, lambda x: F.when(F.startswith(x, F.lit(f"</{tag}>")), -1).when(F.rlike(x, F.lit(rf"(?i)\A<{tag}\b")), 1).otherwise(0))
        return _let(steps, lambda k: _let(_running_sums(k), lambda depth: matched(pieces, k, depth)))

    def matched(pieces: Column, steps: Column, depth: Column) -> Column:
        def event(step: Column, i: Column) -> Column:
            level = F.get(depth, i) + F.greatest(step, F.lit(0))
            sought = F.startswith(F.get(pieces, i), F.lit(f"<{tag}{_MARK}>"))
            return F.struct(level.alias("level"), i.alias("at"), step.alias("step"), sought.alias("sought"))

        events = F.array_sort(F.filter(F.transform(steps, event), lambda e: e["step"] != 0))
        return _let(events, lambda order: F.transform(F.array_sort(F.filter(F.transform(order, lambda e, n: F.when(
            e["sought"], F.struct(e["at"].alias("at"), end_of(pieces, e, F.get(order, n + 1)).alias("end"))
        )), lambda x: x.isNotNull())), lambda x: body(pieces, x)))

    def end_of(pieces: Column, e: Column, follows: Column) -> Column:
        return F.when((follows["level"] == e["level"]) & (follows["step"] == -1), follows["at"]).otherwise(F.size(pieces))

    def body(pieces: Column, x: Column) -> Column:
        text = F.array_join(F.slice(pieces, x["at"] + 1, x["end"] - x["at"]), "")
        return F.replace(F.substring(text, F.lit(len(tag) + len(_MARK) + 3), F.lit(2**31 - 1)), F.lit(_MARK), F.lit(""))

    pieces = _let(F.regexp_replace(col_of(html), begin, f"<{tag}{_MARK}>"), cut)
    return F.coalesce(_let(pieces, bodies), F.array().cast("array<string>"))


def block_text(html: ColumnOrName, tag: str, css_class: str) -> Column:
    """Text of the first element of a class; '' when there is none."""
    return inner_text(F.coalesce(F.get(element_bodies(html, tag, css_class), F.lit(0)), F.lit("")))


def labelled_value(html: ColumnOrName, section_class: str, label_class: str, value_class: str, label: str) -> Column:
    """Whole text of the value in the first section whose label contains ``label``; '' when there is none.
    On a page without sections a label's section goes on to the next label."""
    parts = F.split(col_of(html), start_tag("div", label_class))
    after = _let(parts, lambda p: F.slice(p, F.lit(2), F.size(p)))
    loose = F.coalesce(F.transform(after, lambda x: F.concat(F.lit(f'<div class="{label_class}">'), x)), F.array().cast("array<string>"))
    sections = _let(element_bodies(html, "div", section_class), lambda bodies: F.when(F.size(bodies) > 0, bodies).otherwise(loose))

    def named(section: Column) -> Column:
        return F.contains(F.lower(block_text(section, "div", label_class)), F.lit(label))

    hits = F.filter(sections, named)
    return block_text(F.coalesce(F.get(hits, F.lit(0)), F.lit("")), "div", value_class)


def section_text(html: ColumnOrName, section: str, heading: str, label: str) -> Column:
    """Cleaned text (X-5) of the first section whose heading contains ``label``.

    ``section`` and ``heading`` are patterns with one group.
    """
    sections = F.regexp_extract_all(col_of(html), F.lit(section), 1)
    hits = F.filter(
        sections,
        lambda s: F.contains(F.lower(F.regexp_extract(s, heading, 1)), F.lit(label)),
    )
    return html_to_text(F.coalesce(F.get(hits, F.lit(0)), F.lit("")))


def section_of(bodies: Column, heading: str, label: str) -> Column:
    """Cleaned text (X-5) of the first body whose heading contains ``label``."""
    hits = F.filter(bodies, lambda b: F.contains(F.lower(F.regexp_extract(b, heading, 1)), F.lit(label)))
    return html_to_text(F.coalesce(F.get(hits, F.lit(0)), F.lit("")))


def page_blocks(
    html: ColumnOrName, tag: str = SECTION[0], css_class: str = SECTION[1], heading: str = SECTION_HEADING
) -> Column:
    """The (heading, text) blocks of a job page of the fourth source, as I-15 assembles them."""
    return F.transform(
        element_bodies(html, tag, css_class),
        lambda b: F.struct(
            inner_text(F.regexp_extract(b, heading, 1)).alias("heading"),
            unescape(html_to_text(b)).alias("text"),
        ),
    )


def from_job_html(df: DataFrame, html: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """I-13: fields of a job page of the fifth source."""
    page = JOB_PAGE

    def company(item: str) -> Column:
        # the item first, then the value inside it
        block = F.get(element_bodies(html, "div", f"{page['company_item_prefix']}{item}"), F.lit(0))
        return block_text(F.coalesce(block, F.lit("")), "div", page["company_value_class"])

    experience = labelled_value(
        html, page["info_class"], page["label_class"], page["value_class"], page["experience_label"]
    )
    requirements = section_of(
        element_bodies(html, "div", page["section_class"]), r"(?is)<h3[^>]*>(.*?)</h3>", page["requirements_label"]
    )
    return df.select(
        *keep,
        page_title(html, page["title_marker"]).alias("title"),
        block_text(html, "div", page["company_class"]).alias("company_name"),
        company("field").alias("company_field"),
        company("scale").alias("company_scope"),
        experience.alias("experience"),
        requirements.alias("requirements"),
    )


# Texts of landed job pages ---------------------------------------------------------------------


_PICTURES = r"(?is)<(svg|picture|i)\b[^>]*>.*?</\1\s*>|<img\b[^>]*>"


def _page_text(body: Column) -> Column:
    return unescape(html_to_text(F.regexp_replace(body, _PICTURES, "")))


def description_text(html: ColumnOrName, source: str) -> Column:
    """The job text of a landed page, '' when the page has none.

    ``a``: the element with a fixed id. ``b``: the blocks of ``css_class`` (see ``blocks_text``). ``c``: the first
    element of a fixed class, double line breaks made single. ``d``: the sections about the job and its skills.
    """
    if source == "a":
        tag, name = TEXT_ID["a"]
        start = rf"""(?is)<{tag}\b(?=[^>]*\sid\s*=\s*["']{name}["'])[^>]*>"""
        body = F.get(element_bodies(html, tag, start=start), F.lit(0))
        return _page_text(F.coalesce(body, F.lit("")))
    if source == "c":
        tag, name = TEXT_CLASS["c"]
        body = F.get(element_bodies(html, tag, name), F.lit(0))
        return collapse_double_newline(_page_text(F.coalesce(body, F.lit(""))))
    if source == "d":
        return assemble_sections(page_blocks(html))
    raise ValueError(f"no text rule for source {source!r}")


def blocks_text(html: ColumnOrName, tag: str, css_class: str) -> Column:
    """The texts of all elements of a class with a blank line between them (second source)."""
    return F.array_join(F.transform(element_bodies(html, tag, css_class), _page_text), "\n\n")


def from_card_html(df: DataFrame, html: str = "html", keep: tuple[str, ...] = ()) -> DataFrame:
    """Links of the cards of the fourth source: the ``data-url`` of a heading without its query, and the id in it."""
    urls = F.explode_outer(F.regexp_extract_all(html, F.lit(DATA_URL), 1)).alias("_url")
    found = df.select(*keep, urls).filter(F.col("_url").isNotNull())
    return found.select(
        *keep, url_without_query("_url").alias("url"), source_id_path("_url").alias("source_id")
    )


def from_detail_html(
    df: DataFrame, html: str = "html", as_of: ColumnOrName = "update_date", keep: tuple[str, ...] = ("url",)
) -> DataFrame:
    """A job page of the fourth source: title, company, place, day and text; pages without text are dropped."""
    place = F.regexp_extract(col_of(html), r"(?is)<use\b[^>]*map-pin[^>]*>(?:\s*</use>)?\s*</svg>(.*?)</div>", 1)
    posted = F.regexp_extract(col_of(html), r"(?is)<span\b[^>]*>([^<]*Posted[^<]*)</span>", 1)

    def titles(header: Column) -> Column:
        company = F.regexp_extract(header, start_tag(r"(\w+)", "employer-name") + r"(.*?)</\1\s*>", 2)
        title = F.regexp_extract(header, r"(?is)<h1[^>]*>(.*?)</h1>", 1)
        return F.struct(inner_text(title).alias("job_title"), inner_text(company).alias("company_name"))

    header = F.coalesce(F.get(element_bodies(html, "div", "job-header-info"), F.lit(0)), F.lit(""))
    page = F.struct(
        _let(header, titles).alias("titles"),
        _let(inner_text(place), last_address_part).alias("location"),
        _let(posted, lambda p: posted_date(p, as_of)).cast("string").alias("posted_date"),
        description_text(html, "d").alias("full_text_jd"),
    )
    # of a plain select Catalyst would move the filter below it, and read the page twice
    read = df.select(*keep, F.inline_outer(F.array(page)))
    return read.select(*keep, "titles.*", "location", "posted_date", "full_text_jd").filter(strip("full_text_jd") != "")
