"""I-2..I-7, I-16..I-21: from landed rows to one clean collection of raw postings."""

from __future__ import annotations

import datetime as dt

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skilltide.functions.postings import as_date, posting_hash, source_id_path
from skilltide.functions.text import strip
from skilltide.operators.positions import global_position
from skilltide.schemas import RAW_POSTING
from skilltide.session import is_small, saved


def count_where(df: DataFrame, condition: Column | str) -> DataFrame:
    """I-2"""
    return df.filter(condition).agg(F.count("*").alias("n"))


def first_per_key(df: DataFrame, key: list[str], order_by: list[str]) -> DataFrame:
    """The first row per key. ``min_by`` keeps one row per key and task before the shuffle,
    so a key that holds a large part of all rows costs one row per task."""
    rest = [c for c in df.columns if c not in key]
    winner = F.min_by(F.struct(*rest), F.struct(*order_by)).alias("_w")
    return df.groupBy(*key).agg(winner).select(*key, "_w.*").select(*df.columns)


_FILE, _ROW = "__file", "__row"


def located(df: DataFrame) -> DataFrame:
    """``df`` with the file and row that each row is read from; saved first if it is not read from Parquet files."""
    try:
        return df.withColumns({_FILE: F.col("_metadata.file_path"), _ROW: F.col("_metadata.row_index")})
    except AnalysisException:
        return saved(df, "rows").withColumns({_FILE: F.col("_metadata.file_path"), _ROW: F.col("_metadata.row_index")})


def _fetched(rows: DataFrame, winners: DataFrame) -> DataFrame:
    """The rows at the places of ``winners``. Places are saved, so their number is known: few are broadcast, for many
    rows are dealt by place, which is even whatever the keys, into hash tables of places. Rows are never sorted."""
    places = saved(winners.select(_FILE, _ROW), "places")
    places = F.broadcast(places) if is_small(places) else places.hint("shuffle_hash")
    return rows.join(places, [_FILE, _ROW], "left_semi").drop(_FILE, _ROW)


def insert_if_absent(
    new: DataFrame, target: DataFrame | None, key: str, order_by: list[str], *, fetch_payload: bool = False
) -> DataFrame:
    """I-3: the rows of ``new`` to append, first write wins in the batch and over the target.

    For a small batch the target's keys are first reduced to the ones in question, by a
    broadcast while they are read, so a large target is not shuffled. With ``fetch_payload`` the winners are found
    by key, order and place alone, and the other columns, which may be wide, are read for them only;
    rows that tie in order are then taken by their place.
    """
    if fetch_payload:
        rows = located(new)
        first = F.min(F.struct(*order_by, _FILE, _ROW)).alias("_w")
        winners = rows.groupBy(key).agg(first).select(key, f"_w.{_FILE}", f"_w.{_ROW}")
    else:
        winners = first_per_key(new, [key], order_by)
    if target is not None:
        stored = target.select(key)
        if is_small(new):
            stored = stored.join(F.broadcast(new.select(key)), key, "left_semi")
        winners = winners.join(stored, key, "left_anti")
    return _fetched(rows, winners) if fetch_payload else winners


def months(spark: SparkSession, start: dt.date | str, as_of: dt.date | str) -> DataFrame:
    """I-5: first days of the months from ``start`` to the month after ``as_of``."""
    last = F.add_months(F.trunc(as_date(as_of), "month"), 1)
    return spark.range(1).select(
        F.explode(F.sequence(as_date(start), last, F.expr("interval 1 month"))).alias("month")
    )


def bronze_slice(
    df: DataFrame,
    month: dt.date | str,
    column: str = "posted_date",
    last: dt.date | str | None = None,
) -> DataFrame:
    """I-6: the half-open month (or months up to and including ``last``) of a date column.

    A text column is compared as text, as ISO dates sort the same way, so the filter reaches
    the scan in both cases.
    """
    first = dt.date.fromisoformat(str(month))
    until = dt.date.fromisoformat(str(last or month))
    until = (until.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
    if df.schema[column].dataType.simpleString() == "string":
        lo, hi = F.lit(first.isoformat()), F.lit(until.isoformat())
    else:
        lo, hi = F.lit(first), F.lit(until)
    return df.filter((F.col(column) >= lo) & (F.col(column) < hi))


def conform(df: DataFrame, mapping: dict[str, str | Column]) -> DataFrame:
    """I-16: select target columns from source columns or expressions."""
    return df.select(
        *[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in mapping.items()]
    )


def from_alt_posting(df: DataFrame, source: str) -> DataFrame:
    """I-16: the second raw shape as the first, hashed like it. A date it lacks is ''."""
    posted = F.col("date_post")
    return conform(
        df,
        {
            "hash": posting_hash("company_name", "title", posted),
            "source": F.lit(source),
            "source_id": source_id_path("url"),
            "url": "url",
            "job_title": "title",
            "company_name": "company_name",
            "posted_date": posted,
            "full_text_jd": "requirements",
        },
    )


def raw_postings(
    listing: DataFrame, texts: DataFrame, at: dt.datetime | str, legacy_order: bool = False
) -> DataFrame:
    """Listing rows with the text of their page (url, full_text_jd) as raw postings: invalid
    ones dropped, hash and update time added."""
    rows = valid_postings(listing.join(texts.select("url", "full_text_jd"), "url"))
    hashed = rows.withColumn(
        "hash", posting_hash("company_name", "job_title", "posted_date", legacy_order)
    )
    return stamp_update(hashed, at).select(*RAW_POSTING.names)


def union_sources(*frames: DataFrame) -> DataFrame:
    """I-16: union by name, a column one source lacks is null."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out


def concat(*frames: DataFrame) -> DataFrame:
    """I-20: strict concatenation, the same columns in any order."""
    out = frames[0]
    for df in frames[1:]:
        out = out.unionByName(df)
    return out


def posting_is_valid(
    required: tuple[str, ...] = ("job_title", "company_name", "url"),
    text: str = "full_text_jd",
    url: str = "url",
) -> Column:
    """I-17 as a condition that is never null, so rejects are its plain negation."""
    present = F.lit(True)
    for name in required:
        present = present & (F.coalesce(F.length(F.col(name)), F.lit(0)) > 0)
    has_text = F.coalesce(F.length(strip(text)), F.lit(0)) > 0
    return present & has_text & F.coalesce(F.startswith(F.col(url), F.lit("http")), F.lit(False))


def valid_postings(df: DataFrame) -> DataFrame:
    """I-17"""
    return df.filter(posting_is_valid())


def stamp_update(df: DataFrame, at: dt.datetime | str) -> DataFrame:
    """I-18"""
    return df.withColumn("update_date", F.lit(str(at)).cast("timestamp_ntz"))


def batch_slice(
    df: DataFrame, order: list[str], size: int, start: int, limit: int | None = None
) -> DataFrame:
    """I-19: the rows of batches ``start .. start + limit - 1`` and their batch number.

    ``order`` must identify a row: positions are found on these columns alone and the wide
    rows are joined back for the chosen batches only.
    """
    batch = F.floor((F.col("position") - 1) / size)
    chosen = global_position(df.select(*order), order).withColumn("batch", batch)
    chosen = chosen.filter(F.col("batch") >= start)
    if limit is not None:
        chosen = chosen.filter(F.col("batch") < start + limit)
    return df.join(chosen, order)


def batch_count(df: DataFrame, size: int) -> DataFrame:
    """I-19: number of batches, rounded up."""
    return df.agg(F.ceil(F.count("*") / size).alias("batches"))


def keep_links(df: DataFrame, href: str = "href") -> DataFrame:
    """I-21: links with a target that is not a brand page."""
    return df.filter((F.col(href) != "") & ~F.contains(F.col(href), F.lit("/brand/")))
