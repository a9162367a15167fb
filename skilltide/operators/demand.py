"""Q-1..Q-18: which skills the postings that match a request ask for.

A request is a row. Titles are matched once per distinct title: in place for one request,
through equi-joins on tokens and trigrams for many. The postings meet the few chosen titles
afterwards, and the pairs meet the matched postings.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skilltide.functions._cols import ColumnOrName, col_of
from skilltide.functions.postings import months_ago
from skilltide.functions.text import (
    all_terms_match,
    contains_either_way,
    fold,
    percent,
    percent_text,
    set_similarity,
    space_tokens,
    strip,
    tokens,
    trigrams,
)
from skilltide.operators.titles import TitleIndex, index_of_titles, title_index
from skilltide.schemas import KEYWORD_ALIAS, REQUEST
from skilltide.session import broadcaster, saved

WINDOW_MONTHS = 6
MAX_PAGE = 100
MIN_SIMILARITY = 0.3


@dataclass(frozen=True)
class Request:
    """One search. None means no filter; the cursor is the last row of the page before."""

    job_title: str
    locations: Sequence[str] | None = None
    levels: Sequence[str] | None = None
    updated_after: str | None = None
    last_freq: float | None = None
    last_name: str | None = None
    limit: int = 10
    request_id: int = 1

    def __post_init__(self):
        if not 1 <= self.limit <= MAX_PAGE:
            raise ValueError(f"limit must be between 1 and {MAX_PAGE}")
        object.__setattr__(self, "job_title", self.job_title.strip())
        if self.updated_after is not None:
            dt.date.fromisoformat(self.updated_after)


@dataclass(frozen=True)
class Serving:
    """The tables the demand queries read. With a stored index no title is cut at request time."""

    jobs: DataFrame
    skills: DataFrame
    job_skills: DataFrame
    alias: DataFrame
    index: TitleIndex | None = None


def requests_frame(spark: SparkSession, requests: Sequence[Request]) -> DataFrame:
    rows = [tuple(asdict(r)[f] for f in REQUEST.names) for r in requests]
    return spark.createDataFrame(rows, REQUEST)


def alias_frame(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(KEYWORD_ALIAS, "job_word STRING, keyword STRING")


# Alias words ---------------------------------------------------------------------------------


def _alias_hits(requests: DataFrame, alias: DataFrame) -> DataFrame:
    """(request_id, job_word) for each alias row whose folded keyword is the folded title or
    one of its tokens."""
    title = fold(strip("job_title"))
    words = F.array_distinct(F.array_append(space_tokens(title), title))
    asked = requests.select("request_id", F.explode(words).alias("word"))
    return asked.join(alias.select("job_word", fold("keyword").alias("word")), "word").select(
        "request_id", "job_word"
    )


def resolve_intent(requests: DataFrame, alias: DataFrame) -> DataFrame:
    """Q-1: the job word with most keyword hits per request, ties by name."""
    hits = _alias_hits(requests, alias).groupBy("request_id", "job_word").agg(
        F.count("*").alias("hits")
    )
    return hits.groupBy("request_id").agg(
        F.min_by("job_word", F.struct(-F.col("hits"), F.col("job_word"))).alias("job_word")
    )


def match_alias(requests: DataFrame, alias: DataFrame) -> DataFrame:
    """Q-2: the job word a demand query expands to. Hits are distinct words, so each counts
    once and the first by name is taken."""
    return _alias_hits(requests, alias).groupBy("request_id").agg(
        F.min("job_word").alias("job_word")
    )


# Filters -------------------------------------------------------------------------------------


def cutoff_date(updated_after: ColumnOrName, as_of: dt.date | str) -> Column:
    return F.coalesce(col_of(updated_after).try_cast("date"), months_ago(as_of, WINDOW_MONTHS))


def filter_jobs(jobs: DataFrame, request: Request, as_of: dt.date | str) -> DataFrame:
    """Q-3 with literal values, which reach the scan."""
    out = _since(jobs, cutoff_date(F.lit(request.updated_after), as_of))
    if request.locations is not None:
        out = out.filter(F.col("location").isin(*request.locations))
    if request.levels is not None:
        out = out.filter(F.col("seniority_level").isin(*request.levels))
    return out


def _since(jobs: DataFrame, day: Column) -> DataFrame:
    """Postings from a day on; a table kept by ``month`` is read from that month on."""
    recent = jobs.filter(F.col("posted_date") >= day)
    if "month" in jobs.columns:
        recent = recent.filter(F.col("month") >= F.trunc(day, "month"))
    return recent


def _passes(date_column: str) -> Column:
    """Q-3 between a job and a request row."""
    place, level = F.col("location"), F.col("seniority_level")
    return (
        (F.col("locations").isNull() | F.array_contains("locations", place))
        & (F.col("levels").isNull() | F.array_contains("levels", level))
        & (F.col(date_column) >= F.col("cutoff"))
    )


# Title match ---------------------------------------------------------------------------------


Hint = Callable[[DataFrame], DataFrame]


def _index(titles: DataFrame | TitleIndex) -> TitleIndex:
    """An index as it is, or one of distinct titles."""
    if isinstance(titles, TitleIndex):
        return titles
    dated = titles.select(F.lit(None).cast("date").alias("month"), "job_title")
    return index_of_titles(dated, dated)


def match_alias_title(
    titles: DataFrame | TitleIndex, requests: DataFrame, alias: DataFrame, few: Hint | None = None
) -> DataFrame:
    """Q-4: (job_title, request_id) where the title has all tokens of the alias word.

    ``few`` is the hint for request-sized sides; by default the requests are counted for it.
    """
    asked = _alias_terms(requests, alias)
    return _match_terms(_index(titles), asked, few or broadcaster(requests)).drop("tier")


def match_direct(titles: DataFrame | TitleIndex, requests: DataFrame, few: Hint | None = None) -> DataFrame:
    """Q-5: (job_title, request_id) where the title has all tokens of the raw input."""
    asked = _direct_terms(requests)
    return _match_terms(_index(titles), asked, few or broadcaster(requests)).drop("tier")


def _alias_terms(requests: DataFrame, alias: DataFrame) -> DataFrame:
    return match_alias(requests, alias).select(
        "request_id", F.lit(1).alias("tier"), tokens("job_word").alias("terms")
    )


def _direct_terms(requests: DataFrame) -> DataFrame:
    return requests.select("request_id", F.lit(2).alias("tier"), tokens("job_title").alias("terms"))


def _match_terms(index: TitleIndex, asked: DataFrame, few: Hint) -> DataFrame:
    """(job_title, request_id, tier) of the titles that hold all terms. Each row of ``asked`` is
    joined on its rarest term only, then the others are checked on the title's own token list."""
    terms = asked.withColumn("term", F.explode("terms"))
    weight = (
        index.counts.join(few(terms.select("term")), "term", "left_semi")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
    )
    anchors = (
        weight.join(few(terms), "term")
        .groupBy("request_id", "tier")
        .agg(
            F.min_by("term", F.struct("n", "term")).alias("term"),
            F.first("terms").alias("terms"),
        )
    )
    return (
        index.terms.join(few(anchors), "term")
        .filter(all_terms_match("title_tokens", "terms"))
        .select("job_title", "request_id", "tier")
        .distinct()
    )


def match_fuzzy_title(
    titles: DataFrame | TitleIndex, requests: DataFrame, few: Hint | None = None
) -> DataFrame:
    """Q-6: (job_title, request_id) where some blank-separated title token is similar to the
    raw input. Shared trigrams are counted per distinct token, not per title."""
    index = _index(titles)
    asked = requests.withColumn("grams", trigrams(strip("job_title"))).select(
        "request_id", F.size("grams").alias("n_asked"), F.explode("grams").alias("gram")
    )
    few = few or broadcaster(requests)
    shared = F.col("shared")
    similar_words = (
        index.grams.join(few(asked), "gram")
        .select("request_id", "word", "n_word", "n_asked", "gram")
        .distinct()
        .groupBy("request_id", "word", "n_word", "n_asked")
        .agg(F.count("*").alias("shared"))
        .filter(shared / (F.col("n_word") + F.col("n_asked") - shared) > MIN_SIMILARITY)
        .select("request_id", "word")
    )
    return index.words.join(similar_words, "word").select("job_title", "request_id").distinct()


def chosen_titles(
    jobs: DataFrame, requests: DataFrame, alias: DataFrame, as_of: dt.date | str, index: TitleIndex | None = None
) -> DataFrame:
    """The titles of each request's first tier that any filtered posting reaches, with the
    request's filters.

    Whether a tier is reached is asked of the distinct (title, place, level) with their newest
    date, since a posting passes the date filter exactly when the newest of its kind does. Without a
    stored index one is made of the postings in the window, which are scanned once for it. The
    third tier is run for the requests that the first two leave empty.
    """
    requests = saved(requests, "requests")
    oldest = _oldest_cutoff(requests, as_of)
    index = title_index(_since(jobs, oldest)) if index is None else index.since(oldest)
    few = broadcaster(requests)
    filters = few(requests.select(
        "request_id", "locations", "levels", cutoff_date("updated_after", as_of).alias("cutoff")
    ))
    exact = _match_terms(index, _alias_terms(requests, alias).unionByName(_direct_terms(requests)), few)
    reached = saved(
        index.kinds.join(exact, "job_title").join(filters, "request_id").filter(_passes("newest"))
        .groupBy("request_id", "job_title").agg(F.min("tier").alias("tier")),
        "reached",
    )
    best = reached.groupBy("request_id").agg(F.min("tier").alias("tier"))
    chosen = reached.join(few(best), ["request_id", "tier"])
    empty = requests.join(best, "request_id", "left_anti")
    if not empty.isEmpty():
        fuzzy = match_fuzzy_title(index, empty, few).withColumn("tier", F.lit(3))
        chosen = chosen.unionByName(fuzzy)
    return chosen.join(filters, "request_id")


def _oldest_cutoff(requests: DataFrame, as_of: dt.date | str) -> Column:
    """The earliest date any request asks for, as a scalar subquery the scan can prune by."""
    return requests.agg(F.min(cutoff_date("updated_after", as_of)).alias("day")).scalar()


def _jobs_of(jobs: DataFrame, chosen: DataFrame, passes: Column) -> DataFrame:
    """Saved distinct (request_id, id, tier) of the postings with a chosen title.

    The chosen titles were saved: while they are few the postings are filtered by a broadcast
    join, beyond that they are shuffled by title, where hot titles are split.
    """
    matched = (
        jobs.select("id", "job_title", "location", "seniority_level", "posted_date")
        .join(chosen, "job_title")
        .filter(passes)
        .select("request_id", "id", "tier")
        .distinct()
    )
    return saved(matched, "matched")


def matched_jobs(
    jobs: DataFrame, requests: DataFrame, alias: DataFrame, as_of: dt.date | str, index: TitleIndex | None = None
) -> DataFrame:
    """Q-7: distinct (request_id, id, tier) of the first tier that is reached."""
    chosen = saved(chosen_titles(jobs, requests, alias, as_of, index), "chosen")
    oldest = chosen.agg(F.min("cutoff").alias("day")).scalar()
    return _jobs_of(_since(jobs, oldest), chosen, _passes("posted_date"))


def matched_jobs_of(
    jobs: DataFrame, request: Request, alias: DataFrame, as_of: dt.date | str, index: TitleIndex | None = None
) -> DataFrame:
    """Q-7 for one request: its values are literals, so the filters reach the scan. Titles are looked up in
    the stored index; without one a distinct title is tested in place, and trigrams are compared for titles
    that miss tiers 1, 2."""
    filtered = filter_jobs(jobs, request, as_of)
    typed = F.lit(request.job_title)
    asked_words = F.array_append(space_tokens(fold(typed)), fold(typed))
    hits = alias.filter(F.array_contains(asked_words, fold("keyword")))
    alias_word = hits.agg(F.min("job_word").alias("job_word")).scalar()
    if index is not None:
        return _jobs_of(filtered, _looked_up(index, request, alias_word, as_of), F.lit(True))
    own, words = tokens("job_title"), space_tokens(fold("job_title"))
    tier = (
        F.when(all_terms_match(own, tokens(alias_word)), F.lit(1))
        .when(all_terms_match(own, tokens(typed)), F.lit(2))
        .when(F.exists(words, lambda w: similar(w, typed)), F.lit(3))
    )
    # Generated rather than selected, so the filter reads the tier and does not repeat it.
    row = F.inline_outer(F.array(F.struct(tier.alias("tier"))))
    titles = filtered.select("job_title").distinct().select("job_title", row)
    reached = saved(titles.filter(F.col("tier").isNotNull()), "titles")
    best = reached.agg(F.min("tier").alias("tier")).scalar()
    chosen = reached.filter(F.col("tier") == best).withColumn(
        "request_id", F.lit(request.request_id).cast("bigint")
    )
    return _jobs_of(filtered, chosen, F.lit(True))


def _looked_up(index: TitleIndex, request: Request, alias_word: Column, as_of: dt.date | str) -> DataFrame:
    """(job_title, tier, request_id) of the first tier that a posting of the window reaches, by the stored index."""
    day = cutoff_date(F.lit(request.updated_after), as_of)
    index = index.since(day)
    kinds = filter_jobs(index.kinds.withColumnRenamed("newest", "posted_date"), request, as_of)
    tier = F.when(all_terms_match("title_tokens", tokens(alias_word)), F.lit(1)).when(
        all_terms_match("title_tokens", tokens(F.lit(request.job_title))), F.lit(2)
    )
    reached = saved(kinds.select("job_title", tier.alias("tier")).filter(F.col("tier").isNotNull()).distinct(), "titles")
    best = reached.agg(F.min("tier")).first()[0]
    if best is None:
        asked = requests_frame(kinds.sparkSession, [request])
        return match_fuzzy_title(index, asked, F.broadcast).withColumn("tier", F.lit(3))
    return reached.filter(F.col("tier") == best).withColumn("request_id", F.lit(request.request_id).cast("bigint"))


# Counts and percentages ----------------------------------------------------------------------


def total_jobs(matched: DataFrame) -> DataFrame:
    """Q-8: matched postings per request."""
    return matched.groupBy("request_id").agg(F.count("*").alias("matched_job_count"))


def skill_stats(matched: DataFrame, job_skills: DataFrame, skills: DataFrame) -> DataFrame:
    """Q-9: postings per request and skill.

    While the matched postings (saved by Q-7) are few, the pairs are read in place, without a
    shuffle. They are counted by skill id before names are looked up, so a skill most postings
    ask for is one row per task.
    """
    ids = matched.select("request_id", F.col("id").alias("job_id"))
    counted = (
        job_skills.join(ids, "job_id")
        .groupBy("request_id", "skill_id")
        .agg(F.count("*").alias("n"))
    )
    named = _named(skills)
    return (
        counted.join(named, "skill_id")
        .groupBy("request_id", "skill_name", "skill_type")
        .agg(F.sum("n").alias("skill_count"))
    )


def skill_freq(stats: DataFrame, totals: DataFrame) -> DataFrame:
    """Q-10: percentages of the matched postings."""
    return stats.join(totals, "request_id").withColumn(
        "frequency_percent", percent("skill_count", "matched_job_count")
    )


def _named(skills: DataFrame) -> DataFrame:
    return skills.select(
        F.col("id").alias("skill_id"),
        F.col("name").alias("skill_name"),
        F.col("type").alias("skill_type"),
    )


# Pages ---------------------------------------------------------------------------------------

PAGE_COLUMNS = (
    "request_id", "skill_name", "skill_type", "frequency", "frequency_percent", "matched_job_count",
)


def _after_cursor(last_freq: Column, last_name: Column) -> Column:
    freq = F.col("frequency_percent")
    last = last_freq.cast("decimal(20,6)")
    return (last.isNull() & last_name.isNull()) | (
        (freq < last) | ((freq == last) & (F.col("skill_name") > last_name))
    )


def _page_row(df: DataFrame) -> DataFrame:
    return df.withColumn("frequency", percent_text("frequency_percent")).select(*PAGE_COLUMNS)


def skill_page(freq: DataFrame, request: Request) -> DataFrame:
    """Q-11 for one request: a top-k."""
    last_freq, last_name = F.lit(request.last_freq), F.lit(request.last_name)
    after = _after_cursor(last_freq.cast("double"), last_name.cast("string"))
    return _page_row(
        freq.filter(after)
        .orderBy(F.desc("frequency_percent"), F.asc("skill_name"))
        .limit(request.limit)
    )


def skill_pages(freq: DataFrame, requests: DataFrame) -> DataFrame:
    """Q-11 for many requests: as many first rows as each request asks for."""
    page = requests.select(
        "request_id", "last_freq", "last_name", F.col("limit").alias("_limit")
    )
    order = Window.partitionBy("request_id").orderBy(
        F.desc("frequency_percent"), F.asc("skill_name")
    )
    # a constant, by which tasks drop rows before they are shuffled
    most = requests.agg(F.max("limit")).first()[0] or 0
    ranked = (
        freq.join(page, "request_id")
        .filter(_after_cursor(F.col("last_freq"), F.col("last_name")))
        .withColumn("_rank", F.row_number().over(order))
        .filter((F.col("_rank") <= most) & (F.col("_rank") <= F.col("_limit")))
    )
    return _page_row(ranked)


def next_cursors(page: DataFrame, requests: DataFrame) -> DataFrame:
    """Q-11: the cursor after each full page; no row when the page was the last."""
    last = F.struct(-F.col("frequency_percent"), F.col("skill_name"))
    ends = page.groupBy("request_id").agg(
        F.count("*").alias("n"),
        F.max_by("frequency_percent", last).alias("last_freq"),
        F.max_by("skill_name", last).alias("last_name"),
    )
    full = ends.join(requests.select("request_id", F.col("limit").alias("_limit")), "request_id")
    return full.filter(F.col("n") == F.col("_limit")).select("request_id", "last_freq", "last_name")


def page_meta(page: DataFrame, requests: DataFrame) -> DataFrame:
    """Q-13: rows returned and postings matched, 0 without rows."""
    meta = page.groupBy("request_id").agg(
        F.count("*").alias("n"), F.max("matched_job_count").alias("m")
    )
    return requests.select("request_id").join(meta, "request_id", "left").select(
        "request_id",
        F.coalesce("n", F.lit(0)).alias("count"),
        F.coalesce("m", F.lit(0)).alias("matched_job_count"),
    )


def by_type(page: DataFrame, skill_type: str | None = None) -> DataFrame:
    """Q-14: all skills, or the ones of a type."""
    return page if skill_type is None else page.filter(F.col("skill_type") == skill_type)


# Whole queries -------------------------------------------------------------------------------


def _freq(serving: Serving, matched: DataFrame) -> DataFrame:
    stats = skill_stats(matched, serving.job_skills, serving.skills)
    return skill_freq(stats, total_jobs(matched))


def demand(serving: Serving, requests: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Q-2..Q-10: all skills with their percentages, per request."""
    return _freq(serving, matched_jobs(serving.jobs, requests, serving.alias, as_of, serving.index))


def skill_demand(serving: Serving, request: Request, as_of: dt.date | str) -> DataFrame:
    """Q-16: one request."""
    matched = matched_jobs_of(serving.jobs, request, serving.alias, as_of, serving.index)
    return skill_page(_freq(serving, matched), request)


def skill_demand_batch(serving: Serving, requests: DataFrame, as_of: dt.date | str) -> DataFrame:
    """Q-17: a page for every request."""
    return skill_pages(demand(serving, requests, as_of), requests)


def skill_frequency_stats(jobs: DataFrame, job_skills: DataFrame, skills: DataFrame) -> DataFrame:
    """Q-18: skill counts and percentages per title, place and level.

    Both aggregates start with task-side counts and the distinct count is spread over ids, so
    a hot (title, place, level) is never gathered whole.
    """
    group = ["job_title", "location", "seniority_level"]
    totals = jobs.groupBy(*group).agg(F.countDistinct("id").alias("total_jobs"))
    counted = (
        jobs.select(F.col("id").alias("job_id"), *group)
        .join(job_skills, "job_id")
        .groupBy(*group, "skill_id")
        .agg(F.count("*").alias("skill_count"))
    )
    named = _named(skills)
    return (
        counted.join(named, "skill_id")
        .join(totals, group)
        .withColumn("frequency_percent", percent("skill_count", "total_jobs"))
        .drop("skill_id", "total_jobs")
    )


# Options -------------------------------------------------------------------------------------


def distinct_levels(jobs: DataFrame, order: Sequence[str] | None = None) -> DataFrame:
    """Q-12: the levels of the data, last name first, or by their place in ``order`` with
    unlisted ones at the end."""
    levels = jobs.select("seniority_level").distinct()
    if order is None:
        return levels.orderBy(F.desc("seniority_level"))
    place = F.array_position(F.array(*[F.lit(x) for x in order]), F.col("seniority_level"))
    return levels.orderBy(place == 0, place, "seniority_level")


def distinct_locations(jobs: DataFrame) -> DataFrame:
    """Q-12"""
    return jobs.select("location").distinct().orderBy("location")


def search_options(values: DataFrame, column: str, text: str) -> DataFrame:
    """Q-15: the options that contain the typed text or are contained in it."""
    return values.filter(contains_either_way(column, F.lit(text)))


def similar(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Q-6 on two columns."""
    return set_similarity(trigrams(a), trigrams(b)) > MIN_SIMILARITY
