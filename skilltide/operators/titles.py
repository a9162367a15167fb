"""Q-4..Q-7: the inverted index that requests look titles up in.

It is made of the postings of a month and kept by month, so a month that is loaded again replaces its own
part and nothing else. A title of several months is in each of them.
"""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skilltide.functions.text import fold, space_tokens, tokens, trigrams
from skilltide.session import saved


@dataclass(frozen=True)
class TitleIndex:
    """``kinds``: the distinct (title, place, level) with their newest date and the title's tokens. ``terms``: token to title, with the title's
    tokens. ``counts``: titles per token. ``words``: blank-separated folded word to title. ``grams``: trigram
    to word, with the word's number of trigrams. Each has the ``month``."""

    kinds: DataFrame
    terms: DataFrame
    counts: DataFrame
    words: DataFrame
    grams: DataFrame

    def since(self, day: Column) -> TitleIndex:
        """The parts of the months from a day on."""
        return TitleIndex(*[getattr(self, f.name).filter(F.col("month") >= F.trunc(day, "month")) for f in fields(self)])


KEYS = {"kinds": "job_title", "terms": "term", "counts": "term", "words": "word", "grams": "gram"}


def kinds_of(jobs: DataFrame) -> DataFrame:
    month = F.trunc("posted_date", "month").alias("month")
    return jobs.filter("posted_date IS NOT NULL").groupBy(month, "job_title", "location", "seniority_level").agg(
        F.max("posted_date").alias("newest")
    )


def title_index(jobs: DataFrame) -> TitleIndex:
    """The index of the titles of postings. The distinct kinds are saved, so postings are read once."""
    kinds = saved(kinds_of(jobs), "kinds")
    return index_of_titles(kinds.select("month", "job_title").distinct(), kinds.withColumn("title_tokens", tokens("job_title")))


def index_of_titles(titles: DataFrame, kinds: DataFrame) -> TitleIndex:
    """Of distinct (month, job_title). The outer explodes keep Catalyst from splitting titles twice."""
    terms = titles.select("month", "job_title", tokens("job_title").alias("title_tokens")).withColumn("term", F.explode_outer("title_tokens"))
    words = titles.select("month", "job_title", F.explode_outer(F.array_distinct(space_tokens(fold("job_title")))).alias("word"))
    grams = words.select("month", "word").distinct().withColumn("grams", trigrams("word")).select(
        "month", "word", F.size("grams").alias("n_word"), F.explode_outer("grams").alias("gram")
    )
    return TitleIndex(kinds, terms, terms.groupBy("month", "term").agg(F.count("*").alias("n")), words, grams)
