"""What is read more than once is computed once."""

import re

from pyspark.sql import functions as F

from skilltide.operators import normalize as n
from skilltide.operators.extract import extract_levels
from skilltide.operators.vocab import with_keys
from skilltide.plans import lake as plans
from skilltide.registry import lake, shapes
from skilltide.registry import normalize as queries
from skilltide.registry.core import shape
from skilltide.sources import listings
from skilltide.sources.files import read_layer
from skilltide.sources.warehouse import load_table, read_table


def _counted(spark, df, column):
    """``df`` and the number of times that a value of its column was computed."""
    calls = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def seen(x):
        calls.add(1)
        return x

    return df.withColumn(column, seen(column)), calls


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_postings_of_a_query_are_made_once(spark, sf_dir, monkeypatch):
    made, real = [], shapes.postings
    monkeypatch.setattr(shapes, "postings", lambda *a: made.append(1) or real(*a))
    for run in (queries.n6, queries.n15, queries.n16):
        # the lines are in no plan that is left: the saved postings are
        assert "lineitem" not in _plan(run(spark, sf_dir))
    assert len(made) == 3
    lake._loaded(spark, sf_dir, "major_table")
    assert len(made) == 4


def test_a_load_computes_its_rows_once(spark, tmp_path):
    rows = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", None)], "id string, name string").coalesce(1)
    df, calls = _counted(spark, rows, "name")
    assert load_table(df, str(tmp_path), "major_table", "2025-01-01")
    assert calls.value == 3
    assert read_table(spark, str(tmp_path), "major_table", "2025-01-01").count() == 3


def test_an_empty_load(spark, tmp_path):
    none = spark.createDataFrame([], "id string, name string")
    some = spark.createDataFrame([("1", "a")], "id string, name string")
    assert not load_table(none, str(tmp_path), "major_table")
    assert not (tmp_path / "major_table").exists()
    assert load_table(some, str(tmp_path), "major_table")
    assert not load_table(none, str(tmp_path), "major_table")
    assert read_table(spark, str(tmp_path), "major_table").count() == 0
    months = some.withColumn("month", F.lit("2025-01-01").cast("date"))
    assert load_table(months, str(tmp_path), "soft_skill_table")
    assert not load_table(months.limit(0), str(tmp_path), "soft_skill_table")
    assert read_table(spark, str(tmp_path), "soft_skill_table").count() == 0


def test_values_are_distinct_before_they_are_trimmed(spark):
    postings = spark.createDataFrame(
        [("1", " Ha Noi", ["a", " a", None, ""]), ("2", "Ha Noi", None), ("3", None, ["a"]), (None, " ", [])],
        "_id string, location string, tech_stack array<string>",
    )
    vocab = with_keys(spark.createDataFrame([("location", "Ha Noi", 1)], "category string, value string, ord long"))
    values = []
    real = n.resolve_values
    n.resolve_values = lambda v, *a: values.append(v) or real(v, *a)
    try:
        mapping = n.field_mapping(postings, vocab, ("location",), ("tech_stack",), None)
    finally:
        n.resolve_values = real
    assert "trim" not in _plan(values[0]) and "HashAggregate" in _plan(values[0])
    assert sorted(map(tuple, mapping.collect())) == [("location", "Ha Noi", "Ha Noi", False), ("tech_stack", "a", "a", True)]


def test_levels_split_a_text_once(spark):
    df = spark.createDataFrame([(" Senior, JUNIOR",), ("intern",), (",",), ("",), (None,)], "t string")
    out = df.select(extract_levels("t", ["junior", "senior", "senior"]).alias("l"))
    assert [r.l for r in out.collect()] == [["junior", "senior", "senior"], ["Else"], ["Else"], ["Else"], ["Else"]]
    # in a lambda nothing is shared between the levels
    assert "lambda" not in _plan(out)


def test_a_page_is_read_once(spark):
    page = '<div class="a"><div>x</div></div><h3 data-url="u"></h3><div class="paragraph"><h2>Skills</h2>sql</div>'
    df, calls = _counted(spark, spark.createDataFrame([(page,)], "html string").coalesce(1), "html")
    assert listings.from_detail_html(df.withColumn("update_date", F.lit("2025-01-01")), keep=()).count() == 1
    assert calls.value == 1
    said = str(listings.element_bodies(F.upper("html"), "div", "a")._jc)
    assert len(re.findall("upper", said, re.I)) == 1


def test_items_are_listed_where_all_of_a_job_are(spark, sf_dir):
    plan = _plan(shapes.postings(spark, sf_dir))
    lists = plan[plan.index("partial_listagg"):]
    # the next line below the lists is past the shuffle: they are no rows of one
    assert "REPARTITION_BY_COL" in lists and lists.index("REPARTITION_BY_COL") < lists.index("Join")
    said = shape(spark, sf_dir, "posting_rows").select("_id", "tech", "soft", "majors")
    made = shapes.postings(spark, sf_dir).select(
        "_id", *[F.array_join(c, ";").alias(c) for c in ("tech_stack", "soft_skills", "major")])
    assert sorted(map(tuple, made.na.fill("").collect())) == sorted(map(tuple, said.na.fill("").collect()))


def test_rows_do_not_carry_the_mapping(spark):
    vocab = with_keys(spark.createDataFrame([("major", "Art", 1)], "category string, value string, ord int"))
    df = spark.createDataFrame([("1", ["art ", "", "x", None]), ("2", None), ("3", [])], "_id string, major array<string>")
    out = n.normalize_list(df, "major", vocab, None)
    assert "AS _lookup" not in _plan(out)
    assert {r["_id"]: r["normalized_major"] for r in out.collect()} == {"1": ["Art", "x"], "2": None, "3": []}


def test_rows_that_lie_by_month_are_not_dealt_anew(spark, tmp_path, monkeypatch):
    fields = "_id job_title company_name location posted_date url update_date salary job_position"
    rows = [(str(i), "t", "c", "l", f"2025-0{i % 3 + 1}-05", "u", "d", "s", "p", ["a"], [f"x{i}"], ["b"], ["M"]) for i in range(9)]
    lists = "seniority_level tech_stack soft_skills major"
    df = spark.createDataFrame(rows, ", ".join([*(f"{c} string" for c in fields.split()), *(f"{c} array<string>" for c in lists.split())]))
    vocab = with_keys(spark.createDataFrame([("major", "M", 1)], "category string, value string, ord int"))
    dealt, real = [], type(df).hint
    monkeypatch.setattr(type(df), "hint", lambda self, name, *a: dealt.append(name) or real(self, name, *a))
    metrics = plans.backfill(df, vocab, str(tmp_path), "2025-01-01", "2025-03-01", threshold=None)
    assert dealt.count("rebalance") == 5  # bronze, and the four tables of distinct names
    assert metrics["silver.job_descriptions"]["row_count"] == 9
    for layer, table in (("silver", "job_descriptions"), ("gold", "job_tech_skill_mapping")):
        held = read_layer(spark, str(tmp_path), layer, table)
        assert sorted(str(r["month"]) for r in held.collect()) == sorted(3 * ["2025-01-01", "2025-02-01", "2025-03-01"])
