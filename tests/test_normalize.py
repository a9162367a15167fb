"""Vocabulary matching and evolution."""

import json

import pytest
from pyspark.sql import functions as F

from skilltide.operators import normalize as n
from skilltide.operators import vocab as v
from tests.test_functions import plain_score

TERMS = {
    "tech_stack": ["EKYC", "Ekyc", "eKYC", "Node.js", "Java", "Spring Boot", "CI/CD", "PostgreSQL"],
    "soft_skills": ["Teamwork", "Problem solving"],
    "location": ["Ha Noi", "Da Nang", "HCMC"],
    "major": ["Computer Science"],
    "job_position": ["Backend Developer", "Data Engineer"],
}


@pytest.fixture(scope="module")
def vocab(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("vocab") / "vocab.json"
    path.write_text(json.dumps(TERMS), encoding="utf-8")
    return v.load_vocab(spark, str(path)).cache()


def resolved(spark, vocab, values, threshold=None, category="tech_stack"):
    df = spark.createDataFrame([(category, x) for x in values], "category STRING, raw STRING")
    rows = n.resolve_values(df, vocab, threshold).collect()
    return {r["raw"]: (r["value"], r["is_new"]) for r in rows}


def test_load_vocab(spark, vocab, tmp_path):
    rows = vocab.filter("category = 'tech_stack'").orderBy("ord").collect()
    assert [r["value"] for r in rows] == TERMS["tech_stack"]
    assert [r["key"] for r in rows][:4] == ["ekyc", "ekyc", "ekyc", "nodejs"]
    assert v.load_vocab(spark, str(tmp_path / "missing.json")).count() == 0


def test_tiers(spark, vocab):
    got = resolved(spark, vocab, [" EKYC ", "e.kyc", "nodejs", "Cobol", "", "  ", None])
    assert got == {
        "EKYC": ("EKYC", False),  # exact, although a later spelling shares the key
        "e.kyc": ("eKYC", False),  # cleaned key, last spelling
        "nodejs": ("Node.js", False),
        "Cobol": ("Cobol", True),
    }


def brute_best(value_key, category, threshold):
    keys = {}
    for term in TERMS[category]:
        key = "".join(c for c in term.lower() if c.isalnum() or c in "_ ").strip()
        keys[key] = term  # first place, last value
    best, target = -1, None
    for key, term in keys.items():
        score = plain_score(value_key, key)
        if score > best:
            best, target = score, term
    return target if best >= threshold else None


FUZZY = ["spring", "java ee", "postgres", "node", "qqqq", "boot spring java", "ci cd tools", "k"]


@pytest.mark.parametrize("chunk", [1, 3, 1000])
@pytest.mark.parametrize("small", [True, False])
def test_fuzzy_equals_brute_force(spark, vocab, monkeypatch, chunk, small):
    monkeypatch.setattr(n, "CHUNK", chunk)
    monkeypatch.setattr(n, "is_small", lambda df, *a: small)
    keys = [(category, k) for k in FUZZY for category in TERMS]  # categories share tasks
    df = spark.createDataFrame(keys, "category STRING, key STRING").coalesce(1)
    found = n.match_fuzzy(df, vocab, 50).collect()
    got = {(r["category"], r["key"]): r["fuzzy"] for r in found}
    expected = {(c, k): brute_best(k, c, 50) for c, k in keys}
    assert got == {k: t for k, t in expected.items() if t is not None}
    assert None in expected.values()


def test_fuzzy_tier_comes_last(spark, vocab):
    got = resolved(spark, vocab, ["EKYC", "spring", "qqqq"], 50)
    assert got == {
        "EKYC": ("EKYC", False), "spring": ("Spring Boot", False), "qqqq": ("qqqq", True),
    }


def test_empty_vocabulary(spark, vocab):
    got = resolved(spark, vocab.limit(0), ["a"], 50)
    assert got == {"a": ("a", True)}


@pytest.fixture(scope="module")
def postings(spark):
    rows = [
        ("1", "hà nội", ["Java", None, " ", "nodejs", "Java"], [], None, "Data Engineer!"),
        ("2", None, None, ["teamwork"], ["computer science"], ""),
        ("3", "Mars", [], ["New skill", "teamwork"], ["x"], "Data engineer"),
    ]
    columns = (
        "_id STRING, location STRING, tech_stack ARRAY<STRING>, soft_skills ARRAY<STRING>,"
        " major ARRAY<STRING>, job_position STRING"
    )
    return spark.createDataFrame(rows, columns)


def test_lists_keep_order_repeats_and_nulls(postings, vocab):
    mapping = n.field_mapping(postings, vocab, threshold=None)
    got = {r["_id"]: r for r in n.silver_postings(postings, mapping).collect()}
    assert got["1"]["tech_stack"] == ["Java", "Node.js", "Java"]
    assert got["2"]["tech_stack"] is None
    assert got["3"]["tech_stack"] == []
    assert got["1"]["soft_skills"] == [] and got["1"]["major"] is None
    assert got["2"]["location"] is None and got["2"]["job_position"] is None
    assert got["3"]["soft_skills"] == ["New skill", "Teamwork"]
    assert got["1"]["job_position"] == got["3"]["job_position"] == "Data Engineer"


def test_one_pass_equals_combined_fields(postings, vocab):
    one = n.silver_postings(postings, n.field_mapping(postings, vocab))
    parts = [
        n.silver_location(postings, vocab), n.silver_major(postings, vocab),
        n.silver_soft_skills(postings, vocab), n.silver_tech_stack(postings, vocab),
        n.silver_job_position(postings, vocab),
    ]
    combined = n.promote_normalized(n.silver_combine(postings, *parts)).select(*one.columns)
    assert sorted(map(str, one.collect())) == sorted(map(str, combined.collect()))


def test_vocabulary_values_are_fixed_points(spark, vocab):
    for category, terms in TERMS.items():
        got = resolved(spark, vocab, terms, 50, category)
        assert got == {t: (t, False) for t in terms}


def test_evolution_skips_frozen_categories(spark, postings, vocab):
    mapping = n.field_mapping(postings, vocab, threshold=None)
    added = {(r["category"], r["value"]) for r in v.new_values(mapping).collect()}
    assert {("soft_skills", "New skill"), ("location", "Mars"), ("major", "x")} <= added
    evolved = v.evolve_vocab(vocab, v.new_values(mapping))
    by_category = {
        r["category"]: r["l"]
        for r in evolved.groupBy("category")
        .agg(F.array_sort(F.collect_list(F.struct("ord", "value"))).alias("l"))
        .collect()
    }
    names = {c: [x["value"] for x in rows] for c, rows in by_category.items()}
    assert names["soft_skills"] == sorted([*TERMS["soft_skills"], "New skill"])
    assert names["location"] == TERMS["location"]
    assert names["tech_stack"] == TERMS["tech_stack"]


def test_shuffle_join_of_a_large_mapping_gives_the_same(spark, postings, vocab):
    mapping = n.field_mapping(postings, vocab)
    expected = sorted(map(str, n.silver_postings(postings, mapping).collect()))
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, n.silver_postings(postings, mapping).collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
