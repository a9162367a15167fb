"""Demand queries on a small set of tables."""

import pytest

from skilltide.operators import demand as q

AS_OF = "2025-06-30"


@pytest.fixture(scope="module")
def serving(spark):
    jobs = [
        (1, "Senior Java Developer", "Ha Noi", "Senior", "2025-06-01"),
        (2, "Java Developer", "Ha Noi", "Junior", "2025-05-01"),
        (3, "Java Developer", "Da Nang", "Junior", "2025-04-01"),
        (4, "Data Engineer", "Ha Noi", "Senior", "2025-06-01"),
        (5, "Data Engineer", "Ha Noi", "Senior", "2024-01-01"),
        (6, "Kỹ sư dữ liệu", "Ha Noi", "Senior", None),
        (1, "Senior Java Developer", "Ha Noi", "Lead", "2025-06-01"),
    ]
    skills = [("a", "Java", "tech"), ("b", "SQL", "tech"), ("c", "Teamwork", "soft"), ("d", "Git", "tech")]
    pairs = [(1, "a"), (1, "c"), (2, "a"), (2, "b"), (3, "a"), (3, "d"), (4, "b"), (5, "b"), (6, "b")]
    job_frame = spark.createDataFrame(
        jobs, "id LONG, job_title STRING, location STRING, seniority_level STRING, d STRING"
    )
    return q.Serving(
        job_frame.selectExpr("* EXCEPT (d)", "CAST(d AS DATE) AS posted_date").cache(),
        spark.createDataFrame(skills, "id STRING, name STRING, type STRING"),
        spark.createDataFrame(pairs, "job_id LONG, skill_id STRING"),
        spark.createDataFrame(
            [("Data Engineer", "de"), ("Dba", "de"), ("QA/QC Engineer", "qa"), ("DevOps Engineer", "dev ops")],
            "job_word STRING, keyword STRING",
        ),
    )


def page(serving, **request):
    rows = q.skill_demand(serving, q.Request(**request), AS_OF).collect()
    return [(r["skill_name"], r["frequency"], r["matched_job_count"]) for r in rows]


def test_direct_match_counts_a_job_once(serving):
    assert page(serving, job_title="java developer") == [
        ("Java", "100.0%", 3), ("Git", "33.3%", 3), ("SQL", "33.3%", 3), ("Teamwork", "33.3%", 3),
    ]


def test_alias_beats_direct_and_first_word_wins(serving):
    # "de" names two words; Data Engineer sorts before Dba.
    assert page(serving, job_title="DE") == [("SQL", "100.0%", 1)]


def test_fuzzy_is_the_last_resort(serving):
    assert page(serving, job_title="javaa")[0][0] == "Java"
    assert page(serving, job_title="zzz") == []


def test_filters(serving):
    assert page(serving, job_title="java", locations=["Da Nang"]) == [
        ("Git", "100.0%", 1), ("Java", "100.0%", 1),
    ]
    assert page(serving, job_title="java", levels=["Lead"]) == [
        ("Java", "100.0%", 1), ("Teamwork", "100.0%", 1),
    ]
    assert page(serving, job_title="data engineer", updated_after="2023-01-01") == [
        ("SQL", "100.0%", 2),
    ]
    assert page(serving, job_title="java", locations=[]) == []


def test_missing_date_never_passes(serving):
    ids = q.filter_jobs(serving.jobs, q.Request("x", updated_after="1900-01-01"), AS_OF)
    assert 6 not in {r["id"] for r in ids.collect()}


def test_pages_join_to_the_whole(serving):
    whole = page(serving, job_title="java", limit=100)
    got, cursor = [], {}
    while True:
        request = q.Request("java", limit=1, **cursor)
        rows = q.skill_demand(serving, request, AS_OF)
        got += [(r["skill_name"], r["frequency"], r["matched_job_count"]) for r in rows.collect()]
        after = q.next_cursors(rows, q.requests_frame(serving.jobs.sparkSession, [request])).collect()
        if not after:
            break
        cursor = {"last_freq": float(after[0]["last_freq"]), "last_name": after[0]["last_name"]}
    assert got == whole


def test_batch_equals_single_requests(spark, serving):
    requests = [
        q.Request("java developer", request_id=1),
        q.Request("de", request_id=2),
        q.Request("javaa", request_id=3, limit=2),
        q.Request("java", request_id=4, levels=["Junior"], locations=["Ha Noi", "Da Nang"]),
        q.Request("nothing here", request_id=5),
        q.Request("java", request_id=6, last_freq=100.0, last_name="Java"),
        q.Request("data engineer", request_id=7, updated_after="2020-01-01"),
    ]
    batch = q.skill_demand_batch(serving, q.requests_frame(spark, requests), AS_OF)
    expected = [str(r) for x in requests for r in q.skill_demand(serving, x, AS_OF).collect()]
    assert sorted(map(str, batch.collect())) == sorted(expected)
    meta = {r["request_id"]: r["count"] for r in q.page_meta(batch, q.requests_frame(spark, requests)).collect()}
    assert meta[5] == 0 and meta[3] == 2


def test_shuffle_joins_give_the_same(spark, serving, monkeypatch):
    requests = q.requests_frame(
        spark, [q.Request(t, request_id=n) for n, t in enumerate(("java", "de", "javaa", "zzz"))]
    )
    expected = sorted(map(str, q.skill_demand_batch(serving, requests, AS_OF).collect()))
    monkeypatch.setattr(q, "broadcaster", lambda df: lambda side: side)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(str, q.skill_demand_batch(serving, requests, AS_OF).collect())) == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_whole_keyword_alias(spark, serving):
    asked = q.requests_frame(spark, [q.Request("Dev Ops", request_id=1), q.Request("my dev ops", request_id=2)])
    got = {r["request_id"]: r["job_word"] for r in q.match_alias(asked, serving.alias).collect()}
    assert got == {1: "DevOps Engineer"}


@pytest.mark.parametrize("bad", [{"limit": 0}, {"limit": 101}, {"updated_after": "2025-02-30"}])
def test_request_bounds(bad):
    with pytest.raises(ValueError):
        q.Request("x", **bad)


def test_levels_in_their_order(serving):
    by_name = [r[0] for r in q.distinct_levels(serving.jobs).collect()]
    listed = [r[0] for r in q.distinct_levels(serving.jobs, ["Junior", "Senior"]).collect()]
    assert by_name == ["Senior", "Lead", "Junior"] and listed == ["Junior", "Senior", "Lead"]


def test_seed_alias(spark):
    assert q.alias_frame(spark).count() == 25
