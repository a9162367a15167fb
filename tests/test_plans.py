"""What the physical plans must and must not hold."""

import re

import pytest
from pyspark.sql import functions as F

from skilltide.operators import demand as q
from skilltide.operators import extract as e
from skilltide.operators import ingest as i
from skilltide.operators import normalize as n
from skilltide.operators import titles
from skilltide.registry import shapes
from skilltide.registry.core import AS_OF, table
from skilltide.session import saved
from skilltide.sources.warehouse import read_title_index, save_serving, save_title_index


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_request_filters_reach_the_scan(spark, sf_dir):
    jobs = saved(shapes.serving(spark, sf_dir).jobs, "jobs")
    request = q.Request("x", locations=["NATION_1"], levels=["5-LOW"])
    text = plan(q.filter_jobs(jobs, request, AS_OF))
    pushed = text[text.index("PushedFilters") :]
    assert "GreaterThanOrEqual(posted_date" in pushed
    assert "EqualTo(location,NATION_1)" in pushed and "EqualTo(seniority_level,5-LOW)" in pushed


def test_month_filter_prunes_partitions(spark, sf_dir, tmp_path):
    jobs = shapes.serving(spark, sf_dir).jobs.withColumn("month", F.trunc("posted_date", "month"))
    path = str(tmp_path / "jobs")
    jobs.write.partitionBy("month").parquet(path)
    month = spark.read.parquet(path)
    text = plan(i.bronze_slice(month, "2000-03-01", "month").select("id"))
    assert "PartitionFilters: [isnotnull(month" in text and "ReadSchema: struct<id:bigint>" in text


def test_insert_keeps_one_row_per_key_before_the_shuffle(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    text = plan(i.insert_if_absent(events, None, "user_id", ["ts", "event_id"]))
    assert text.count("Exchange") == 1
    assert text.index("partial_min_by") > text.index("Exchange")  # printed bottom up


def test_small_mapping_needs_no_join(spark, sf_dir):
    postings = saved(shapes.postings(spark, sf_dir), "postings")
    mapping = n.field_mapping(postings, shapes.vocab(spark, sf_dir), threshold=None)
    text = plan(n.apply_mapping(postings, mapping)).split("Subquery")[0]
    assert "Join" not in text and "Exchange" not in text


def test_pairs_are_not_shuffled_for_few_matched_jobs(spark, sf_dir):
    s = shapes.serving(spark, sf_dir)
    pairs = saved(s.job_skills, "pairs")
    matched = q.matched_jobs_of(s.jobs, q.Request("red widget"), s.alias, AS_OF)
    text = plan(q.skill_stats(matched, pairs, saved(s.skills, "skills")))
    join = text.index("BroadcastHashJoin [job_id")
    assert "Exchange hashpartitioning(job_id" not in text and join > 0


def test_bucketed_serving_tables_join_without_a_shuffle(spark, sf_dir, tmp_path):
    s = shapes.serving(spark, sf_dir)
    tables = {"jobs": s.jobs, "skills": s.skills, "job_skills": s.job_skills}
    save_serving(tables, "serving_test", str(tmp_path), 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        jobs, pairs = spark.table("serving_test.jobs"), spark.table("serving_test.job_skills")
        assert "Exchange" not in plan(jobs.join(pairs, jobs["id"] == pairs["job_id"]))
        assert jobs.count() == s.jobs.count()
        recent = plan(q.filter_jobs(jobs, q.Request("red widget"), AS_OF))
        assert "(month#" in recent[recent.index("PartitionFilters") : recent.index("PushedFilters")]
        kept = q.Serving(jobs, spark.table("serving_test.skills"), pairs, s.alias)
        requests = q.requests_frame(spark, [q.Request("red widget"), q.Request("hot", request_id=2)])
        expected = q.skill_demand_batch(s, requests, AS_OF).collect()
        assert sorted(map(str, q.skill_demand_batch(kept, requests, AS_OF).collect())) == sorted(
            map(str, expected)
        )
        assert len(expected) > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        spark.sql("DROP SCHEMA serving_test CASCADE")


def test_large_target_is_not_shuffled_for_a_small_batch(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    target = saved(events.filter("event_id > 10"), "target")
    text = plan(i.insert_if_absent(events, target, "event_id", ["ts"]))
    scan = text[text.index("LeftSemi") :]
    assert "LeftSemi" in text and "Exchange hashpartitioning" not in scan


def test_hot_value_is_split_when_the_mapping_is_too_large_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(n, "_fits_a_task", lambda mapping: False)
    value = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("v"), "id"))
    df = spark.range(0, 60_000, 1, 8).select(F.col("id").alias("_id"), value.alias("location"))
    mapping = saved(
        df.select(F.lit("location").alias("category"), F.col("location").alias("raw")).distinct()
        .withColumn("value", F.upper("raw")),
        "mapping",
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {k: spark.conf.get(k) for k in settings}
    for k, x in settings.items():
        spark.conf.set(k, x)
    try:
        out = n.apply_mapping(df, mapping, ("location",), ())
        assert out.filter("normalized_location = 'HOT'").count() == 20_000
        execution = out._jdf.queryExecution()
        execution.toRdd().count()
        assert "skew=true" in execution.executedPlan().toString()
    finally:
        for k, x in before.items():
            spark.conf.set(k, x)


@pytest.fixture()
def stored(spark, sf_dir, tmp_path):
    s = shapes.serving(spark, sf_dir)
    save_serving({"jobs": s.jobs, "skills": s.skills, "job_skills": s.job_skills}, "index_test", str(tmp_path), 2)
    tables = [spark.table(f"index_test.{t}") for t in ("jobs", "skills", "job_skills")]
    yield s, q.Serving(*tables, s.alias, read_title_index(spark, "index_test"))
    spark.sql("DROP SCHEMA index_test CASCADE")


ASKED = [
    q.Request("red widget"), q.Request("hot", request_id=2), q.Request("Gizmoo", request_id=3),
    q.Request("Gizmoo", locations=["NATION_1", "NATION_2"], request_id=4), q.Request("zzz", request_id=5),
    q.Request("red", updated_after="1995-01-01", levels=["1-URGENT"], request_id=6), q.Request("", request_id=7),
]


def test_stored_index_answers_like_the_postings_and_cuts_no_title(spark, stored, monkeypatch):
    plain, kept = stored
    asked = q.requests_frame(spark, ASKED)
    expected = sorted(map(str, q.skill_demand_batch(plain, asked, AS_OF).collect()))
    one_by_one = [sorted(map(str, q.skill_demand(plain, r, AS_OF).collect())) for r in ASKED]
    assert len(expected) > 20

    def never(*args, **kwargs):
        raise AssertionError("titles are cut")

    for name in ("tokens", "space_tokens", "trigrams", "title_index", "index_of_titles"):
        monkeypatch.setattr(titles, name, never)
    monkeypatch.setattr(q, "title_index", never)
    monkeypatch.setattr(q, "index_of_titles", never)
    plans = []
    real = q.saved

    def spy(df, name):
        plans.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, name)

    monkeypatch.setattr(q, "saved", spy)
    assert sorted(map(str, q.skill_demand_batch(kept, asked, AS_OF).collect())) == expected
    assert [sorted(map(str, q.skill_demand(kept, r, AS_OF).collect())) for r in ASKED] == one_by_one
    # the index is read from the window's months on, and postings only once titles are chosen
    reached = [p for name, p in plans if name == "reached"]
    assert all("title_terms" in p and "month#" in p[p.index("PartitionFilters") :] for p in reached)
    assert not any("index_test.jobs" in p for name, p in plans if name != "matched")


def test_trigrams_are_read_for_requests_left_empty_only(spark, stored, monkeypatch):
    _, kept = stored
    seen = []
    real = q.match_fuzzy_title
    monkeypatch.setattr(q, "match_fuzzy_title", lambda i, r, *few: seen.append({x["request_id"] for x in r.collect()}) or real(i, r, *few))
    q.skill_demand_batch(kept, q.requests_frame(spark, ASKED[:1]), AS_OF).collect()
    assert seen == []
    q.skill_demand_batch(kept, q.requests_frame(spark, ASKED), AS_OF).collect()
    assert len(seen) == 1 and 1 not in seen[0] and 5 in seen[0]


def test_a_month_of_the_index_is_replaced_alone(spark, sf_dir, tmp_path):
    s = shapes.serving(spark, sf_dir)
    jobs = s.jobs.filter("posted_date >= '1998-01-01'")
    spark.sql("CREATE SCHEMA month_test")
    try:
        save_title_index(jobs, "month_test", str(tmp_path), 2)
        month = jobs.filter("posted_date >= '1998-03-01' AND posted_date < '1998-04-01'")
        other = month.withColumn("job_title", F.lit("Only title"))
        save_title_index(other, "month_test", str(tmp_path), 2)
        index = read_title_index(spark, "month_test")
        whole = jobs.filter("NOT (posted_date >= '1998-03-01' AND posted_date < '1998-04-01')").unionByName(other)
        fresh = titles.title_index(whole)
        for part in titles.KEYS:
            got, expected = getattr(index, part), getattr(fresh, part)
            assert sorted(map(str, got.select(*expected.columns).collect())) == sorted(map(str, expected.collect())), part
    finally:
        spark.sql("DROP SCHEMA month_test CASCADE")


def test_beyond_a_small_mapping_only_items_move(spark, sf_dir, monkeypatch):
    posted = shapes.postings(spark, sf_dir).withColumn("payload", F.repeat(F.lit("x"), 500))
    postings = saved(posted, "postings")
    vocab = shapes.vocab(spark, sf_dir)
    mapping = n.field_mapping(postings, vocab, threshold=None)
    expected = sorted(map(str, n.apply_mapping(postings, mapping).collect()))
    monkeypatch.setattr(n, "_fits_a_task", lambda mapping: False)
    out = n.apply_mapping(postings, mapping)
    text = plan(out)
    for exchange in re.findall(r"Exchange [^\n]*(?:\n[^\n]*)", text):
        assert "payload" not in exchange
    assert "Bucketed: true" in text and "ShuffledHashJoin" in text
    above = text[: text.index("ShuffledHashJoin")]
    assert "Exchange" not in above and "Sort" not in above
    left = text[text.index("ShuffledHashJoin") :]
    left = left[: left.index("Exchange")]
    assert "payload" in left  # the postings' side: scan and join, nothing between
    assert sorted(map(str, out.collect())) == expected


@pytest.mark.parametrize("limit", ["none", "rows", "bytes"])
def test_entities_move_as_hits_only(spark, monkeypatch, limit):
    terms = ["the", "of the", "the cat sat", "the cat sat on the mat", "mat the", "cat", "on", "on the mat and more words here", "x y z w v"]
    texts = ["the cat sat on the mat", "of the the cat", "", None, "x y z w v x y z w", "on the mat and more words", "on the mat and more words here", "The CAT!"]
    vocab = spark.createDataFrame([("c%d" % (k % 2), t, k) for k, t in enumerate(terms)], "category STRING, value STRING, ord INT")
    docs = saved(spark.createDataFrame(list(enumerate(texts)), "id INT, text STRING"), "texts")
    if limit == "rows":
        monkeypatch.setattr(e, "is_small", lambda df: False)
    if limit == "bytes":
        monkeypatch.setattr(e, "TERM_BYTES", 10)
    found = e.extract_entities(docs, vocab, "id", "text")
    expected = set()
    for n, text in enumerate(texts):
        words = re.findall("[a-z]+", (text or "").lower())
        for k, t in enumerate(terms):
            if any(words[i : i + len(t.split())] == t.split() for i in range(len(words))):
                expected.add((n, "c%d" % (k % 2), t))
    assert {(r["id"], r["category"], t) for r in found.collect() for t in r["terms"]} == expected
    text = plan(found)
    for exchange in re.findall(r"Exchange hashpartitioning[^\n]*\n[^\n]*", text):
        assert "_words" not in exchange
    assert ("getbit" in text) == (limit != "none") and "Python" not in text
