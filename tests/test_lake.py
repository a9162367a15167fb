"""Ingest, gold model, loads and runs."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from skilltide.functions.postings import assemble_sections
from skilltide.operators import checks
from skilltide.operators import demand as q
from skilltide.operators import extract as e
from skilltide.operators import ingest as i
from skilltide.operators import model as m
from skilltide.operators import vocab as v
from skilltide.operators.positions import global_position
from skilltide.operators.vocab import load_vocab
from skilltide.plans import lake
from skilltide.plans.stats import read_stats, refresh_stats
from skilltide.schemas import PARSED_POSTING, RAW_POSTING, RAW_POSTING_ALT, WAREHOUSE
from skilltide.sources import files, listings
from skilltide.sources.warehouse import load_table, read_table
from skilltide.streaming import ingest as streams
from skilltide.streaming.ingest import ingest_stream, read_ingested


def rows(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("small", [True, False])
def test_insert_twice_is_insert_once(spark, monkeypatch, small):
    monkeypatch.setattr(i, "is_small", lambda df: small)
    new = spark.createDataFrame([("h1", 2, "b"), ("h1", 1, "a"), ("h2", 3, "c")], "hash STRING, n INT, x STRING")
    first = i.insert_if_absent(new, None, "hash", ["n"])
    assert rows(first) == [("h1", 1, "a"), ("h2", 3, "c")]
    assert i.insert_if_absent(new, first, "hash", ["n"]).count() == 0


def test_global_position_with_a_hot_value(spark):
    data = [("same" if x % 3 else "other", x) for x in range(2000)]
    df = spark.createDataFrame(data, "k STRING, x INT").repartition(7)
    got = {(r["k"], r["x"]): r["position"] for r in global_position(df, ["k", "x"]).collect()}
    assert got == {row: p for p, row in enumerate(sorted(data), 1)}


def test_batch_slice(spark):
    df = spark.createDataFrame([(x, f"row {x}") for x in range(25)], "x INT, wide STRING")
    got = i.batch_slice(df, ["x"], 10, 1, 1)
    assert sorted(r["x"] for r in got.collect()) == list(range(10, 20))
    assert i.batch_slice(df, ["x"], 10, 2).count() == 5
    assert i.batch_count(df, 10).first()["batches"] == 3


def test_months(spark):
    got = [str(r["month"]) for r in i.months(spark, "2025-01-01", "2025-03-31").collect()]
    assert got == ["2025-01-01", "2025-02-01", "2025-03-01", "2025-04-01"]


def test_bronze_slice_on_text_and_december(spark):
    df = spark.createDataFrame([("2024-12-31",), ("2024-12-01",), ("2025-01-01",), (None,)], "posted_date STRING")
    assert i.bronze_slice(df, "2024-12-01").count() == 2


def test_valid_postings_and_rejects(spark):
    good = {"job_title": "t", "company_name": "c", "url": "https://x", "full_text_jd": "text"}
    cases = [good] + [{**good, k: x} for k, x in [
        ("job_title", ""), ("company_name", None), ("url", "ftp://x"), ("full_text_jd", "\n \u00a0"),
    ]]
    df = spark.createDataFrame([tuple(c.get(f) for f in RAW_POSTING.names) for c in cases], RAW_POSTING)
    assert i.valid_postings(df).count() == 1
    assert df.filter(~i.posting_is_valid()).count() == 4


def test_land_listing_and_second_shape(spark):
    body = ('{"data": [{"id": 1, "title": "Dev", "company": {"display_name": "Acme"}, "detail_url": "https://j/1",'
            ' "refreshed": {"date": "2025-01-02 x"}, "addresses": {"sort_addresses": "A, Ha Noi"}},'
            ' {"id": 2, "title": "No company", "detail_url": "https://j/2"}]}')
    listing = listings.from_listing_a(spark.createDataFrame([(body,)], "body STRING"), source="a")
    texts = spark.createDataFrame([("https://j/1", "text"), ("https://j/2", "text")], "url STRING, full_text_jd STRING")
    landed = i.raw_postings(listing, texts, "2025-01-03 00:00:00")
    other = spark.createDataFrame([("https://k/dev-9?x", "Dev", "2025-01-02", "Acme", "f", "s", "e", "req")], RAW_POSTING_ALT)
    both = i.union_sources(landed, i.from_alt_posting(other, "e"))
    got = both.select("source", "source_id", "location", "full_text_jd", "hash").collect()
    assert [tuple(r)[:4] for r in got] == [("a", "1", "Ha Noi", "text"), ("e", "9", None, "req")]
    assert i.insert_if_absent(both, None, "hash", ["source"]).count() == 1


def test_listing_b_without_places(spark):
    body = ('{"data": [{"jobTitle": "t", "companyName": "c", "jobUrl": "", "alias": "dev-", "jobId": 7,'
            ' "approvedOn": "2025-01-02T00:00:00"},'
            ' {"jobTitle": "u", "jobUrl": "u://", "jobId": 8, "workingLocations": []}]}')
    df = spark.createDataFrame([(body,), ('{"data": []}',), ("{}",)], "body STRING")
    got = listings.from_listing_b(df, "https://s").select("job_title", "url", "posted_date", "location")
    assert rows(got) == [("t", "https://s/dev-7-jv", "2025-01-02", "Unknown"), ("u", "u://", "", "Unknown")]


def test_listing_cards_and_job_page(spark):
    card = ('<ul><li><a class="base-card__full-link x" href="https://l/j-5?t">x</a>'
            '<h3 class="base-search-card__title"> Dev &amp; Ops </h3><h4 class="base-search-card__subtitle"><a>Acme</a></h4>'
            '<span class="job-search-card__location">Ha Noi</span><time datetime="2025-05-01">now</time></li>'
            "<li>no fields</li></ul>")
    df = spark.createDataFrame([(card,)], "html STRING")
    assert rows(listings.from_listing_html(df)) == [("Dev & Ops", "Acme", "Ha Noi", "2025-05-01", "https://l/j-5?t")]
    job = ('<title>Dev làm việc tại Acme</title><div class="company-name">Acme</div>'
           '<div class="job-detail__company--information-item company-field"><div class="company-value">IT</div></div>'
           '<div class="job-detail__info--section-content-title">Kinh nghiệm</div>'
           '<div class="job-detail__info--section-content-value">2 năm</div>'
           '<div class="job-description__item"><h3>Mô tả</h3><div>no</div></div>'
           '<div class="job-description__item"><h3>Yêu cầu ứng viên</h3><div><p>Java</p></div></div>')
    page = spark.createDataFrame([("u", job)], "url STRING, html STRING")
    assert rows(listings.from_job_html(page)) == [
        ("u", "Dev", "Acme", "IT", "", "2 năm", "Yêu cầu ứng viên\nJava"),
    ]


def test_sections_of_a_job_page(spark):
    html = ('<div class="imy-5 paragraph"><h2>Top 3 reasons</h2><p>no</p></div>'
            '<div class="imy-5 paragraph"><h2> Job description</h2><ul><li>Build &lt;x&gt;</li><li>Test</li></ul></div>'
            '<div class="imy-5 paragraph"><h2>Your skills</h2>Java</div>')
    page = spark.createDataFrame([(html,), ("<p></p>",)], "html STRING")
    got = [r[0] for r in page.select(assemble_sections(listings.page_blocks("html"))).collect()]
    assert got == [
        "Job description:\nJob description\nBuild <x>\nTest\n\nYour skills:\nYour skills\nJava", "",
    ]


def test_layer_replaces_only_its_month(spark, tmp_path):
    def month(day, x):
        return spark.createDataFrame([(x, dt.date.fromisoformat(day))], "x INT, month DATE")

    for day, x in (("2025-01-01", 1), ("2025-02-01", 2), ("2025-01-01", 3)):
        files.write_layer(month(day, x), str(tmp_path), "bronze", "t")
    assert sorted(r["x"] for r in files.read_layer(spark, str(tmp_path), "bronze", "t").collect()) == [2, 3]
    assert files.read_layer(spark, str(tmp_path), "bronze", "t", "2025-02-01").first()["x"] == 2


def test_warehouse_month_and_missing_table(spark, tmp_path):
    dim = spark.createDataFrame([("1", "a")], "id STRING, name STRING")
    assert load_table(dim, str(tmp_path), "major_table", "2025-01-01")
    assert load_table(dim, str(tmp_path), "major_table", "2025-02-01")
    assert load_table(dim, str(tmp_path), "major_table", "2025-01-01")
    assert not load_table(dim.limit(0), str(tmp_path), "major_table", "2025-01-01")
    # the month that is loaded empty is gone, the other stays
    assert [str(r["month"]) for r in read_table(spark, str(tmp_path), "major_table").collect()] == ["2025-02-01"]
    assert read_table(spark, str(tmp_path), "tech_skill_table").columns == ["id", "name", "month"]


def test_stream_equals_batch_and_repeats_nothing(spark, tmp_path):
    schema = "hash STRING, n INT"
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    first = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], schema)
    first.coalesce(1).write.parquet(source)

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        ingest_stream(stream, target, "hash", ["n"], str(tmp_path / "cp")).awaitTermination()
        return rows(read_ingested(spark, target))

    assert run() == rows(i.insert_if_absent(first, None, "hash", ["n"]))
    spark.createDataFrame([("b", 0), ("c", 4)], schema).write.mode("append").parquet(source)
    assert run() == [("a", 1), ("b", 3), ("c", 4)]


@pytest.fixture(scope="module")
def silver(spark):
    data = [
        ("1", "t", "c", "l", "2025-01-05", "u", "d", "s", ["Senior", "Lead"], "Dev", ["x", "y", "x"], ["z"], None),
        ("2", "t", "c", "l", "2025-01-06", "u", "d", "s", [], None, [], None, ["m", None]),
        ("3", "t", "c", "l", "2025-02-30", "u", "d", "s", None, "Dev", None, ["x"], ["m"]),
    ]
    return spark.createDataFrame(data, PARSED_POSTING)


def test_fact_rows_per_level(silver):
    got = sorted((r["id"], r["seniority_level"] or "") for r in m.job_fact(silver).collect())
    assert got == [("1", "Lead"), ("1", "Senior"), ("2", ""), ("3", "")]
    joined = m.with_position_id(m.job_fact(silver), silver, m.dim_position(silver))
    direct = m.job_table(silver)
    assert sorted(map(str, joined.select(*direct.columns).collect())) == sorted(map(str, direct.collect()))
    assert m.joined_positions(direct).first()["joined"] == 3
    assert m.joined_positions(m.with_position_id(m.job_fact(silver), silver, None)).first()["joined"] == 0


def test_null_member_of_dimensions(silver):
    assert {r["name"] for r in m.dim_tech_skill(silver).collect()} == {"x", "y"}
    assert {r["name"] for r in m.dim_tech_skill(silver, True).collect()} == {"x", "y", None}
    assert {r["name"] for r in m.dim_major(silver, True).collect()} == {"m", None}


def test_bridges_keep_repeats_and_stay_in_the_dimension(silver):
    dim = m.dim_tech_skill(silver)
    for pairs in (m.bridge_tech_skill(silver), m.bridge_tech_skill(silver, dim)):
        assert pairs.count() == 3
        assert pairs.join(dim, pairs["tech_skill_id"] == dim["id"], "left_anti").count() == 0
    assert m.bridge(silver, "tech_stack", "x", distinct=True).count() == 2
    assert m.bridge_tech_skill(silver, dim.filter("name = 'y'")).count() == 1


def test_serving_tables_pass_the_constraints(spark, silver):
    tables = m.serving_tables(m.gold_tables(silver))
    types = {r["name"]: r["type"] for r in tables["skills"].collect()}
    assert types == {"x": "tech", "y": "tech", "z": "soft"}
    alias = spark.createDataFrame([("a", "b")], "job_word STRING, keyword STRING")
    report = checks.check_constraints(tables["jobs"], tables["skills"], tables["job_skills"], alias)
    found = {(r["table_name"], r["rule"]) for r in report.filter("violations > 0").collect()}
    assert found == {("jobs", "seniority_level not null")}
    # A day that does not exist is no date.
    assert {str(r["posted_date"]) for r in tables["jobs"].collect()} == {"2025-01-05", "2025-01-06", "None"}


def test_lake_and_warehouse_month(spark, silver, tmp_path):
    vocab = v.with_keys(spark.createDataFrame([("tech_stack", "x", 0)], "category STRING, value STRING, ord INT"))
    root = str(tmp_path / "lake")
    for _ in range(2):
        metrics = lake.run_datalake(silver, vocab, root, "2025-01-01")
    assert metrics["bronze.job_descriptions"]["row_count"] == 2
    assert metrics["gold.job_tech_skill_mapping"]["row_count"] == 3
    metrics = lake.run_datalake(silver, vocab, root, "2025-02-01")
    assert metrics["silver.job_descriptions"] == {
        "row_count": 1, "column_count": 14, "partition": "2025-02-01", "status": "success",
    }
    assert files.read_layer(spark, root, "silver", "job_descriptions").count() == 3
    assert "y" in {r["value"] for r in spark.read.parquet(f"{root}/vocab/2025-01-01").collect()}
    done = lake.run_warehouse(spark, root, str(tmp_path / "wh"), "2025-01-01")
    assert set(done) == set(WAREHOUSE) and done["tech_skill_table"]
    assert read_table(spark, str(tmp_path / "wh"), "job_description_table", "2025-01-01").count() == 3


def test_empty_month(spark, silver, tmp_path):
    vocab = v.with_keys(spark.createDataFrame([("tech_stack", "x", 0)], "category STRING, value STRING, ord INT"))
    metrics = lake.run_datalake(silver, vocab, str(tmp_path), "2030-01-01")
    assert {x["status"] for x in metrics.values()} == {"empty"}


def test_backfill_equals_months(spark, silver, tmp_path):
    vocab = v.with_keys(spark.createDataFrame([("tech_stack", "x", 0)], "category STRING, value STRING, ord INT"))
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    lake.backfill(silver, vocab, one, "2025-01-01", "2025-02-01", threshold=None)
    for month in ("2025-01-01", "2025-02-01"):
        lake.run_datalake(silver, vocab, two, month, threshold=None)
    for table in WAREHOUSE:
        a, b = (files.read_layer(spark, r, "gold", table) for r in (one, two))
        assert sorted(map(str, a.collect())) == sorted(map(str, b.select(*a.columns).collect()))


def test_cascade_delete(spark):
    child = spark.createDataFrame([(1, "a"), (2, "b")], "job_id INT, skill_id STRING")
    assert rows(checks.cascade_delete(child, spark.createDataFrame([(1,)], "id INT"), "job_id")) == [(2, "b")]


@pytest.mark.parametrize("small", [True, False])
def test_entities_match_whole_tokens(spark, monkeypatch, small):
    monkeypatch.setattr(e, "is_small", lambda df, *a: small)
    terms = [("tech_stack", "C++", 0), ("tech_stack", "C", 1), ("tech_stack", "Java", 2),
             ("tech_stack", "Spring Boot", 3), ("soft_skills", "Làm việc nhóm", 0), ("tech_stack", "JAVA", 4)]
    vocab = v.with_keys(spark.createDataFrame(terms, "category STRING, value STRING, ord INT"))
    docs = spark.createDataFrame(
        [(1, "Java, C++; spring-boot & JavaScript"), (2, "lam viec NHOM"), (3, ""), (4, "spring. boots")],
        "id INT, text STRING",
    )
    got = {(r["id"], r["category"]): r["terms"] for r in e.extract_entities(docs, vocab, "id", "text").collect()}
    assert got == {(1, "tech_stack"): ["C++", "JAVA", "Spring Boot"], (2, "soft_skills"): ["Làm việc nhóm"]}


def test_levels(spark):
    df = spark.createDataFrame([("Senior / Staff  engineer",), ("seniors",), ("",)], "t STRING")
    got = [r[0] for r in df.select(e.extract_levels("t")).collect()]
    assert got == [["Senior", "Staff Engineer"], ["Else"], ["Else"]]


def test_merge_parsed_by_key_presence(spark):
    meta = [("1", "raw title", None, "loc", "2025-01-01", "u"), ("2", "b", "c", "l", "d", "u")]
    raw = spark.createDataFrame(meta, "_id STRING, job_title STRING, company_name STRING, location STRING, posted_date STRING, url STRING")
    body = '{"job_title": "parsed", "location": null, "tech_stack": ["a", "a"], "salary": "10"}'
    parsed = spark.createDataFrame([("1", body), ("2", None)], "_id STRING, body STRING")
    got = e.merge_parsed(raw, parsed, "2025-02-02").collect()
    assert len(got) == 1
    row = got[0]
    assert (row["job_title"], row["company_name"], row["location"]) == ("parsed", "", None)
    assert (row["tech_stack"], row["salary"], row["major"]) == (["a"], "10", None)


def test_run_parse(spark):
    vocab = v.with_keys(spark.createDataFrame(
        [("tech_stack", "Java", 0), ("job_position", "Backend Developer", 0), ("seniority_level", "Senior", 0)],
        "category STRING, value STRING, ord INT"))
    raw = spark.createDataFrame(
        [("1", "Senior backend developer", "c", "l", "2025-01-01", "u", "We use java. Java!"),
         ("2", "x", "c", "l", "2025-01-01", "u", "nothing"), ("3", "done", "c", "l", "d", "u", "java")],
        "_id STRING, job_title STRING, company_name STRING, location STRING, posted_date STRING, url STRING, full_text_jd STRING")
    got = {r["_id"]: r for r in lake.run_parse(raw, raw.filter("_id = '3'"), vocab, "2025-02-02").collect()}
    assert set(got) == {"1", "2"}
    assert got["1"]["tech_stack"] == ["Java"] and got["1"]["job_position"] == "Backend Developer"
    assert got["1"]["seniority_level"] == ["Senior"] and got["2"]["tech_stack"] is None
    one = lake.run_parse(raw, raw.filter("_id = '3'"), vocab, "2025-02-02", limit=1).collect()
    assert len(one) == 1 and str(one[0]) == str(got[one[0]["_id"]])


def test_micro_batch_reads_its_prefixes_only(spark, tmp_path, monkeypatch):
    schema = "hash STRING, n INT"
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    many = spark.createDataFrame([(f"k{x}", x) for x in range(500)], schema)
    many.coalesce(1).write.parquet(source)
    seen = []
    real = streams.stored_part

    def spy(batch, stored):
        part = real(batch, stored)
        seen.append((part.inputFiles(), part._jdf.queryExecution().executedPlan().toString(), stored.inputFiles()))
        return part

    monkeypatch.setattr(streams, "stored_part", spy)

    def run():
        stream = spark.readStream.schema(schema).parquet(source)
        ingest_stream(stream, target, "hash", ["n"], str(tmp_path / "cp")).awaitTermination()

    run()
    spark.createDataFrame([("k7", -1), ("new", 1)], schema).coalesce(1).write.mode("append").parquet(source)
    run()
    (read, text, every) = seen[-1]
    assert "key_prefix" in text[text.index("PartitionFilters") : text.index("PushedFilters")]
    assert "ReadSchema: struct<hash:string" in text
    assert len(every) > 50
    prefixes = spark.createDataFrame([("k7",), ("new",)], "hash STRING").select(F.pmod(F.xxhash64("hash"), F.lit(64)))
    kept = spark.read.parquet(target)
    assert kept.filter(F.col("key_prefix").isin([r[0] for r in prefixes.collect()])).count() < 40
    assert read_ingested(spark, target).count() == 501


def test_fetched_payload_equals_carried(spark, tmp_path):
    wide = spark.range(0, 3000, 1, 4).select(
        (F.col("id") % 700).cast("string").alias("hash"), ((F.col("id") * 7919) % 1009).alias("n"), F.col("id"),
        F.repeat(F.md5(F.col("id").cast("string")), 20).alias("payload"), F.array("id").alias("more"),
    ).unionByName(spark.createDataFrame([(None, 1, -1, "x", [1]), (None, None, -2, "y", None)], "hash STRING, n LONG, id LONG, payload STRING, more ARRAY<LONG>"))
    path = str(tmp_path / "wide")
    wide.write.parquet(path)
    stored = spark.createDataFrame([(str(x),) for x in range(0, 700, 3)], "hash STRING")
    for new in (wide, spark.read.parquet(path)):
        for target in (None, stored):
            fetched = i.insert_if_absent(new, target, "hash", ["n", "id"], fetch_payload=True)
            assert fetched.columns == new.columns
            assert sorted(map(str, fetched.collect())) == sorted(map(str, i.insert_if_absent(new, target, "hash", ["n", "id"]).collect()))
    tied = wide.withColumn("n", F.lit(1))
    assert i.insert_if_absent(tied, None, "hash", ["n"], fetch_payload=True).count() == 701


@pytest.mark.parametrize("small", [True, False])
def test_payload_is_never_sorted(spark, tmp_path, monkeypatch, small):
    path = str(tmp_path / "wide")
    spark.range(2000).select((F.col("id") % 300).alias("k"), "id", F.repeat(F.lit("x"), 300).alias("payload")).write.parquet(path)
    plans = []
    real = i.saved
    monkeypatch.setattr(i, "saved", lambda df, name: plans.append(df._jdf.queryExecution().executedPlan().toString()) or real(df, name))
    monkeypatch.setattr(i, "is_small", lambda df: small)
    fetched = i.insert_if_absent(spark.read.parquet(path), None, "k", ["id"], fetch_payload=True)
    plan = fetched._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and ("BroadcastHashJoin" if small else "ShuffledHashJoin") in plan
    assert len(plans) == 1 and "payload#" not in plans[0] and "payload:" not in plans[0]
    assert fetched.count() == 300


# Months in one step -----------------------------------------------------------------------------


def _parsed(spark, titles, day):
    rows = [(f"{t}-{k}", t, "Acme", "Ha Noi", day, "u", ["Senior"], ["Java"], ["teamwork"], ["x"], "Data Engineer", "1", "2025-01-09") for k, t in enumerate(titles)]
    names = "_id job_title company_name location posted_date url seniority_level tech_stack soft_skills major job_position salary update_date".split()
    df = spark.createDataFrame(rows, names)
    return df.select(*PARSED_POSTING.names)


def _seen(spark, root):
    tables = files.snapshot(spark, root)
    return {t: sorted(map(str, files.read_layer(spark, root, *t.split("/")).collect())) for t in tables}


def test_a_run_that_fails_changes_nothing(spark, tmp_path, monkeypatch):
    root, vocab = str(tmp_path), load_vocab(spark, str(tmp_path / "none.json"))
    lake.run_datalake(_parsed(spark, ["a", "b"], "2025-01-05"), vocab, root, "2025-01-01", None)
    lake.run_datalake(_parsed(spark, ["c"], "2025-02-05"), vocab, root, "2025-02-01", None)
    before = _seen(spark, root)
    assert len(before) > 8

    real = lake.stage_layer

    def failing(at):
        def stage(df, root, layer, table, *rest):
            if (layer, table) == at:
                raise RuntimeError("lost")
            return real(df, root, layer, table, *rest)

        return stage

    again = _parsed(spark, ["x", "y", "z"], "2025-01-07")
    for at in (("silver", "job_descriptions"), ("gold", sorted(t.split("/")[1] for t in before if t.startswith("gold"))[0])):
        monkeypatch.setattr(lake, "stage_layer", failing(at))
        with pytest.raises(RuntimeError, match="lost"):
            lake.run_datalake(again, vocab, root, "2025-01-01", None)
        assert _seen(spark, root) == before
    monkeypatch.setattr(lake, "stage_layer", real)

    # a reader that began before a run ends with what it saw
    old = files.read_layer(spark, root, "bronze", "job_descriptions")
    lake.run_datalake(again, vocab, root, "2025-01-01", None)
    assert {r["job_title"] for r in old.collect()} == {"a", "b", "c"}
    assert {r["job_title"] for r in files.read_layer(spark, root, "bronze", "job_descriptions").collect()} == {"x", "y", "z", "c"}
    assert files.vacuum(spark, root) > 0
    after = _seen(spark, root)
    assert files.vacuum(spark, root) == 0 and _seen(spark, root) == after
    lake.run_datalake(again.limit(0), vocab, root, "2025-01-01", None)
    assert {r["job_title"] for r in files.read_layer(spark, root, "bronze", "job_descriptions").collect()} == {"c"}


def test_two_runs_at_once_lose_no_month(spark, tmp_path, monkeypatch):
    root = str(tmp_path)

    def staged(day, x):
        df = spark.createDataFrame([(x, dt.date.fromisoformat(day))], "x INT, month DATE")
        return files.stage_layer(df, root, "bronze", "t")

    one, two = staged("2025-01-01", 1), staged("2025-02-01", 2)
    real, calls = files._manifests, []

    def slow(spark, root):
        found = real(spark, root)
        calls.append(1)
        if len(calls) == 1:  # another run is first
            files.commit(spark, root, [two])
        return found

    monkeypatch.setattr(files, "_manifests", slow)
    files.commit(spark, root, [one])
    assert sorted(r["x"] for r in files.read_layer(spark, root, "bronze", "t").collect()) == [1, 2]


# Statistics kept by month -----------------------------------------------------------------------


def test_kept_statistics_follow_months(spark, tmp_path):
    jobs = spark.createDataFrame(
        [(k % 37, f"t{k % 3}" if k % 11 else None, "p", f"l{k % 2}", dt.date(2025, 1 + k % 4, 3) if k % 13 else None) for k in range(200)]
        + [(None, "t1", "p", "l0", dt.date(2025, 1, 1))],
        "id LONG, job_title STRING, location STRING, seniority_level STRING, posted_date DATE",
    )
    pairs = spark.createDataFrame([(k % 37, f"s{k % 5}") for k in range(90)], "job_id LONG, skill_id STRING")
    skills = spark.createDataFrame([(f"s{k}", f"Skill {k}", "tech") for k in range(5)], "id STRING, name STRING, type STRING")

    def check(expected):
        whole = q.skill_frequency_stats(expected, pairs, skills)
        got = read_stats(spark, root, skills)
        assert got.columns == whole.columns
        assert sorted(map(str, got.collect())) == sorted(map(str, whole.collect()))

    root = str(tmp_path)
    month = lambda n: F.month("posted_date") == n
    refresh_stats(jobs, pairs, root, "0001-01-01", "2025-02-28")
    check(jobs.filter(month(1) | month(2) | F.col("posted_date").isNull()))
    refresh_stats(jobs, pairs, root, "2025-03-01", "2025-04-30")
    check(jobs)
    moved = jobs.filter(month(2)).filter("id < 20")  # a month with fewer postings
    refresh_stats(moved, pairs, root, "2025-02-01", "2025-02-28")
    check(jobs.filter(~month(2) | month(2).isNull()).unionByName(moved))
    refresh_stats(jobs.limit(0), pairs, root, "2025-01-01", "2025-01-31")  # a month is removed
    check(jobs.filter(~(month(1) | month(2)) | F.col("posted_date").isNull()).unionByName(moved))
