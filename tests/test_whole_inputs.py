"""Whole sections, texts, lists and pages; months that can be rerun; rows that repeat an id."""

import random
import re
import time

import pytest
from pyspark.sql import functions as F

from skilltide.functions import fuzzy
from skilltide.operators import demand as q
from skilltide.operators import extract as e
from skilltide.operators import normalize as n
from skilltide.plans import lake
from skilltide.schemas import WAREHOUSE
from skilltide.sources import listings, warehouse
from skilltide.sources.files import read_layer


def test_elements_end_where_they_are_closed(spark):
    html = (
        '<div class="a paragraph"><h2>Job description</h2><div>one<div>two</div></div>three<div class="paragraph">in</div>four</div>'
        "after<DIV id='x' CLASS='paragraph b'>open <div>never"
    )
    df = spark.createDataFrame([(html,), ("",), (None,)], "html STRING")
    got = [r[0] for r in df.select(listings.element_bodies("html", "div", "paragraph")).collect()]
    assert got == [
        [
            '<h2>Job description</h2><div>one<div>two</div></div>three<div>in</div>four', "in", "open <div>never",
        ],
        [], [],
    ]


def test_job_page_fields_stay_in_their_item(spark):
    page = (
        '<div class="job-detail__company--information-item company-field"></div>'
        '<div class="company-scale job-detail__company--information-item"><div class="company-value">100 people</div></div>'
        '<div id="z" class="x job-description__item"><h3>Yêu cầu ứng viên</h3><div><p>first</p></div><div>second<div>third</div></div></div>'
    )
    row = listings.from_job_html(spark.createDataFrame([("u", page)], "url STRING, html STRING")).first()
    assert (row["company_field"], row["company_scope"]) == ("", "100 people")
    assert row["requirements"] == "Yêu cầu ứng viên\nfirst\nsecond\nthird"


def test_labelled_values_are_whole(spark):
    def section(label, value):
        return f'<div class="x job-detail__info--section-content"><div class="job-detail__info--section-content-title">{label}</div>{value}</div>'

    value = '<div class="job-detail__info--section-content-value">{}</div>'
    nested = value.format("<div>3 years</div><div>, senior</div>")
    pages = [
        section("Mức lương", value.format("no")) + section("Kinh nghiệm", nested),
        section("<b>Kinh</b> nghiệm", f"<p></p><div><div>{nested}</div></div>"),
        section("Kinh nghiệm", "") + section("Địa điểm", value.format("no")),
        '<div class="job-detail__info--section-content-title">Mức lương</div>' + value.format("no")
        + f'<div class="job-detail__info--section-content-title">Kinh nghiệm</div><div>{nested}</div>',
        "", None,
    ]
    df = spark.createDataFrame(list(enumerate(pages)), "url INT, html STRING")
    got = {r["url"]: r["experience"] for r in listings.from_job_html(df).collect()}
    assert got == {0: "3 years, senior", 1: "3 years, senior", 2: "", 3: "3 years, senior", 4: "", 5: ""}


def test_cards_take_attributes_in_any_order(spark):
    card = (
        '<li><a href="https://l/1" class="q base-card__full-link">x</a><h3 id="t" class="base-search-card__title">T</h3>'
        '<h4 class="base-search-card__subtitle">C</h4><span class="job-search-card__location">P</span><time class="t" datetime="2025-05-01">n</time></li>'
    )
    assert [tuple(r) for r in listings.from_listing_html(spark.createDataFrame([(card,)], "html STRING")).collect()] == [
        ("T", "C", "P", "2025-05-01", "https://l/1"),
    ]


def test_model_output_is_kept_whole(spark):
    raw = spark.createDataFrame([("1", "t", "c", "l", "d", "u")], "_id STRING, job_title STRING, company_name STRING, location STRING, posted_date STRING, url STRING")
    body = (
        '{"salary": {"min": "10", "max": ["20", "30"]}, "tech_stack": "Python", "major": "[\\"a\\", \\"b\\"]", "soft_skills": "[broken",'
        ' "benefits": "tea \\"hot\\"", "remote": {"days": [1, 2]}, "nothing": null}'
    )
    row = e.merge_parsed(raw, spark.createDataFrame([("1", body)], "_id STRING, body STRING"), "2025-01-01").select(
        "*", F.to_json("rest").alias("text")
    ).first()
    assert row["salary"] == "min: 10. max: 20; 30"
    assert (row["tech_stack"], row["major"], row["soft_skills"]) == (["Python"], ["a", "b"], ["[broken"])
    assert row["text"] == '{"benefits":"tea \\"hot\\"","nothing":null,"remote":{"days":[1,2]}}'


def test_prompts_have_no_size_limit(spark):
    vocab = spark.range(120_000).select(F.lit("tech_stack").alias("category"), F.concat(F.lit("t"), "id").alias("value"), F.col("id").alias("ord"))
    prompt = e.render_prompt(spark.createDataFrame([("x",)], "text STRING"), vocab, "{}", "text").first()["prompt"]
    assert "t0, t1, t2" in prompt and "t119999" in prompt


def test_parse_run_reads_large_texts(spark):
    raw = spark.createDataFrame(
        [("1", "Dev", "c", "l", "2025-01-01", "u", "plain " * 50_000 + " Senior Java")],
        "_id STRING, job_title STRING, company_name STRING, location STRING, posted_date STRING, url STRING, full_text_jd STRING",
    )
    vocab = spark.createDataFrame([("tech_stack", "Java", 1)], "category STRING, value STRING, ord INT")
    done = lake.run_parse(raw, raw.limit(0), vocab, "2025-02-02").first()
    assert done["tech_stack"] == ["Java"] and done["seniority_level"] == ["Senior"]
    guarded = lake.run_parse(raw, raw.limit(0), vocab, "2025-02-02", max_bytes=1000).first()
    assert guarded["tech_stack"] is None and "too large" in guarded["error"] and guarded["seniority_level"] == ["Else"]


def test_text_lists_and_repeated_ids(spark, monkeypatch):
    vocab = spark.createDataFrame([("tech_stack", "Java", 1, "java"), ("tech_stack", "Python", 2, "python")], "category STRING, value STRING, ord INT, key STRING")
    rows = [("1", ["java"]), ("1", ["PYTHON", None, " "]), ("2", []), ("3", None)]
    lists = spark.createDataFrame(rows, "_id STRING, tech_stack ARRAY<STRING>")
    texts = spark.createDataFrame([("1", '["java", "new"]'), ("2", "Python"), ("3", None)], "_id STRING, tech_stack STRING")
    for small in (True, False):
        monkeypatch.setattr(n, "_fits_a_task", lambda mapping, s=small: s)
        got = n.normalize_list(lists, "tech_stack", vocab, None).select("_id", "normalized_tech_stack").collect()
        assert sorted(map(tuple, got), key=str) == [("1", ["Java"]), ("1", ["Python"]), ("2", []), ("3", None)]
        got = n.normalize_list(texts, "tech_stack", vocab, None).select("_id", "normalized_tech_stack").collect()
        assert sorted(map(tuple, got), key=str) == [("1", ["Java", "new"]), ("2", ["Python"]), ("3", None)]


def test_silver_moves_no_posting_while_the_mapping_is_small(spark):
    vocab = spark.createDataFrame([("tech_stack", "Java", 1, "java")], "category STRING, value STRING, ord INT, key STRING")
    df = spark.createDataFrame([("1", "x", "y", ["java"], ["a"], ["b"])], "_id STRING, location STRING, job_position STRING, tech_stack ARRAY<STRING>, soft_skills ARRAY<STRING>, major ARRAY<STRING>")
    out = n.silver_postings(df, n.field_mapping(df, vocab, threshold=None))
    plan = out._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in plan and "Join" not in plan


def postings(spark, months):
    rows = [(f"{m}-{i}", f"t{i}", "c", "l", f"{m}-0{i + 1}", "u", "d", "s", ["x"], "p", ["Java"], ["Talk"], ["M"]) for m, k in months.items() for i in range(k)]
    names = "_id job_title company_name location posted_date url update_date salary"
    text = ", ".join(f"{c} STRING" for c in names.split())
    return spark.createDataFrame(rows, f"{text}, seniority_level ARRAY<STRING>, job_position STRING, tech_stack ARRAY<STRING>, soft_skills ARRAY<STRING>, major ARRAY<STRING>")


def test_months_are_rerun_to_less_and_to_nothing(spark, tmp_path):
    vocab = spark.createDataFrame([("tech_stack", "Java", 1, "java")], "category STRING, value STRING, ord INT, key STRING")
    root, house = str(tmp_path / "lake"), str(tmp_path / "house")
    lake.backfill(postings(spark, {"2025-01": 2, "2025-02": 3, "2025-03": 1}), vocab, root, "2025-01-01", "2025-03-01", threshold=None)

    def state():
        silver = read_layer(spark, root, "silver", "job_descriptions", None)
        return sorted(r["_id"] for r in silver.select("_id").collect())

    assert len(state()) == 6
    assert all(lake.run_warehouse(spark, root, house, "2025-02-01").values())
    lake.run_datalake(postings(spark, {"2025-02": 1}), vocab, root, "2025-02-01", threshold=None)
    assert state() == ["2025-01-0", "2025-01-1", "2025-02-0", "2025-03-0"]
    metrics = lake.run_datalake(postings(spark, {"2025-01": 1}), vocab, root, "2025-02-01", threshold=None)
    assert state() == ["2025-01-0", "2025-01-1", "2025-03-0"]
    assert {m["row_count"] for m in metrics.values()} == {0}
    assert not any(lake.run_warehouse(spark, root, house, "2025-02-01").values())
    for table in WAREHOUSE:
        assert warehouse.read_table(spark, house, table, "2025-02-01").count() == 0


def test_title_is_trimmed_and_pages_are_as_long_as_asked(spark):
    assert q.Request(" dev ops ").job_title == "dev ops"
    alias = spark.createDataFrame([("DevOps", "dev ops")], "job_word STRING, keyword STRING")
    asked = spark.createDataFrame([(1, "dev ops ")], "request_id INT, job_title STRING")
    assert [r["job_word"] for r in q.match_alias(asked, alias).collect()] == ["DevOps"]
    freq = spark.range(140).select(
        F.lit(1).alias("request_id"), F.concat(F.lit("s"), "id").alias("skill_name"), F.lit("t").alias("skill_type"),
        F.lit(1).alias("skill_count"), F.lit(1).alias("matched_job_count"), F.lit(5).cast("decimal(20,1)").alias("frequency_percent"),
    )
    rows = spark.createDataFrame([(1, None, None, 140)], "request_id INT, last_freq DOUBLE, last_name STRING, limit INT")
    assert q.skill_pages(freq, rows).count() == 140


@pytest.mark.parametrize("threshold", [30, 50, 80])
def test_bounds_never_lose_the_best_candidate(threshold):
    draw = random.Random(threshold)
    words = ["java", "spring", "boot", "data", "engineer", "đà", "nẵng", "c", "node", "js", "sql", "x1"]

    def text():
        said = " ".join(draw.choice(words) for _ in range(draw.randrange(0, 4)))
        return "".join(c for c in said if draw.random() > 0.1) if draw.random() < 0.5 else said

    for _ in range(60):
        options = [text() for _ in range(40)]
        chunk = fuzzy.Chunk(options)
        key = fuzzy.Prepared(text())
        scores = [fuzzy.token_set_score(key, o) for o in chunk.options]
        best = max(scores)
        assert chunk.best(key, threshold) == ((best, scores.index(best)) if best >= threshold else (-1, -1))


def test_large_chunks_and_long_texts_give_the_first_best_candidate():
    """Batches of candidates with shared words, beyond a machine word, of many letters and with gaps in rounding."""
    draw = random.Random(9)
    letters = "abcdefghij đà日"

    def word(most):
        return "".join(draw.choice(letters[:10]) for _ in range(draw.randint(1, most)))

    shared = [f"senior developer {word(9)}" for _ in range(400)]
    plain = [word(12) for _ in range(300)]
    long = [" ".join(word(9) for _ in range(draw.randint(20, 120))) for _ in range(25)]
    almost = [f"{long[0]} {word(1)}", long[0], f"{'x' * 300}", f"{'x' * 299}y", "", "đà 日 đà"]
    chunk = fuzzy.Chunk([*shared, *plain, *long, *almost, *shared[:30]])
    for text in [*shared[:20], *plain[:20], *long[:4], *almost, "senior developer", "developer zz", "x" * 301, "senior " + long[1]]:
        key = fuzzy.Prepared(text)
        for threshold in (50, 95):
            scores = [fuzzy.token_set_score(key, o) for o in chunk.options]
            best = max(scores)
            assert chunk.best(key, threshold) == ((best, scores.index(best)) if best >= threshold else (-1, -1)), text


def test_work_follows_the_candidates(monkeypatch):
    """Of candidates that all share two words only those within the bound are compared."""
    draw = random.Random(3)
    options = [f"senior developer {''.join(draw.choice('abcdefghijklmnopqrstuvwxyz') for _ in range(8))}" for _ in range(3000)]
    chunk, compared = fuzzy.Chunk(options), []
    real = fuzzy._lcs_many
    monkeypatch.setattr(fuzzy, "_lcs_many", lambda text, others: compared.append(len(others)) or real(text, others))
    for text in options[:50]:
        assert chunk.best(fuzzy.Prepared(text[:-1] + "0"), 50)[0] >= 90
    assert sum(compared) < 50 * len(options) / 20


def plain_bodies(html, tag, css_class):
    """Element bodies by a scan with a counter per element."""
    begin = re.compile(listings.start_tag(tag, css_class))
    marks = re.compile(rf"(?i)<{tag}\b|</{tag}\s*>")
    out = []
    for m in begin.finditer(html or ""):
        depth, end = 1, len(html)
        for x in marks.finditer(html, m.end()):
            depth += -1 if x.group().startswith("</") else 1
            if depth == 0:
                end = x.start()
                break
        body = begin.sub(f"<{tag}>", html[m.end() : end])
        out.append(re.sub(rf"(?i)</{tag}\s*>", f"</{tag}>", body))
    return out


def test_elements_equal_a_plain_scan(spark):
    draw = random.Random(8)
    parts = ["<div>", "<div class='x'>", '<DIV CLASS="a x b">', "</div>", "</div >", "</DIV>", "text ", "<p>", "<divx>", "</divx>", "<div class=xx>", "\n", "é"]
    pages = ["".join(draw.choice(parts) for _ in range(draw.randint(0, 250))) for _ in range(300)]
    df = spark.createDataFrame([(p,) for p in pages], "html STRING").coalesce(1)
    got = df.select("html", listings.element_bodies("html", "div", "x").alias("found")).collect()
    assert all(r["found"] == plain_bodies(r["html"], "div", "x") for r in got)


def test_elements_take_time_in_proportion_to_the_page(spark):
    def seconds(n):
        page = "".join(f"<div class='x'><h2>head {i}</h2><div>in {i}</div> tail</div>" for i in range(n))
        df = spark.createDataFrame([(page,)], "html STRING").select(F.size(listings.element_bodies("html", "div", "x")).alias("n"))
        took = []
        for _ in range(2):
            start = time.perf_counter()
            assert df.first()["n"] == n
            took.append(time.perf_counter() - start)
        return min(took)

    assert seconds(20_000) < 20  # 1.3 MB; twice the square of a second's page would be minutes
    assert seconds(40_000) < 5 * seconds(10_000) + 2
