"""Operator 6: signals against a plain count, fences against sorted values, and no Python in its plans."""

import re
from collections import Counter

from skilltide.llm import quality
from tests.llm.conftest import words


def signals(text):
    w = words(text, lower=False)
    runs = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    often = Counter(runs)
    covered = {j for i, g in enumerate(runs) if often[g] > 1 for j in range(i, i + 3)}
    lines = [x for x in (text or "").split("\n") if words(x)]
    return len(w), sum(map(len, w)), len(re.findall("[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_signals(documents, odd):
    for df in (documents.select("doc_id", "text"), odd):
        for r in quality.text_signals(df, carry=["doc_id", "text"]).collect():
            assert tuple(r[c] for c in quality.BASE) == signals(r["text"]), r["doc_id"]
            assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])


def test_odd_rows(odd, none):
    out = quality.quality_rules(odd)
    assert out.count() == odd.count() and quality.quality_rules(none).count() == 0
    assert out.filter("kept IS NULL").count() == 0
    assert not any(r["kept"] for r in out.filter("n_words < 50").collect())


def test_fences_follow_the_group(spark):
    plain = [(i, " ".join(f"word{(i * 31 + j) % 997}" for j in range(80)), "en", "a") for i in range(150)]
    signs = [(1000 + i, " ".join(f"{'#' * (2 + i % 3)}tag{(i * 17 + j) % 997}" for j in range(80)), "en", "b") for i in range(150)]
    odd_one = [(5000, " ".join(f"##tag{j}" for j in range(80)), "en", "a"), (5001, " ".join(f"##tag{j}" for j in range(80)), "en", "b")]
    df = spark.createDataFrame(plain + signs + odd_one, "doc_id LONG, text STRING, lang STRING, source STRING")
    kept = {r["doc_id"]: r["kept"] for r in quality.quality_rules(df, carry=["doc_id"]).collect()}
    assert not kept[5000] and kept[5001] and all(kept[r[0]] for r in plain + signs)


def test_sketches_merge_and_are_close(spark):
    values = [(i * i) % 5003 for i in range(3000)]
    rows = spark.createDataFrame([(v,) for v in values], "v LONG").selectExpr("v", f"{quality.middle('v')} AS m").collect()
    assert all(abs(r["m"] - r["v"]) <= max(0, r["v"] / 32) for r in rows)


def test_main_path_is_native(documents, spark, monkeypatch):
    plans = []
    real = quality.saved

    def spy(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(df, name)

    monkeypatch.setattr(quality, "saved", spy)
    plans.append(quality.quality_rules(documents, carry=["doc_id"])._jdf.queryExecution().executedPlan().toString())
    assert len(plans) == 4 and not any(re.search("Python|Arrow|Pandas|CartesianProduct|BroadcastNestedLoop", p) for p in plans)
