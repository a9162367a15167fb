"""Operators 3 and 7."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from skilltide.llm import histsort, mixing
from skilltide.llm.queries import table


def layout(df, n, **options):
    rows = histsort.shards(df, n, **options).collect()
    slots, size = {}, [0] * n
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        size[r["shard"]] += r["size"]
        assert r["size"] == len((r["text"] or "").encode()) + 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len(rows) == df.count()
    return size, max([r["size"] for r in rows], default=0)


@pytest.mark.parametrize("options", [{}, {"cell_bytes": 5_000}])
def test_shards_are_even(documents, options):
    size, largest = layout(documents, 12, **options)
    assert max(size) - min(size) <= 2 * largest


def test_hot_text_is_divided(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.concat(F.lit("text "), "id")).alias("text"))
    size, largest = layout(df, 10)
    assert max(size) - min(size) <= 2 * largest


def test_odd_rows(odd, none):
    size, _ = layout(odd, 4)
    assert sum(size) > 0 and histsort.shards(odd, 4).columns == [c for c in odd.columns if c not in ("size", "shard", "slot")] + ["size", "shard", "slot"]
    assert histsort.shards(none, 4).count() == 0
    layout(odd.filter("doc_id = 1"), 4)


def test_counts_are_exact(spark, documents):
    slim = documents.select(histsort.sort_key(F.col("doc_id"), F.col("text")).alias("key"), F.octet_length("text").cast("long").alias("size"))
    rows = sorted(tuple(r) for r in slim.collect())
    probes = np.array(sorted({rows[i][0] for i in range(0, len(rows), 7)}), np.int64)
    size, count = histsort.counts_below(slim, probes)
    assert [int(x) for x in count] == [sum(k < p for k, _ in rows) for p in probes] + [len(rows)]
    assert [int(x) for x in size] == [sum(s for k, s in rows if k < p) for p in probes] + [sum(s for _, s in rows)]


def test_rates_meet_the_targets_and_the_least_squares_solution(spark):
    rng = np.random.default_rng(2)
    p = rng.dirichlet([0.3, 0.2, 0.1], 500)
    n = rng.integers(1, 1000, 500)
    slim = spark.createDataFrame([(int(a), b.tolist()) for a, b in zip(n, p, strict=True)], "__n LONG, __p ARRAY<DOUBLE>")
    steps, present, target, reached = mixing.fit_rates(slim, np.array([1.0, 0.4, 1.5]))
    assert np.allclose(present, n @ p) and np.abs(reached - target).sum() <= mixing.CLOSE * target.sum()
    rates = mixing._rates(p, steps)
    assert (rates >= 0).all() and np.allclose((n * rates) @ p, reached)
    # brute force: plain projected gradient on all unknowns at once
    r = np.ones(500)
    for _ in range(4000):
        r = np.maximum(0, r - 0.9 * (p @ (((n * r) @ p - target) / present) + mixing.RIDGE * (r - 1)))
    assert np.abs((n * r) @ p - reached).sum() <= 2 * mixing.CLOSE * target.sum()
    assert np.abs(r - rates).max() < 0.1


def test_classifier_on_rows_kept_back(spark):
    larger = "/root/testdata/sf0.01"  # the smallest table has labels for a few dozen rows only
    documents, labels = table(spark, larger, "documents"), table(spark, larger, "labels")
    train, test = (labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(4)).isin(x)) for x in ([1, 2, 3], [0]))
    domains, model = mixing.learn(documents, train, "doc_id", "text", "doc_id", 20_000)
    found = mixing.classified(documents.join(test, "doc_id"), model, "text").select("quality", "toxic", "__p").collect()
    good = sum(domains[int(np.argmax(r["__p"]))] == f"quality={r['quality']},toxic={r['toxic']}" for r in found)
    assert good >= 0.85 * len(found)


def test_mixing_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, 0), (3, 0, 0), (9, 1, None), (None, 1, 1)], "doc_id LONG, quality INT, toxic INT")
    out, domains = mixing.mixture(odd, labels)
    rows = out.collect()
    assert len(rows) == odd.count() and all(abs(sum(r["posterior"]) - 1) < 1e-9 and r["rate"] >= 0 and r["copies"] >= 0 for r in rows)
    assert len(domains) == 3
    assert mixing.mix(odd, labels).columns == odd.columns
    whole = mixing.mix(odd, labels.limit(0))  # nothing is known: every row once
    assert whole.count() == odd.count()
    assert mixing.mix(none, labels).count() == 0


def test_copies_follow_the_rate(spark):
    docs = spark.range(400).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "good word here").otherwise("bad term there").alias("text"))
    labels = docs.select("doc_id", (1 - F.col("doc_id") % 2).cast("int").alias("quality"))
    mixed = mixing.mix(docs, labels, multiples={"quality=0": 0.3, "quality=1": 1.5}).groupBy("text").count().collect()
    count = {r["text"]: r["count"] for r in mixed}
    assert 270 <= count["good word here"] <= 330 and 35 <= count["bad term there"] <= 85
