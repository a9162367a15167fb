"""Operator 1 against all windows."""

from collections import Counter

from skilltide.llm import winnow
from skilltide.llm.queries import table
from tests.llm.conftest import words

PATTERN = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"


def brute(docs, items, window=10):
    known = {}
    for r in items:
        w = words(r["text"], PATTERN)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            known.setdefault(tuple(w[i : i + n]), set()).add("" if r["item_id"] is None else str(r["item_id"]))
    out = Counter()
    for r in docs:
        w, hit, found = words(r["text"], PATTERN), set(), set()
        for n in {len(k) for k in known}:
            for i in range(len(w) - n + 1):
                if (t := tuple(w[i : i + n])) in known:
                    hit.update(range(i, i + n))
                    found |= known[t]
        out[r["doc_id"], len(w), len(hit), tuple(sorted(found))] += 1
    return out


def check(docs, items):
    got, _ = winnow.contamination(docs, items)
    rows = Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["item_ids"])) for r in got.collect())
    assert rows == brute(docs.select("doc_id", "text").collect(), items.select("item_id", "text").collect())
    return rows


def test_documents(spark, sf_dir, documents):
    rows = check(documents, table(spark, sf_dir, "benchmark"))
    assert any(r[2] for r in rows)


def test_spans_of_every_kind(spark, odd, none):
    w = [f"w{i}" for i in range(40)]
    items = spark.createDataFrame(
        [
            (1, " ".join(w[:30])), (2, " ".join(w[5:15])), (2, "two rows, one id"), (3, "tiny"), (None, "no id " * 3), (4, None), (5, "..."),
            (6, "a a a a a a a a a a a a"), (7, " ".join(w[:10])), (8, "one TWO three four five"),
        ],
        "item_id LONG, text STRING",
    )
    texts = [
        " ".join(w[:9]), " ".join(w[:10]), "x " + " ".join(w[3:14]) + " y", " ".join(w[20:35]), "Tiny, tiny! tinyx", "a " * 9, "a " * 10, "a " * 50,
        "no id no id no id", "one-two three.four five", "two rows one idx", " ".join(w[:10] + w[:10]), None, "",
    ]
    docs = spark.createDataFrame([(i % 9, t) for i, t in enumerate(texts)], "doc_id LONG, text STRING")
    check(docs, items)
    check(odd, items)
    assert winnow.contamination(none, items)[0].count() == 0
    assert winnow.contamination(docs, items.limit(0))[0].filter("n_hit > 0").count() == 0
    clean = winnow.decontaminate(odd, items)
    assert clean.columns == odd.columns and clean.count() == sum(c for k, c in brute(odd.collect(), items.collect()).items() if not k[2])


def test_selection_keeps_a_print_in_every_window():
    import numpy as np

    h = np.random.default_rng(3).integers(0, 2**63, 500).astype(np.uint64)
    at, _ = winnow.selected(h, np.array([0, 200, 205, 500]), 5, 10)
    for a, b in ((0, 200), (205, 500)):
        assert all(any(i <= x <= i + 5 for x in at) for i in range(a, b - 9))
