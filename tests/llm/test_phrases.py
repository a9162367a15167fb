"""Operator 13: the trie, and phrases against a plain count."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from skilltide.llm import phrases, queries
from tests.llm.conftest import LETTERS


def plain(rows, most_words=3, least=10, inside=50, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by the definition."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LETTERS)):
            w = re.findall("[^ \t]+", piece)
            totals[lang] += len(w)
            for n in range(1, most_words + 1):
                counts.update((lang, tuple(w[i : i + n])) for i in range(len(w) - n + 1))
    often = {(lang, p): a for (lang, p), a in counts.items() if len(p) > 1 and a >= least}
    longer = Counter()
    for (lang, p), a in often.items():
        for m in range(2, len(p)):
            for i in range(len(p) - m + 1):
                longer[lang, p[i : i + m]] = max(longer[lang, p[i : i + m]], a)
    out = []
    for lang in totals:
        found = []
        for (of, p), a in often.items():
            if of != lang or 100 * longer[lang, p] >= inside * a and longer[lang, p]:
                continue
            cuts = [(10**6 * a * a // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def drawn(seed, n):
    draw, out = random.Random(seed), []
    for i in range(n):
        words = [draw.choice(["New", "york", "city", "of", "the", "The", "x" * 3, "é", "日本", "a.b", "c,d"]) for _ in range(draw.randint(0, 30))]
        text = draw.choice([" ", "  ", "\t"]).join(words) + draw.choice(["", ".", " ! ", "\n", "\r\n"])
        out.append((draw.choice(["en", "de", None]), None if i % 29 == 0 else text))
    return out


def test_against_plain_count(spark):
    rows = drawn(5, 300) + [("en", "hot pair " * 500), ("en", "hot pair " * 500)]
    docs = spark.createDataFrame(rows, "lang STRING, text STRING").repartition(3)
    for options in ({}, {"most_words": 4, "least": 5, "inside": 80, "top": 7}, {"most_words": 2, "least": 2}):
        found = sorted(tuple(r) for r in phrases.collocations(docs, **options).collect())
        assert found == plain(rows, **options)


def counted(rows, sizes):
    batch = pa.RecordBatch.from_arrays([pa.array([x or "und" for x, _ in rows]), pa.array([t or "" for _, t in rows])], ["lang", "text"])
    sums, runs = Counter(), 0
    for some in phrases._scan(sizes, None)([batch.slice(0, 90), batch.slice(90)]):
        runs += 1
        for lang, phrase, n in zip(*(c.to_pylist() for c in some.columns), strict=True):
            sums[lang, phrase] += n
    return sums, runs


@pytest.mark.parametrize("sizes", [[1, 2], [3], [4]])
def test_small_limits_change_nothing(monkeypatch, sizes):
    rows = [*drawn(6, 300), ("en", "hot pair " * 500)]
    whole, few = counted(rows, sizes)
    limits = {"HELD": 40, "BURST": 3, "SLICE_WORDS": 7, "SLICE_CHARS": 50, "KNOWN_WORDS": 6, "RUN_ROWS": 5}
    for name, value in limits.items():
        monkeypatch.setattr(phrases, name, value)
    again, many = counted(rows, sizes)
    assert whole == again and many > 10 * few


def test_trie_bursts_and_spills(monkeypatch):
    monkeypatch.setattr(phrases, "BURST", 4)
    draw = random.Random(2)
    grams = [tuple(draw.randint(0, 6) for _ in range(4)) for _ in range(3000)]
    trie, spilled = phrases.Trie(4), Counter()

    def take(most):
        ids, counts = trie.taken(most)
        assert trie.held <= most
        heads = set(ids[:, 0].tolist())
        assert not heads & set(trie.root)  # whole subtrees
        for g, n in zip(map(tuple, ids.tolist()), counts.tolist(), strict=True):
            spilled[g] += n

    for i in range(0, len(grams), 500):
        some = sorted(Counter(grams[i : i + 500]).items())
        rest = [(b << 64) | (c << 32) | d for (_, b, c, d), _ in some]
        trie.add([g[0] for g, _ in some], rest, [n for _, n in some])
        assert any(type(x) is phrases.Trie.Node for x in trie.root.values())
        take(300)
    take(0)
    assert spilled == Counter(grams)


def test_runs_are_sorted():
    names = ["b", "a", "é", "z", "日"]
    ids = np.array([[x, y] for x in range(5) for y in range(5)])
    found = [p for b in phrases._run("en", names, ids, np.ones(25, np.int64)) for p in b.column(1).to_pylist()]
    assert found == [f"{a} {b}" for a in sorted(names, key=str.encode) for b in sorted(names, key=str.encode)]


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    rows = [("en", "a b", big, 2), ("en", "a", big + 7, 1), ("en", "b", big + 11, 1), ("en", "", 4 * big, 0)]
    counts = spark.createDataFrame(rows, "lang STRING, phrase STRING, n LONG, words INT")
    assert [r["score"] for r in phrases.scored(counts).collect()] == [10**6 * big * big // ((big + 7) * (big + 11))]


def test_given_table(spark, sf_dir):
    found = sorted(tuple(r) for r in queries.QUERIES["op13_hat_trie_phrases"](spark, sf_dir).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    assert found == sorted(con.execute(queries.SQL["op13_hat_trie_phrases"]).fetchall())
    assert found == plain([(r["lang"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()])


def test_odd_rows(odd, none):
    found = sorted(tuple(r) for r in phrases.collocations(odd, least=2).collect())
    assert found == plain([(r["lang"], r["text"]) for r in odd.select("lang", "text").collect()], least=2)
    assert phrases.collocations(none).collect() == []
