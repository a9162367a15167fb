"""Operator 12: the search against a plain one, and what pruning may leave out."""

import math
import random

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from skilltide.llm import hardneg, queries

SCHEMA = "vec_id LONG, label INT, embedding ARRAY<DOUBLE>, row INT, score STRING, dim STRING, id INT, length INT"


def plain(rows, every=50, positives=5, negatives=3, low=(50, 100), high=(95, 100)):
    rows = [r for r in rows if None not in r[:3] and all(x is not None and math.isfinite(x) for x in r[2])]
    rows = [(i, y, [math.floor(256 * x) for x in v]) for i, y, v, *_ in rows]
    out = []
    for a in (r for r in rows if r[0] % every == 0):
        near = [(-sum(x * y for x, y in zip(a[2], r[2], strict=True)), r[0], r[1]) for r in rows if r is not a and len(r[2]) == len(a[2])]
        near.sort()
        for s, i, _ in [x for x in near if x[2] == a[1]][:positives]:
            fit = [x for x in near if x[2] != a[1] and low[0] * -s <= low[1] * -x[0] and high[1] * -x[0] <= high[0] * -s]
            out += [(a[0], i, k, j, -s, -t) for k, (t, j, _) in enumerate(fit[:negatives], 1)]
    return sorted(out)


def vectors(n, dim, seed, near=0.0):
    draw = np.random.default_rng(seed)
    centre = draw.normal(size=(4, dim))
    out = []
    for i in range(n):
        v = draw.normal(size=dim) + near * centre[i % 4]
        v = v / np.linalg.norm(v) * draw.choice([0.2, 1.0, 3.0])
        out.append((i, int(draw.integers(0, 4)), [float(x) for x in v]))
    return out


def found(spark, rows, every=50, **options):
    rest = (None,) * 5
    df = spark.createDataFrame([(*r, *rest) for r in rows], SCHEMA).repartition(3)
    return sorted(tuple(r) for r in hardneg.hard_negatives(df, F.col("vec_id") % every == 0, **options).collect())


@pytest.mark.parametrize(("dim", "near"), [(3, 0.0), (8, 2.0), (64, 3.0)])
def test_against_plain_search(spark, monkeypatch, dim, near):
    monkeypatch.setattr(hardneg, "BUCKET", 20 * dim)
    monkeypatch.setattr(hardneg, "ANCHORS", 3 * dim)
    monkeypatch.setattr(hardneg, "CHUNK", 2)
    rows = vectors(400, dim, dim, near)
    rows += [(400 + i, rows[i % 3][1], rows[i % 3][2]) for i in range(60)]  # copies: ties
    assert found(spark, rows, every=10) == plain(rows, every=10)
    assert found(spark, rows, every=10, positives=2, negatives=9, low=(0, 100), high=(100, 100)) == plain(
        rows, every=10, positives=2, negatives=9, low=(0, 100), high=(100, 100)
    )


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [0.5, 0.5]), (50, 1, [0.4, -0.1]), (50, 1, [0.4, -0.1]), (1, 1, [0.6, 0.1]), (2, 2, [0.4, 0.1]), (3, 2, [0.4, 0.1]), (None, 2, [0.4, 0.1]),
        (4, None, [0.4, 0.1]), (5, 2, None), (6, 2, [0.4, None]), (7, 2, [nan, 0.3]), (8, 2, [inf, 0.3]), (9, 2, [0.4, 0.1, 0.2]), (100, 2, [0.0, 0.0]),
        (150, 3, [0.1, 0.2, 0.3]), (10, 3, [0.1, 0.2, 0.3]), (11, 4, [0.1, 0.1, 0.3]), (200, 5, []), (12, 5, []), (13, 6, []), (250, 7, [-0.5, -0.5]),
        (14, 7, [0.5, 0.5]), (15, 8, [1e5, 3e5]), (16, 1, [2.0**31, 1.0]), (300, 9, [-(2.0**29), 0.25]), (17, 9, [-3.0, 7.0]),
    ]
    assert found(spark, rows) == plain(rows)
    assert found(spark, []) == []


def test_score_beyond_64_bits_is_an_error(spark):
    with pytest.raises(Exception, match="too large|too big|OverflowError"):
        found(spark, [(0, 1, [1e30]), (1, 1, [1e30])])
    with pytest.raises(Exception, match="no finite double"):
        found(spark, [(0, 1, [1e307]), (1, 1, [1.0])])


def test_pruning_drops_rows_and_keeps_those_that_reach():
    draw = np.random.default_rng(4)
    near = draw.normal(size=16)
    rows = np.floor(256 * (draw.normal(size=(500, 16)) * 0.2 + np.where(np.arange(500) % 5 == 0, 1.0, 0.0)[:, None] * near))
    bucket = hardneg.Bucket(*[np.arange(500)] * 3, rows)
    anchor = hardneg.Anchor(-1, 0, np.floor(256 * near), [])
    exact, sizes = rows @ anchor.vector, []
    for least in np.quantile(exact, [0.5, 0.7, 0.9, 0.99, 1.0]):
        at = bucket.candidates(anchor, float(least))
        kept = np.arange(500) if at is None else at
        assert set(np.flatnonzero(exact >= least)) <= set(kept.tolist())
        sizes.append(len(kept))
    assert sizes[-1] <= 100  # the rows in the anchor's direction


def test_given_table(spark, sf_dir):
    got = sorted(tuple(r) for r in queries.QUERIES["op12_coordinate_pruned_negatives"](spark, sf_dir).collect())
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    assert got == sorted(con.execute(queries.SQL["op12_coordinate_pruned_negatives"]).fetchall())
    assert got == plain([
        (r["vec_id"], (r["label"] + 1) % 10 if r["vec_id"] % 7 == 0 else r["label"], r["embedding"])
        for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    ])
