"""The pipeline's stages against plain versions."""

import corpus_pipeline
import pytest

from skilltide.llm import quality
from skilltide.llm.queries import QUERIES, SQL, table
from tests.llm.test_near import brute as components
from tests.llm.test_near import sets_of
from tests.llm.test_quality import signals
from tests.llm.test_winnow import brute as windows
from tests.oracle import _rows, database


def test_stages(spark, sf_dir, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == documents.columns
        out = corpus_pipeline.saved(out, name)
        before, after = docs.collect(), out.collect()
        ids = [r["doc_id"] for r in after]
        if name == "quality_rules":
            base = {r["doc_id"] for r in before if (s := signals(r["text"]))[0] < 50 or 2 * s[4] > s[0]}
            assert not base & set(ids) and len(set(ids)) >= 0.8 * (len(before) - len(base))
            verdict = {r["doc_id"] for r in quality.quality_rules(docs).filter("kept").collect()}
            assert set(ids) == verdict
        elif name == "near_duplicates":
            least = {}
            for r, root in zip(before, components(sets_of(before), 80, 100), strict=True):
                least[root] = min(least.get(root, r["doc_id"]), r["doc_id"])
            assert sorted(ids) == sorted(least.values())
        elif name == "benchmark_decontamination":
            found = windows(before, table(spark, sf_dir, "benchmark").collect())
            assert sorted(ids) == sorted(k[0] for k in found if not k[2])
        else:
            assert set(ids) <= {r["doc_id"] for r in before} and len(ids) >= 0.8 * len(before)
        docs = out
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == docs.count() and {"shard", "slot"} <= set(last.columns)


def test_odd_and_empty_tables(spark, sf_dir, odd, none):
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, sf_dir)
            assert name == "sharding" or out.columns == docs.columns
            docs = corpus_pipeline.saved(out, name)


@pytest.mark.parametrize("name", sorted(SQL))
def test_comparison_sql(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    ours = _rows(df.columns, df.collect())
    result = database(sf_dir).execute(SQL[name])
    assert ours == _rows([d[0] for d in result.description], result.fetchall())
