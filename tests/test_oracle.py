"""Every registered query: its rows against its SQL, and its plan."""

import pytest

from skilltide.registry import REGISTRY
from tests.oracle import compare, database
from tests.test_plans import plan

FUZZY = {"n4_match_fuzzy", "x18_token_set_ratio"}


@pytest.fixture(scope="module")
def con(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_query(spark, con, sf_dir, name):
    def no_pairwise_joins_and_no_python(df):
        text = plan(df)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert ("Python" in text or "Arrow" in text) == (name in FUZZY)

    rows, difference = compare(spark, con, name, sf_dir, no_pairwise_joins_and_no_python)
    assert difference is None, difference
    assert rows > 0 and REGISTRY[name].sql is not None


def test_comparison_sees_a_wrong_row(spark, con, sf_dir, monkeypatch):
    entry = REGISTRY["q12_distinct_levels"]
    wrong = type(entry)(lambda s, d: entry.run(s, d).limit(3), entry.sql)
    monkeypatch.setitem(REGISTRY, "q12_distinct_levels", wrong)
    assert compare(spark, con, "q12_distinct_levels", sf_dir)[1] is not None
