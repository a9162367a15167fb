"""Operator 9 against all pairs."""

from collections import Counter, defaultdict

import pytest

from skilltide.llm import bottomk
from skilltide.llm.components import connected
from tests.llm.conftest import words


def sets_of(rows, n=5):
    out = []
    for r in rows:
        w = words(r["text"])
        out.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
    return out


def brute(sets, num, den):
    """Root of each set: the first index it is linked with."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    lists = defaultdict(list)
    for i, s in enumerate(sets):
        both = Counter(j for x in s for j in lists[x])
        for x in s:
            lists[x].append(i)
        for j, c in both.items():
            if den * c >= num * (len(s) + len(sets[j]) - c):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(sets))]


def check(df, num=85, den=100):
    rows = df.select("doc_id", "text").collect()
    sets = sets_of(rows)
    roots = brute(sets, num, den)
    least = {}
    for r, root in zip(rows, roots, strict=True):
        if r["doc_id"] is not None:
            least[root] = min(least.get(root, r["doc_id"]), r["doc_id"])
    expected = Counter(
        (r["doc_id"], len(s), least.get(root) if s else r["doc_id"]) for r, s, root in zip(rows, sets, roots, strict=True)
    )
    got = Counter(
        (r["doc_id"], r["n_shingles"], r["component_id"]) for r in bottomk.near_duplicate_labels(df, num=num, den=den).collect()
    )
    assert got == expected
    return len(set(roots))


def test_documents(documents):
    check(documents)


def test_lower_limit_and_chains(spark):
    """A line of texts each like the next; ends are not alike. And a hub with members unlike each other."""
    base = [f"w{i}" for i in range(120)]
    rows, n = [], 0
    for step in range(0, 60, 2):
        rows.append((n := n + 1, " ".join(base[step:] + [f"y{i}" for i in range(step)])))
    for i in range(40):
        changed = [f"v{j}" for j in range(120)]
        changed[3 * i] = f"own{i}"
        rows.append((n := n + 1, " ".join(changed)))
    rows.append((n + 1, " ".join(f"v{j}" for j in range(120))))
    shared = [f"s{i}" for i in range(200)]
    rows += [(n + 2 + i, " ".join(shared + [f"t{i}_{j}" for j in range(60)])) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    for num in (80, 85, 90):
        check(df, num)


def test_dedup_keeps_one_of_each_group(odd, none):
    check(odd)
    kept = bottomk.near_dedup(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    ids = [r["doc_id"] for r in rows]
    # texts without words all stay, repeated rows of near copies go
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7, 9, 10, 10]
    assert sum(i is None for i in ids) == 2
    assert bottomk.near_dedup(none).count() == 0 and bottomk.near_duplicate_labels(none).count() == 0


@pytest.mark.parametrize("edges", [[], [(1, 2), (2, 3), (9, 8), (3, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)]])
def test_components(spark, edges):
    found = {r["node"]: r["root"] for r in connected(spark.createDataFrame(edges, "a LONG, b LONG")).collect()}
    root = {}
    for _ in edges:
        for a, b in edges:
            m = min(root.get(a, a), root.get(b, b))
            root[a] = root[b] = m
    assert found == root
