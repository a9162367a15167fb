"""Column functions on hand-written rows."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from skilltide.functions import fuzzy, parsing, postings, text


def values(spark, rows, *columns):
    """Results of functions of column ``c``, a list per function."""
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "i INT, c STRING")
    out = df.select("i", *[c.alias(f"x{n}") for n, c in enumerate(columns)]).orderBy("i").collect()
    found = [[row[n + 1] for row in out] for n in range(len(columns))]
    return found[0] if len(columns) == 1 else found


def test_fold_and_client_fold(spark):
    rows = ["Đà Nẵng", "Da\u0300 Na\u0306\u0303ng", "Straße ŒUVRE", "  Việt   Nam\u00a0", None]
    folded, client = values(spark, rows, text.fold("c"), text.client_fold("c"))
    assert folded == ["da nang", "da nang", "strasse oeuvre", "  viet   nam\u00a0", None]
    assert client == ["đa nang", "da nang", "straße œuvre", "viet nam", None]


def test_strip_removes_all_white_space(spark):
    rows = ["\n a\tb \u00a0\u2003", "", "\r\n", None]
    assert values(spark, rows, text.strip("c")) == ["a\tb", "", "", None]


def test_clean_key(spark):
    rows = ["  CI/CD ", "Node.js", "C++", "Kỹ năng!", "snake_case", None, "..."]
    expected = ["cicd", "nodejs", "c", "kỹ năng", "snake_case", "", ""]
    assert values(spark, rows, text.clean_key("c")) == expected


def test_tokens_and_match(spark):
    assert values(spark, ["QA/QC  Engineer, qa", "", "--"], text.tokens("c")) == [
        ["qa", "qc", "engineer"], [], [],
    ]
    rows = ["Senior Java Developer"]
    hit, part, none = values(
        spark,
        rows,
        text.all_terms_match(text.tokens("c"), text.tokens(F.lit("developer JAVA"))),
        text.all_terms_match(text.tokens("c"), text.tokens(F.lit("java tester"))),
        text.all_terms_match(text.tokens("c"), text.tokens(F.lit(" - "))),
    )
    assert (hit, part, none) == ([True], [False], [False])


def test_trigram_similarity(spark):
    grams = values(spark, ["cat"], F.array_sort(text.trigrams("c")))[0]
    assert grams == ["  c", " ca", "at ", "cat"]
    similarity = values(spark, ["word", "", None], text.trigram_similarity("c", F.lit("two words")))
    assert similarity[0] == pytest.approx(4 / 11)
    assert similarity[1] == 0.0


def test_space_tokens_keep_empty(spark):
    assert values(spark, [" a  b"], text.space_tokens("c")) == [["", "a", "", "b"]]


def test_html_to_text(spark):
    rows = ["<div><p>a</p><p>b &amp; c</p></div>", ""]
    assert values(spark, rows, text.html_to_text("c")) == ["a\nb &amp; c", ""]
    assert values(spark, ["a\n\n\nb"], text.collapse_double_newline("c")) == ["a\n\nb"]


def test_parse_list(spark):
    rows = ['["a","b"]', "plain", "[a", "[a]", "", ' [1, null, "x"] ', None]
    expected = [["a", "b"], ["plain"], ["[a"], [], [""], ["1", None, "x"], None]
    assert values(spark, rows, text.parse_list("c")) == expected


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10**9), st.integers(1, 10**9)), min_size=1, max_size=20))
def test_percent_is_exact(spark, pairs):
    df = spark.createDataFrame(pairs, "n LONG, total LONG")
    got = [row[0] for row in df.select(text.percent("n", "total").cast("string")).collect()]
    tenths = [(2000 * n + t) // (2 * t) for n, t in pairs]
    assert got == [f"{x // 10}.{x % 10}" for x in tenths]


def test_posted_date(spark):
    rows = ["Posted 5 minutes ago", "3 hours", "2 days", "1 day", "yesterday", None]
    as_of = F.lit("2025-03-01 00:04:00")
    got = [str(d) for d in values(spark, rows, postings.posted_date("c", as_of))]
    assert got == [
        "2025-02-28", "2025-02-28", "2025-02-27", "2025-02-28", "2025-03-01", "None",
    ]


def test_last_address_part(spark):
    rows = ["A, B, C ", " A ", "", "  ", "A,"]
    assert values(spark, rows, postings.last_address_part("c")) == ["C", "A", "Unknown", "Unknown", ""]


def test_source_ids(spark):
    rows = ["https://x.com/jobs/dev-ops-123/?a=b-9", "https://x.com/dev-77?t=1"]
    path, tail = values(spark, rows, postings.source_id_path("c"), postings.source_id_tail("c"))
    assert path == ["123", "77"]
    assert tail == ["9", "77"]


def test_posting_hash_order_and_nulls(spark):
    import hashlib

    got = values(spark, ["Acme", None], postings.posting_hash("c", F.lit("Dev"), F.lit("2025-01-01")))
    expected = [
        hashlib.md5(f"{c}Dev2025-01-01".encode()).hexdigest() for c in ("Acme", None)
    ]
    assert got == expected
    legacy = values(spark, ["Acme"], postings.posting_hash("c", F.lit("Dev"), F.lit("d"), True))
    assert legacy == [hashlib.md5(b"DevAcmed").hexdigest()]


def test_normalize_id(spark):
    assert values(spark, ["abc", '{"$oid": "42"}', None], postings.normalize_id("c")) == [
        "abc", "42", None,
    ]


def test_month_bucket(spark):
    rows = ["2025-06-15", None, "2025-05-01", "2025-03-31", "2024-12-01", "2024-07-20", "2023-06-01"]
    day = F.col("c").cast("date")
    assert values(spark, rows, postings.month_bucket(day, "2025-06-15")) == [
        "0", "0", "", "3", "6", "12", "24",
    ]


def test_months_ago_clamps(spark):
    ago = values(spark, ["2026-08-31"], postings.months_ago(F.col("c").cast("date"), 6))
    assert str(ago[0]) == "2026-02-28"


def test_jsonld_date(spark):
    def page(body):
        return f'<script type="application/ld+json">{body}</script>'

    rows = [page('{"datePosted": "2025-04-25"}'), page('{"datePosted": "2025-02-30"}'),
            page("{broken"), page('{"datePosted": "2025"}'), "<p>none</p>"]
    got = values(spark, rows, postings.jsonld_date("c"))
    assert [str(d) for d in got] == ["2025-04-25", "None", "None", "None", "None"]


def test_extract_json(spark):
    rows = ['Sure:\n```{"a": {"b": 1}}``` done', "{oops", "none", "", None]
    got = values(spark, rows, F.to_json(parsing.extract_json("c")))
    assert got == ['{"a":{"b":1}}', None, None, None, None]


def test_json_lists_flatten_and_dedupe(spark):
    body = '{"l": [{"k": ["p", "q"], "m": "r"}, "s", "s"], "d": {"x": "y"}}'
    items = parsing.dedupe_list(parsing.json_list_items("c", "$.l"))
    assert values(spark, [body, "{}"], items) == [["k: p; q. m: r", "s"], None]
    top = parsing.json_dict_text(F.get_json_object("c", "$.d"))
    assert values(spark, [body], top) == ["x: y"]


# Token-set ratio -----------------------------------------------------------------------------


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], (before + 1 if x == y else max(row[j], row[j - 1]))
    return row[-1]


def plain_score(a, b):
    """The definition: three strings, all three ratios in full."""

    def ratio(x, y):
        if not x or not y:
            return 0
        return round(100 * (2 * lcs(x, y) / (len(x) + len(y))))

    one, two = set(fuzzy.prepare(a).split()), set(fuzzy.prepare(b).split())
    if not one or not two:
        return 0
    sect = " ".join(sorted(one & two))
    first = f"{sect} {' '.join(sorted(one - two))}".strip()
    second = f"{sect} {' '.join(sorted(two - one))}".strip()
    return max(ratio(sect, first), ratio(sect, second), ratio(first, second))


def test_scores_by_hand(spark):
    pairs = [("java spring", "java", 100), ("abc", "abd", 67), ("abc", "xyz", 0), ("", "", 0),
             ("a", "", 0), ("spring java", "java spring", 100), ("café", "caf", 100)]
    df = spark.createDataFrame([(a, b) for a, b, _ in pairs], "a STRING, b STRING")
    got = [r[0] for r in df.select(fuzzy.token_set_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [score for *_, score in pairs]


words = st.lists(st.text("abcdé 1ệ", max_size=6), max_size=4).map(" ".join)


@settings(max_examples=400, deadline=None)
@given(words, words)
def test_score_equals_definition(a, b):
    got = fuzzy.token_set_score(fuzzy.Prepared(a), fuzzy.Prepared(b))
    assert got == plain_score(a, b)


@settings(max_examples=400, deadline=None)
@given(words, words, st.integers(0, 100))
def test_floor_only_hides_lower_scores(a, b, floor):
    expected = plain_score(a, b)
    got = fuzzy.token_set_score(fuzzy.Prepared(a), fuzzy.Prepared(b), floor)
    assert got == expected if expected >= floor else got < floor
