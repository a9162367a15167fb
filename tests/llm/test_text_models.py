"""Operators 4, 5 and 10."""

import html
import re
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import functions as F

from skilltide.llm import hyperlang, layout, licenses
from skilltide.llm.queries import QUERIES, table

# --- language


def test_language_of_rows_kept_back(spark, sf_dir, documents):
    found = QUERIES["op4_hyperdimensional_language"](spark, sf_dir).join(documents.select("doc_id", "lang", "text"), "doc_id")
    rows = found.filter("held_out AND length(text) >= 40").collect()
    assert len(rows) > 20 and sum(r["lang_pred"] == r["lang"] for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_vectors_are_those_of_the_definition():
    space = hyperlang.Space(64, 3)
    runs, text, has = hyperlang.letter_runs(["ab, c", "1 2"], 3)
    spelled = ["".join(chr((int(r) >> (21 * i)) & (2**21 - 1)) for i in (2, 1, 0)).replace("\0", " ") for r in runs]
    assert spelled == [" ab", "ab ", "b c", " c "][: len(spelled)] or spelled == [" ab", "ab ", "b c", " c "]
    assert has.tolist() == [True, False] and set(text.tolist()) == {0}
    a, b, gap = space.letter(ord("a")), space.letter(ord("b")), space.letter(0)
    assert np.array_equal(space.vectors(runs[:1])[0], np.roll(gap, 2) * np.roll(a, 1) * b)


def test_language_of_odd_rows(odd, none):
    model = hyperlang.learn(odd)
    assert set(model[0]) == {"de", "en", "fr"}
    rows = hyperlang.predict(odd, model).collect()
    assert len(rows) == odd.count()
    assert all((r["lang_pred"] == "und") == (r["score"] == 0.0) for r in rows)
    assert {r["lang_pred"] for r in rows if r["doc_id"] in (4, 5, 6)} == {"und"}
    nothing = hyperlang.learn(none)
    assert {r["lang_pred"] for r in hyperlang.predict(odd, nothing).collect()} == {"und"}
    assert hyperlang.predict(none, model).count() == 0


# --- licences

NOTICES = {
    "MIT": "Released under the MIT License.", "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL": "This work is licensed under the GNU General Public License, version 3.", "CC-BY-NC": "Licensed under CC BY-NC 4.0.", "Proprietary": "All rights reserved.",
}


def test_licences_of_documents(spark, sf_dir, documents):
    found = {r["doc_id"]: r for r in QUERIES["op5_license_paragraphs"](spark, sf_dir).collect()}
    for r in documents.collect():
        held = {f for f, t in NOTICES.items() if t in (r["text"] or "")}
        families = set(filter(None, found[r["doc_id"]]["families"].split(",")))
        assert held == families - {"unknown"}, r["doc_id"]
        assert found[r["doc_id"]]["n_paragraphs"] == sum(bool(re.search("[0-9A-Za-z\x80-\U0010ffff]", x)) for x in (r["text"] or "").split("\n"))


def test_unknown_and_long_lines(spark, odd, none, documents):
    model = licenses.learn(documents)
    many = " ".join(f"plain{i}" for i in range(500))
    rows = [
        (1, "Licensed under the Zorgon license."), (2, f"{many} {NOTICES['MIT']} {many}"), (3, "We talked about the license of a taxi driver in the city"),
        (4, "This program is free software: redistribute it under the terms of the GNU Affero General Public License as published by the Free Software Foundation"),
    ]
    got = {r["doc_id"]: r for r in licenses.license_findings(spark.createDataFrame(rows, "doc_id INT, text STRING"), model=model).collect()}
    assert {x["family"] for x in got[1]["findings"]} == {"unknown"}
    assert {x["family"] for x in got[2]["findings"]} - {"unknown"} == {"MIT"}
    assert not {x["family"] for x in got[3]["findings"]} - {"unknown"}
    assert {x["family"] for x in got[4]["findings"]} - {"unknown"} == {"AGPL"}
    assert licenses.license_findings(odd, model=model).count() == odd.count()
    assert licenses.license_findings(none, model=model).count() == 0
    assert len(licenses.learn(none)[0]) == len(licenses.TEMPLATES) + 2


# --- layout


class Visible(HTMLParser):
    """All words outside elements that are never shown."""

    def __init__(self):
        super().__init__()
        self.words, self.depth = [], 0

    def handle_starttag(self, tag, attrs):
        self.depth += tag in ("script", "style", "title")

    def handle_endtag(self, tag):
        self.depth -= tag in ("script", "style", "title")

    def handle_data(self, data):
        if not self.depth:
            self.words += data.split()


def test_all_words_of_pages_in_order(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    for r in layout.extract_text(pages.select("page_id", "html", F.col("html").alias("source"))).collect():
        plain = Visible()
        plain.feed(r["source"])
        plain.close()
        got = re.sub(r"(?m)^(\s*)(- |[0-9]+\. )", r"\1", r["text"])
        assert "".join(got.split()) == "".join("".join(plain.words).split()), r["page_id"]


def test_layout():
    page = """<!doctype html><title>no</title><style>.ad, #x{display:none} p{margin:0}</style><body><h1>Head &amp; tail</h1>
    <p>One <b>bold<p>Two<br>lines<ul><li>a<li>b<ol start=3><li>c<li>d</ol><li>e</ul>
    <table><caption>Cap</caption><tr><th>Name<th>Age<tr><td>Jo<td>5<tr><td>Alexander<td>77</table>
    <div class="big ad">hidden</div><span id=x>no</span><i style="visibility: hidden">no</i><p hidden>no</p>
    <pre>  keep
   this</pre><details><summary>More</summary>not open</details><!-- no --><noscript>no</noscript>end"""
    assert layout.rendered(page) == "\n".join([
        "Head & tail", "", "One bold", "", "Two", "lines", "", "- a", "- b", "  3. c", "  4. d", "- e", "", "Cap", "",
        "Name      | Age", "Jo        | 5", "Alexander | 77", "", "  keep", "   this", "", "More", "end",
    ])


def test_layout_of_broken_pages(spark):
    deep = "<div>" * 50_000 + "x"
    rows = [(1, None), (2, ""), (3, "<p"), (4, "a < b & c"), (5, deep), (6, "<td>x</td></p></table><li>y"), (7, "<script>if (a<b) x</script>z"), (8, "<a href='x\">q</a>w"), (None, "<p>n")]
    got = {r["page_id"]: r["text"] for r in layout.extract_text(spark.createDataFrame(rows, "page_id INT, html STRING")).collect()}
    assert got[1] is None and got[2] == "" and got[4] == "a < b & c" and got[5] == "x" and got[7] == "z" and got[None] == "n"
    assert html.unescape(got[6]).split() == ["x", "-", "y"]
    assert layout.extract_text(spark.createDataFrame([], "page_id INT, html STRING, text INT")).columns == ["page_id", "text"]


def test_implied_head_ends_and_rows():
    """Every way to let out the tags of a head or row gives the text of the page with all its tags."""
    whole = layout.rendered("<!doctype html><html><head><title>t</title></head><body><p>Hello</p></body></html>")
    for ends in ("", "</head>", "<body>", "</head><body>"):
        for start in ("<html><head>", "<head>", "<head><meta charset=utf-8><style>p{margin:0}</style>"):
            for text in ("<p>Hello", "Hello", "\n <div>Hello</div>"):
                assert layout.rendered(f"<!doctype html>{start}<title>t</title>{ends}{text}") == whole == "Hello"
    full = "a | b\nc | d"
    assert layout.rendered("<table><tbody><tr><td>a</td><td>b</td></tr><tr><td>c</td><td>d</td></tr></tbody></table>") == full
    for body in ("", "<tbody>", "<thead>"):
        for around in ("", "<form>", "<div>", "<b>"):
            for row in ("<tr>", f"<tr>{around}", f"{around}<tr>"):
                for first in ("", around, row):
                    for end in ("", "</form>"):
                        page = f"<table>{body}{first}<td>a<td>b{end}{row}<td>c{end}<td>d</table>"
                        assert layout.rendered(page) == full, page


def test_text_between_cells_is_kept():
    assert layout.rendered("<table><form><td>x") == "x"
    assert layout.rendered("x<table><div>one</div><tr>two<td>a<td>b</table>y").split() == ["x", "one", "two", "a", "|", "b", "y"]
    assert layout.rendered("<table><tr><td>a<table><td>in</table><td>b</table>").split() == ["a", "|", "b", "|", "in", "|"]
    assert layout.rendered("<table><tr><td>a</table><table><tr><table><td>c</table>").split() == ["a", "c"]
    assert layout.rendered("<table><tr><td>a<template><td>no</template><td>b</table>") == "a | b"


def test_the_rule_that_counts_decides():
    def shown(sheet, tag="<p class=x id=y>", style="<style>"):
        return layout.rendered(f"{style}{sheet}</style>{tag}text</p>") == "text"

    hide = ".x{display:none}"
    assert not shown(hide)
    # what holds elsewhere, or under a condition only
    for at in ("@media print", "@media print, (max-width: 600px)", "@media screen and (max-width:600px)", "@media(max-width:9px)", "@supports not (a:b)", "@page :first"):
        assert shown(f"{at}{{a{{color:red}}{hide}}}p{{margin:0}}") and not shown(f"{at}{{b{{display:block}}}}{hide}"), at
    for at in ("@media screen", "@media all", "@media\nonly screen", "@media print, screen", "@media not print", "@media", "@layer a"):
        assert not shown(f'@import "a;b{{";{at}{{{hide}}}p{{margin:0}}'), at
    assert shown(hide, style="<style media=print>") and not shown(hide, style="<style media='screen, print'>")
    # of several declarations one counts
    assert shown(f"{hide}.x{{display:block}}") and not shown(f".x{{display:block}}{hide}")
    assert shown(".x{display:none;color:red;display:flex}") and not shown(".x{display:none!important}.x{display:block}")
    assert shown("#y{display:block}.x{display:none}") and not shown("p{display:block}.x{display:none}") and not shown(f"{hide}.x{{visibility:visible}}")
    assert shown(hide, "<p class=x style='display:block'>") and not shown(".x{display:block}", "<p class=x style='display:none'>")
    assert not shown(f"@layer a{{.x{{display:block}}}}{hide}") and not shown(f"{hide}@layer a{{.x{{display:block}}}}")
    assert not shown("<!-- .x{display:none} -->") and not shown("a{b{c:d}}/* } */.x{content:'}';display:none") and shown("a{.x{display:none}}")


def test_text_of_drawings_and_verbatim_elements():
    drawing = (
        "<svg viewBox='0 0 9 9'><title>no</title><desc>no</desc><defs><text>no</text></defs><g>no<path d=M0 /><text x=1>One <tspan>two</tspan>"
        "<tspan x=1 dy=1>three</tspan></text><title/><text display=none>no</text></g><foreignObject><p>in html</p></foreignObject></svg>"
    )
    assert layout.rendered(f"before{drawing}after").split() == ["before", "One", "two", "three", "in", "html", "after"]
    assert layout.rendered("a<svg/>b<svg><g>no<p>c") == "ab\n\nc"
    assert layout.rendered("<p>a<xmp>  <b>&amp;\n x</xmp>b") == "a\n\n  <b>&amp;\n x\n\nb"
    assert layout.rendered("<p>a<plaintext><i>b</plaintext>") == "a\n\n<i>b</plaintext>"


def test_notices_wrapped_over_lines(spark, documents):
    model = licenses.learn(documents)
    texts = {
        "BSD": "Redistribution and use in source and binary forms, with or without\nmodification, are permitted provided that the following conditions\nare met:",
        "ISC": "Permission to use, copy, modify, and/or distribute this software for any\npurpose with or without fee is hereby granted, provided that the above\n"
        "copyright notice and this permission notice appear in all copies.",
        "MIT": "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files (the \"Software\"), to deal\n"
        "in the Software without restriction, including without limitation the rights",
    }
    rows = []
    for family, text in texts.items():
        for sign in ("", "# ", " * ", "// ", "; "):
            notice = "\n".join(sign + x for x in text.split("\n"))
            plain = "\n".join(f"we had a walk in the town on day {i} of may" for i in range(9))
            rows += [(family, sign, x) for x in (notice, f"{sign}Copyright (c) 2020 Jo\n{sign}\n{notice}\n\nint main", f"{plain}\n{notice}\n{plain}", notice.replace("\n", "\r\n"))]
    df = spark.createDataFrame(rows, "family STRING, sign STRING, body STRING").selectExpr("*", "body AS text")
    for r in licenses.license_findings(df, model=model).collect():
        found = [x for x in r["findings"] if x["family"] != "unknown"]
        assert {x["family"] for x in found} == {r["family"]}, (r["body"], r["findings"])
        lines = [x for x in r["body"].split("\n") if re.search("[0-9A-Za-z]", x)]
        assert {lines[x["paragraph"]].strip("#*/; \r").split()[0] for x in found} <= {"Redistribution", "Permission"}
    blank = texts["BSD"].replace("\n", "\n\n")
    apart = licenses.license_findings(spark.createDataFrame([(blank,)], "text STRING"), model=model).first()
    assert not {x["family"] for x in apart["findings"]} - {"unknown"}  # a blank line ends a notice
