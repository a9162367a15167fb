"""Operator 10: cells of several lines, spans, what is seen in what is not, and time."""

import time

import pytest

from skilltide.llm import layout


def lines(html):
    return layout.rendered(html).split("\n")


def test_cells_of_several_lines():
    assert lines("<table><tr><td><p>One</p><p>Two</p><ul><li>a<li>b</ul></td><td>x") == [
        "One | x", "    |", "Two |", "    |", "- a |", "- b |",
    ]
    assert lines("<table><tr><td><pre>a\n  b</pre><td>x<br>y") == ["a   | x", "  b | y"]
    # a page laid out by a table keeps its blocks
    assert lines("<table><tr><td><h1>Head</h1><p>One</p><p>Two</p></table>end") == ["Head", "", "One", "", "Two", "", "end"]


def test_spans():
    assert lines("<table><tr><th colspan=2>Head<th>C<tr><td>aaaaaaa<td>b<td>c</table>") == ["Head        | C", "aaaaaaa | b | c"]
    assert lines("<table><tr><td rowspan=2>A<td>b<td>c<tr><td>d<td>e<tr><td>f<td>g<td>h</table>") == ["A | b | c", "  | d | e", "f | g | h"]
    assert lines("<table><tr><td rowspan=2>A<br>B<br>C<td>b<tr><td>d</table>") == ["A | b", "B | d", "C |"]
    assert lines("<table><tr><td colspan=0 rowspan=x>a<td colspan=999999999>b<tr><td>c<td>d<td>e</table>") == ["a | b", "c | d | e"]


def test_empty_rows_and_bars():
    assert lines("<table><tr><td><td><tr><td>|<td>x<tr><td> </table>") == ["| | x"]
    assert layout.rendered("<table><tr><td></table>") == ""


def test_what_is_seen_in_what_is_not():
    assert layout.rendered('<div style="visibility:hidden">h<span style="visibility:visible">shown</span></div>') == "shown"
    assert layout.rendered('<div style="display:none">h<span style="display:block;visibility:visible">no</span></div>x') == "x"
    assert layout.rendered('<ul><li style="visibility:hidden">h</li><li>x</ul>') == "- x"
    assert layout.rendered("<style>.a{visibility:hidden}.a .b,b{visibility:visible}</style><p class=a>no<b>yes</b>") == "yes"
    assert layout.rendered("<ul><li></li></ul><p>after") == "after"


def test_selectors_of_several_parts():
    page = "<style>div.x,p.a.b,#i.c{display:none}p.a{display:block}</style><div class=x>1</div><p class=x>2</p><p class='b a'>3</p><p id=i>4</p><p id=i class=c>5"
    assert layout.rendered(page).split() == ["2", "4"]
    assert layout.rendered("<style>*{display:none}</style><p>shown</p>") == "shown"  # no part to look up by


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "<li>x" * 100_000, "<a b='" * 170_000, "<a " * 330_000, "<ul><li>x" * 100_000, "<table><tr><td>" * 60_000,
        "<table><tr>" + "<td rowspan=9999 colspan=3>a" * 30_000 + "<tr><td>b" * 20_000, "<table>" + "<tr><td rowspan=65534>x" * 40_000,
        "<p><b>" * 160_000, "</p>" * 200_000, "<!--" * 250_000, "<style>" + ".a.b{display:none}" * 50_000 + "</style>" + "<p class='a b'>x" * 3,
        "<table><tr><td>" + "long " * 20_000 + "<td>x" + "<tr><td>a<td>b" * 60_000, "<svg><g>" * 120_000, "<select><option>x" * 60_000,
    ],
)
def test_a_megabyte_takes_seconds(page):
    start = time.perf_counter()
    layout.rendered(page)
    assert time.perf_counter() - start < 25


def test_no_text_is_lost_by_the_bounds():
    wide = "<table><tr>" + "".join(f"<td>c{i}" for i in range(400)) + "<tr><td colspan=400><p>x</p><p>y</p></table>"
    assert [w for w in layout.rendered(wide).split() if w != "|"] == [f"c{i}" for i in range(400)] + ["x", "y"]
    deep = "".join(f"<ul><li>n{i}" for i in range(200))
    assert [w for w in layout.rendered(deep).split() if w != "-"] == [f"n{i}" for i in range(200)]
    assert max(map(len, lines(deep))) < 100
