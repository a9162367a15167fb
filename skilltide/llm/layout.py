"""Text of pages as laid out (operator 10).

One pass over a page's tags keeps the stack of open elements, with the ends and starts that HTML lets
out (a block ends an open paragraph, an item its predecessor, a cell or row what it follows, what is no
head content the head; a cell opens its row), and writes
visible text to the innermost open box: the page, or a table cell. Blocks start lines,
paragraphs, headings, lists and tables stand apart by a blank line, items carry bullets or
numbers and indent, cells of a table are padded to the width of their column.

Hidden: comments, scripts, styles, templates and other elements that are never shown, ``hidden``,
inputs, ``display: none`` and ``visibility: hidden`` in style attributes and for plain element, class and
id selectors of the page's style sheets, closed dialogs, and closed details but for the summary. Of several
declarations for an element the one counts that a browser takes: important ones first, then the style attribute,
ids, classes, element names, then the last. Rules in at-rules and sheets for other media than all or screen count
for nothing, and so do those under a condition (the width of a window, say), as the text shows without it.
Of a drawing (svg) the text elements are shown, each in a line, and html in foreign objects.

Null html: null text. Empty html or a page with nothing visible: empty text. Unclosed and stray tags never
fail; nesting of any depth is a stack, not a recursion. Repeated rows and ids: each row by itself. Empty
table: empty result. Input columns called like an output column are replaced.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from skilltide.llm._rows import without

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|<[!?/][^>]*+>?|[^<]++|<",
    re.S,
)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s\"'>]++)))?")
SHEET = re.compile(r"/\*.*?(?:\*/|\Z)|\"(?:[^\"\\\n]|\\.)*+\"?|'(?:[^'\\\n]|\\.)*+'?|[{};]|(?:[^{};\"'/\\]++|\\.|/(?!\*))++|\\", re.S)
SELECTOR = re.compile(r"(?:[\w-]+|\*)?(?:[.#][\w-]+)*+")
PART = re.compile(r"[.#]?[\w-]+")
CUT_OFF = re.compile(r"<[!?/]")
SHOWN = re.compile(r"(?i)(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]++(?:\s++[a-z-]++)*+)\s*+(!\s*important\s*)?(?=;|$)")
AT_RULE = re.compile(r"@([\w-]+)(.*)", re.S)
MEDIA = re.compile(r"(?i)(?:only\s+)?(?:all|screen)|not\s+(?:print|speech)|")
SPACES = re.compile(r"[ \t\n\r\f]+")

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
VERBATIM = frozenset({"xmp", "plaintext"})
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())
NEVER = frozenset("script style title template head noembed noframes noscript iframe datalist object audio video canvas rp param area source track base link meta".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl menu table blockquote pre figure fieldset hr listing xmp plaintext".split())
BLOCK = APART | frozenset(
    "html body address article aside center dd details dialog dir div dt figcaption footer form header hgroup legend li main nav "
    "optgroup option search section summary tr caption thead tbody tfoot".split()
)
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr listing main menu nav ol p plaintext pre search section summary table ul xmp".split()
)
# A start tag ends open elements of the first kind, up to the nearest element of the second.
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tbody": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "body": ({"head"}, set()),
}
IN_HEAD = frozenset("html head base basefont bgsound link meta title noframes noscript script style template".split())
PARTS = frozenset("td th tr thead tbody tfoot caption colgroup".split())
BETWEEN = frozenset("table thead tbody tfoot tr colgroup".split())  # text in these stands before the table
# The innermost open element when a part of a table starts.
PLACE = {
    **dict.fromkeys(("td", "th"), frozenset({"tr", "thead", "tbody", "tfoot", "table"})),
    "tr": frozenset({"thead", "tbody", "tfoot", "table"}),
    **dict.fromkeys(("thead", "tbody", "tfoot", "caption", "colgroup"), frozenset({"table"})),
}
# In a drawing: elements that are not drawn themselves, and html start tags that end it.
UNDRAWN = frozenset("title desc metadata defs symbol clippath mask pattern marker style script lineargradient radialgradient filter".split())
NOT_IN_SVG = frozenset(
    "b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu meta nobr ol p pre "
    "ruby s small span strong strike sub sup table tt u ul var".split()
)
SCOPE = frozenset("table td th caption html template".split())
OUTER = frozenset("tr table thead tbody tfoot body html".split())  # ends that reach out of a cell or table
LISTS = frozenset("ul ol menu dir".split())

# Bounds of the layout; no text is lost by them.
INDENT = 64  # characters that nested lists indent at most
COLUMNS = 100  # of a table that is aligned
PADDED = 120  # characters that a column is padded to


class Box:
    """Lines of text: words are joined by single spaces, breaks wait until there is more text."""

    def __init__(self):
        self.lines, self.line, self.space, self.breaks, self.bullet = [], [], False, 0, ""

    def gap(self, breaks: int) -> None:
        self.breaks = max(self.breaks, breaks)
        self.space = False

    def _start(self, indent: str) -> None:
        if self.breaks or not (self.line or self.lines):
            if self.line:
                self.lines.append("".join(self.line))
            if self.lines:
                self.lines.extend([""] * (self.breaks - 1))
            self.line, self.breaks = [indent[: len(indent) - len(self.bullet)] + self.bullet], 0
            self.bullet = ""

    def text(self, data: str, indent: str) -> None:
        words = SPACES.sub(" ", data)
        if words == " " or not words:
            self.space = self.space or bool(words)
            return
        lead = words[0] == " "
        fresh = self.breaks or not (self.line or self.lines)
        self._start(indent)
        if (lead or self.space) and not fresh:
            self.line.append(" ")
        self.line.append(words.strip(" "))
        self.space = words[-1] == " "

    def kept(self, data: str, indent: str) -> None:
        """Text whose white space counts."""
        for i, part in enumerate(data.replace("\r\n", "\n").split("\n")):
            if i:
                self.line_break()
            if part:
                self._start(indent)
                self.line.append(part)

    def line_break(self) -> None:
        self.breaks += 1
        self.space = False

    def block(self, lines: list[str], indent: str) -> None:
        """Lines that are laid out already, apart from what is around them."""
        if lines:
            self.gap(2)
            self._start(indent)
            self.line.append(lines[0])
            for line in lines[1:]:
                self.lines.append("".join(self.line))
                self.line = [indent + line]
            self.gap(2)

    def done(self) -> list[str]:
        return [x.rstrip() for x in ([*self.lines, "".join(self.line)] if self.line or self.lines else [])]


class Element:
    __slots__ = ("tag", "hidden", "box", "rows", "number", "indent", "pre", "svg", "drawn", "unseen", "spans")

    def __init__(self, tag, hidden, box, indent, pre, svg=False, drawn=True, unseen=False):
        self.tag, self.hidden, self.box, self.indent, self.pre = tag, hidden, box, indent, pre
        self.svg, self.drawn, self.unseen = svg, drawn, unseen
        self.rows, self.number, self.spans = None, None, (1, 1)


def _attributes(source: str) -> dict[str, str]:
    a: dict[str, str] = {}
    if source.strip(" /\t\r\n"):
        for m in ATTRIBUTE.finditer(source):
            a.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return a


def _empty(attributes: str) -> bool:
    """Whether a tag ends in a slash that is not part of a bare value."""
    return attributes.endswith("/") and not re.search(r"=\s*[^\s\"']+\Z", attributes)


def _span(value: str, most: int) -> int:
    return min(int(value), most) if re.fullmatch(r"[0-9]{1,9}", value) and int(value) else 1


class Cell:
    __slots__ = ("lines", "across", "down", "left", "row", "at", "end")

    def __init__(self, lines: list[str], across: int = 1, down: int = 1):
        self.lines, self.across, self.down = lines, across, down


def _placed(rows: list[list[Cell]]) -> list[list[Cell]] | None:
    """For each row the cells that are in it, from left to right: its own, each in the first free columns, and those that
    reach down from rows above. None if they are too many."""
    out, above = [], []
    for r, row in enumerate(rows):
        here, at, k = [], 0, 0
        above = [c for c in above if c.row + c.down > r]
        if len(above) + len(row) > COLUMNS:
            return None
        for cell in row:
            while k < len(above) and above[k].left < at + cell.across:
                at = max(at, above[k].left + above[k].across)
                here.append(above[k])
                k += 1
            cell.left, cell.row = at, r
            at += cell.across
            here.append(cell)
        above = [*here, *above[k:]]
        out.append(above)
    return out


def _aligned(rows: list[list[Cell]]) -> list[str]:
    """The lines of a table. Columns in which no cell begins are not drawn, nor are rows without text. A table of too many
    columns is written row by row."""
    placed = _placed(rows)
    columns = sorted({c.left for row in rows for c in row}) if placed is not None else []
    if placed is None or len(columns) > COLUMNS:
        lines = [[" ".join(x.strip() for x in c.lines if x.strip()) for c in row] for row in rows]
        return [" | ".join(x).rstrip() for x in lines if any(x)]
    number = {c: i for i, c in enumerate(columns)}
    wide, high = [0] * len(columns), [0] * len(rows)
    cells = [c for row in rows for c in row]
    for c in cells:
        c.at, c.end = number[c.left], bisect_left(columns, c.left + c.across)
    for c in sorted(cells, key=lambda c: c.end - c.at):
        need = min(max(map(len, c.lines), default=0), PADDED)
        wide[c.end - 1] += max(0, need - sum(wide[c.at : c.end]) - 3 * (c.end - c.at - 1))
    for c in sorted(cells, key=lambda c: c.down):
        last = min(c.row + c.down, len(rows))
        high[last - 1] += max(0, len(c.lines) - sum(high[c.row : last]))
    tops, out = [0, *accumulate(high)], []
    for r, row in enumerate(placed):
        for k in range(tops[r], tops[r + 1]):
            parts = []
            for c in row:
                text = c.lines[k - tops[c.row]] if k - tops[c.row] < len(c.lines) else ""
                parts.append(text.ljust(sum(wide[c.at : c.end]) + 3 * (c.end - c.at - 1)))
            out.append(" | ".join(parts).rstrip())
    return out


def _declared(body: str):
    """(property, hides, important) of the declarations that show or hide."""
    if "display" in (low := body.lower()) or "visibility" in low:
        for m in SHOWN.finditer(body):
            yield m[1].lower(), m[2].lower() in ("none", "hidden", "collapse"), bool(m[3])


def _for_screen(media: str) -> bool:
    return any(MEDIA.fullmatch(x.strip()) for x in media.split(","))


def _rules(sheet: str):
    """(selectors, declarations, whether in no layer) of the rules that hold on a screen whatever its size."""
    said: list[str] = []
    open_rules: list[tuple[str, int]] = []  # group or rule, and 0 if it does not count, 1 if it is in a layer, 2 if not
    body: list[str] = []
    selectors = ""
    for m in SHEET.finditer(sheet):
        token = m[0]
        if token.startswith("/*"):
            said.append(" ")
        elif token == "{":
            head, said = re.sub("<!--|-->", " ", "".join(said)).strip(), []
            kind, counts = open_rules[-1] if open_rules else ("group", 2)
            if kind == "group" and head.startswith("@"):
                name, rest = m.groups() if (m := AT_RULE.match(head)) else ("", "")
                holds = {"layer": 1, "media": 2 * _for_screen(rest)}.get(name.lower(), 0)
                open_rules.append(("group", min(counts, holds)))
            else:
                if kind == "group":
                    selectors, body = head, []
                open_rules.append(("rule", counts if kind == "group" else 0))
        elif token == "}":
            if open_rules:
                kind, counts = open_rules.pop()
                if kind == "rule" and counts:
                    yield selectors, "".join([*body, *said]), counts == 2
            said = []
        elif token == ";":
            if open_rules and open_rules[-1][0] == "rule" and open_rules[-1][1]:
                body += [*said, ";"]
            said = []
        else:
            said.append('""' if token[0] in "\"'" else token)
    if open_rules and open_rules[-1][0] == "rule" and open_rules[-1][1]:
        yield selectors, "".join([*body, *said]), open_rules[-1][1] == 2


class Sheets:
    """For each selector of one element (its name, classes and ids) and property the declaration that counts: its rank, and whether
    it hides. A rank is (important, in the style attribute, in no layer or else important, ids, classes, names, place)."""

    def __init__(self):
        self.found: dict[str, dict[frozenset, dict[str, tuple[tuple, bool]]]] = {}
        self.place = 0

    def add(self, sheet: str) -> None:
        for selectors, body, plain in _rules(sheet):
            declared = list(_declared(body))
            for name in [x.lower() for x in map(str.strip, selectors.split(",")) if x and SELECTOR.fullmatch(x)] if declared else []:
                parts = PART.findall(name)
                if not parts:
                    continue
                ids, classes = (sum(x[0] == sign for x in parts) for sign in "#.")
                # looked up by its last part
                held = self.found.setdefault(parts[-1], {}).setdefault(frozenset(parts), {})
                for what, hides, important in declared:
                    self.place += 1
                    new = ((important, False, plain != important, ids, classes, len(parts) - ids - classes, self.place), hides)
                    held[what] = max(held.get(what, new), new)

    def hide(self, tag: str, a: dict[str, str]) -> dict[str, bool]:
        """Whether ``display`` and ``visibility`` are declared for an element, and hide it."""
        best: dict[str, tuple[tuple, bool]] = {}
        for i, (what, hides, important) in enumerate(_declared(a["style"]) if "style" in a else ()):
            new = ((important, True, False, 0, 0, 0, i), hides)
            best[what] = max(best.get(what, new), new)
        if self.found:
            names = {tag, *(f".{c}" for c in a.get("class", "").lower().split()), *([f"#{a['id'].lower()}"] if "id" in a else [])}
            for name in names & self.found.keys():
                for parts, declared in self.found[name].items():
                    if parts <= names:
                        for what, new in declared.items():
                            best[what] = max(best.get(what, new), new)
        return {what: hides for what, (_, hides) in best.items()}


class Page:
    """The stack of open elements; ``at`` has the places in it of those of each tag, ``tables`` of tables that are laid out."""

    def __init__(self):
        self.box = Box()
        self.root = Element("", False, self.box, "", False)
        self.stack, self.sheets, self.at, self.tables = [self.root], Sheets(), defaultdict(list), []

    def push(self, e: Element) -> None:
        self.at[e.tag].append(len(self.stack))
        if e.rows is not None:
            self.tables.append(len(self.stack))
        self.stack.append(e)

    def last(self, tags) -> int:
        """The place of the innermost open element of some tags; 0 if there is none."""
        return max((self.at[t][-1] for t in tags if self.at[t]), default=0)

    def close(self) -> None:
        e = self.stack.pop()
        self.at[e.tag].pop()
        up = self.stack[-1]
        if e.rows is not None:
            self.tables.pop()
        if e.tag == "table":
            if not e.hidden:
                up.box.block(_aligned(e.rows), up.indent)
        elif e.tag in ("td", "th") and e.box is not up.box:
            if not e.hidden and self.tables:
                rows = self.stack[self.tables[-1]].rows
                if not rows:
                    rows.append([])
                rows[-1].append(Cell(e.box.done(), *e.spans))
        elif e.svg:
            if not e.hidden and e.tag in ("text", "foreignobject"):
                e.box.gap(1)
        elif not e.hidden and e.tag in BLOCK:
            if e.tag == "li":
                e.box.bullet = ""  # nothing came to stand behind it
            e.box.gap(2 if e.tag in APART and not (e.tag in ("ul", "ol") and self.within("li")) else 1)

    def around(self) -> Element:
        """The innermost open element that holds text: outside a table, or in one of its cells."""
        return next(e for e in reversed(self.stack) if e.tag not in BETWEEN)

    def holder(self) -> Element | None:
        """The table whose parts may start here; none in a template, which has parts of its own."""
        at = self.last(("table", "template"))
        return self.stack[at] if self.stack[at].tag == "table" else None

    def between(self) -> bool:
        """Whether a table is open here and none of its cells."""
        return bool(self.at["table"]) and self.last(BETWEEN) > self.last(("td", "th", "caption", "template"))

    def within(self, tag: str) -> bool:
        return bool(self.at[tag]) and self.at[tag][-1] >= self.last(SCOPE)

    def close_to(self, tags, stop) -> None:
        """End the outermost open element of ``tags`` this side of ``stop``, and all in it."""
        low, first = self.last(stop), 0
        for t in tags:
            places = self.at[t]
            if places and places[-1] > low:
                at = places[bisect_right(places, low)]
                first = min(first or at, at)
        while first and len(self.stack) > first:
            self.close()

    def hides(self, tag: str, a: dict[str, str], up: Element) -> tuple[bool, bool]:
        """Whether an element is left out with all that is in it, and whether it is not seen, though what is in it may be."""
        said = self.sheets.hide(tag, a)
        return up.hidden or said.get("display", "hidden" in a), said.get("visibility", up.unseen)

    def draw(self, tag: str, attributes: str) -> None:
        """A start tag in a drawing; those that end in a slash hold nothing."""
        up, a = self.stack[-1], _attributes(attributes)
        if _empty(attributes) or tag in PARTS:
            return
        gone, unseen = self.hides(tag, a, up)
        if a.get("visibility"):
            unseen = a["visibility"] in ("hidden", "collapse")
        hidden = tag in UNDRAWN or a.get("display") == "none" or gone
        e = Element(tag, hidden, up.box, up.indent, False, True, tag in ("text", "foreignobject") or (up.drawn and up.svg), unseen)
        if not hidden and (tag in ("text", "foreignobject") or (tag == "tspan" and not a.keys().isdisjoint(("x", "y")))):
            e.box.gap(1)
        self.push(e)

    def start(self, tag: str, attributes: str) -> None:
        if self.stack[-1].svg and self.stack[-1].tag != "foreignobject":
            if tag not in NOT_IN_SVG:
                self.draw(tag, attributes)
                return
            while self.stack[-1].svg and self.stack[-1].tag != "foreignobject":
                self.close()
        if self.stack[-1].tag == "head":
            if tag == "head":
                return
            if tag not in IN_HEAD:
                self.close()
        if tag in PARTS and self.holder() is None:
            return  # parts of a table count in a table only; what is in them stays
        if tag == "table" and self.between():
            while self.stack[-1].tag != "table":
                self.close()
            self.close()
        if tag in ENDS_P and self.within("p"):
            self.close_to({"p"}, SCOPE)
        if tag in IMPLIED:
            self.close_to(*IMPLIED[tag])
        if tag in PLACE:
            while self.stack[-1].tag not in PLACE[tag]:
                self.close()
        if tag in ("td", "th") and self.stack[-1].tag != "tr":
            self.start("tr", "")
        up = self.stack[-1] if tag in PARTS else self.around()
        a = _attributes(attributes)
        gone, unseen = self.hides(tag, a, up)
        hidden = tag in NEVER or gone
        if tag == "dialog" and "open" not in a:
            hidden = True
        if not hidden and up.tag == "details" and up.number == 0 and tag != "summary":
            hidden = True
        if tag == "br":
            if not hidden:
                up.box.line_break()
            return
        if tag == "hr" and not hidden:
            up.box.gap(2)
        if tag in VOID or (tag == "svg" and _empty(attributes)):
            return
        e = Element(tag, hidden, up.box, up.indent, up.pre or tag in ("pre", "textarea", "listing", *VERBATIM), tag == "svg", tag != "svg", unseen)
        if hidden:
            self.push(e)
            return
        if tag in BLOCK and tag not in ("tr", "thead", "tbody", "tfoot", "table"):
            e.box.gap(2 if tag in APART and not (tag in ("ul", "ol") and self.within("li")) else 1)
        if tag in ("ul", "ol", "menu", "dir"):
            start = a.get("start", "1")
            e.number = int(start) if tag == "ol" and re.fullmatch(r"-?[0-9]{1,9}", start) else 1 if tag == "ol" else None
        elif tag == "li":
            owner = self.stack[self.last(LISTS)]
            mark = "- "
            if owner.tag in LISTS and owner.number is not None:
                value = a.get("value", "")
                owner.number = int(value) if re.fullmatch(r"-?[0-9]{1,9}", value) else owner.number
                mark = f"{owner.number}. "
                owner.number += 1
            e.indent = (up.indent + " " * len(mark))[: max(INDENT, len(mark))]
            e.box.bullet = "" if unseen else mark
        elif tag in ("dd", "blockquote"):
            e.indent = (up.indent + "  ")[:INDENT]
        elif tag == "details":
            e.number = 1 if "open" in a else 0
        elif tag == "table":
            e.rows, e.box = [], Box()
        elif tag == "tr":
            if self.tables:
                self.stack[self.tables[-1]].rows.append([])
        elif tag in ("td", "th"):
            e.box, e.indent, e.spans = Box(), "", (_span(a.get("colspan", ""), 1000), _span(a.get("rowspan", ""), 65534))
        elif tag == "caption" and self.at["table"]:
            outside = self.stack[self.at["table"][-1] - 1]
            e.box, e.indent = outside.box, outside.indent
            e.box.gap(2)
        self.push(e)

    def end(self, tag: str) -> None:
        if tag == "br":
            self.start("br", "")
        if tag == "p" and not self.within("p"):
            self.start("p", "")
        closed = self.last((tag,))
        if not closed or tag not in OUTER and closed < self.last(("td", "th", "table", "caption")):
            return
        while len(self.stack) > closed:
            self.close()

    def text(self, data: str, verbatim: bool = False) -> None:
        if self.stack[-1].tag == "head" and data.strip(" \t\n\r\f"):
            self.close()
        e = self.stack[-1]
        if e.tag in BETWEEN:
            if not data.strip():
                return
            e = self.around()
        if e.hidden or e.unseen or not e.drawn or (e.tag == "details" and e.number == 0):
            return
        if "&" in data and not verbatim:
            data = html.unescape(data)
        (e.box.kept if e.pre else e.box.text)(data, e.indent)


def rendered(source: str) -> str:
    """The visible text of a page."""
    page, at, n = Page(), 0, len(source)
    last = source.rfind(">")
    while at < n:
        if at > last:
            # nothing closes here any more: text up to what would open a comment or an end tag
            cut = CUT_OFF.search(source, at)
            page.text(source[at : cut.start() if cut else n])
            break
        m = TOKEN.match(source, at)
        at = m.end()
        tag = m[2] or m[5]
        if tag is None:
            token = m[0]
            if token[0] != "<" or token == "<":
                page.text(token)
            continue
        tag = tag.lower()
        if m[1] or m[4]:
            page.end(tag)
            continue
        attributes = (m[3] if m[2] else m[6]) or ""
        page.start(tag, attributes)
        if tag in RAW and page.stack[-1].tag == tag:
            close = tag != "plaintext" and re.compile(rf"</{re.escape(tag)}\b", re.I).search(source, at)
            stop = close.start() if close else n
            if tag == "style":
                if _for_screen(_attributes(attributes).get("media", "")):
                    page.sheets.add(source[at:stop])
            elif tag == "textarea" or tag in VERBATIM:
                page.text(source[at:stop], tag in VERBATIM)
            at = stop
    while len(page.stack) > 1:
        page.close()
    return "\n".join(page.box.done())


@F.pandas_udf(StringType())
def layout_text(pages: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for page in pages:
        yield page.map(rendered, na_action="ignore")


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text``."""
    kept = without(pages, ["text", html_col])
    return pages.select(*[F.col(f"`{c}`") for c in kept.columns], layout_text(F.col(f"`{html_col}`").cast("string")).alias("text"))
