"""Rendering of pages: layout by example, and no visible word lost or hidden one shown."""

from __future__ import annotations

import random
import re
import time
from html.parser import HTMLParser

import pytest
from pyspark.sql import functions as F

from martworks.llm import html_text
from martworks.llm.common import read
from martworks.llm.html_text import page_text

CASES = {
    "": "", "plain  text\n here": "plain text here", "a<br>b<br/>c": "a\nb\nc", "<p>a<p>b": "a\n\nb", "<div>a</div><div>b</div>": "a\nb",
    "<b>a</b> <i> b</i>c": "a bc", "1 < 2 &amp; 3 &lt;4": "1 < 2 & 3 <4", "<!-- a --> b <!--> c -->d": "b c -->d",
    "<head><title>t</title><style>s</style></head>x": "x", "<title>t</title><p>x": "x", "<script>if (a</p>b) {}</script>y": "y",
    "<script>never closed": "", "<div hidden>a</div>b": "b", "<div style='color: red; DISPLAY : none'>a<p>b</div>c": "c",
    "<span style=\"visibility:hidden\">a</span>b": "b", "<textarea>a <b></textarea>": "a <b>", "<noscript>n</noscript>m": "m",
    "<ul><li>a<li>b<ul><li>c</ul><li>d</ul>": "- a\n- b\n  - c\n- d", "<ol start=9><li>a<li>b</ol>": "9. a\n10. b",
    "<ol><li><p>a</p></li><li></li></ol>": "1. a", "<dl><dt>a<dd>b<dt>c<dd>d</dl>": "a\n  b\nc\n  d",
    "<table><tr><th>a<th>bb<tr><td>ccc<td>d</table>e": "a   | bb\nccc | d\n\ne", "<table><td>x</td>out<td>y</table>": "out\n\nx | y",
    "<table><tr><td colspan=2>wide<td>z<tr><td>1<td>2<td>3</table>": "wide |   | z\n1    | 2 | 3",
    "<table><tr><td rowspan=2>r<td>1<tr><td>2</table>": "r | 1\n  | 2", "<table><tr><td hidden>h<td>v</table>": "v",
    "<table><tr><td><p>a<p>b<td>c</table>": "a | c\n\nb", "<td>a</td><tr>b": "ab", "<table><tr><td>a|</table>": "a|",
    "<table><tr><td>a<table><tr><td>b<td>c</table></table>d": "a\n\nb | c\n\nd",
    "<pre> x\n  y\n\nz </pre>": "x\n  y\n\nz".replace("x", " x", 1), "a<hr>b": "a\n\nb", "<blockquote>a</blockquote>": "  a", "</p>a</div></td>": "a",
    "<p>a<table><tr><td>b</table>c": "a\n\nb\n\nc", "<a href='x>y'>t</a>": "t", "<a href=\"x>t": "t", "a<b": "a<b", "<select><option>a<option>b</select>": "a\nb",
    "x&nbsp;y": "x y", "<p></p><p></p>a": "a", "<br><br>a": "a", "a<br><br>b": "a\n\nb",
}


@pytest.mark.parametrize("source", CASES)
def test_layout(source):
    assert page_text(source) == CASES[source]


SHOWN = {
    "<a title=\"hidden gems of Rome\">a</a>b": "ab", "<p data-x='the hidden one'>a": "a", "<p class=\"hidden lg:block\">a": "a",
    "<p data-style=\"display:none\">a": "a", "<p title=\"style='display:none'\">a": "a", "<p aria-hidden=true>a": "a",
    "<p HIDDEN>a</p>b": "b", "<p hidden=until-found>a</p>b": "b", "<p class=x hidden/>a</p>b": "b", "<p hidden style='display:block'>a": "a",
    "<p style=display:none>a</p>b": "b", "<p style='display:none;display:block'>a": "a", "<p style='display:none!important;display:block'>a</p>b": "b",
    "<p style='background:url(x;display:none)'>a": "a", "<p style='/* display:none */'>a": "a", "<p style='--display:none'>a": "a",
    "<p style='a' style='display:none'>a": "a", "<p style='display&#58;none'>a</p>b": "b",
    "<div style='visibility:hidden'>a<b style='visibility:visible'>b</b>c</div>": "b",
    "<div style='display:none'>a<b style='visibility:visible'>b</b></div>c": "c",
    "<ol><li style='visibility:hidden'>a<li>b</ol>": "2. b", "x<div style='visibility:hidden'>a</div>y": "x\ny",
    "<math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>tex</annotation></math>": "x=1", "<math><mspace/><mi>x</math>y": "xy",
    "<svg>no<title>t</title><g/><defs><text>d</text></defs><text>a<tspan>b</tspan></text><text>c</text></svg>d": "ab c d",
    "<svg><style/><path d='M0'/><text x=1>a</text></svg>b": "a b", "<svg><foreignObject><p>a</p></foreignObject></svg>": "a",
    "<svg><path><p>a": "a", "<svg/>a": "a", "<svg><tr><section>a</section><text>b</text></svg>c": "b c",
    "<table><tr><td title='colspan=3'>a<td>b<tr><td>c<td>d</table>": "a | b\nc | d", "<ol data-start=4><li>a</ol>": "1. a",
}


@pytest.mark.parametrize("source", SHOWN)
def test_only_what_hides_hides(source):
    assert page_text(source) == SHOWN[source]


class Visible(HTMLParser):
    """Words outside scripts, styles and heads, by the standard parser."""

    def __init__(self):
        super().__init__()
        self.off, self.words = [], []

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style", "title", "head"):
            self.off.append(tag)

    def handle_endtag(self, tag):
        if tag in self.off:
            self.off.remove(tag)

    def handle_data(self, data):
        if not self.off:
            self.words += data.split()


def test_no_word_of_a_page_is_lost(spark):
    for row in read(spark, "/root/testdata/sf0.01", "pages", "html").collect():
        parser = Visible()
        parser.feed(row["html"])
        found = [w for w in page_text(row["html"]).split() if w != "-"]
        assert "".join(found) == "".join(parser.words).replace(" ", "")


def test_any_tag_soup_ends_and_keeps_its_words():
    rng = random.Random(4)
    tags = "p div li ul ol table tr td th tbody caption dl dt dd b pre blockquote br hr select option a span h1 html body".split()
    for _ in range(400):
        parts, words = [], []
        for i in range(rng.randint(0, 60)):
            kind = rng.random()
            if kind < 0.5:
                parts.append(f"<{rng.choice(tags)}>")
            elif kind < 0.75:
                parts.append(f"</{rng.choice(tags)}>")
            else:
                words.append(f"w{i}q")
                parts.append(f" w{i}q ")
        found = re.findall(r"w\d+q", page_text("".join(parts)))
        assert sorted(found) == sorted(words)


def test_depth_and_length():
    assert page_text("<div>" * 50_000 + "x") == "x"
    assert page_text("<table><tr><td>" * 300 + "x").strip() == "x"
    assert len(page_text("<p>" + "word " * 500_000).split()) == 500_000
    assert page_text("<a " + "\"'" * 20_000) .startswith("<a")


def test_column_with_nulls_and_clashing_name(spark):
    pages = spark.createDataFrame([(1, "<p>a"), (2, None), (2, None), (3, "")], "page_id long, html string").withColumn("TEXT", F.lit("own"))
    found = html_text.extract(pages, "html")
    assert found.columns == ["page_id", "html", "text"]
    assert sorted((r["page_id"], r["text"]) for r in found.collect()) == [(1, "a"), (2, ""), (2, ""), (3, "")]
    assert html_text.extract(pages.limit(0), "html").count() == 0


def test_details_and_dialogs():
    assert page_text("a<details><summary>s</summary>body<p>more</details>z") == "a\ns\nz"
    assert page_text("<details open><summary>s</summary>body</details>") == "s\nbody"
    assert page_text("<details>x<summary>one</summary><summary>two</summary></details>") == "one"
    assert page_text("<dialog>no</dialog><dialog open>yes</dialog>") == "yes"


def test_many_open_elements_take_linear_time():
    for inner in ("<div>", "<p><table><tr><td><div>", "<ul><li>", "<b>"):
        begun = time.perf_counter()
        text = page_text(inner.join(["<p>x<table><tr><td>"] + [""] * (50_000 // inner.count("<"))) + "end")
        assert "x" in text and "end" in text and time.perf_counter() - begun < 10
    assert page_text("<blockquote>" * 3 + "deep").endswith("      deep")


def brute_table(cells):
    """Rows of one-line cells, each column as wide as its widest cell."""
    columns = [c for c in range(max(map(len, cells))) if any(len(row) > c and row[c] for row in cells)]
    width = {c: max(len(row[c]) for row in cells if len(row) > c) for c in columns}
    rows = [" | ".join((row[c] if len(row) > c else "").ljust(width[c]) for c in columns) for row in cells if any(row)]
    return "\n".join(re.sub(r"[ |]*$", "", row) for row in rows)


def brute_list(items, depth=0):
    """Nested lists of (marker, text, items)."""
    lines = []
    for marker, text, inner in items:
        lines.append(" " * depth + marker + text)
        lines += brute_list(inner, depth + len(marker))
    return lines


def test_tables_and_lists_against_brute_force():
    rng = random.Random(2)
    word = lambda: "".join(rng.choice("abcé") for _ in range(rng.choice((1, 2, 5, 61, 200))))
    for _ in range(60):
        cells = [[word() if rng.random() < 0.8 else "" for _ in range(rng.randrange(1, 5))] for _ in range(rng.randrange(1, 5))]
        if not any(map(any, cells)):
            continue
        source = "<table>" + "".join("<tr>" + "".join(f"<td>{c}" + rng.choice(("", "</td>")) for c in row) for row in cells) + "</table>"
        assert page_text(source) == brute_table(cells)

    def listed(depth):
        ordered, start = rng.random() < 0.5, rng.choice((1, 7, 98))
        items = [(f"{start + i}. " if ordered else "- ", word(), listed(depth + 1)[0] if depth < 3 and rng.random() < 0.5 else [])
                 for i in range(rng.randrange(1, 4))]
        return items, (ordered, start)

    def tags(items):
        number = items[0][0].removesuffix(". ")
        begin = f"<ol start={number}>" if number.isdigit() else "<ul>"
        return begin + "".join(f"<li>{text}{tags(inner) if inner else ''}" for _, text, inner in items) + ("</ol>" if number.isdigit() else "</ul>")

    for _ in range(40):
        items = listed(0)[0]
        assert page_text(tags(items)).split("\n") == brute_list(items)


def test_spans_and_numbers_out_of_range():
    assert page_text("<ol start=99999999999><li>a</ol><ol start=-3><li>b</ol><ol start=x><li>c</ol>") == "1. a\n\n-3. b\n\n1. c"
    assert page_text(f"<table><tr><td rowspan={'9' * 5000}>a<td>b<tr><td>c</table>") == "a | b\n  | c"
