import random
import re
from html.parser import HTMLParser

import pytest

from urbanstats.llm.queries import QUERIES
from urbanstats.llm.rendering import extract_text, visible_text

SF = "/root/testdata/sf0.01"


class Plain(HTMLParser):
    """All text outside head, script and style, without any layout."""

    def __init__(self):
        super().__init__()
        self.skip, self.out = None, []

    def handle_starttag(self, tag, attrs):
        if tag in ("head", "script", "style") and self.skip is None:
            self.skip = tag
        self.out.append(" ")

    def handle_endtag(self, tag):
        if tag == self.skip:
            self.skip = None
        self.out.append(" ")

    def handle_data(self, data):
        if self.skip is None:
            self.out.append(data)


def letters(text):
    return re.sub(r"\s+", "", text)


def test_query_has_all_visible_text(spark):
    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = QUERIES["op2_html_extraction"](spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        plain = Plain()
        plain.feed(pages[r["page_id"]])
        plain.close()
        # List marks are the renderer's own.
        text = re.sub(r"(?m)^\s*- ", "", r["text"])
        assert letters(text) == letters("".join(plain.out))


CASES = {
    "implied ends": ("<p>one<p>two<div>three</div>four", "one\n\ntwo\n\nthree\nfour"),
    "inline": ("a<b>b</b> <i> c </i>d<span>e</span>", "ab c de"),
    "breaks": ("a<br>b<br><br>c", "a\nb\n\nc"),
    "list": ("<ul><li>a<li>b<ol start=9><li>x<li value=4>y</ol></ul>z", "- a\n- b\n  9. x\n  4. y\n\nz"),
    "definitions": ("<dl><dt>t<dd>one<dd>two</dl>", "t\n  one\n  two"),
    "table": (
        "<table><tr><th>Name<th>Qty<tr><td>long name<td>3<tr><td>x<td>12</table>",
        "Name       Qty\nlong name  3\nx          12",
    ),
    "spans": (
        "<table><tr><td rowspan=2>r<td>1<tr><td>2<tr><td colspan=2>both</table>",
        "r  1\n   2\nboth",
    ),
    "cell lines": ("<table><tr><td>a<br>b<td>c</table>", "a  c\nb"),
    "nested table": ("<table><tr><td><table><tr><td>i<td>j</table><td>o</table>", "i  j  o"),
    "caption": ("<table><caption>cap</caption><tr><td>x</table>", "cap\nx"),
    "no table": ("<td>a<td>b", "a\nb"),
    "pre": ("<pre>\n a\n  b\n\nc</pre>", " a\n  b\n\nc"),
    "hidden": ("<p hidden>a</p><p style='color:red; display : none'>b</p>c", "c"),
    "visibility": ("<p style=visibility:hidden>a<b style=visibility:visible>b</b></p>", "b"),
    "details": ("<details><summary>s</summary>b</details><details open>o</details>", "s\no"),
    "unseen": ("<head><title>t</title></head><script>if (a<b)</script><template>x</template>y", "y"),
    "comments": ("a<!-- b -->c<!-- open", "ac"),
    "entities": ("&lt;a&gt; &amp;amp; &eacute;&#233;&nbsp;x", "<a> &amp; éé\xa0x"),
    "misnested": ("<b>a<i>b</b>c</i>d", "abcd"),
    "stray": ("a</p></table>b < c <unclosed", "ab < c"),
    "button": ("<input type=submit value=Go><input value=no>", "Go"),
    "quote": ("x<blockquote>q<p>r</blockquote>y", "x\n\n  q\n\n  r\n\ny"),
    "upper case": ("<P>A<BR/>B</P><SCRIPT>x</SCRIPT>", "A\nB"),
    "attributes": ("<a title='x>y' href=z>t</a>", "t"),
    "empty": ("", ""),
    "blank": (" \n ", ""),
}


@pytest.mark.parametrize("case", CASES)
def test_layout(case):
    html, text = CASES[case]
    assert visible_text(html) == text


def table_of(*rows):
    cells = ["".join(f"<td{' colspan=%d' % wide if wide > 1 else ''}>{text}" for text, wide in row) for row in rows]
    return visible_text("<table>" + "".join("<tr>" + c for c in cells) + "</table>").split("\n")


def test_long_words_leave_the_cells_after_them_in_place():
    assert table_of([("w" * 200, 1), ("x", 1)], [("a", 1), ("y", 1)]) == ["w" * 200, "   x", "a  y"]


def test_long_cells_are_wrapped_in_their_column():
    lines = table_of([("word " * 40, 1), ("x", 1)], [("a", 1), ("y", 1)], [("b", 1), ("last " * 40, 1)])
    assert lines == [
        ("word " * 16)[:79] + "  x",
        ("word " * 16)[:79],
        ("word " * 8)[:39],
        "a" + " " * 80 + "y",
        "b" + " " * 80 + ("last " * 40).strip(),
    ]


def test_spanning_cells_widen_their_columns():
    assert table_of([("spanning two", 2), ("x", 1)], [("a", 1), ("b", 1), ("y", 1)]) == [
        "spanning two  x",
        "a      b      y",
    ]
    # A span over columns that are wide enough, and one that nothing follows.
    assert table_of([("ab", 2), ("x", 1)], [("long", 1), ("er", 1), ("y", 1)], [("to the end of it", 3)]) == [
        "ab        x",
        "long  er  y",
        "to the end of it",
    ]


def test_aligned_text_in_cells_is_not_wrapped():
    inner = "<table><tr><td>" + "i" * 60 + "<td>" + "j" * 60 + "</table>"
    assert table_of([(inner, 1), ("x", 1)], [("a", 1), ("y", 1)]) == ["i" * 60 + "  " + "j" * 60, "   x", "a  y"]


@pytest.mark.parametrize("seed", range(40))
def test_every_cell_starts_at_its_column(seed):
    """Tables of random spans and lengths: a cell's own mark stands at one place per column."""
    rnd = random.Random(seed)
    rows, marks, n = [], {}, rnd.randrange(2, 6)
    for r in range(8):
        row, column = [], 0
        while column < n:
            wide = min(rnd.choice([1, 1, 1, 2, 3]), n - column)
            mark = f"m{r}.{column}"
            marks[mark] = column
            row.append((mark + rnd.choice(["", " word" * rnd.randrange(60), "w" * rnd.randrange(200)]), wide))
            column += wide
        rows.append(row)
    lines, places = table_of(*rows), {}
    for mark, column in marks.items():
        (at,) = {m.start() for line in lines for m in re.finditer(rf"{mark}(?!\d)", line)}
        assert places.setdefault(column, at) == at
    assert letters("".join(lines)) and sorted(letters("".join(lines))) == sorted(
        letters("".join(text for row in rows for text, _ in row))
    )


def test_any_text_is_read():
    rnd = random.Random(2)
    parts = "<p> </p> <table> <tr> <td> </table> <li> <ul> </ul> x <b <!-- --> <pre> </pre> <div > \" &amp; "
    parts = [*parts.split(" "), "<textarea>", "<script>", "</script>", "\n", "<td colspan=99999999>", "<svg>", "<head>"]
    for _ in range(3000):
        assert isinstance(visible_text("".join(rnd.choice(parts) for _ in range(rnd.randrange(40)))), str)


def test_very_long_and_deep_pages():
    assert visible_text("<div>" * 50_000 + "x") == "x"
    assert visible_text("<p " * 30_000) == ""
    assert visible_text("<!--" * 30_000) == ""
    assert visible_text("<li>" * 20_000 + "y").endswith("y")
    assert len(visible_text("<p>word</p>" * 20_000)) == 20_000 * 6 - 2


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (None, "<p>a"), (3, "<b>x</b>"), (3, "<b>x</b>")]
    pages = spark.createDataFrame([(i, h, "t") for i, h in rows], "page_id long, html string, text string")
    got = sorted((str(r["page_id"]), r["text"]) for r in extract_text(pages).collect())
    assert got == [("1", ""), ("2", ""), ("3", "x"), ("3", "x"), ("None", "a")]
    assert extract_text(pages.limit(0)).collect() == []
