import random

import pytest

from sendero.llm.html_text import cell_width, extract, render


def test_blocks_and_implied_tags():
    assert render("<p>a<p>b <b>c\n d</b><div>e</div>f") == "a\n\nb c d\n\ne\nf"
    assert render("a<br>b<br><br>c") == "a\nb\n\nc"
    assert render("x </p> y </zz> z < 3 &amp; &lt;b&gt;") == "x y z < 3 & <b>"
    assert render("<pre> a\n  b</pre>c") == " a\n  b\n\nc"


def test_visibility():
    page = "<html><head><title>no</title><style>p{}</style></head><body>yes<script>var t='</p>';</script><!-- no --><p hidden>no<p style='display: none'>no<div style='visibility:hidden'>no<b style='visibility:visible'>seen</b></div><noscript>no</noscript><template>no</template>"
    assert render(page) == "yes\nseen"
    assert render("<title>t</title>body") == "body"


def test_lists():
    assert render("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>e") == "- a\n- b\n  - c\n- d\n\ne"
    assert render("<ol start=9><li>a<li>b<p>c</ol>") == "9. a\n10. b\n\n    c"


def test_tables():
    assert render("<table><tr><th>k<th>value<tr><td>long<td>1<tr><td colspan=2>both</table>x") == "k     value\nlong  1\nboth\n\nx"
    assert render("<table><caption>cap<tr><td>a<br>b<td>c</table>") == "cap\na  c\nb"
    assert render("<table><td><table><td>i<td>j</table><td>k</table>") == "i  j  k"


def test_odd_pages():
    assert [render(x) for x in (None, "", " ", "<", "<a", "<!--", "</", "<p", "a<b", "<a href='x")] == ["", "", "", "<", "", "", "", "", "a", ""]
    deep = "<div>" * 50_000 + "x"
    assert render(deep) == "x"
    assert render("<b>" * 20_000 + "<li>x" * 3).count("x") == 3
    assert render("a" * 1_000_000 + "<br>" * 10).startswith("aaa")


def test_frames(spark):
    rows = [(1, "<p>a", 1), (1, "<p>a", 1), (None, None, 2), (2, "", 3)]
    pages = spark.createDataFrame(rows, "page_id bigint, html string, text int")
    assert sorted((r.text for r in extract(pages).collect())) == ["", "", "a", "a"]
    assert extract(pages.limit(0)).count() == 0


def test_formulas_and_drawings_are_text():
    assert render("<p>If <math><mi>x</mi><mo>=</mo><mn>1</mn></math> then") == "If x=1 then"
    assert render("<p>see <svg><path d='M0'/><defs><text>no</text></defs><title>no</title><text>north</text><text>south</text></svg> here") == "see north south here"
    assert render("<svg><title/><defs/><text>a</text></svg><math><semantics><mi>y</mi><annotation>no</annotation></semantics></math>") == "a y"
    assert render("<symbol>shown</symbol>") == "shown"


def test_only_whole_properties_hide():
    assert render("<p style='backface-visibility: hidden'>a<p style='--display:none'>b<p style='color:red; visibility : HIDDEN'>c<p style='color:red;display:none'>d") == "a\n\nb"


def test_raw_end_tags_in_any_case():
    assert render("\u0130<SCRIPT>var a;</SCRIPT>after<style>x</STYLE >more<script>'</scripts>'</script>end") == "\u0130aftermoreend"


def test_wide_columns_are_aligned():
    wide = "w" * 300
    lines = render(f"<table><tr><td>{wide}<td>a<tr><td>x<td>b<tr><td>y<td></table>").split("\n")
    assert lines == [f"{wide}  a", "x".ljust(302) + "b", "y"]


def test_short_comments():
    assert render("<p>a</p><!--><p>b</p>-->c") == "a\n\nb\n\n-->c"
    assert render("a<!--->b<!-- x --!>c<!-- - -> -->d<!---->e") == "abcde"


def test_rows_and_widths():
    assert render("<table><tr><td rowspan=2>A<td>b<tr><td>c<tr><td>d<td>e</table>") == "A  b\n   c\nd  e"
    assert render("<table><tr><td>x<td rowspan=0>y<td>z<tr><td>p<td>q<tr><td>r<td>s</table>") == "x  y  z\np     q\nr     s"
    assert render("<table><tr><td>日本<td>b<tr><td>abcde<td>c<tr><td>e\u0301e<td>d</table>") == "日本   b\nabcde  c\ne\u0301e     d"
    assert render(f"<table><tr><td>{'z' * 300}<td>b<tr><td>q<td>c</table>") == f"{'z' * 300}  b\nq{' ' * 301}c"


def test_columns_line_up():
    rng = random.Random(3)
    for _ in range(200):
        n = rng.randrange(1, 6)
        rows = [["".join(rng.choice("ab日e\u0301") for _ in range(rng.randrange(1, 9))).lstrip("\u0301") + "." for _ in range(n)] for _ in range(rng.randrange(1, 5))]
        lines = render("<table>" + "".join("<tr>" + "".join(f"<td>{c}" for c in row) for row in rows) + "</table>").split("\n")
        width = [max(cell_width(row[k]) for row in rows) for k in range(n)]
        for row, line in zip(rows, lines, strict=True):
            assert line == "  ".join(c + " " * (w - cell_width(c)) for c, w in zip(row, width, strict=True)).rstrip()


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("<p>a<dialog><p>no</p></dialog></p><dialog open>yes</dialog>", "a\n\nyes"),
        ("<details><summary>head</summary>body<p>more</details><p>x", "head\n\nx"),
        ("<details open><summary>head</summary>body</details>", "head\nbody"),
        ("<details>body only</details>x", "x"),
        ("<div popover>tip</div><ruby>字<rp>(</rp><rt>zi</rt><rp>)</rp></ruby>", "字zi"),
        ("<ol><li>a<li value=9>b<li>c</ol>", "1. a\n9. b\n10. c"),
        ("<ol type=a start=26><li>x<li>y</ol>", "z. x\naa. y"),
        ("<ol type=I><li>x<li value=49>y<li type=1>z<li value=0>n</ol>", "I. x\nXLIX. y\n50. z\n0. n"),
        ("<ol reversed><li>a<li>b<li>c</ol>", "3. a\n2. b\n1. c"),
        ("<ol reversed start=2><li>a<li>b<li>c</ol>", "2. a\n1. b\n0. c"),
        ("say<textarea>hello</textarea><button>go</button>now", "say hello go now"),
        ("<style>.x{display:none}</style><p class=x>rules of sheets are not applied", "rules of sheets are not applied"),
    ],
)
def test_what_is_open_and_how_lists_count(html, text):
    assert render(html) == text
