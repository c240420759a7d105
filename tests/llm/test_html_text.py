import time

from pyspark.sql import functions as F

from zonepipe.llm.html_text import extract, extract_text


def test_implied_end_tags():
    assert extract("<p>one<p>two<div>three</div>four") == "one\n\ntwo\n\nthree\nfour"
    assert extract("<ul><li>a<li>b</ul>") == "- a\n- b"
    assert extract("<dl><dt>t<dd>d<dt>u<dd>e</dl>") == "t\n  d\nu\n  e"


def test_nested_and_numbered_lists():
    assert extract("<ol start=3><li>a<ul><li>x</ul><li>b</ol>") == "3. a\n   - x\n4. b"


def test_table_cells_are_aligned():
    page = "<table><caption>C</caption><thead><tr><th>name<th>n</thead><tr><td>a long one<td>1<tr><td>b<td>22</table>"
    assert extract(page) == "C\nname        n\na long one  1\nb           22"


def test_wide_and_spanning_cells():
    assert extract("<table><tr><td>你<td>x<tr><td>abc<td>y</table>") == "你   x\nabc  y"
    assert extract("<table><tr><td colspan=2>whole width here<td>z<tr><td>a<td>b<td>c</table>") == "whole width here  z\na  b  c"


def test_what_lies_outside_rows_and_cells_is_shown():
    assert extract("<table><tbody><form><tr><td>text</td></tr></form></tbody></table>") == "text"
    assert extract("<table><form><tr><td>a<td>b</tr><tr><td>c</form></table>") == "a  b\nc"
    assert extract("<table><tbody>some text<tr><td>a</table>") == "some text\na"
    assert extract("<table><tbody><div>text</div></tbody><tfoot>foot<tr><td>a</table>") == "text\nfoot\na"
    assert extract("<table><colgroup><col>loose<tr><td>a</table>") == "loose\na"
    assert extract("<table><tr><td>a<td>b<tr><form><td>c<td>d</form></table>") == "a  b\nc  d"
    assert extract("<table><tbody hidden>no<tr><td>no<tbody><noscript><tr><td>no</td></tr></noscript><tr><td>a</table>") == "a"


def test_nested_table_stays_in_its_cell():
    assert extract("<table><tr><td>a<td><table><tr><td>x<td>y</table></table>") == "a  x  y"


def test_visibility():
    page = (
        "<head><title>t</title><style>p{}</style></head><script>var a='</p>';</script><p hidden>no</p>"
        "<p style='color:red; display : none'>no</p><div style=visibility:hidden>no</div><template>no</template>"
        "<noscript>no</noscript><!-- no --><p>yes</p>"
    )
    assert extract(page) == "yes"


def test_formulas_and_texts_of_drawings_are_shown():
    formula = "<math><semantics><mrow><mi>x</mi><mspace width=1/><mo>=</mo><mn>1</mn></mrow><annotation>no</annotation></semantics></math>"
    assert extract(f"<p>so {formula} holds") == "so x=1 holds"
    drawing = "<svg>no<title>no</title><defs><text>no</text></defs><path d='M0'/><g><text>one <tspan>two</tspan></text></g><text>three</text></svg>"
    assert extract(f"a{drawing}b") == "a one two three b"
    assert extract("<svg><text display=none>no</text><text>yes</text></svg><svg/>after") == "yes after"


def test_visible_parts_of_hidden_elements_are_shown():
    page = "<div style='visibility:hidden'>no<img alt=no><p>no <b style='visibility: visible'>yes</b></div><p>end"
    assert extract(page) == "yes\n\nend"
    assert extract("<div style='visibility:visible'>a<i style=visibility:collapse>no</i></div>") == "a"


def test_text_and_inline_elements_end_an_open_head():
    assert extract("<head><title>t</title>Hello <b>world</b><p>x") == "Hello world\n\nx"
    assert extract("<head>\n<meta charset=utf-8> <style>p{}</style>\n<a href=x>link</a> y<p>x") == "link y\n\nx"
    assert extract("<head><noscript><img alt=no></noscript><title>t</title></head>x") == "x"


def test_white_space_and_breaks():
    assert extract("a  b\n\tc<br>d <b> e</b>f<hr>g") == "a b c\nd ef\n---\ng"
    assert extract("<pre>x\n  y</pre>z") == "x\n  y\n\nz"
    assert extract("<blockquote>q<p>r</blockquote>") == "  q\n\n  r"


def test_entities_and_attributes():
    assert extract("&lt;b&gt; &amp;&nbsp;x &eacute; <img alt='pic' src=x> <a href='a>b'>l</a>") == "<b> &\xa0x é pic l"


def test_broken_markup():
    assert extract("a < b <1> </nothing> <p") == "a < b <1>"
    assert extract("<div><p>x</div>y</p>z") == "x\n\nyz"
    assert extract("<script>never ends") == ""
    assert extract("<!-- never ends") == ""
    assert extract("") == "" and extract(None) is None and extract("<br>") == ""


def test_stray_and_unclosed_quotes():
    assert extract('<p class="a"">x</p><p "b>y</p>') == "x\n\ny"
    assert extract("<p>it's <b title=don't>bold</b> isn't it") == "it's bold isn't it"
    assert extract('<p>before <a href="never closed>and after') == "before"
    assert extract("<p>a<!-->b<!--->c") == "abc"


def test_cost_is_linear_in_odd_pages():
    # Each of these takes hours where a tag costs a look at the whole stack or the rest of the page.
    assert extract("<p>x" + '<a "' * 300_000) == "x"
    assert extract("<i>" * 100_000 + "<section>y</section></b>" * 100_000).startswith("y\ny\n")


def test_cost_of_nested_tags_behind_a_border():
    for page in ("<p><button>" + "<div>" * 40_000 + "x", "<table><tr><td><p><object>" + "<section>" * 40_000 + "</i>" * 40_000):
        began = time.perf_counter()
        extract(page)
        assert time.perf_counter() - began < 3
    assert extract("<p>a<button>b<div>c</button>d") == "ab\nc\nd"


def test_cells_over_several_rows():
    assert extract("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>") == "a  b\n   c"
    assert extract("<table><tr><td>a<td rowspan=0>bb<td>c<tr><td>d<td>e<tr><td>f<td>g</table>") == "a  bb  c\nd      e\nf      g"
    assert extract("<table><tr><td rowspan=2 colspan=2>a<td>b<tr><td>c<tr><td>d<td>e<td>f</table>") == "a     b\n      c\nd  e  f"
    # A section ends what reaches beyond it.
    assert extract("<table><thead><tr><th rowspan=9>a<th>b<tbody><tr><td>c<td>d</table>") == "a  b\nc  d"
    assert extract("<table><tr><td rowspan=x>a<td>b<tr><td>c<td>d</table>") == "a  b\nc  d"


def test_numbers_of_items_and_closed_parts():
    assert extract("<ol><li>a<li value=7>b<li>c<li value=x>d</ol>") == "1. a\n7. b\n8. c\n9. d"
    assert extract("<details><summary>s</summary>hidden<p>too</details>y") == "s\ny"
    assert extract("<details open><summary>s</summary>shown</details>y") == "s\nshown\ny"
    assert extract("<ruby>k<rp>(</rp><rt>r</rt><rp>)</rp></ruby>") == "kr"


def test_depth_and_length_are_no_obstacle():
    assert extract("<div>" * 20_000 + "x") == "x"
    assert extract("<ul><li>" * 2_000 + "x").endswith("x")
    assert extract("<table><tr><td>" * 500 + "x").endswith("x")
    assert len(extract("<p>" + "word " * 400_000)) == 5 * 400_000 - 1


def test_columns_are_carried_and_replaced(spark):
    rows = spark.createDataFrame([(1, "<p>a", "old"), (2, None, "old")], "id int, html string, text string")
    assert [tuple(r) for r in extract_text(rows).orderBy("id").collect()] == [(1, "<p>a", "a"), (2, None, None)]
    assert extract_text(rows.where(F.lit(False))).collect() == []
