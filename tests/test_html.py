"""The parse helper: numbering, serialising, auto-closing, stray tags."""

import random
import time

import pytest

from pagegrain.functions.htmlnodes import PageNodes, wanted_by
from pagegrain.operators import nodes as N


def keep_all(tag, attrs, path):
    return 2


def nodes(html, keep=keep_all):
    return PageNodes(html, keep).nodes


def test_serialises_lower_case_double_quoted_and_escaped():
    page = PageNodes("<DIV Class=x DATA-a='1&amp;2'>a & b<BR/>c</DIV>", keep_all)
    assert page.html == '<div class="x" data-a="1&amp;2">a &amp; b<br>c</div>'


def test_paragraphs_items_and_cells_close_their_predecessor():
    assert PageNodes("<p>a<p>b<ul><li>1<li>2</ul>", keep_all).html == "<p>a</p><p>b</p><ul><li>1</li><li>2</li></ul>"
    assert PageNodes("<table><tr><td>1<td>2<tr><td>3</table>", keep_all).html == (
        "<table><tr><td>1</td><td>2</td></tr><tr><td>3</td></tr></table>")


def test_nested_list_items_do_not_close_the_outer_one():
    assert PageNodes("<ul><li>a<ul><li>b</ul>c</ul>", keep_all).html == "<ul><li>a<ul><li>b</li></ul>c</li></ul>"


def test_unmatched_end_tag_is_dropped_and_open_tags_are_closed():
    assert PageNodes("<div>a</span></p>b", keep_all).html == "<div>ab</div>"


def test_end_tag_does_not_reach_over_a_cell():
    assert PageNodes("<div><table><tr><td>a</div>b</table></div>", keep_all).html == (
        "<div><table><tr><td>ab</td></tr></table></div>")


def test_script_text_is_raw():
    page = PageNodes('<script>var a="</p>&amp;";</script>x', keep_all)
    assert page.nodes[0][8] == 'var a="</p>&amp;";'
    assert page.html == '<script>var a="</p>&amp;";</script>x'


def test_interval_parent_level_and_position():
    found = {(n[4], n[0]): n for n in nodes("<div><p>a</p><p>b<i>c</i></p></div>")}
    div, second = found[("div", 1)], found[("p", 4)]
    assert (div[0], div[1]) == (1, 7)
    assert (second[2], second[3], second[5], second[6]) == (1, 2, 2, "/div/p")
    assert found[("i", 6)][2] == 4


def test_only_wanted_nodes_come_out():
    keep = wanted_by([("a", "href", "starts", "/x", False), ("li", None, "eq", "", True)])
    got = nodes('<ul><li><a href="/x1">1</a><li><a href="/y">2</a></ul>', keep)
    assert [(n[4], n[9]) for n in got] == [
        ("li", '<li><a href="/x1">1</a></li>'), ("a", None), ("li", '<li><a href="/y">2</a></li>')]


def test_comments_doctype_and_unclosed_comment_are_dropped():
    assert PageNodes("<!DOCTYPE html><!-- <p> --><b>x</b><!-- open", keep_all).html == "<b>x</b>"


def test_lone_angle_bracket_is_text():
    assert PageNodes("a < b and <p>c", keep_all).html == "a &lt; b and <p>c</p>"


def timed(html, keep=None):
    start = time.process_time()
    page = PageNodes(html, keep or wanted_by([("b", None, "eq", "", False, False)]), with_html=False)
    return page, time.process_time() - start


@pytest.mark.parametrize("html", [
    "<font>" * 100_000, "<div>" * 100_000, "<li><b>" * 50_000, "<i>" * 4_000 + "</u>" * 100_000, "<p><table><tr><td>" + "<font>" * 50_000 + "</p>" * 50_000,
    "<font>" * 50_000 + "<div>" * 50_000, "<a " * 100_000, "<b>" + "x<br>" * 100_000 + "</b>", "<!--" * 100_000, "<a title='" * 50_000 + ">"])
def test_no_page_takes_more_than_its_length(html):
    """Unclosed tags, end tags nobody opened, brackets without an end: time and memory grow with the page."""
    _, seconds = timed(html)
    assert seconds < 20


def test_deep_nesting_numbers_nodes():
    page, _ = timed("<b>" * 100_000 + "x")
    assert len(page.nodes) == 100_000 and page.nodes[0][1] == 100_001 and page.nodes[-1][2] == 99_999 and page.nodes[0][6] is None


def test_descendants_of_many_nodes(spark):
    """The merge by order gives what comparing all pairs gives, also where ancestors nest; its time grows with the nodes."""
    rng = random.Random(3)
    html = "".join(rng.choice(["<div>", "</div>", "<b>x</b>", "<ul><li>", "</ul>", "<div class='a'>"]) for _ in range(3000))
    docs = N.parse_nodes(spark.createDataFrame([(1, html)], "page_id int, html string"), [N.Test("div"), N.Test("li"), N.Test("b")], ["page_id"])
    up, below = N.select(N.ALL, N.Test("div", "class", "eq", "a")), N.select(N.ALL, N.Test("b"), N.Test("div"))
    row = docs.select(N.ALL.col.alias("all"), N.descendants(up, below).col.alias("got"), N.children(up, below).col.alias("kids"), N.count(up).alias("n")).first()
    marks = [(n.pre, n.end) for n in row["all"] if n.tag == "div" and n.attrs.get("class") == "a"]
    wanted = [n for n in row["all"] if n.tag in ("b", "div")]
    assert row["n"] > N.FEW
    assert [n.pre for n in row["got"]] == [n.pre for n in wanted if any(p < n.pre <= e for p, e in marks)]
    assert [n.pre for n in row["kids"]] == [n.pre for n in wanted if n.parent in {p for p, _ in marks}]
    wide = "<ul>" + "<li><b>x</b></li>" * 25_000 + "</ul>"
    docs = N.parse_nodes(spark.createDataFrame([(1, wide)], "page_id int, html string"), [N.Test("li"), N.Test("b")], ["page_id"])
    start = time.time()
    assert docs.select(N.count(N.descendants(N.select(N.ALL, N.Test("li")), N.select(N.ALL, N.Test("b")))).alias("n")).first()["n"] == 25_000
    assert time.time() - start < 30
