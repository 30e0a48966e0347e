"""Main text of pages: parsing, wrappers, templates, and hand-made pages of many kinds."""

import html
import random
import re

import pytest

from gridops.llm import pagetext
from gridops.llm.pagetext import Node, match_children, match_weight, merged, parse_page, skeleton, tree_of
from gridops.llm.queries import QUERIES
from tests.conftest import SMALL

SCHEMA = "page_id long, url string, html string, host string, text string"


def article(page):
    return "\n".join(t for _, s, t in parse_page(page)[1] if s)


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain  words\n here", "plain words here"),
        ("<p>a<p>b</p>c", "a\nb\nc"),
        ("<p>one <b>bo</b>ld<br>next&nbsp;&amp;&lt;x&gt; &#233;&eacute; &am &amp</p>", "one bold next &<x> éé &am &"),
        ("<nav>menu</nav><article><h1>T</h1><p>x<script>if(a<b)'</p>'</script>y</p></article><footer>f</footer>", "T\nxy"),
        ("<body class='no-sidebar'><header>site</header><main><h1>T</h1><p>x</p><aside>more</aside></main>", "T\nx"),
        ("<article><header><h1>T</h1></header><p>x</p><section class='comments'><article>c</article></section></article>", "T\nx"),
        ("<div id=cookie-consent>We use</div><div class='page-header'>H</div><div>x</div><form>q<input></form>", "x"),
        ("<form id=f1><div><article><p>x</p></article></div><p>button</p></form>", "x"),
        ("<div><ul><li><a href=/a>A</a><li><a href=/b>B</a></ul></div><p><a href=/c>kept</a></p>", "kept"),
        ("<!-- <p>no</p> --><p>yes</p><!-- cut <p>no", "yes"),
        ("<p>a < b and c<d e=\"x>y\">f</d></p><p class='", "a < b and cf"),
        ("<ul><li>a<ul><li>b<li>c</ul><li>d</ul>", "a\nb\nc\nd"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b\nc"),
        ("<article>a</article><div role=complementary>x</div><article>b</article>", "a\nb"),
        ("<article><p>x</p><div class='ad-slot'>buy</div><p>y</p><button>go</button></article>", "x\ny"),
        ("<title>t</title><style>s{}</style><noscript>n</noscript><p>x", "x"),
    ],
)
def test_article_of_one_page(page, text):
    assert article(page) == text


def test_odd_markup_never_fails():
    rnd = random.Random(3)
    bits = ["<p>", "</p>", "<article>", "</article>", "<nav", ">", "<!--", "-->", '"', "'", "=", "&amp", "&#x;", "x ", "</", "<a href=", "<li>", "<td>", "<script>", "</script>", "<b>", "\x00", "é", "<br/>", "<select>", "</div>", "<div class='ad"]
    for _ in range(3000):
        line, blocks = parse_page("".join(rnd.choice(bits) for _ in range(rnd.randrange(40))))
        assert skeleton(tree_of(line)) == line and all(t.strip() for _, _, t in blocks)
    assert article("<div>" * 3000 + "deep") == "deep"


def brute_weight(a, b):
    """Most matched pairs, over all ways to align the children."""
    if a.label != b.label:
        return 0

    def best(x, y):
        if not x or not y:
            return 0
        return max(best(x[1:], y), best(x, y[1:]), brute_weight(x[0], y[0]) + best(x[1:], y[1:]))

    return 1 + best(a.children, b.children)


def test_tree_matching_equals_trying_everything():
    rnd = random.Random(6)

    def tree(depth):
        return Node(rnd.choice("ab") if depth else "r", [tree(depth + 1) for _ in range(rnd.randrange(4 - depth))] if depth < 3 else [])

    for _ in range(150):
        a, b = tree(0), tree(0)
        assert match_weight(a, b) == brute_weight(a, b) == 1 + sum(w for *_, w in match_children(a.children, b.children))
        both = merged(a, b)
        assert both.size == a.size + b.size - match_weight(a, b)
        assert match_weight(both, a) == a.size and match_weight(both, b) == b.size


def page(i, host="a.example", extra="", top="<div><p>Welcome to our site</p></div>", items=("Home", "News")):
    menu = "".join(f"<p>{x}</p>" for x in items)
    return (i, f"https://{host}/p/{i}", f"<html><body>{top}<div>{menu}</div><div><p>Story number {i}</p><p>It has text {i * 7}</p>{extra}</div><div><p>All rights reserved</p></div></body></html>", "x", "y")


def test_constant_slots_are_template(spark):
    rows = [page(i) for i in range(9)] + [page(20, extra="<p>Only here</p>"), page(21, top="")] + [page(i, host="b.example") for i in range(30, 33)]
    copies = [(i, "http://c.example/x", "<article><h1>Same</h1><p>The same words</p></article>" + f"<p>{i}</p>", "", "") for i in range(40, 50)]
    odd = [(60, None, None, None, None), (60, None, None, None, None), (None, "no url", "<p>x</p>", "", ""), (61, "https://a.example", "", "", "")]
    df = spark.createDataFrame(rows + copies + odd, SCHEMA).repartition(4)
    got = {}
    for r in pagetext.extract_main_text(df).collect():
        got.setdefault(r["page_id"], []).append(r["text"])
        assert r["n_chars"] == len(r["text"])
    for i in range(9):
        assert got[i] == [f"Story number {i}\nIt has text {i * 7}"]
    assert got[20] == ["Story number 20\nIt has text 140\nOnly here"] and got[21] == ["Story number 21\nIt has text 147"]
    # Too few pages to tell, and an article that is the same on all pages.
    assert got[30][0].startswith("Welcome") and all(got[i] == ["Same\nThe same words"] for i in range(40, 50))
    assert got[60] == ["", ""] and got[None] == ["x"] and got[61] == [""]
    assert pagetext.extract_main_text(df.limit(0)).count() == 0


def test_texts_do_not_depend_on_partitions_or_broadcast(spark, monkeypatch):
    df = spark.createDataFrame([page(i, host=f"{i % 3}.example", items=("A", f"B{i % 2}")) for i in range(60)], SCHEMA)
    one = sorted(map(tuple, pagetext.extract_main_text(df.coalesce(1)).collect()))
    monkeypatch.setattr(pagetext, "bounded_broadcast", lambda small: small)
    assert one == sorted(map(tuple, pagetext.extract_main_text(df.repartition(7)).collect()))


def test_query_finds_the_articles(spark):
    def expected(source):
        own = re.search("<article>(.*?)</article>", source, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("</?b>", "", x).replace("<br>", " ")).split()) for x in re.split("</?(?:p|h1)>", own)]
        return "\n".join(filter(None, parts))

    pages = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SMALL}/pages.parquet").collect()}
    got = {r["page_id"]: r["text"] for r in QUERIES["op13_html_extraction"](spark, SMALL).collect()}
    assert got == {i: expected(h) for i, h in pages.items()}
