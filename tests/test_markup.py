import random
from html.parser import HTMLParser

import pytest
from conftest import rows
from pyspark.sql import functions as F

from martwright.functions.text import WHITESPACE
from martwright.sources.markup import VOID, extract_elements, parse_selector, select_elements


class Plain(HTMLParser):
    """A tree of (tag, attributes, children) with a stack of open elements."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.root = ("", {}, [])
        self.stack = [self.root]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        found = {}
        for name, value in attrs:
            found.setdefault(name, value or "")
        node = (tag, found, [])
        self.stack[-1][2].append(node)
        if tag not in VOID:
            self.stack.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.stack.pop()

    def handle_endtag(self, tag):
        for at in range(len(self.stack) - 1, 0, -1):
            if self.stack[at][0] == tag:
                del self.stack[at:]
                return

    def handle_data(self, data):
        self.stack[-1][2].append(data)


def walk(node):
    for child in node[2]:
        if not isinstance(child, str):
            yield child
            yield from walk(child)


def text_of(node):
    if node[0] in ("script", "style"):
        return ""
    return "".join(c.strip(WHITESPACE) if isinstance(c, str) else text_of(c) for c in node[2])


def found(html, selector):
    out = []
    for node in walk(Plain(html).root):
        for s in parse_selector(selector):
            classes = node[1].get("class", "").split()
            if (
                s.tag in ("", node[0])
                and set(s.classes) <= set(classes)
                and all(a in node[1] for a in s.attributes)
            ):
                out.append((node[0], text_of(node), node[1].get("href")))
                break
    return out


PAGES = [
    "<div class=card>a<div class=card>b</div>c</div>d",
    '<div class="x card y"><h2>T</h2></div><DIV CLASS=\'card\n\tz\'>U</DIV><div class="cards">no</div>',
    "<article class=job><p>one<p>two</article><p>three",
    "<!-- <div class=card>no</div> --><div class=card>yes<!-- </div> -->still</div>",
    '<script>var t="</div><div class=card>no";</script><div class=card>s<script>x</script><style>p{}</style></div>',
    '<a href="/x?a=1&amp;b=2" class=card>l</a><a class=card>n</a><a href class=card>e</a><a href=/y/z/>u</a>',
    '<p title="class=card">no</p><p data-class=card>no</p><p title=\'a > b\' class=card>yes</p>',
    "<ul><li class=card>a<li class=card>b</ul>c<br class=card>d<img class='card'/>",
    "<div class=card/>x<p class=card>&nbsp;y &eacute;&#150;</p>", "</div></p><div class=card>", "", "a < b <3 <",
    "<b class=card>x</i>y</b>z</b><i class=card>open <b>end", "<h2 class=card> \n a <b> b </b>\xa0</h2>",
    "<!DOCTYPE html><?xml ?><html><body class='card'>t</body></html>", "<!-- open <div class=card>",
    "<div class=card class=other>first</div><div class=other class=card>first</div>",
]


def check(spark, pages, selector):
    df = spark.createDataFrame(list(enumerate(pages)), "id int, html string")
    got = select_elements(df, "html", selector, ["id"], ["href"])
    want = [(i, n, *e) for i, p in enumerate(pages) for n, e in enumerate(found(p, selector), 1)]
    assert rows(got, "id", "element_no") == want


@pytest.mark.parametrize("selector", [".card", "h2, p, .card", "div.card, a[href]", "li", "p.card, b, i"])
def test_elements_are_those_of_a_plain_parser(spark, selector):
    check(spark, PAGES, selector)


def test_random_markup(spark):
    rng = random.Random(8)
    parts = [
        "<div>", "<div class=card>", "</div>", "<p class='card big'>", "<p>", "</p>", "<span class=big>", "</span>",
        "<br>", "text ", " &amp; ", "<!-- <p> -->", "<script>'</p>'</script>", "<a href='#'>", "</a>", "<hr class=card />",
    ]
    pages = ["".join(rng.choices(parts, k=rng.randrange(40))) for _ in range(300)]
    check(spark, pages, "div.card, p, .big, a[href]")
    check(spark, pages, ".card.big, span, hr")


def test_long_pages(spark):
    pages = ["<li class=card>x</li>" * 2_000, "<div>" * 300 + "<p class=card>deep", "<p title='" + "a" * 100_000 + "' class=card>t"]
    check(spark, pages, ".card")


def test_cards(spark):
    html = (
        "<section class='card top'><h2>Outer</h2><span class=tag>T &amp; U</span>"
        "<div class=card><h3 class=x>Inner</h3><a href='/in'>i</a></div><a href=/out>o</a></section>"
        "<article class=job><b>no title</b></article><div class=card><h2> </h2></div>"
        "<article class='new job'><div class=title>Late</div></article>"
    )
    pages = spark.createDataFrame([("u", html), ("v", None), ("w", "")], "url string, html string")
    cards = extract_elements(
        pages, "html", ["url"], ".card, article.job",
        {"name": "h2, h3, .title", "tag": ".tag", "link": ("a[href]", "href")},
        {"tag": "Unknown", "link": F.col("url")}, required=["name"],
    )
    assert rows(cards, "card_no") == [
        ("u", 1, "Outer", "T & U", "/in"), ("u", 2, "Inner", "Unknown", "/in"), ("u", 5, "Late", "Unknown", "u"),
    ]


def test_selectors():
    assert [(s.tag, s.classes, s.attributes) for s in parse_selector("h2, .a.b-c, a[href], li.x[id][Title]")] == [
        ("h2", (), ()), ("", ("a", "b-c"), ()), ("a", (), ("href",)), ("li", ("x",), ("id", "title")),
    ]
    for wrong in ("", "a b", "h2,", "a > b", "#id"):
        with pytest.raises(ValueError):
            parse_selector(wrong)
