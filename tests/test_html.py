import html
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from martwright.functions import decode_references, html_text

FRAGMENTS = [
    "a &amp; b", "&amp;amp;", "&amp;lt;", "&lsqb;x&rsqb;", "&period;", "&copy 2020", "&eacute b", "&#150;",
    "&#0;", "&#00065;", "&#x0041;", "&#X41", "&#65x", "&notin; &notit; &not it", "&ampx", "&amplt;",
    "&#55296;", "&#1114112;", "&#99999999999999999999;", "&#xffffffffff;", "&#11;", "&#13;", "&#xfdd0;",
    "&#128;&#129;&#159;", "&", "&&", "&;", "&#;", "&#x;", "& amp;", "&unknown;", "&CounterClockwiseContourIntegral;",
    "&acE;", "&thetasym;", "&frac12", "&hellip;&ndash;&middot;", "&#x1F600;", "&" + "a" * 40 + ";", "é&eacute;", "",
    "&nbsp;", "&#xfffe;&#x1ffff;", "no reference", "&#038;lt;",
]


def test_references_are_those_of_the_standard(one):
    assert one(decode_references("c"), *FRAGMENTS, None) == [*map(html.unescape, FRAGMENTS), None]


def test_every_name(one):
    names = list(html.entities.html5)
    assert one(decode_references("c"), *(f"&{n}!" for n in names)) == [
        html.unescape(f"&{n}!") for n in names
    ]


def test_numbers(one):
    rng = random.Random(2)
    numbers = [*range(300), *(rng.randrange(0x110010) for _ in range(500))]
    texts = [f"&#{n}{rng.choice(';x')}" for n in numbers] + [f"&#x{n:x};" for n in numbers]
    assert one(decode_references("c"), *texts) == list(map(html.unescape, texts))


def test_any_text(one):
    found = []

    @settings(max_examples=400, deadline=None)
    @given(st.lists(st.sampled_from(["&", "#", "x", ";", "amp", "lt", "1", "65", "f", " ", "not", "in", "é"]), max_size=8))
    def collect(parts):
        found.append("".join(parts))

    collect()
    assert one(decode_references("c"), *found) == list(map(html.unescape, found))


def test_html_text(one):
    assert one(html_text("c"), " <b>Two </b> words &amp;amp; <i>x</i>") == ["Twowords &amp;x"]
    assert one(html_text("c"), "<p>&nbsp; end&nbsp;</p> &#160;<b>\n</b>", None, "") == ["end", None, ""]
