"""Elements of HTML pages by class, tag and attribute, in built-in functions.

A page is cut into an array of tokens (comments, scripts, tags, text). One pass over its tags
(`aggregate`) keeps the stack of open elements: a close tag ends the nearest open element of its
name and all that lie in it; what is open at the end ends there. An element is a range of tokens,
so cards may lie in cards, and its text is that of the tokens in between.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.functions.html import decode_references
from martwright.functions.text import strip

_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>"']++)"""
_ATTRIBUTE = rf"""[^\s=>/"']++(?:\s*+=\s*+{_VALUE})?+"""
_TOKEN = (
    r"(?is)<!--.*?(?:-->|\z)"
    r"""|<(script|style)(?=[\s/>])(?:[^>"']++|"[^"]*+"|'[^']*+')*+>.*?(?:</\1[\s/]*+>|\z)"""
    r"""|</?[a-z](?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
    r"|<[!?][^>]*+>|[^<]++|<"
)
# A slash at the end of a tag that is not part of a value without quotes.
_CLOSED = rf"(?is)^<[a-z][^\s/>]*+(?:[\s/]++{_ATTRIBUTE})*+\s*+/[\s/]*+>$"
_NAME = r"(?s)^</?([a-zA-Z][^\s/>]*+)"
# Elements without content.
VOID = (
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source",
    "track", "wbr",
)
RAW = ("script", "style")


def _attribute(name: str) -> str:
    """A pattern that finds an attribute of a tag by name; its value is group 1, 2 or 3."""
    name = re.escape(name)
    return (
        rf"(?is)^<[a-z][^\s/>]*+(?:[\s/]++(?!{name}(?:[\s=/>])){_ATTRIBUTE})*+[\s/]++{name}(?=[\s=/>])"
        r"""(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>"']++)))?+"""
    )


def _spelled(tag: Column, name: str) -> Column:
    return F.concat(*(F.regexp_extract(tag, _attribute(name), group) for group in (1, 2, 3)))


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a tag, references decoded; null if it has none of the name."""
    return F.when(tag.rlike(_attribute(name)), decode_references(_spelled(tag, name)))


@dataclass(frozen=True)
class Simple:
    """One alternative of a selector: a tag, classes (as spelled) and attributes it must have."""

    tag: str = ""
    classes: tuple[str, ...] = ()
    attributes: tuple[str, ...] = ()

    def holds(self, token: Column, name: Column) -> Column:
        held = name == self.tag if self.tag else F.lit(True)
        for c in self.classes:
            pattern = rf"(?s)(?:^|\s){re.escape(c)}(?:\s|$)"
            held = held & _spelled(token, "class").rlike(pattern)
        for a in self.attributes:
            held = held & token.rlike(_attribute(a))
        return held


def parse_selector(text: str) -> list[Simple]:
    """Alternatives such as `h2, .title, article.job, a[href]`, separated by commas."""
    found = []
    for part in text.split(","):
        match = re.fullmatch(r"([A-Za-z][\w-]*)?((?:\.[\w-]+)*)((?:\[[\w-]+\])*)", part.strip())
        if not match or not part.strip():
            raise ValueError(f"not a selector: {part.strip()!r}")
        classes = tuple(match[2].split(".")[1:])
        attributes = tuple(a.lower() for a in re.findall(r"\[([\w-]+)\]", match[3]))
        found.append(Simple((match[1] or "").lower(), classes, attributes))
    return found


def _matches(selector: str, token: Column, name: Column) -> Column:
    held = F.lit(False)
    for simple in parse_selector(selector):
        held = held | simple.holds(token, name)
    return held


def _tokens(html: Column) -> Column:
    return F.regexp_extract_all(html, F.lit(_TOKEN), F.lit(0))


def _tags(tokens: Column, selectors: Sequence[str]) -> Column:
    """(at, name, close, empty, mask) of every tag; bit k of the mask: selector k holds."""

    def named(token: Column, at: Column) -> Column:
        name = F.when(token.startswith("<"), F.lower(F.regexp_extract(token, _NAME, 1)))
        return F.struct(at.alias("at"), token.alias("token"), name.alias("name"))

    def parsed(tag: Column) -> Column:
        token, name = tag["token"], tag["name"]
        close = token.startswith("</")
        mask = F.lit(0)
        for k, selector in enumerate(selectors):
            mask = mask + F.when(_matches(selector, token, name), 1 << k).otherwise(0)
        empty = name.isin(*VOID, *RAW) | (token.endswith("/>") & token.rlike(_CLOSED))
        return F.struct(
            tag["at"].alias("at"),
            name.alias("name"),
            close.alias("close"),
            empty.alias("empty"),
            F.when(~close, mask).otherwise(0).alias("mask"),
        )

    # In two steps: an expression in a lambda is worked out wherever it stands.
    tags = F.filter(F.transform(tokens, named), lambda t: t["name"] != "")
    return F.transform(tags, parsed)


_OPEN = "array<struct<name:string,at:int,mask:int>>"
_FOUND = "array<struct<start:int,stop:int,mask:int>>"


def _elements(tags: Column, size: Column) -> Column:
    """(start, stop, mask) of the elements with a mask, in the order of their open tags.

    Only names and places of open elements are kept on the stack, its top first.
    """

    def ended(items: Column, stop: Column) -> Column:
        wanted = F.filter(items, lambda e: e["mask"] != 0)
        return F.transform(
            wanted,
            lambda e: F.struct(e["at"].alias("start"), stop.alias("stop"), e["mask"].alias("mask")),
        )

    def step(state: Column, tag: Column) -> Column:
        stack, found = state["stack"], state["found"]
        depth = F.array_position(F.transform(stack, lambda e: e["name"]), tag["name"]).cast("int")
        opened = F.array(F.struct(tag["name"].alias("name"), tag["at"].alias("at"), tag["mask"].alias("mask")))
        alone = F.array(
            F.struct(tag["at"].alias("start"), tag["at"].alias("stop"), tag["mask"].alias("mask"))
        )
        rest = F.slice(stack, depth + 1, F.size(stack))
        over = ended(F.slice(stack, F.lit(1), depth), tag["at"])

        def changed(stack: Column, found: Column) -> Column:
            return F.struct(stack.cast(_OPEN).alias("stack"), found.cast(_FOUND).alias("found"))

        closed = F.when(depth > 0, changed(rest, F.concat(found, over))).otherwise(state)
        void = F.when(tag["mask"] != 0, changed(stack, F.concat(found, alone))).otherwise(state)
        return (
            F.when(tag["close"], closed)
            .when(tag["empty"], void)
            .otherwise(changed(F.concat(opened, stack), found))
        )

    nothing = F.struct(
        F.array().cast(_OPEN).alias("stack"), F.array().cast(_FOUND).alias("found")
    )
    return F.aggregate(
        tags, nothing, step,
        lambda state: F.array_sort(F.concat(state["found"], ended(state["stack"], size))),
    )


def _pieces(tokens: Column) -> Column:
    """The text of each token, decoded and stripped; empty for all that is no text."""
    return F.transform(
        tokens,
        lambda t: F.when(t.startswith("<") & (F.length(t) > 1), F.lit("")).otherwise(
            strip(decode_references(t))
        ),
    )


def _text(pieces: Column, element: Column) -> Column:
    inner = F.greatest(element["stop"] - element["start"] - 1, F.lit(0))
    return F.array_join(F.slice(pieces, element["start"] + 2, inner), "")


def _parsed(pages: DataFrame, html: str, selectors: Sequence[str]) -> DataFrame:
    """The pages with `_tokens`, `_pieces` and `_elements`."""
    cut = pages.withColumn("_tokens", _tokens(F.coalesce(F.col(html), F.lit(""))))
    return cut.withColumn("_pieces", _pieces(F.col("_tokens"))).withColumn(
        "_elements", _elements(_tags(F.col("_tokens"), selectors), F.size("_tokens"))
    )


def select_elements(
    pages: DataFrame, html: str, selector: str, keep: Sequence[str], attributes: Sequence[str] = ()
) -> DataFrame:
    """One row per element that a selector finds, in page order: its number, tag, text, and the
    named attributes. Elements within elements are rows of their own. Narrow: no shuffle."""
    parsed = _parsed(pages, html, [selector])

    def read(element: Column) -> Column:
        token = F.get(F.col("_tokens"), element["start"])
        return F.struct(
            F.lower(F.regexp_extract(token, _NAME, 1)).alias("tag"),
            _text(F.col("_pieces"), element).alias("text"),
            *(attribute(token, a).alias(a) for a in attributes),
        )

    # Read within the page, so that the rows do not carry its tokens.
    return _exploded(parsed, F.transform("_elements", read), keep, "element_no")


def _exploded(parsed: DataFrame, found: Column, keep: Sequence[str], number: str) -> DataFrame:
    rows = parsed.select(*keep, F.posexplode_outer(found).alias("_no", "_found"))
    return rows.filter(F.col("_found").isNotNull()).select(
        *keep, (F.col("_no") + 1).alias(number), "_found.*"
    )


def extract_elements(
    pages: DataFrame,
    html: str,
    keep: Sequence[str],
    card: str,
    fields: Mapping[str, str | tuple[str, str]],
    defaults: Mapping[str, str | Column] | None = None,
    required: Sequence[str] = (),
) -> DataFrame:
    """One row per card that the selector `card` finds, with its number and one column per field.

    A field is a selector, for the text of the first element it finds within the card, or a pair
    (selector, attribute). A field without an element takes its default; cards without a `required`
    element are dropped. Blank text counts as no text for required fields. Narrow: no shuffle.
    """
    defaults = defaults or {}
    pairs = {n: (f, None) if isinstance(f, str) else f for n, f in fields.items()}
    parsed = _parsed(pages, html, [card, *(s for s, _ in pairs.values())])
    kinds = [wanted for _, wanted in pairs.values()]

    def first_each(card: Column) -> Column:
        return F.struct(*(_first_within(card, k).alias(f"f{k}") for k in range(len(pairs))))

    def read(firsts: Column) -> Column:
        values = []
        for k, wanted in enumerate(kinds):
            element = firsts[f"f{k}"]
            value = (
                _text(F.col("_pieces"), element)
                if wanted is None
                else attribute(F.get(F.col("_tokens"), element["start"]), wanted)
            )
            values.append(F.when(element.isNotNull(), value).alias(f"_value_{k}"))
        return F.struct(*values)

    # In two steps, so that the first element of a field is looked for once.
    cards = F.filter("_elements", lambda e: e["mask"].bitwiseAND(F.lit(1)) != 0)
    found = F.transform(F.transform(cards, first_each), read)
    rows = _exploded(parsed, found, [c for c in pages.columns if c != html], "card_no")
    out, needed = [], F.lit(True)
    for k, name in enumerate(pairs):
        value = F.col(f"_value_{k}")
        if name in required:
            needed = needed & (F.coalesce(value, F.lit("")) != "")
        default = defaults.get(name)
        if default is not None:
            value = F.coalesce(value, default if isinstance(default, Column) else F.lit(default))
        out.append(value.alias(name))
    return rows.filter(needed).select(*keep, "card_no", *out)


def _first_within(card: Column, k: int) -> Column:
    """The first element of field k that starts within the card."""
    bit = F.lit(2 << k)
    return F.get(
        F.filter(
            "_elements",
            lambda e: (e["mask"].bitwiseAND(bit) != 0)
            & (e["start"] > card["start"])
            & (e["start"] < card["stop"]),
        ),
        F.lit(0),
    )
