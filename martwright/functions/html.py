"""Text of HTML: character references and tags, as column expressions without Python."""

from __future__ import annotations

import html
import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from martwright.functions.text import column, strip

_FREQUENT = ["amp;", "nbsp;", "quot;", "lt;", "gt;", "copy;", "middot;", "apos;", "hellip;", "ndash;"]
#: Names that also stand without a semicolon, whatever follows them.
_OPEN_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))
#: What names stand for, frequent ones first, and the numbers below 160 (not always that character).
_TABLE = (
    {n: html5[n] for n in _FREQUENT} | html5 | {str(n): html.unescape(f"&#{n};") for n in range(160)}
)
_REFERENCE = r"^(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_UNKNOWN = "\ufffd"


def _lookup(key: Column) -> Column:
    # The table is parsed once, when the plan is made.
    return F.try_element_at(F.from_json(F.lit(json.dumps(_TABLE)), "map<string,string>"), key)


def _number(reference: Column) -> Column:
    """The number of `#123;` or `#x7B;`; null if it is too large for any character."""
    digits = F.regexp_replace(F.regexp_extract(reference, "([0-9a-fA-F]+);?$", 1), "^0+(?=.)", "")
    short = F.when(F.length(digits) <= 8, digits)
    return F.when(reference.rlike("^#[xX]"), F.conv(short, 16, 10)).otherwise(short).try_cast("long")


def _character(number: Column) -> Column:
    """The character of a number from 160 on; nothing for a number of no character."""
    valid = number.between(0, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    no_character = (
        number.between(0xFDD0, 0xFDEF) | (number.bitwiseAND(F.lit(0xFFFE)) == 0xFFFE)
    )
    letter = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    found = F.when(valid, F.when(no_character, F.lit("")).otherwise(letter))
    return F.coalesce(found, F.lit(_UNKNOWN))


def _value(reference: Column) -> Column:
    """What a reference (without its ampersand) stands for, and what is left of it; null if it is
    none."""
    numeric = reference.startswith("#")
    number = _number(reference)
    key = F.when(~numeric, reference).when(number < 160, number.cast("string"))
    name = F.regexp_extract(reference, f"^(?:{'|'.join(_OPEN_NAMES)})", 0)
    rest = F.substr(reference, F.length(name) + 1)
    # A number must not be read as a key spelled with digits.
    exact = F.when(numeric | reference.rlike("^[A-Za-z]"), _lookup(key))
    other = F.when(numeric, _character(number)).when(name != "", F.concat(_lookup(name), rest))
    return F.coalesce(exact, other)


def decode_references(c: Column | str) -> Column:
    """All character references of the HTML standard decoded, each once; other ampersands stay.

    Names with and without a semicolon, decimal and hexadecimal numbers; numbers 128 to 159 mean
    Windows-1252, numbers of no character give nothing or U+FFFD. Texts without an ampersand are
    left as they are.
    """
    text = column(c)

    def decoded(piece: Column, i: Column) -> Column:
        reference = F.regexp_extract(piece, _REFERENCE, 0)
        whole = F.concat(_value(reference), F.substr(piece, F.length(reference) + 1))
        missing = F.concat(F.lit("&"), piece)
        return F.when(i == 0, piece).otherwise(
            F.when(reference == "", missing).otherwise(F.coalesce(whole, missing))
        )

    pieces = F.array_join(F.transform(F.split(text, "&"), decoded), "")
    return F.when(text.contains("&"), pieces).otherwise(text)


def html_text(c: Column | str) -> Column:
    """The text of an HTML fragment: tags dropped, each text piece decoded, then stripped."""
    pieces = F.split(column(c), "<[^>]*>")
    return F.array_join(F.transform(pieces, lambda p: strip(decode_references(p))), "")
